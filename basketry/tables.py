"""The set of input tables handed from the sources to the operators."""

from __future__ import annotations

from dataclasses import dataclass, fields

from pyspark.sql import DataFrame


@dataclass(frozen=True)
class RetailTables:
    stores: DataFrame
    items: DataFrame
    transactions: DataFrame
    oil: DataFrame
    holidays_events: DataFrame
    train: DataFrame
    test: DataFrame | None = None

    def present(self) -> dict[str, DataFrame]:
        named = {field.name: getattr(self, field.name) for field in fields(self)}
        return {name: frame for name, frame in named.items() if frame is not None}
