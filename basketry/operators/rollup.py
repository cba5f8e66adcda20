"""Stored summaries of sales and the choice of the one a report is answered from.

A summary holds, for each combination of its keys, the parts that add up: ``rows``, ``known`` (rows with
a sales figure) and their sum, kept under the name ``unit_sales`` so that reports written for
the wide sales table read a summary unchanged: any sum over it is the sum over the sales.
The calendar follows from the date and a store's attributes from its number, so they need no
room in a summary and are added when it is read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.functions.calendar import add_calendar
from basketry.operators.enrich import join_stores
from basketry.operators.lookup import Lookup

#: Keys of the finest summary.
FINEST = ("date", "store_nbr", "item_family", "onpromotion")

#: Coarser ones, each computed from the smallest that covers it.
COARSER = (
    ("date", "item_family", "onpromotion"),
    ("date", "store_nbr"),
    ("date", "onpromotion"),
    ("store_nbr", "item_family", "onpromotion"),
)

#: All of them, those first that have few cells even with many stores.
BY_SIZE = (COARSER[2], COARSER[0], COARSER[3], COARSER[1], FINEST)

PARTS = ("rows", "known", "unit_sales")

_CALENDAR = (
    "year", "month", "week_of_year", "day_of_month", "day_of_week",
    "is_weekend", "is_payday", "is_month_start", "is_month_end",
)
_OF_STORE = ("city", "state", "store_type", "store_cluster")

#: Columns that follow from a key.
FOLLOWS = {**dict.fromkeys(_CALENDAR, "date"), **dict.fromkeys(_OF_STORE, "store_nbr")}


def summarise(sales: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The summary of single sales by ``keys``."""
    return sales.groupBy(*keys).agg(
        F.count("*").alias("rows"),
        F.count("unit_sales").alias("known"),
        F.sum("unit_sales").alias("unit_sales"),
    )


def coarsen(summary: DataFrame, keys: Sequence[str]) -> DataFrame:
    """A summary by fewer keys; sums keep their type, so that summaries can replace each other."""
    kind = summary.schema["unit_sales"].dataType
    return summary.groupBy(*keys).agg(
        F.sum("rows").alias("rows"),
        F.sum("known").alias("known"),
        F.sum("unit_sales").cast(kind).alias("unit_sales"),
    )


def keys_needed(columns: Iterable[str]) -> frozenset[str] | None:
    """Keys a summary must have to offer the columns; None if no summary can."""
    wanted = {FOLLOWS.get(column, column) for column in columns} - set(PARTS)
    return frozenset(wanted) if wanted <= set(FINEST) else None


def _with_calendar(frame: DataFrame) -> DataFrame:
    """The calendar of each date; a stored ``year`` stays, as filters on it choose folders."""
    if "year" not in frame.columns:
        return add_calendar(frame)
    made = add_calendar(frame.withColumnRenamed("year", "__year"))
    return made.withColumn("year", F.col("__year")).drop("__year")


@dataclass(frozen=True)
class Summary:
    keys: tuple[str, ...]
    frame: DataFrame
    size: int  # rows


class Summaries:
    """Summaries from fine to coarse, and reports answered from the smallest that will do."""

    def __init__(self, stores: Lookup | DataFrame):
        self.stores = stores if isinstance(stores, Lookup) else Lookup.of(stores)
        self.known: list[Summary] = []

    @staticmethod
    def build(
        sales: DataFrame,
        stores: Lookup | DataFrame,
        store: Callable[[str, DataFrame], DataFrame],
        coarser: Sequence[Sequence[str]] = COARSER,
    ) -> Summaries:
        """The finest summary from one pass over the sales, the others from each other;
        ``store`` writes a frame under a name and returns it read back."""
        made = Summaries(stores)
        made.add(FINEST, store("summary", summarise(sales, FINEST)))
        for keys in coarser:
            base = made.choose(keys)
            made.add(keys, store(f"summary-{'-'.join(keys)}", coarsen(base.frame, keys)))
        return made

    def add(self, keys: Sequence[str], frame: DataFrame) -> None:
        self.known.append(Summary(tuple(keys), frame, frame.count()))

    def choose(self, columns: Iterable[str]) -> Summary | None:
        """The smallest summary from which all of the columns follow."""
        needed = keys_needed(columns)
        if needed is None:
            return None
        able = [each for each in self.known if needed <= set(each.keys)]
        return min(able, key=lambda each: (each.size, each.keys), default=None)

    def source(self, columns: Sequence[str], otherwise: DataFrame) -> DataFrame:
        """Rows with the columns and the parts: of a summary, or ``otherwise`` of all sales."""
        chosen = self.choose(columns)
        if chosen is None:
            return otherwise
        frame = chosen.frame
        if set(columns) & set(_CALENDAR):
            frame = _with_calendar(frame)
        if set(columns) & set(_OF_STORE):
            frame = join_stores(frame, self.stores)
        return frame
