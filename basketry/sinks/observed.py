"""Figures of what is written, gathered while it is written."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from typing import Any

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from basketry.functions.aggregates import flag_count


def write_observed(
    frame: DataFrame, write: Callable[[DataFrame], Any], figures: Mapping[str, Column]
) -> dict[str, Any]:
    """Run ``write`` on the rows and return aggregates over them, from that one pass.

    The figures may be any aggregates but distinct ones. They belong to the write that
    succeeded: the rows of a task that was lost count once, in its repetition.
    """
    observation = Observation()
    named = [column.alias(name) for name, column in figures.items()]
    write(frame.observe(observation, *named))
    try:
        return dict(observation.get)
    except Py4JJavaError:  # rows known to be none before they are read pass no observer
        return frame.agg(*named).first().asDict()


def load_figures() -> dict[str, Column]:
    """Of a load of sales: rows, sales, promotions, and the days from and to."""
    return {
        "rows": F.count("*"),
        "total_sales": F.sum("unit_sales"),
        "unknown_promotions": F.count_if(F.col("onpromotion").isNull()),
        "promotions": F.count_if(F.col("onpromotion")),
        "first_date": F.min("date"),
        "last_date": F.max("date"),
    }


def clean_figures(flags: tuple[str, ...] = ("has_integrity_issues", "is_orphan_store", "is_orphan_item")) -> dict[str, Column]:
    """Of cleaned sales: rows, days from and to, and rows with each flag."""
    return {
        "rows": F.count("*"),
        "first_date": F.min("date"),
        "last_date": F.max("date"),
        **{name: flag_count(F.col(name)) for name in flags},
    }
