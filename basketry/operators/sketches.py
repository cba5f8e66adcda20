"""Approximate distinct counts from sketches that are stored per day and merged for any span.

For figures that may be off by a little: a span of any length reads one sketch of a few kilobytes
for each of its days and none of the sales. Exact counts are in ``operators.distinct``.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Binary logarithm of the number of slots of a sketch.
SLOTS_LOG = 12


def relative_error(slots_log: int = SLOTS_LOG, deviations: float = 3.0) -> float:
    """Bound on the relative error, by three standard deviations unless said otherwise."""
    return deviations * 1.04 / math.sqrt(1 << slots_log)


def daily_sketches(
    sales: DataFrame, columns: Sequence[str], date: str = "date", slots_log: int = SLOTS_LOG
) -> DataFrame:
    """A sketch of the distinct values of each column per day; partial ones merge on the way."""
    return sales.groupBy(date).agg(*(F.hll_sketch_agg(c, slots_log).alias(c) for c in columns))


def merged_estimates(
    sketches: DataFrame, spans: Sequence[Column], columns: Sequence[str], prefix: str = "about_"
) -> DataFrame:
    """Estimated distinct values per span of days; days of a span may overlap other spans'."""
    estimates = [F.hll_sketch_estimate(F.hll_union_agg(c)).alias(f"{prefix}{c}") for c in columns]
    return sketches.groupBy(*spans).agg(*estimates)
