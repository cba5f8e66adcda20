"""Exact quantiles of columns of any length, without sorting them or holding their values.

A pass counts the values in each of ``BUCKETS`` equal ranges between the least and the largest.
The range that holds the wanted rank is known then, with its least and largest value, and
the next pass looks at its values alone, in ranges that much finer, until all values of the range are
equal. Few passes do: doubles have 64 bits and a pass settles twelve. Only counts are
shuffled, at most ``BUCKETS`` for each rank and task, however often a value occurs.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKETS = 4096


@dataclass(frozen=True)
class _Range:
    low: float
    high: float
    before: int  # values below it


def _bucket(value: Column, within: _Range, buckets: int) -> Column:
    """Number of the part of the range; it grows with the value. Halves never overflow."""
    span = within.high * 0.5 - within.low * 0.5
    if span == 0 or not math.isfinite(buckets / span):  # neighbours too close to be told apart so
        return F.when(value == F.lit(within.low), 0).when(value == F.lit(within.high), 2).otherwise(1)
    share = (value * 0.5 - F.lit(within.low * 0.5)) / F.lit(span)
    return F.least(F.floor(share * buckets).cast("int"), F.lit(buckets - 1))


def values_at(frame: DataFrame, column: str, ranks: Sequence[int], buckets: int = BUCKETS) -> list[float]:
    """The values at the given places (from 0) of the sorted column; NULL and NaN are left out."""
    value = F.col(column).cast("double")
    known = frame.select(value.alias("v")).where(F.col("v").isNotNull() & ~F.isnan("v"))
    whole = known.agg(F.min("v").alias("low"), F.max("v").alias("high")).first()
    if whole["low"] is None:
        raise ValueError(f"{column} has no values")
    at = {rank: _Range(whole["low"], whole["high"], 0) for rank in ranks}
    while open_ones := sorted({r for r in at.values() if r.low < r.high}, key=lambda r: r.low):
        place = F.lit(None).cast("struct<range:int,bucket:int>")
        for number, within in reversed(list(enumerate(open_ones))):
            inside = F.col("v").between(F.lit(within.low), F.lit(within.high))
            part = _bucket(F.col("v"), within, buckets).cast("int")
            place = F.when(inside, F.struct(F.lit(number).alias("range"), part.alias("bucket"))).otherwise(place)
        counted = known.select("v", place.alias("p")).where("p IS NOT NULL").groupBy("p.range", "p.bucket")
        found = counted.agg(F.count("*").alias("n"), F.min("v").alias("low"), F.max("v").alias("high"))
        rows = sorted(found.collect(), key=lambda r: (r["range"], r["bucket"]))  # at most BUCKETS a range
        finer: dict[_Range, list[_Range]] = {}
        for number, within in enumerate(open_ones):
            before = within.before
            for row in (r for r in rows if r["range"] == number):
                finer.setdefault(within, []).append(_Range(row["low"], row["high"], before))
                before += row["n"]
        at = {
            rank: max((r for r in finer[within] if r.before <= rank), key=lambda r: r.before)
            if within in finer
            else within
            for rank, within in at.items()
        }
    return [at[rank].low for rank in ranks]


def quantiles(frame: DataFrame, column: str, fractions: Sequence[float], number: int) -> list[float]:
    """Quantiles between the values at both neighbouring ranks; ``number`` values are known."""
    places = [(number - 1) * fraction for fraction in fractions]
    ranks = sorted({rank for place in places for rank in (math.floor(place), math.ceil(place))})
    value = dict(zip(ranks, values_at(frame, column, ranks), strict=True))
    return [
        value[math.floor(place)] + (value[math.ceil(place)] - value[math.floor(place)]) * (place % 1)
        for place in places
    ]


def describe_all(frame: DataFrame, column: str) -> DataFrame:
    """Count, mean, sample deviation, extremes and exact quartiles of a column of any length."""
    value = F.col(column).cast("double")
    exact = F.try_divide(F.sum(column).cast("double"), F.count(column).cast("double"))
    summary = frame.agg(
        F.count(value).alias("count"), exact.alias("mean"), F.stddev_samp(value).alias("std"),
        F.min(value).alias("min"), F.max(value).alias("max"),
    ).first()
    quartiles = [None] * 3
    if summary["count"]:
        quartiles = quantiles(frame, column, (0.25, 0.5, 0.75), summary["count"])
    schema = (
        "column_name string, count long, mean double, std double, min double, "
        "p25 double, p50 double, p75 double, max double"
    )
    row = (column, summary["count"], summary["mean"], summary["std"], summary["min"], *quartiles, summary["max"])
    return frame.sparkSession.createDataFrame([row], schema)
