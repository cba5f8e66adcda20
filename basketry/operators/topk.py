"""The latest rows of a table, for counts too large to gather from every task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

#: Ranges of ``key`` counted within the last day needed.
RANGES = 10_000


def latest_rows(
    frame: DataFrame,
    n: int = 100_000,
    date: str = "date",
    key: str = "id",
    days: DataFrame | None = None,
) -> DataFrame:
    """The ``n`` latest rows by date; within a day those with the highest ``key``.

    Rows per day give the earliest day needed, and rows per key range the part of that
    day needed. Both come from counts, so older days are not read by the final sort
    and a day holding most of the rows does not reach it whole; of a table stored by
    ``year`` only the years needed are read. Equal dates and keys are ordered by the
    remaining columns. Rows without a date come last, so they are needed only if fewer
    than ``n`` have one. ``days`` (``date``, ``rows``) gives the counts if they are known.
    """
    order = [F.desc_nulls_last(date), F.desc_nulls_last(key)]
    order += [F.desc_nulls_last(name) for name in frame.columns if name not in (date, key)]

    if days is None:
        days = frame.groupBy(date).agg(F.count("*").alias("rows"))
    last_day = _last_day_needed(days.where(F.col(date).isNotNull()), n, date)
    first_day = last_day.select("day").scalar()
    wanted = last_day.select("wanted").scalar()
    lowest_key = _lowest_key(_of_day(frame, date, first_day), wanted, key).scalar()

    in_part = lowest_key.isNull() | (F.col(key) >= lowest_key)
    needed = (F.col(date) > first_day) | ((F.col(date) == first_day) & in_part)
    dated = frame.where(F.col(date) >= first_day)
    if "year" in frame.columns:
        dated = dated.where(F.col("year") >= F.year(first_day))
    # Without a day that fills the count, the rows without a date are next.
    undated = frame.where(F.col(date).isNull() & wanted.isNull())
    return dated.where(needed).unionByName(undated).orderBy(*order).limit(n)


def _of_day(frame: DataFrame, date: str, day: Column) -> DataFrame:
    found = frame.where(F.col(date) == day)
    return found.where(F.col("year") == F.year(day)) if "year" in frame.columns else found


def _last_day_needed(days: DataFrame, n: int, date: str) -> DataFrame:
    """The latest day from which on there are at least ``n`` rows, else the first day,
    and how many of its rows are wanted (NULL if all rows are)."""
    seen = F.sum("rows").over(_descending(date))
    counted = days.select(F.col(date).alias("day"), "rows", seen.alias("seen"))
    reached = F.col("seen") >= n
    wanted = n - (F.col("seen") - F.col("rows"))
    return counted.agg(
        F.coalesce(F.max(F.when(reached, F.col("day"))), F.min("day")).alias("day"),
        F.max_by(wanted, F.when(reached, F.col("day"))).alias("wanted"),
    )


def _lowest_key(day: DataFrame, wanted: Column, key: str) -> DataFrame:
    """A key from which on the day has at least ``wanted`` rows; NULL if it has fewer."""
    low = day.agg(F.min(key)).scalar()
    width = F.greatest((day.agg(F.max(key)).scalar() - low) / RANGES, F.lit(1))
    ranges = (
        day.where(F.col(key).isNotNull())
        .groupBy(F.floor((F.col(key) - low) / width).alias("range"))
        .agg(F.count("*").alias("rows"), F.min(key).alias("lowest"))
    )
    reached = F.sum("rows").over(_descending("range")) >= wanted
    return ranges.select("lowest", reached.alias("reached")).agg(
        F.max(F.when(F.col("reached"), F.col("lowest"))).alias("lowest_key")
    )


def _descending(column: str) -> WindowSpec:
    return Window.orderBy(F.desc(column)).rowsBetween(Window.unboundedPreceding, Window.currentRow)
