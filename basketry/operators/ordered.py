"""Fills and moving means along ordered series, spread over ranges of days.

A window over a whole series is one task's work. Here a series is cut into ranges; each range is
worked on by itself, what the ranges before it hand on is worked out on one row per range, and
both are put together. Series have keys or not: without keys there is one series, cut all the same.
Rows of a series must differ in their date.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Days of a range.
DAYS = 512
#: Rows of a block of a moving mean, at least.
BLOCK_ROWS = 4096


def _range(date: str, days: int) -> Column:
    return F.floor(F.unix_date(date) / days).cast("int")


def _on_keys(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Join by keys that may be NULL; columns of the right side are other ones."""
    renamed = right.withColumnsRenamed({key: f"__r_{key}" for key in keys})
    same = F.lit(True)
    for key in keys:
        same = same & F.col(key).eqNullSafe(F.col(f"__r_{key}"))
    return left.join(renamed, same, "left").drop(*[f"__r_{key}" for key in keys])


def daily_series(frame: DataFrame, keys: Sequence[str], date: str = "date") -> DataFrame:
    """Every day from the first to the last date of each series, with the columns of its row if
    it has one."""
    keys = list(keys)
    span = frame.groupBy(*keys).agg(F.min(date).alias("__first"), F.max(date).alias("__last"))
    # The days of a range at a time, so that a long series is no single task's work.
    ranges = F.sequence(_range("__first", DAYS), _range("__last", DAYS))
    cut = span.select(*keys, "__first", "__last", F.explode(ranges).alias("__range"))
    begin = F.greatest("__first", F.date_from_unix_date(F.col("__range") * DAYS))
    end = F.least("__last", F.date_from_unix_date(F.col("__range") * DAYS + (DAYS - 1)))
    days = cut.repartition(*keys, "__range").select(*keys, F.explode(F.sequence(begin, end)).alias(date))
    return _on_keys(days, frame, [*keys, date])


def fill(
    frame: DataFrame, keys: Sequence[str], column: str, filled: str, date: str = "date", days: int = DAYS
) -> DataFrame:
    """Add ``filled``: the column's last known value, or the first known one before that."""
    keys = list(keys)
    own = [*keys, "__range"]
    ranged = frame.withColumn("__range", _range(date, days))
    known = F.col(column).isNotNull()
    ends = ranged.groupBy(*own).agg(
        F.max_by(F.when(known, F.col(column)), F.when(known, F.col(date))).alias("__latest"),
        F.min_by(F.when(known, F.col(column)), F.when(known, F.col(date))).alias("__earliest"),
    )
    ordered = Window.partitionBy(*keys).orderBy("__range")
    before = ordered.rowsBetween(Window.unboundedPreceding, -1)
    whole = ordered.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    handed = ends.select(
        *own,
        F.last("__latest", ignorenulls=True).over(before).alias("__before"),
        F.first("__earliest", ignorenulls=True).over(whole).alias("__first"),
    )
    within = Window.partitionBy(*own).orderBy(date).rowsBetween(Window.unboundedPreceding, 0)
    local = ranged.withColumn("__local", F.last(column, ignorenulls=True).over(within))
    joined = _on_keys(local, handed, own)
    return joined.withColumn(filled, F.coalesce("__local", "__before", "__first")).drop(
        "__range", "__local", "__before", "__first"
    )


def _numbered(frame: DataFrame, keys: list[str], date: str, days: int) -> DataFrame:
    """``__place`` of each row in its series, from 0."""
    own = [*keys, "__range"]
    ranged = frame.withColumn("__range", _range(date, days))
    sizes = ranged.groupBy(*own).agg(F.count("*").alias("__size"))
    before = Window.partitionBy(*keys).orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(*own, F.coalesce(F.sum("__size").over(before), F.lit(0)).alias("__start"))
    local = ranged.withColumn("__row", F.row_number().over(Window.partitionBy(*own).orderBy(date)))
    placed = _on_keys(local, starts, own)
    return placed.withColumn("__place", F.col("__start") + F.col("__row") - 1).drop("__range", "__start", "__row")


def moving_mean(
    frame: DataFrame,
    keys: Sequence[str],
    column: str,
    rows: int,
    name: str,
    date: str = "date",
    days: int = DAYS,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Add the mean of the last ``rows`` values, NULL until there are that many.

    Blocks of a series overlap by the rows a window reaches back, which are sent to both. Sums
    are those of the column's type, exact for decimals.
    """
    keys = list(keys)
    size = max(block_rows, rows)
    placed = _numbered(frame, keys, date, days)
    own = F.floor(F.col("__place") / size).cast("int")
    needed_next = F.pmod("__place", F.lit(size)) > size - rows
    both = F.when(needed_next, F.array(own, own + 1)).otherwise(F.array(own))
    dealt = placed.withColumn("__block", F.explode(both))
    last = Window.partitionBy(*keys, "__block").orderBy("__place").rowsBetween(1 - rows, 0)
    full = F.count(column).over(last) == rows
    mean = F.when(full, F.sum(column).over(last).cast("double") / rows)
    return dealt.withColumn(name, mean).where(own == F.col("__block")).drop("__place", "__block")


def out_of_order(frame: DataFrame, column: str = "date", block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Rows of stored files that stand right after a greater value in their file, with both values.

    ``frame`` is read from files. Blocks of a file overlap by one row, which is sent to both, so
    that no task works on whole files; files go by number, as their paths are long.
    """
    file, place = F.col("_metadata.file_path"), F.col("_metadata.row_index")
    placed = frame.select(column, file.alias("__file"), place.alias("__place"))
    files = placed.select("__file").distinct()
    numbered = files.withColumn("__number", F.row_number().over(Window.orderBy("__file")))
    own = F.floor(F.col("__place") / block_rows).cast("int")
    both = F.when(F.pmod("__place", F.lit(block_rows)) == block_rows - 1, F.array(own, own + 1)).otherwise(F.array(own))
    dealt = (
        placed.join(F.broadcast(numbered), "__file")
        .drop("__file")
        .withColumn("__block", F.explode(both))
    )
    order = Window.partitionBy("__number", "__block").orderBy("__place")
    before = dealt.withColumn("before", F.lag(column).over(order)).where(own == F.col("__block"))
    return before.where(F.col("before") > F.col(column)).select(column, "before")
