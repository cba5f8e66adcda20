"""A layout in which files are narrow in several columns at once.

Each column is cut into ``2 ** BITS`` parts of about equally many rows. The bits of a row's parts,
interleaved, give a place on a curve along which neighbours are alike in all columns; rows are
brought together by ranges of it. So the least and largest values kept with each file, and
each of its row groups, let a filter on any of the columns pass over most of them, where an order by
day alone does so for days only. The bounds of parts are estimates and decide nothing but the layout.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Bits of each column's part.
BITS = 6
#: Columns that reports filter on.
CLUSTER_ON = ("date", "store_nbr", "item_nbr")


def _number(frame: DataFrame, column: str) -> Column:
    if isinstance(frame.schema[column].dataType, T.DateType):
        return F.unix_date(column)
    return F.col(column).cast("long")


def part_bounds(frame: DataFrame, columns: Sequence[str], bits: int = BITS) -> dict[str, list[int]]:
    """Where the parts of each column begin: at most ``2 ** bits - 1`` numbers for each."""
    shares = [i / (1 << bits) for i in range(1, 1 << bits)]
    found = frame.agg(
        *(F.approx_percentile(_number(frame, c), F.lit(shares), 1000).alias(c) for c in columns)
    ).first()
    return {c: sorted(set(found[c] or [])) for c in columns}


def _part(value: Column, bounds: Sequence[int], first: int = 0) -> Column:
    """Number of bounds that are at most ``value``, by halving; NULL is in the first part."""
    if not bounds:
        return F.lit(first)
    middle = len(bounds) // 2
    below = _part(value, bounds[:middle], first)
    return F.when(value >= bounds[middle], _part(value, bounds[middle + 1 :], first + middle + 1)).otherwise(below)


def curve(frame: DataFrame, columns: Sequence[str], bounds: dict[str, list[int]], bits: int = BITS) -> Column:
    """The interleaved bits of the parts of all columns, the highest of each first."""
    place = F.lit(0).cast("long")
    for number, column in enumerate(columns):
        part = _part(_number(frame, column), bounds[column]).cast("long")
        for bit in range(bits):
            one = F.shiftright(part, bit).bitwiseAND(F.lit(1).cast("long"))
            place = place.bitwiseOR(F.shiftleft(one, bit * len(columns) + len(columns) - 1 - number))
    return place


def write_clustered(
    frame: DataFrame, path: str, columns: Sequence[str] = CLUSTER_ON, files: int | None = None
) -> None:
    """Parquet files along the curve; as many as the shuffle gives, or ``files``.

    Rows with the same place on the curve would be one file, however many: the row's other
    columns spread them.
    """
    columns = list(columns)
    bounds = part_bounds(frame, columns)
    placed = frame.withColumn("__place", curve(frame, columns, bounds))
    spread = F.xxhash64(*frame.columns)
    order = [F.col("__place"), *[F.col(c) for c in columns], spread]
    dealt = placed.repartitionByRange(files, *order) if files else placed.repartitionByRange(*order)
    dealt.sortWithinPartitions("__place", *columns).drop("__place").write.mode("overwrite").parquet(path)
