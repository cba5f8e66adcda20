"""A bounded number of rows of every key, the same in every run."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from basketry.operators.lookup import lookup_join

#: Rows that pass the first cut, as a multiple of those asked for, and its resolution.
_MARGIN = 4
_PARTS = 1 << 40


def bounded_sample(rows: DataFrame, key: str, number: int, by: str) -> DataFrame:
    """At most ``number`` rows of each ``key``, chosen by a hash of ``by``, with their ``turn``.

    Rows of a large key are first thinned out by their hash to about four times that many
    where they are, so that only a bounded number of them meets in one task.
    """
    counts = rows.groupBy(key).agg(F.count("*").alias("__rows"))
    place = F.pmod(F.xxhash64(by), F.lit(_PARTS))
    thinned = lookup_join(rows, counts, [key], "inner")
    share = place.cast("double") / _PARTS
    thinned = thinned.where(share * F.col("__rows") < _MARGIN * number)
    turn = Window.partitionBy(key).orderBy(place, by)
    return thinned.drop("__rows").withColumn("turn", F.row_number().over(turn)).where(F.col("turn") <= number)
