"""Joins of large facts to lookup tables, safe for big lookups and hot keys."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketry.session import shared_dir

#: Largest lookup sent to every executor, as its values are held in memory.
BROADCAST_BYTES = 64 * 1024 * 1024

#: In the shuffled join a key with more rows than this is spread over several tasks,
#: about one for each so many rows.
ROWS_PER_TASK = 5_000_000

#: Salts for rows without a key, which meet no lookup row.
MISSING_SPREAD = 65_536


def _value_bytes(field: T.StructField) -> Column:
    """Bytes of a value in a row in memory: eight for each, a NULL too, and its content."""
    column = F.col(f"`{field.name}`")
    if isinstance(field.dataType, (T.StringType, T.BinaryType)):
        return F.coalesce(F.octet_length(column), F.lit(0)) + 16
    if isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType)):
        text = F.octet_length(F.to_json(F.struct(column)))
        return F.coalesce(4 * text, F.lit(0)) + 16
    return F.lit(16 if isinstance(field.dataType, T.DecimalType) else 8)


@dataclass(frozen=True)
class Lookup:
    """A lookup table and whether its measured size allows a broadcast."""

    frame: DataFrame
    small: bool
    max_bytes: int

    @staticmethod
    def of(frame: DataFrame, max_bytes: int | None = None) -> Lookup:
        limit = BROADCAST_BYTES if max_bytes is None else max_bytes
        row_bytes = F.lit(8).cast("long")
        for field in frame.schema.fields:
            row_bytes = row_bytes + _value_bytes(field)
        measured = frame.agg(F.coalesce(F.sum(row_bytes), F.lit(0)).alias("bytes")).first()
        return Lookup(frame, measured["bytes"] <= limit, limit)

    def derive(self, frame: DataFrame) -> Lookup:
        """A lookup of the same rows with some of the columns, or with a flag or two."""
        return Lookup(frame, self.small, self.max_bytes)

    def measure(self, frame: DataFrame) -> Lookup:
        """A lookup computed from this one, measured anew by the same limit."""
        return Lookup.of(frame, self.max_bytes)


def lookup_join(
    facts: DataFrame,
    lookup: Lookup | DataFrame,
    on: Sequence[str],
    how: str = "left",
    keys_from: DataFrame | None = None,
    row_id: Sequence[str] = (),
) -> DataFrame:
    """Equi-join ``facts`` (left or inner) to a lookup.

    A small lookup is broadcast: the facts stay where they are, whatever the skew.
    A larger one is joined by shuffle with the hot keys salted. ``keys_from`` is an
    earlier form of ``facts``, cheaper to compute, in which to count the hot keys.
    ``row_id`` names columns that tell rows apart; without it all columns together do.
    """
    lookup = lookup if isinstance(lookup, Lookup) else Lookup.of(lookup)
    if lookup.small:
        return facts.join(F.broadcast(lookup.frame), list(on), how)
    return salted_join(facts, lookup.frame, list(on), how, keys_from, row_id=row_id)


def salted_join(
    facts: DataFrame,
    lookup: DataFrame,
    on: list[str],
    how: str = "left",
    keys_from: DataFrame | None = None,
    rows_per_task: int | None = None,
    row_id: Sequence[str] = (),
) -> DataFrame:
    """Shuffle join in which each hot key is split by a salt, the more the more rows it has.

    The lookup rows of a hot key are repeated once per salt, so that every fact row
    meets each of its matches exactly once. The salt comes from the columns ``row_id``: a
    task that is run again gives each row the same one, and rows that are equal in other
    columns are still told apart.
    """
    counted = facts if keys_from is None else keys_from
    hot = _hot_keys(counted, on, rows_per_task or ROWS_PER_TASK)
    hot = F.broadcast(hot) if Lookup.of(hot).small else hot
    spread = F.coalesce("_spread", F.lit(1))
    row_hash = F.xxhash64(*(row_id or facts.columns))
    salted_facts = (
        facts.join(hot, on, "left")
        .withColumn("_spread", F.when(_any_null(on), MISSING_SPREAD).otherwise(spread))
        .withColumn("_salt", F.pmod(row_hash, "_spread").cast("int"))
        .drop("_spread")
    )
    salted_lookup = (
        lookup.join(hot, on, "left")
        .withColumn("_salt", F.explode(F.sequence(F.lit(0), spread - 1)))
        .drop("_spread")
    )
    return salted_facts.join(salted_lookup, [*on, "_salt"], how).drop("_salt")


def _any_null(columns: Sequence[str]) -> Column:
    test = F.col(columns[0]).isNull()
    for name in columns[1:]:
        test = test | F.col(name).isNull()
    return test


def _hot_keys(facts: DataFrame, on: list[str], rows_per_task: int) -> DataFrame:
    """Keys with more than ``rows_per_task`` rows and the number of tasks for each,
    written once so that both join sides see the same. There are at most as many as the
    facts fill tasks."""
    shared_dir(facts.sparkSession)
    counted = facts.select(*on).dropna().groupBy(*on).agg(F.count("*").alias("_rows"))
    tasks = F.ceil(F.col("_rows") / rows_per_task).cast("int")
    hot = counted.where(F.col("_rows") > rows_per_task)
    return hot.select(*on, tasks.alias("_spread")).checkpoint()
