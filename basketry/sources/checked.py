"""Files of which every line is kept: rows that hold, and rows that do not with the reasons.

A line is refused if it cannot be read as the table's types, lacks a value that must be there, or
breaks a rule. All rules are tested on the same pass that reads the file, and one write puts
accepted and refused rows into folders of their own.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketry import schemas
from basketry.operators.lookup import Lookup, lookup_join
from basketry.sources.csv_files import csv_header

#: The line as it was, where it cannot be read.
LINE = "refused_line"
REASONS = "reasons"
MALFORMED = "malformed line"


def read_lines(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """All lines; one that does not fit has NULLs and its text in ``refused_line``."""
    known = {field.name: field.dataType for field in schema.fields}
    fields = [T.StructField(name, known.get(name, T.StringType())) for name in csv_header(spark, path)]
    whole = T.StructType([*fields, T.StructField(LINE, T.StringType())])
    return (
        spark.read.schema(whole)
        .options(header=True, nullValue="", mode="PERMISSIVE", columnNameOfCorruptRecord=LINE)
        .csv(path)
    )


def missing_values(table: str) -> dict[str, Column]:
    """A rule for every column of a table that must have a value."""
    return {f"{name} is missing": F.col(name).isNull() for name in schemas.REQUIRED_COLUMNS[table]}


def outside(column: str, first: str, end: str) -> dict[str, Column]:
    """Days before ``first``, or from ``end`` on."""
    day = F.col(column)
    return {f"{column} is out of range": (day < F.lit(first).cast("date")) | (day >= F.lit(end).cast("date"))}


def judged(
    lines: DataFrame,
    rules: Mapping[str, Column],
    parents: Mapping[str, Lookup | DataFrame] | None = None,
    row_id: tuple[str, ...] = (),
) -> DataFrame:
    """``lines`` with the ``reasons`` against each, an empty list for a row that holds.

    A rule is broken where its condition is true. ``parents`` has, for each key column, the
    table that must know it; small ones are broadcast, so the rows are not shuffled.
    """
    unreadable = F.col(LINE).isNotNull()
    broken = {MALFORMED: unreadable}
    broken |= {reason: ~unreadable & condition for reason, condition in rules.items()}
    checked = lines
    for number, (key, parent) in enumerate((parents or {}).items()):
        parent = parent if isinstance(parent, Lookup) else Lookup.of(parent)
        flag = f"__known{number}"
        known = parent.frame.select(key).distinct().withColumn(flag, F.lit(True))
        checked = lookup_join(checked, parent.derive(known), [key], row_id=row_id)
        broken[f"{key} is unknown"] = ~unreadable & F.col(key).isNotNull() & F.col(flag).isNull()
    found = F.array(*[F.when(condition, F.lit(reason)) for reason, condition in broken.items()])
    return checked.select(*lines.columns, F.array_compact(found).alias(REASONS))


@dataclass(frozen=True)
class Split:
    accepted: DataFrame
    refused: DataFrame


def store_split(checked: DataFrame, path: str) -> Split:
    """Write both kinds of rows in one pass and read them back."""
    refused = F.size(REASONS) > 0
    checked.withColumn("refused", refused).write.partitionBy("refused").parquet(path)
    spark = checked.sparkSession
    kept = spark.read.schema(T.StructType([*checked.schema.fields, T.StructField("refused", T.BooleanType())]))
    stored = kept.parquet(path)
    good = stored.where(~F.col("refused")).drop("refused", LINE, REASONS)
    return Split(good, stored.where("refused").drop("refused"))


def reasons_count(refused: DataFrame) -> DataFrame:
    """Rows per reason; a row with several counts for each."""
    listed = refused.select(F.explode(REASONS).alias("reason"))
    return listed.groupBy("reason").agg(F.count("*").alias("rows"))
