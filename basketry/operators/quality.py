"""Constraint checks that a database would enforce on the input tables."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry import schemas
from basketry.tables import RetailTables


def _stacked(reports: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, reports)


def duplicate_keys(frame: DataFrame, key: Sequence[str]) -> DataFrame:
    """Keys that occur more than once."""
    return frame.groupBy(*key).agg(F.count("*").alias("rows")).where("rows > 1")


def primary_key_report(tables: RetailTables) -> DataFrame:
    present = tables.present()
    return _stacked(
        [
            duplicate_keys(present[name], key).agg(
                F.lit(name).alias("table_name"), F.count("*").alias("duplicate_keys")
            )
            for name, key in schemas.PRIMARY_KEYS.items()
        ]
    )


def orphans(child: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """Rows per key value without a parent.

    The child is counted per key before the join, so a frequent key moves as one row.
    """
    counted = child.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("rows"))
    return counted.join(parent.select(key), key, "left_anti")


def foreign_key_report(tables: RetailTables) -> DataFrame:
    present = tables.present()
    return _stacked(
        [
            orphans(present[child], present[parent], key).agg(
                F.lit(f"{child}.{key}").alias("reference"),
                F.count("*").alias("orphan_keys"),
                F.coalesce(F.sum("rows"), F.lit(0)).alias("orphan_rows"),
            )
            for child, parent, key in schemas.FOREIGN_KEYS
        ]
    )


def missing_values(frame: DataFrame, name: str, columns: Sequence[str] | None = None) -> DataFrame:
    """NULLs per column, counted in one pass."""
    columns = list(columns or frame.columns)
    counted = frame.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return _per_column(counted, name, columns, "missing")


def distinct_values(frame: DataFrame, name: str, columns: Sequence[str]) -> DataFrame:
    """Distinct values per column; NULL is not counted."""
    counted = frame.agg(*[F.count_distinct(c).alias(c) for c in columns])
    return _per_column(counted, name, list(columns), "distinct_values")


def _per_column(counted: DataFrame, name: str, columns: list[str], value: str) -> DataFrame:
    melted = counted.unpivot([], columns, "column_name", value)
    return melted.select(F.lit(name).alias("table_name"), "column_name", value)


def not_null_report(tables: RetailTables) -> DataFrame:
    present = tables.present()
    return _stacked(
        [
            missing_values(present[name], name, columns)
            for name, columns in schemas.REQUIRED_COLUMNS.items()
        ]
    )


def outside_domain(items: DataFrame) -> DataFrame:
    """Items whose perishable flag is neither 0 nor 1; an unknown flag passes."""
    return items.where(~F.col("perishable").isin(0, 1))


def outside_range(train: DataFrame, first: str, end: str) -> DataFrame:
    """Sales before ``first`` or on or after ``end``."""
    date = F.col("date")
    return train.where((date < F.lit(first).cast("date")) | (date >= F.lit(end).cast("date")))
