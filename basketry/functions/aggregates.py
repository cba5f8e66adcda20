"""Aggregate expressions shared by the reports. All stay in exact decimals."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def flag_count(condition: Column) -> Column:
    """Rows for which ``condition`` holds; NULL counts as not, no rows give NULL."""
    return F.sum(F.when(condition, 1).otherwise(0))


def exact_mean(column: str) -> Column:
    return F.try_divide(F.sum(column), F.count(column))


def rounded_mean(column: str, digits: int = 2) -> Column:
    """Mean of a decimal column, halves rounded away from zero."""
    return F.round(exact_mean(column), digits)


def float_mean(column: str) -> Column:
    """Mean in floating point of an exactly summed column."""
    return F.try_divide(F.sum(column).cast("double"), F.count(column).cast("double"))


def joined_values(column: str) -> Column:
    """Distinct values in order, separated by commas; NULL when there is none."""
    values = F.array_join(F.array_sort(F.collect_set(column)), ",")
    return F.when(F.count(column) > 0, values)


def percent(part: Column, whole: Column) -> Column:
    return F.try_divide(part.cast("double"), whole.cast("double")) * 100


def change_percent(value: Column, base: Column) -> Column:
    return (F.try_divide(value.cast("double"), base.cast("double")) - 1) * 100


def as_doubles(frame: DataFrame) -> DataFrame:
    """Decimal columns as doubles, for output to tools without decimals."""
    return frame.select(
        *[
            F.col(f"`{field.name}`").cast("double").alias(field.name)
            if isinstance(field.dataType, T.DecimalType)
            else F.col(f"`{field.name}`")
            for field in frame.schema.fields
        ]
    )
