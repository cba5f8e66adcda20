"""The figures behind the dashboard, from the wide sales table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.functions.aggregates import float_mean
from basketry.functions.calendar import year_month
from basketry.functions.labels import PROMOTION_STATUS, SUNDAY_FIRST, label


def known_sales(master: DataFrame) -> DataFrame:
    return master.where(F.col("unit_sales").isNotNull())


def filter_sales(
    master: DataFrame,
    store_nbr: int | None = None,
    item_family: str | None = None,
    year: int | None = None,
) -> DataFrame:
    """Known sales that meet every filter given; ``year`` prunes stored folders."""
    chosen = {"store_nbr": store_nbr, "item_family": item_family, "year": year}
    rows = known_sales(master)
    for column, value in chosen.items():
        if value is not None:
            rows = rows.where(F.col(column) == value)
    return rows


def kpi_metrics(master: DataFrame, stores: DataFrame, items: DataFrame) -> DataFrame:
    """Total and mean daily sales, days with sales, number of stores and of items."""
    daily = known_sales(master).groupBy("date").agg(F.sum("unit_sales").alias("sales"))
    totals = daily.agg(
        F.coalesce(F.sum("sales"), F.lit(0)).cast("double").alias("total_sales"),
        F.count("date").alias("total_days"),
    )
    mean = F.coalesce(F.try_divide("total_sales", "total_days"), F.lit(0.0))
    return totals.select(
        "total_sales",
        mean.alias("avg_daily_sales"),
        "total_days",
        stores.agg(F.count("*")).scalar().alias("total_stores"),
        items.agg(F.count("*")).scalar().alias("total_items"),
    )


def monthly_sales(master: DataFrame) -> DataFrame:
    return (
        known_sales(master)
        .groupBy("year", "month")
        .agg(F.sum("unit_sales").alias("total_sales"))
        .withColumn("year_month", year_month(F.col("year"), F.col("month")))
        .orderBy("year", "month")
    )


def sales_by_dimension(master: DataFrame, dimension: str, top_n: int = 10) -> DataFrame:
    """The ``top_n`` values of any column by total sales; NULL counts as a value."""
    return (
        known_sales(master)
        .groupBy(dimension)
        .agg(F.sum("unit_sales").alias("total_sales"))
        .orderBy(F.desc_nulls_first("total_sales"), F.asc_nulls_first(dimension))
        .limit(top_n)
    )


def sales_by_day_of_week(master: DataFrame) -> DataFrame:
    """Mean over days of the day's total sales, per weekday (0 is Sunday)."""
    daily = (
        known_sales(master)
        .groupBy("date", "day_of_week")
        .agg(F.sum("unit_sales").alias("daily_total"))
    )
    return (
        daily.groupBy("day_of_week")
        .agg(float_mean("daily_total").alias("avg_sales"))
        .withColumn("day_name", label(F.col("day_of_week"), SUNDAY_FIRST))
        .orderBy("day_of_week")
    )


def filtered_time_series(
    master: DataFrame,
    store_nbr: int | None = None,
    item_family: str | None = None,
    year: int | None = None,
) -> DataFrame:
    return (
        filter_sales(master, store_nbr, item_family, year)
        .groupBy("date")
        .agg(F.sum("unit_sales").alias("total_sales"))
        .orderBy("date")
    )


def promotion_impact(
    master: DataFrame,
    store_nbr: int | None = None,
    item_family: str | None = None,
    year: int | None = None,
) -> DataFrame:
    """Total sales by promotion flag; an unknown flag is its own, unnamed group."""
    return (
        filter_sales(master, store_nbr, item_family, year)
        .groupBy("onpromotion")
        .agg(F.sum("unit_sales").alias("total_sales"))
        .withColumn("promotion_status", label(F.col("onpromotion"), PROMOTION_STATUS))
    )


def filter_values(master: DataFrame, column: str) -> DataFrame:
    """Distinct values of a column in order, for a select box; NULL is not offered."""
    return master.select(column).where(F.col(column).isNotNull()).distinct().orderBy(column)
