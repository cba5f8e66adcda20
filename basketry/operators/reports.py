"""Validation and preview reports on the cleaned and the wide tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketry.functions.aggregates import flag_count, percent, rounded_mean
from basketry.operators.distinct import counts_of_all


def history(frame: DataFrame, cutoff: str) -> DataFrame:
    """Rows before ``cutoff``, the first day without known sales.

    Of a table stored by year, only the folders up to that year are read, and the one of
    rows without a year: the date alone decides.
    """
    end = F.lit(cutoff).cast("date")
    past = frame.where(F.col("date") < end)
    if "year" not in frame.columns:
        return past
    return past.where(F.col("year").isNull() | (F.col("year") <= F.year(end)))


def validate_oil(oil_clean: DataFrame) -> DataFrame:
    counted = oil_clean.agg(
        F.count("*").alias("total_rows"),
        flag_count(F.col("is_imputed")).alias("imputed_rows"),
        F.min("date").alias("min_date"),
        F.max("date").alias("max_date"),
        F.min("oil_price").alias("min_price"),
        F.max("oil_price").alias("max_price"),
    )
    share = percent(F.col("imputed_rows"), F.col("total_rows"))
    return counted.withColumn("imputed_pct", share)


def _flag_total(name: str, condition: Column | None = None) -> tuple[Column, Column]:
    return flag_count(F.col(name) if condition is None else condition), F.sum(name)


def validate_train(train_clean: DataFrame, cutoff: str) -> DataFrame:
    """Rows, flags, and distinct stores and items by merged bitmaps, in one pass."""
    past = history(train_clean, cutoff)
    merged = {
        "total_rows": (F.count("*"), F.sum("total_rows")),
        "min_date": (F.min("date"), F.min("min_date")),
        "max_date": (F.max("date"), F.max("max_date")),
        "integrity_issues": _flag_total("integrity_issues", F.col("has_integrity_issues")),
        "orphan_stores": _flag_total("orphan_stores", F.col("is_orphan_store")),
        "orphan_items": _flag_total("orphan_items", F.col("is_orphan_item")),
    }
    many = {"unique_stores": "store_nbr", "unique_items": "item_nbr"}
    counted = counts_of_all(past, many, merged, {"unique_dates": "date"})
    return counted.select(
        F.coalesce("total_rows", F.lit(0)).alias("total_rows"),
        "unique_stores", "unique_items", "min_date", "max_date", "integrity_issues", "orphan_stores", "orphan_items",
        "unique_dates",
    )


def validate_holidays(holidays_clean: DataFrame) -> DataFrame:
    return holidays_clean.agg(
        F.count("*").alias("total_rows"),
        F.count_distinct("date").alias("unique_dates"),
        F.count_distinct("locale").alias("unique_locales"),
        F.count_distinct("locale_name").alias("unique_locale_names"),
        F.min("date").alias("min_date"),
        F.max("date").alias("max_date"),
        flag_count(F.col("is_multiple_holidays")).alias("multi_holidays_dates"),
    )


def validate_master(master: DataFrame, cutoff: str) -> DataFrame:
    """Like ``validate_train``, with means, flags, families and store types."""
    past = history(master, cutoff)
    flags = {
        "promotion_count": "onpromotion",
        "holiday_count": "is_holiday",
        "weekend_count": "is_weekend",
        "payday_count": "is_payday",
    }
    merged = {
        "total_rows": (F.count("*"), F.sum("total_rows")),
        "min_date": (F.min("date"), F.min("min_date")),
        "max_date": (F.max("date"), F.max("max_date")),
        **{name: _flag_total(name, F.col(column)) for name, column in flags.items()},
    }
    for name in ("unit_sales", "oil_price"):
        merged[f"sum_{name}"] = (F.sum(name), F.sum(f"sum_{name}"))
        merged[f"known_{name}"] = (F.count(name), F.sum(f"known_{name}"))
    many = {"unique_stores": "store_nbr", "unique_items": "item_nbr"}
    few = {"unique_families": "item_family", "unique_store_types": "store_type", "unique_dates": "date"}
    counted = counts_of_all(past, many, merged, few)

    def mean(name: str) -> Column:
        return F.round(F.try_divide(f"sum_{name}", f"known_{name}"), 2)

    return counted.select(
        F.coalesce("total_rows", F.lit(0)).alias("total_rows"),
        "unique_stores", "unique_items", "min_date", "max_date",
        mean("unit_sales").alias("avg_sales"),
        mean("oil_price").alias("avg_oil_price"),
        *flags,
        *few,
    )


def holiday_distribution(master: DataFrame, cutoff: str) -> DataFrame:
    return (
        history(master, cutoff)
        .where("is_holiday")
        .groupBy("holiday_type")
        .agg(
            F.count("*").alias("occurrences"),
            F.count_distinct("date").alias("unique_dates"),
            rounded_mean("unit_sales").alias("avg_sales_on_holiday"),
        )
        .orderBy(F.desc("occurrences"), F.asc_nulls_last("holiday_type"))
    )


def payday_impact(master: DataFrame, cutoff: str) -> DataFrame:
    return (
        history(master, cutoff)
        .groupBy("is_payday")
        .agg(
            F.count("*").alias("transactions"),
            rounded_mean("unit_sales").alias("avg_sales"),
            F.round(F.stddev_samp("unit_sales"), 2).alias("std_sales"),
        )
        .orderBy(F.desc_nulls_first("is_payday"))
    )


def top_families(master: DataFrame, cutoff: str, top_n: int = 5) -> DataFrame:
    return (
        history(master, cutoff)
        .groupBy("item_family")
        .agg(
            F.count("*").alias("transactions"),
            F.round(F.sum("unit_sales"), 2).alias("total_sales"),
        )
        .orderBy(F.desc_nulls_first("total_sales"), F.asc_nulls_first("item_family"))
        .limit(top_n)
    )
