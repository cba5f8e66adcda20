"""Exploration of sales, stores, items, holidays and oil prices over time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basketry.functions.aggregates import (
    change_percent,
    float_mean,
    percent,
    rounded_mean,
)
from basketry.functions.calendar import add_day_names
from basketry.functions.labels import (
    DAY_KIND,
    MONTH_NAMES,
    PERISHABLE,
    PROMOTION_SHORT,
    WEEKDAYS,
    label,
)
from basketry.operators.distinct import counts_by_key
from basketry.operators.lookup import Lookup, lookup_join

# --- counts and summaries of a table -------------------------------------------------


def value_counts(frame: DataFrame, column: str, top_n: int | None = None) -> DataFrame:
    """Rows per value, most frequent first; NULL is not counted."""
    counted = (
        frame.where(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count("*").alias("count"))
        .orderBy(F.desc("count"), column)
    )
    return counted if top_n is None else counted.limit(top_n)


def pair_counts(frame: DataFrame, *columns: str) -> DataFrame:
    return frame.groupBy(*columns).agg(F.count("*").alias("count"))


def describe(frame: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Count, mean, sample deviation, extremes and exact interpolated quartiles.

    Exact quartiles keep the distinct values of a column together, so this is for
    frames of bounded size, such as one row per day or a fixed number of rows.
    """
    rows = []
    for name in columns:
        value = F.col(name).cast("double")
        rows.append(
            F.struct(
                F.lit(name).alias("column_name"),
                F.count(value).alias("count"),
                float_mean(name).alias("mean"),
                F.stddev_samp(value).alias("std"),
                F.min(value).alias("min"),
                F.percentile(value, F.lit(0.25)).alias("p25"),
                F.percentile(value, F.lit(0.5)).alias("p50"),
                F.percentile(value, F.lit(0.75)).alias("p75"),
                F.max(value).alias("max"),
            ).alias(name)
        )
    summary = frame.select(*columns).agg(*rows)
    return summary.select(F.inline(F.array(*columns)))


def date_span(sales: DataFrame) -> DataFrame:
    return sales.agg(F.min("date").alias("start_date"), F.max("date").alias("end_date")).withColumn(
        "date_span", F.datediff("end_date", "start_date")
    )


def invalid_values(sales: DataFrame) -> DataFrame:
    """Missing values and refunds; everything sold in less than one unit is a refund."""
    return sales.agg(
        F.count_if(F.col("unit_sales").isNull()).alias("null_values"),
        F.count_if(F.col("unit_sales") < 1).alias("refunds"),
        F.count_if(F.col("store_nbr").isNull()).alias("null_stores"),
        F.count_if(F.col("item_nbr").isNull()).alias("null_items"),
    )


def transactions_per_year(transactions: DataFrame) -> DataFrame:
    return (
        transactions.groupBy(F.year("date").alias("year"))
        .agg(F.sum("transactions").alias("total_transactions"))
        .orderBy("year")
    )


# --- daily series --------------------------------------------------------------------


def daily_sales(sales: DataFrame) -> DataFrame:
    """One row per day with sales, refunds included."""
    counted = counts_by_key(
        sales,
        ["date"],
        {"active_stores": "store_nbr", "unique_items": "item_nbr"},
        {
            "num_transactions": F.count("*"),
            "units": F.sum("unit_sales"),
            "known": F.count("unit_sales"),
        },
    )
    return counted.select(
        "date",
        "num_transactions",
        F.round("units", 0).alias("total_sales"),
        F.round(F.try_divide("units", "known"), 2).alias("avg_sales"),
        "active_stores",
        "unique_items",
    )


def moving_average(daily: DataFrame, days: int = 30) -> DataFrame:
    """Mean of the last ``days`` rows, NULL until there are that many.

    The window runs over one row per day.
    """
    rows = Window.orderBy("date").rowsBetween(1 - days, Window.currentRow)
    value = F.col("total_sales").cast("double")
    average = F.when(F.count(value).over(rows) == days, F.avg(value).over(rows))
    return daily.select("date", "total_sales", average.alias(f"ma_{days}"))


def sales_and_oil(daily: DataFrame, oil: DataFrame, days: int = 30) -> DataFrame:
    """The averaged sales and the recorded oil price on one date axis."""
    averaged = moving_average(daily, days).select("date", f"ma_{days}")
    return averaged.join(oil.select("date", "dcoilwtico"), "date", "full")


def year_ranges(daily: DataFrame) -> DataFrame:
    return daily.groupBy(F.year("date").alias("year")).agg(
        F.min("date").alias("first_date"),
        F.max("date").alias("last_date"),
        F.count("date").alias("days"),
    )


def yearly_sales(daily: DataFrame) -> DataFrame:
    totals = daily.groupBy(F.year("date").alias("year")).agg(
        F.sum("total_sales").alias("total_sales"),
        F.sum("num_transactions").alias("total_transactions"),
        F.count("date").alias("days"),
    )
    mean = F.try_divide(F.col("total_sales").cast("double"), F.col("days"))
    return totals.withColumn("avg_daily_sales", F.bround(mean, 0))


def month_pattern(daily: DataFrame) -> DataFrame:
    """Mean day of each calendar month over all years."""
    return (
        daily.groupBy(F.month("date").alias("month"))
        .agg(
            F.bround(float_mean("total_sales"), 0).alias("total_sales"),
            F.bround(float_mean("num_transactions"), 0).alias("num_transactions"),
        )
        .withColumn("month_name", label(F.col("month"), MONTH_NAMES))
    )


def best_and_worst_month(pattern: DataFrame) -> DataFrame:
    """Months with the highest and the lowest mean sales; the earlier one on a tie."""
    sales, month = F.col("total_sales"), F.col("month")
    return pattern.where(sales.isNotNull()).agg(
        F.max_by("month_name", F.struct(sales, -month)).alias("best_month"),
        F.min_by("month_name", F.struct(sales, month)).alias("worst_month"),
    )


def weekday_pattern(daily: DataFrame) -> DataFrame:
    """Mean day per weekday, Monday first, all seven always present, and the
    deviation of each from the mean of the seven in percent."""
    means = (
        add_day_names(daily)
        .groupBy("day_name")
        .agg(
            float_mean("total_sales").alias("total_sales"),
            float_mean("num_transactions").alias("num_transactions"),
        )
    )
    names = F.array(*[F.lit(name) for name in WEEKDAYS])
    week = daily.sparkSession.range(1).select(F.posexplode(names).alias("day_order", "day_name"))
    overall = F.avg("total_sales").over(Window.partitionBy(F.lit(1)))
    change = F.bround(change_percent(F.col("total_sales"), overall), 1)
    return week.join(means, "day_name", "left").select(
        "day_order",
        "day_name",
        "total_sales",
        "num_transactions",
        change.alias("pct_vs_average"),
    )


def holiday_comparison(daily: DataFrame, holidays: DataFrame) -> DataFrame:
    """Mean daily sales on days with and without a recorded event.

    Any event of any place counts, and a day counts once per event. The events are
    counted per day first and enter the mean as a weight, so the join adds no rows.
    """
    events = holidays.groupBy("date").agg(
        F.count("type").alias("named"), F.count("*").alias("events")
    )
    weighted = daily.join(events, "date", "left").select(
        "total_sales",
        F.coalesce("named", F.lit(0)).alias("on_holiday"),
        F.when(F.col("events").isNull(), 1)
        .otherwise(F.col("events") - F.col("named"))
        .alias("on_regular"),
    )
    kinds = weighted.unpivot(["total_sales"], ["on_holiday", "on_regular"], "kind", "weight")
    known = F.when(F.col("total_sales").isNotNull(), F.col("weight"))
    mean = F.try_divide(
        F.sum(F.col("total_sales") * F.col("weight")).cast("double"), F.sum(known).cast("double")
    )
    is_holiday = F.col("kind") == "on_holiday"
    return (
        kinds.where("weight > 0")
        .groupBy(is_holiday.alias("is_holiday"))
        .agg(F.bround(mean, 0).alias("total_sales"))
        .withColumn("day_kind", label(F.col("is_holiday"), DAY_KIND))
    )


def holiday_lift(comparison: DataFrame) -> DataFrame:
    """How much more is sold on holidays than on regular days, in percent."""
    return _compare(comparison, "is_holiday", "total_sales", "holiday_lift_pct")


def december_stats(daily: DataFrame) -> DataFrame:
    return (
        _december(daily)
        .groupBy(F.year("date").alias("year"))
        .agg(
            float_mean("total_sales").alias("mean"),
            F.max("total_sales").alias("max"),
            F.min("total_sales").alias("min"),
        )
    )


def december_days(daily: DataFrame) -> DataFrame:
    return _december(daily).select(
        F.year("date").alias("year"), F.dayofmonth("date").alias("day"), "total_sales"
    )


def december_years(daily: DataFrame) -> DataFrame:
    return december_days(daily).select("year").distinct()


def _december(daily: DataFrame) -> DataFrame:
    return daily.where(F.month("date") == 12)


# --- stores --------------------------------------------------------------------------


def store_performance(sales: DataFrame, stores: DataFrame) -> DataFrame:
    """Sales per existing store. Sales are reduced to one row per store, then joined."""
    per_store = counts_by_key(
        sales,
        ["store_nbr"],
        {"days_active": "date", "unique_items_sold": "item_nbr"},
        {"number_transactions": F.count("*"), "total_sales": F.sum("unit_sales")},
    )
    return stores.join(per_store, "store_nbr").select(
        "store_nbr",
        "city",
        "state",
        "type",
        "cluster",
        "number_transactions",
        "total_sales",
        "unique_items_sold",
        "days_active",
    )


def top_by_sales(performance: DataFrame, key: str, n: int) -> DataFrame:
    return performance.orderBy(F.desc_nulls_first("total_sales"), F.asc_nulls_first(key)).limit(n)


def top_and_bottom_stores(performance: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` stores that sell most and the ``n`` that sell least."""
    ranked = performance.select("store_nbr", "total_sales")
    top = top_by_sales(ranked, "store_nbr", n)
    bottom = ranked.orderBy(F.asc_nulls_last("total_sales"), F.desc("store_nbr")).limit(n)
    both = top.select(F.lit("top").alias("position"), "*").unionByName(
        bottom.select(F.lit("bottom").alias("position"), "*")
    )
    return both.orderBy(F.desc("position"), F.desc_nulls_first("total_sales"), "store_nbr")


def type_performance(performance: DataFrame) -> DataFrame:
    totals = (
        performance.where(F.col("type").isNotNull())
        .groupBy("type")
        .agg(
            F.count("store_nbr").alias("num_stores"),
            F.sum("total_sales").cast("double").alias("total_sales"),
        )
    )
    per_store = F.bround(F.try_divide(F.col("total_sales"), F.col("num_stores")), 0)
    return totals.withColumn("sale_per_store", per_store).orderBy(F.desc("sale_per_store"), "type")


def city_performance(performance: DataFrame, top_n: int = 10) -> DataFrame:
    return (
        performance.where(F.col("city").isNotNull())
        .groupBy("city")
        .agg(
            F.count("store_nbr").alias("num_stores"),
            F.bround(F.sum("total_sales").cast("double"), 0).alias("total_sales"),
            F.sum("number_transactions").alias("total_transactions"),
        )
        .orderBy(F.desc_nulls_last("total_sales"), "city")
        .limit(top_n)
    )


def store_concentration(performance: DataFrame, stores: DataFrame) -> DataFrame:
    """Share of the top 5 and top 10 stores in sales and in the number of stores."""
    n_stores = F.col("n_stores")
    shares = _top_shares(performance, "store_nbr")
    return shares.withColumn("n_stores", stores.agg(F.count("*")).scalar()).select(
        "n_stores",
        "total_sales",
        "top5_sales_pct",
        "top10_sales_pct",
        percent(F.lit(5), n_stores).alias("top5_stores_pct"),
        percent(F.lit(10), n_stores).alias("top10_stores_pct"),
    )


def _top_shares(performance: DataFrame, key: str) -> DataFrame:
    """Totals of all rows and of the 5 and 10 with the highest sales."""
    sales = performance.select(key, "total_sales")
    everything = performance.agg(F.sum("total_sales").alias("total_sales"))
    shares = {
        f"top{n}_sales_pct": percent(
            top_by_sales(sales, key, n).agg(F.sum("total_sales")).scalar(), F.col("total_sales")
        )
        for n in (5, 10)
    }
    return everything.select("total_sales", *[c.alias(name) for name, c in shares.items()])


# --- items and promotions ------------------------------------------------------------


def family_performance(sales: DataFrame, items: Lookup | DataFrame) -> DataFrame:
    """Sales per family of existing items.

    Items are broadcast if they are small, and otherwise met by shuffle with hot ones
    salted; the rows after that are counted per family and word of 64 stores or items.
    """
    items = items if isinstance(items, Lookup) else Lookup.of(items)
    families = items.derive(items.frame.select("item_nbr", "family"))
    sold = lookup_join(
        sales.select("id", "item_nbr", "store_nbr", "unit_sales"), families, ["item_nbr"], "inner", row_id=["id"]
    )
    counted = counts_by_key(
        sold,
        ["family"],
        {"stores_selling": "store_nbr", "unique_items": "item_nbr"},
        {
            "num_transactions": F.count("*"),
            "units": F.sum("unit_sales"),
            "known": F.count("unit_sales"),
        },
    )
    return counted.select(
        "family",
        "num_transactions",
        F.round("units", 0).alias("total_sales"),
        F.round(F.try_divide("units", "known"), 2).alias("avg_sales"),
        "unique_items",
        "stores_selling",
    )


def family_concentration(performance: DataFrame) -> DataFrame:
    return _top_shares(performance, "family")


def perishable_split(sales: DataFrame, items: DataFrame) -> DataFrame:
    """Sales of perishable and other items, with the share of each in the total."""
    per_item = sales.groupBy("item_nbr").agg(
        F.count("*").alias("rows"), F.sum("unit_sales").alias("units")
    )
    split = (
        per_item.join(items.select("item_nbr", "perishable"), "item_nbr")
        .groupBy(F.col("perishable").cast("int").alias("is_perishable"))
        .agg(
            F.sum("rows").alias("num_transactions"),
            F.round(F.sum("units"), 0).alias("total_sales"),
            F.count("item_nbr").alias("num_items"),
        )
    )
    overall = F.sum("total_sales").over(Window.partitionBy(F.lit(1)))
    return split.select(
        "is_perishable",
        label(F.col("is_perishable"), PERISHABLE).alias("perishability"),
        "num_transactions",
        "total_sales",
        "num_items",
        percent(F.col("total_sales"), overall).alias("sales_pct"),
    ).orderBy(F.asc_nulls_last("is_perishable"))


def promotion_by_flag(sales: DataFrame) -> DataFrame:
    """Sales with and without promotion; an unknown flag counts as none."""
    return (
        sales.groupBy(F.coalesce("onpromotion", F.lit(False)).alias("on_promotion"))
        .agg(
            F.round(F.sum("unit_sales"), 0).alias("total_sales"),
            rounded_mean("unit_sales").alias("avg_sales_per_transaction"),
            F.count("*").alias("num_transactions"),
        )
        .withColumn("promotion", label(F.col("on_promotion"), PROMOTION_SHORT))
    )


def promotion_lift(by_flag: DataFrame) -> DataFrame:
    return _compare(by_flag, "on_promotion", "avg_sales_per_transaction", "promotion_lift_pct")


def _compare(frame: DataFrame, flag: str, value: str, name: str) -> DataFrame:
    def value_where(condition: Column) -> Column:
        return F.max(F.when(condition, F.col(value)))

    change = change_percent(value_where(F.col(flag)), value_where(~F.col(flag)))
    return frame.agg(change.alias(name))
