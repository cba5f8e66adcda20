"""Cleaned views of oil prices, sales and holidays."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from basketry import schemas
from basketry.functions.aggregates import joined_values
from basketry.functions.calendar import daily_calendar
from basketry.operators.lookup import Lookup, lookup_join


def oil_calendar(oil: DataFrame) -> DataFrame:
    """Every day from the first to the last price date with the price as recorded."""
    prices = oil.select("date", F.col("dcoilwtico").alias("oil_price_raw"))
    return daily_calendar(oil).join(prices, "date", "left")


def oil_clean(oil: DataFrame) -> DataFrame:
    """One price per day: the last known one, or the first known one before that.

    The windows run over one row per calendar day, a few thousand per decade.
    """
    days = Window.orderBy("date")
    so_far = days.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = days.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    raw = F.col("oil_price_raw")
    return oil_calendar(oil).select(
        "date",
        F.coalesce(
            F.last(raw, ignorenulls=True).over(so_far), F.first(raw, ignorenulls=True).over(whole)
        ).alias("oil_price"),
        raw.isNull().alias("is_imputed"),
    )


def sales_rows(train: DataFrame, test: DataFrame | None = None) -> DataFrame:
    """Positive sales, followed by the rows to predict with no sales figure."""
    keys = ["id", "date", "store_nbr", "item_nbr"]
    sold = train.where("unit_sales > 0").select(*keys, "unit_sales", "onpromotion")
    if test is None:
        return sold
    unknown = F.lit(None).cast(schemas.UNITS).alias("unit_sales")
    return sold.unionByName(test.select(*keys, unknown, "onpromotion"))


def train_clean(
    train: DataFrame,
    stores: Lookup | DataFrame,
    items: Lookup | DataFrame,
    test: DataFrame | None = None,
) -> DataFrame:
    """Sales rows with flags for stores and items that do not exist."""
    sales = sales_rows(train, test)
    flagged = _flag_orphans(sales, stores, "store_nbr", "is_orphan_store", sales)
    flagged = _flag_orphans(flagged, items, "item_nbr", "is_orphan_item", sales)
    return flagged.select(
        *sales.columns,
        "is_orphan_store",
        "is_orphan_item",
        (F.col("is_orphan_store") | F.col("is_orphan_item")).alias("has_integrity_issues"),
    )


def _flag_orphans(
    frame: DataFrame, parents: Lookup | DataFrame, key: str, flag: str, sales: DataFrame
) -> DataFrame:
    parents = parents if isinstance(parents, Lookup) else Lookup.of(parents.select(key))
    known = parents.derive(parents.frame.select(key, F.lit(True).alias("_known")))
    joined = lookup_join(frame, known, [key], keys_from=sales, row_id=["id"])
    return joined.withColumn(flag, F.col("_known").isNull()).drop("_known")


def holidays_clean(holidays: DataFrame) -> DataFrame:
    """Holidays that took place, one row per date and place.

    Equal events are counted together first: a place with very many rows on a day
    reaches the final grouping as its few distinct events.
    """
    place = ["date", "locale", "locale_name"]
    events = (
        holidays.where("transferred = false")
        .groupBy(*place, "type", "description")
        .agg(F.count("*").alias("events"))
    )
    merged = events.groupBy(*place).agg(
        joined_values("type").alias("type"),
        joined_values("description").alias("description"),
        F.sum("events").alias("holiday_count"),
    )
    return merged.select(
        "date",
        "type",
        "locale",
        "locale_name",
        "description",
        "holiday_count",
        (F.col("holiday_count") > 1).alias("is_multiple_holidays"),
    )
