"""Every registered query by name, on the tables derived by the adapter."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketry import schemas
from basketry.functions.aggregates import as_doubles
from basketry.functions.calendar import add_calendar, add_day_names
from basketry.functions.labels import title
from basketry.operators import (
    clean,
    dashboard,
    enrich,
    explore,
    ordered,
    quality,
    reports,
    sketches,
    topk,
)
from basketry.operators.distinct import counts_by_key
from basketry.operators.quantiles import describe_all
from basketry.plans.build import run, store_views
from basketry.plans.refresh import VIEWS, SmallTables, read_view, refresh
from basketry.plans.warehouse import Warehouse, open_warehouse
from basketry.session import fresh_path
from basketry.sinks.clustered import write_clustered
from basketry.sinks.observed import load_figures, write_observed
from basketry.sinks.stored import append_table, rows_per_year, write_by_year, write_csv
from basketry.sources import checked, stored
from basketry.sources.adapter import CUTOFF, YEARS, adapt
from basketry.sources.csv_files import (
    data_lines,
    read_fact,
    read_predictions,
    read_table,
    surrogate_key,
)
from basketry.streaming.incremental import load_new_files
from basketry.streaming.unique import load_unique_rows

Query = Callable[[SparkSession, str], DataFrame]

_FIRST_DAY = f"{YEARS[0]}-01-01"
_END_DAY = f"{YEARS[-1] + 1}-01-01"
_FILTERS = {"store_nbr": 6, "item_family": "Brand#19", "year": 1999}
_ONE_YEAR = {"year": 1999}
_SOME_YEARS = (1996, 1998, 2001)


def warehouse(spark: SparkSession, folder: str) -> Warehouse:
    return open_warehouse(spark, folder, adapt)


# --- sources, sinks and streams ------------------------------------------------------


def _table_counts(w: Warehouse) -> DataFrame:
    stored.register_views(w.tables, "loaded_")
    return stored.table_counts(w.spark, schemas.LOADED_TABLES, "loaded_")


def _csv_dimensions(w: Warehouse) -> DataFrame:
    """The small tables through CSV files; ``transferred`` is left out and so its default."""
    report = None
    tables = w.tables.present()
    for name in ("stores", "items", "transactions", "oil", "holidays_events"):
        path = fresh_path(w.spark, f"{name}-csv")
        write_csv(tables[name].drop("transferred"), path)
        loaded = read_table(w.spark, path, name)
        values = F.concat_ws("|", *(F.col(c).cast("string") for c in loaded.columns))
        row = loaded.select(F.lit(name).alias("table_name"), F.length(values).alias("size"))
        row = row.groupBy("table_name").agg(
            F.count("*").alias("rows"), F.sum("size").alias("characters")
        )
        report = row if report is None else report.unionByName(row)
    return report


def _export_years(w: Warehouse) -> DataFrame:
    """Some years written and read back: rows of each and in all (no year)."""
    path = fresh_path(w.spark, "years")
    write_by_year(stored.slice_years(w.master, _SOME_YEARS), path, _SOME_YEARS)
    written = stored.read_master(w.spark, path)
    return written.rollup("year").agg(F.count("*").alias("rows"))


def _clean_view_counts(w: Warehouse) -> DataFrame:
    names = store_views(w, fresh_path(w.spark, "views"))
    return stored.table_counts(w.spark, names).select("table_name", "row_count")


def _append_rows(w: Warehouse) -> DataFrame:
    """Oil prices added to a table twice."""
    path = fresh_path(w.spark, "appended")
    name = f"appended_oil_{path.rsplit('-', 1)[-1]}"
    for _ in range(2):
        append_table(w.oil, name, path)
    return w.spark.table(name).agg(
        F.count("*").alias("rows"), F.sum("dcoilwtico").alias("total_price")
    )


def _predictions_roundtrip(w: Warehouse) -> DataFrame:
    path = fresh_path(w.spark, "predictions")
    made = w.raw.test.select("id", (F.col("id") % 7).cast("double").alias("unit_sales"))
    write_csv(made, path)
    schema = T.StructType(
        [T.StructField("id", T.LongType()), T.StructField("unit_sales", T.DoubleType())]
    )
    return read_predictions(w.spark, path, schema).agg(
        F.count("*").alias("rows"), F.sum("id").alias("ids"), F.sum("unit_sales").alias("units")
    )


def _layout_check(w: Warehouse) -> DataFrame:
    """Rows of the yearly layout that stand before an earlier day of the same file."""
    return _count_rows(ordered.out_of_order(w.train_by_year))


def _dimension_labels(w: Warehouse) -> DataFrame:
    top = dashboard.sales_by_dimension(w.sales_by("item_family"), "item_family")
    return top.select(
        title(F.lit("item_family")).alias("label"), F.col("item_family").alias("value"), "total_sales"
    )


def _summary_sizes(w: Warehouse) -> DataFrame:
    """Cells of each stored summary, and the rows and sales they stand for."""
    report = None
    for summary in w.summaries.known:
        one = summary.frame.agg(
            F.lit(",".join(summary.keys)).alias("keys"),
            F.count("*").alias("cells"),
            F.sum("rows").alias("rows"),
            F.sum("known").alias("known"),
            F.sum("unit_sales").alias("total_sales"),
        )
        report = one if report is None else report.unionByName(one)
    return report


def _csv_roundtrip(w: Warehouse) -> DataFrame:
    path = fresh_path(w.spark, "train-csv")
    write_csv(w.train, path)
    loaded = read_fact(w.spark, path)
    return loaded.agg(
        data_lines(w.spark, path).scalar().alias("data_lines"),
        F.count("*").alias("rows_loaded"),
        F.sum("unit_sales").alias("total_sales"),
        F.count_if(F.col("onpromotion").isNull()).alias("unknown_promotions"),
        F.count_if(F.col("onpromotion")).alias("promotions"),
        F.min("date").alias("first_date"),
        F.max("date").alias("last_date"),
    )


def _incremental_load(w: Warehouse) -> DataFrame:
    source, target, progress = (
        fresh_path(w.spark, name) for name in ("arriving", "loaded", "progress")
    )
    write_csv(w.train, source)
    for _ in range(2):  # the second run finds nothing new
        load_new_files(w.spark, source, target, progress)
    loaded = w.spark.read.parquet(target)  # a folder per batch, and in it per year
    return loaded.groupBy("year").agg(
        F.count("*").alias("rows"), F.sum("unit_sales").alias("total_sales")
    )


def _stream_unique_rows(w: Warehouse) -> DataFrame:
    """Keys per year after every file has come three times, each time under other names. Sales
    that share a key are one row, whichever came first."""
    source, target, progress = (
        fresh_path(w.spark, name) for name in ("repeated", "unique", "progress")
    )
    write_csv(w.train, f"{source}/first")
    write_csv(w.train, f"{source}/again")
    load_unique_rows(w.spark, f"{source}/*", target, progress)
    write_csv(w.train, f"{source}/later")
    load_unique_rows(w.spark, f"{source}/*", target, progress)
    loaded = w.spark.read.parquet(target)
    return loaded.groupBy("year").agg(
        F.count("*").alias("rows"),
        F.sum("id").alias("ids"),
        F.min("date").alias("first_date"),
        F.max("date").alias("last_date"),
    )


#: Damage done to lines of the sales file, by the last digits of their id.
_DAMAGE = {
    0: "concat_ws(',', id, date, store_nbr, item_nbr, 'many', onpromotion)",
    1: "concat_ws(',', id, '', store_nbr, item_nbr, unit_sales, onpromotion)",
    2: "concat_ws(',', id, date, store_nbr, '', unit_sales, onpromotion)",
    3: "concat_ws(',', id, date, store_nbr, item_nbr, unit_sales, onpromotion, 'more')",
    4: "concat_ws(',', id, '1890-01-01', store_nbr, item_nbr, unit_sales, onpromotion)",
    5: "concat_ws(',', id, '', '', '', '', onpromotion)",
}


def _rejected_rows(w: Warehouse) -> DataFrame:
    """Rows accepted, and rows refused per reason, of a sales file with damaged lines."""
    text = w.train.select(
        *[F.col(c) if c == "id" else F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in schemas.TRAIN.names]
    )
    line = F.expr("concat_ws(',', id, date, store_nbr, item_nbr, unit_sales, onpromotion)")
    for digits, broken in _DAMAGE.items():
        line = F.when(F.col("id") % 1000 == digits, F.expr(broken)).otherwise(line)
    path = fresh_path(w.spark, "damaged")
    head = ",".join(schemas.TRAIN.names)
    text.select(line.alias(head)).write.options(header=True, quote="", escapeQuotes=False, sep="\u0001").csv(path)
    checked_lines = checked.judged(
        checked.read_lines(w.spark, path, schemas.TRAIN),
        {**checked.missing_values("train"), **checked.outside("date", _FIRST_DAY, _END_DAY)},
        {"store_nbr": w.stores, "item_nbr": w.items},
        row_id=("id",),
    )
    split = checked.store_split(checked_lines, fresh_path(w.spark, "split"))
    kept = split.accepted.agg(F.lit("accepted").alias("reason"), F.count("*").alias("rows"))
    refused = split.refused.agg(F.lit("refused").alias("reason"), F.count("*").alias("rows"))
    return checked.reasons_count(split.refused).unionByName(kept).unionByName(refused)


def _observed_load(w: Warehouse) -> DataFrame:
    """Figures of a load gathered by the load itself, beside the rows then stored."""
    source, path = fresh_path(w.spark, "observed-csv"), fresh_path(w.spark, "observed")
    write_csv(w.train, source)
    figures = write_observed(
        read_fact(w.spark, source), lambda rows: write_by_year(rows, path), load_figures()
    )
    schema = (
        "rows long, total_sales decimal(22,5), unknown_promotions long, promotions long, "
        "first_date date, last_date date"
    )
    seen = w.spark.createDataFrame([tuple(figures[name] for name in load_figures())], schema)
    return seen.withColumn("stored_rows", w.spark.read.parquet(path).agg(F.count("*")).scalar())


def _whole_run(w: Warehouse) -> DataFrame:
    """Rows per year after a run from CSV files to the exported wide table."""
    raw, output = fresh_path(w.spark, "raw"), fresh_path(w.spark, "processed")
    for name, frame in w.raw.present().items():
        write_csv(frame, f"{raw}/{name}.csv")
    return run(w.spark, raw, output, CUTOFF)


#: Sales that arrive later than the others: the last years, and a part of a month long past.
_LATE = "date >= DATE '2000-01-01' OR (date BETWEEN DATE '1997-05-01' AND DATE '1997-05-31' AND onpromotion)"


def _refreshed_views(w: Warehouse) -> DataFrame:
    """Rows and sales per view and year after sales have arrived, and been worked in, twice."""
    source, target, progress, views = (
        fresh_path(w.spark, name) for name in ("arriving", "loaded", "progress", "views")
    )
    small = SmallTables(w.stores, w.items, w.oil_clean, w.holidays_clean, w.raw.test)
    late = F.coalesce(F.expr(_LATE), F.lit(False))
    for number, rows in enumerate([w.train.where(~late), w.train.where(late)]):
        write_csv(rows, f"{source}/arrival={number}")
        load_new_files(w.spark, f"{source}/*", target, progress)
        refresh(w.spark, target, views, small)
    report = None
    for name in VIEWS:
        view = read_view(w.spark, views, name)
        units = "total_sales" if name == "daily" else "unit_sales"
        one = view.groupBy(F.lit(name).alias("view"), "year").agg(
            F.count("*").alias("rows"), F.sum(units).cast("double").alias("total_sales")
        )
        report = one if report is None else report.unionByName(one)
    return report


def _surrogate_key(w: Warehouse) -> DataFrame:
    keyed = w.raw.train.drop("id").withColumn("id", surrogate_key())
    return keyed.agg(F.count("*").alias("rows"), F.count_distinct("id").alias("distinct_ids"))


# --- cleaning and enrichment ---------------------------------------------------------


def _calendar_features(w: Warehouse) -> DataFrame:
    return add_calendar(w.train.select("date").distinct())


def _holiday_matches(w: Warehouse) -> DataFrame:
    placed = enrich.join_stores(w.sales(), w.stores)
    return enrich.join_holidays(placed, w.holiday_events).select(
        "id", "date", "store_nbr", "is_holiday", "holiday_type", "holiday_description"
    )


# --- overview counts -----------------------------------------------------------------


def _holidays_by_year(w: Warehouse) -> DataFrame:
    return explore.value_counts(stored.read_with_year(w.holidays_events), "year")


def _distinct_counts(w: Warehouse) -> DataFrame:
    counted = {
        "stores": ("city", "state", "type", "cluster"),
        "items": ("family", "class"),
        "holidays_events": ("type",),
        "transactions": ("store_nbr",),
    }
    return _for_tables(w, counted, quality.distinct_values)


def _missing_values(w: Warehouse) -> DataFrame:
    names = ("stores", "items", "oil", "holidays_events", "transactions")
    counted = {name: tuple(schemas.TABLES[name].names) for name in names}
    return _for_tables(w, counted, quality.missing_values)


def _for_tables(w: Warehouse, columns: dict[str, tuple[str, ...]], count: Callable) -> DataFrame:
    present = w.tables.present()
    first, *rest = [count(present[name], name, wanted) for name, wanted in columns.items()]
    for report in rest:
        first = first.unionByName(report)
    return first


def _by_sales(performance: DataFrame, key: str) -> DataFrame:
    return performance.orderBy(F.desc_nulls_first("total_sales"), F.asc_nulls_first(key))


def _rounded_std(summary: DataFrame) -> DataFrame:
    """Means and deviations as they are printed, to six places."""
    return summary.withColumns(
        {name: F.round(name, 6) for name in ("mean", "std", "p25", "p50", "p75")}
    )


def _describe_daily(w: Warehouse) -> DataFrame:
    columns = ["total_sales", "num_transactions", "avg_sales"]
    return _rounded_std(explore.describe(w.daily, columns))


def _latest(w: Warehouse, n: int = 100_000) -> DataFrame:
    days = w.daily.select("date", F.col("num_transactions").alias("rows"))
    return topk.latest_rows(w.train_by_year, n, days=days).drop("year")


def _describe_latest(w: Warehouse) -> DataFrame:
    return _rounded_std(explore.describe(_latest(w), ["unit_sales"]))


def _fill_per_series(w: Warehouse) -> DataFrame:
    """Daily sales of every family without gaps: as known, filled, and their mean over 7 days."""
    sales = dashboard.known_sales(w.sales_by("date", "item_family"))
    per_day = sales.groupBy("item_family", "date").agg(F.sum("unit_sales").alias("units"))
    series = ordered.daily_series(per_day, ["item_family"])
    filled = ordered.fill(series, ["item_family"], "units", "filled")
    return ordered.moving_mean(filled, ["item_family"], "filled", 7, "ma_7")


def _approx_items_by_span(w: Warehouse) -> DataFrame:
    """Distinct stores and items per year, exact, and whether the merged daily sketches of
    that year are within their stated error."""
    columns = ("store_nbr", "item_nbr")
    path = fresh_path(w.spark, "sketches")
    sketches.daily_sketches(w.train, columns).write.parquet(path)
    year = F.year("date").alias("year")
    about = sketches.merged_estimates(w.spark.read.parquet(path), [year], columns)
    sales = w.train.select("*", year)
    exact = counts_by_key(
        sales, ["year"], {"stores": "store_nbr", "items": "item_nbr"}, {"rows": F.count("*")}
    )
    error = sketches.relative_error()
    close = [
        (F.abs(F.col(f"about_{column}") - F.col(name)) <= F.ceil(F.col(name) * error)).alias(f"{name}_close")
        for name, column in (("stores", "store_nbr"), ("items", "item_nbr"))
    ]
    return exact.join(about, "year").select("year", "rows", "stores", "items", *close)


def _clustered_series(w: Warehouse) -> DataFrame:
    """A store's and an item's sales per day, read from a layout by day, store and item."""
    path = fresh_path(w.spark, "clustered")
    write_clustered(w.train, path)
    stored_sales = w.spark.read.schema(w.train.schema).parquet(path)
    chosen = (F.col("store_nbr") == 6) | (F.col("item_nbr") == 20)
    return (
        stored_sales.where(chosen)
        .groupBy("date")
        .agg(F.count("*").alias("rows"), F.sum("unit_sales").alias("total_sales"))
        .orderBy("date")
    )


# --- quality -------------------------------------------------------------------------


def _count_rows(frame: DataFrame) -> DataFrame:
    return frame.agg(F.count("*").alias("violations"))


_QUERIES: dict[str, Callable[[Warehouse], DataFrame]] = {
    # sources, sinks and streams
    "s_table_counts": _table_counts,
    "csv_roundtrip": _csv_roundtrip,
    "csv_dimensions": _csv_dimensions,
    "predictions_roundtrip": _predictions_roundtrip,
    "append_rows": _append_rows,
    "clean_view_counts": _clean_view_counts,
    "export_years": _export_years,
    "layout_check": _layout_check,
    "incremental_load": _incremental_load,
    "stream_unique_rows": _stream_unique_rows,
    "rejected_rows": _rejected_rows,
    "observed_load": _observed_load,
    "whole_run": _whole_run,
    "refreshed_views": _refreshed_views,
    "surrogate_key": _surrogate_key,
    "export_rows_per_year": lambda w: rows_per_year(w.master),
    # cleaning and enrichment
    "oil_calendar": lambda w: clean.oil_calendar(w.oil),
    "oil_clean": lambda w: clean.oil_clean(w.oil),
    "train_clean": lambda w: w.train_clean(),
    "holidays_clean": lambda w: clean.holidays_clean(w.holidays_events),
    "calendar_features": _calendar_features,
    "master": lambda w: w.master_rows(),
    "master_holiday_join": _holiday_matches,
    # validation reports
    "v_oil": lambda w: reports.validate_oil(w.oil_clean.frame),
    "v_train": lambda w: reports.validate_train(w.train_clean(), CUTOFF),
    "v_holidays": lambda w: reports.validate_holidays(w.holidays_clean.frame),
    "v_master": lambda w: reports.validate_master(w.wide_rows(), CUTOFF),
    "holiday_distribution": lambda w: reports.holiday_distribution(w.master, CUTOFF),
    "payday_impact": lambda w: reports.payday_impact(w.master, CUTOFF),
    "top_families": lambda w: reports.top_families(w.master, CUTOFF),
    # dashboard, from the stored summaries
    "kpi": lambda w: dashboard.kpi_metrics(w.sales_by("date"), w.stores.frame, w.items.frame),
    "monthly_sales": lambda w: dashboard.monthly_sales(w.sales_by("year", "month")),
    "top_city": lambda w: dashboard.sales_by_dimension(w.sales_by("city"), "city"),
    "top_item_family": lambda w: dashboard.sales_by_dimension(
        w.sales_by("item_family"), "item_family"
    ),
    "dow_average": lambda w: dashboard.sales_by_day_of_week(w.sales_by("date", "day_of_week")),
    "filtered_series": lambda w: dashboard.filtered_time_series(
        w.sales_by("date", *_FILTERS), **_FILTERS
    ),
    "filtered_series_year": lambda w: dashboard.filtered_time_series(
        w.sales_by("date", "year"), **_ONE_YEAR
    ),
    "filtered_promo": lambda w: dashboard.promotion_impact(
        w.sales_by("onpromotion", *_FILTERS), **_FILTERS
    ),
    "filtered_promo_year": lambda w: dashboard.promotion_impact(
        w.sales_by("onpromotion", "year"), **_ONE_YEAR
    ),
    "filtered_promo_all": lambda w: dashboard.promotion_impact(w.sales_by("onpromotion")),
    "filter_stores": lambda w: dashboard.filter_values(w.sales_by("store_nbr"), "store_nbr"),
    "filter_years": lambda w: dashboard.filter_values(w.sales_by("year"), "year"),
    "dimension_labels": _dimension_labels,
    "day_names": lambda w: add_day_names(w.train.select("date").distinct()),
    "filter_families": lambda w: dashboard.filter_values(w.sales_by("item_family"), "item_family"),
    "top_item_class": lambda w: dashboard.sales_by_dimension(w.sales_by("item_class"), "item_class"),
    "summary_sizes": _summary_sizes,
    # overview counts
    "vc_store_state": lambda w: explore.value_counts(w.stores.frame, "state"),
    "vc_store_city": lambda w: explore.value_counts(w.stores.frame, "city"),
    "vc_item_family": lambda w: explore.value_counts(w.items.frame, "family", 10),
    "vc_perishable": lambda w: explore.value_counts(w.items.frame, "perishable"),
    "vc_holiday_type": lambda w: explore.value_counts(w.holidays_events, "type"),
    "vc_holiday_locale": lambda w: explore.value_counts(w.holidays_events, "locale"),
    "vc_holiday_year": _holidays_by_year,
    "stores_type_cluster": lambda w: explore.pair_counts(w.stores.frame, "type", "cluster"),
    "distinct_counts": _distinct_counts,
    "missing_values": _missing_values,
    "tx_per_year": lambda w: explore.transactions_per_year(w.transactions),
    "date_span": lambda w: explore.date_span(w.train),
    "invalid_values": lambda w: explore.invalid_values(w.train),
    "latest_rows": _latest,
    "latest_rows_10k": lambda w: _latest(w, 10_000),
    "describe_latest": _describe_latest,
    "describe_sales": lambda w: _rounded_std(describe_all(w.train, "unit_sales")),
    # daily series
    "daily_sales": lambda w: explore.daily_sales(w.train).orderBy("date"),
    "describe_daily": _describe_daily,
    "year_ranges": lambda w: explore.year_ranges(w.daily),
    "yearly_sales": lambda w: explore.yearly_sales(w.daily),
    "month_pattern": lambda w: explore.month_pattern(w.daily),
    "best_worst_month": lambda w: explore.best_and_worst_month(explore.month_pattern(w.daily)),
    "dow_vs_avg": lambda w: explore.weekday_pattern(w.daily),
    "holiday_vs_regular": lambda w: explore.holiday_comparison(w.daily, w.holidays_events),
    "holiday_lift": lambda w: explore.holiday_lift(
        explore.holiday_comparison(w.daily, w.holidays_events)
    ),
    "fill_per_series": _fill_per_series,
    "approx_items_by_span": _approx_items_by_span,
    "clustered_series": _clustered_series,
    "december_stats": lambda w: explore.december_stats(w.daily),
    "december_daily": lambda w: explore.december_days(w.daily),
    "december_years": lambda w: explore.december_years(w.daily),
    "moving_avg_30": lambda w: explore.moving_average(w.daily),
    "sales_vs_oil": lambda w: explore.sales_and_oil(w.daily, w.oil),
    # stores, items and promotions
    "store_perf": lambda w: _by_sales(
        explore.store_performance(w.train, w.stores.frame), "store_nbr"
    ),
    "store_top_bottom": lambda w: explore.top_and_bottom_stores(w.store_performance),
    "type_perf": lambda w: explore.type_performance(w.store_performance),
    "city_perf": lambda w: explore.city_performance(w.store_performance),
    "concentration_stores": lambda w: explore.store_concentration(
        w.store_performance, w.stores.frame
    ),
    "family_perf": lambda w: _by_sales(explore.family_performance(w.train, w.items), "family"),
    "family_top15": lambda w: explore.top_by_sales(w.family_performance, "family", 15),
    "concentration_families": lambda w: explore.family_concentration(w.family_performance),
    "perishable_split": lambda w: explore.perishable_split(w.train, w.items.frame),
    "promo_by_flag": lambda w: explore.promotion_by_flag(w.train),
    "promo_lift": lambda w: explore.promotion_lift(explore.promotion_by_flag(w.train)),
    # constraints
    "q_pk_duplicates": lambda w: quality.primary_key_report(w.tables),
    "q_fk_orphans": lambda w: quality.foreign_key_report(w.tables),
    "q_nulls": lambda w: quality.not_null_report(w.tables),
    "q_domain": lambda w: _count_rows(quality.outside_domain(w.items.frame)),
    "q_date_range": lambda w: _count_rows(
        quality.outside_range(w.train, _FIRST_DAY, _END_DAY)
    ),
}


def _as_query(build: Callable[[Warehouse], DataFrame]) -> Query:
    return lambda spark, folder: as_doubles(build(warehouse(spark, folder)))


def queries() -> dict[str, Query]:
    return {name: _as_query(build) for name, build in _QUERIES.items()}
