"""Building and validating everything from input tables or CSV files."""

from __future__ import annotations

import logging
from collections.abc import Sequence
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry import schemas
from basketry.operators import reports
from basketry.plans.warehouse import Warehouse
from basketry.sinks.observed import clean_figures, write_observed
from basketry.sinks.stored import CLUSTER_BY, rebuild_view, rows_per_year, write_by_year
from basketry.sources.csv_files import read_fact, read_table
from basketry.sources.stored import read_master
from basketry.tables import RetailTables

log = logging.getLogger(__name__)


def load_tables(spark: SparkSession, folder: str) -> RetailTables:
    """Read ``<table>.csv`` for every input table; only ``test`` may be missing."""
    frames = {
        name: read_fact(spark, f"{folder}/train.csv")
        if name == "train"
        else read_table(spark, f"{folder}/{name}.csv", name)
        for name in schemas.TABLES
    }
    missing = [name for name in schemas.LOADED_TABLES if frames[name] is None]
    if missing:
        raise FileNotFoundError(f"no CSV file for: {', '.join(missing)}")
    return RetailTables(**frames)


def store_views(warehouse: Warehouse, folder: str) -> list[str]:
    """Store the clean views, and then the wide table, under their names in ``folder``.

    Later sessions with the same catalog query them by name; a rebuilt view replaces the
    one before.
    """
    views = {
        "oil_clean": (warehouse.oil_clean.frame, ("date",)),
        "train_clean": (warehouse.train_clean(), CLUSTER_BY),
        "holidays_clean": (warehouse.holidays_clean.frame, ("date",)),
    }
    if not warehouse.master_path:
        views["master"] = (warehouse.master, CLUSTER_BY)
    for name, (frame, order) in views.items():
        figures = clean_figures() if name == "train_clean" else {"rows": F.count("*")}
        write = partial(rebuild_view, name=name, sort_by=order, path=f"{folder}/{name}")
        log.info("%s stored: %s", name, write_observed(frame, write, figures))
    if warehouse.master_path:  # stored already: only its name is missing
        master, catalog = warehouse.master, warehouse.spark.catalog
        warehouse.spark.sql("DROP TABLE IF EXISTS master")
        catalog.createTable("master", warehouse.master_path, "parquet", master.schema)
        views["master"] = (master, ())
    return list(views)


def clean_all(warehouse: Warehouse, cutoff: str) -> dict[str, DataFrame]:
    """Build the clean views; returns the report of each."""
    return {
        "oil_clean": reports.validate_oil(warehouse.oil_clean.frame),
        "train_clean": reports.validate_train(warehouse.train_clean(), cutoff),
        "holidays_clean": reports.validate_holidays(warehouse.holidays_clean.frame),
    }


def master_reports(master: DataFrame, cutoff: str) -> dict[str, DataFrame]:
    return {
        "general": reports.validate_master(master, cutoff),
        "holidays": reports.holiday_distribution(master, cutoff),
        "payday": reports.payday_impact(master, cutoff),
        "families": reports.top_families(master, cutoff),
    }


def log_reports(named: dict[str, DataFrame]) -> None:
    """Reports have a handful of rows each."""
    for name, report in named.items():
        for row in report.toLocalIterator():
            log.info("%s: %s", name, row.asDict())


def export(
    warehouse: Warehouse, path: str, years: Sequence[int] | None = None
) -> DataFrame:
    """Write a copy of the wide sales table, or of some of its years; returns the rows
    per year at ``path``."""
    write_by_year(warehouse.master, path, years)
    return rows_per_year(read_master(warehouse.spark, path))


def run(spark: SparkSession, folder: str, output: str, cutoff: str) -> DataFrame:
    """CSV files to clean views, reports and the wide table, stored by year in ``output``."""
    warehouse = Warehouse(spark, load_tables(spark, folder), master_path=output)
    log_reports(clean_all(warehouse, cutoff))
    log_reports(master_reports(warehouse.master, cutoff))
    store_views(warehouse, f"{output}-views")
    return rows_per_year(warehouse.master)
