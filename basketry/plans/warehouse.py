"""Stored views over the input tables, each built when first asked for."""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from basketry.operators import clean, enrich, explore
from basketry.operators.lookup import Lookup
from basketry.operators.rollup import BY_SIZE, FINEST, Summaries, keys_needed, summarise
from basketry.session import fit_shuffles, fresh_path
from basketry.sinks.stored import gather_by_day, write_by_year
from basketry.sources.stored import folder_state, path_exists, read_by_year
from basketry.tables import RetailTables


class Warehouse:
    """Input tables and the views built on them.

    Reports that go over the sales once read the input. The small tables are written to
    the shared folder when first asked for and read from there afterwards, and so are the
    wide sales table, at ``master_path`` if given, so that no report repeats its joins, and
    the sales per day, store and family that many reports start from. The layout of the
    sales by year and day is a load of its own (``train_by_year``): at ``train_path``, if
    given, it is kept and found again by later sessions. A new ``Warehouse`` builds all
    views anew.
    """

    def __init__(
        self,
        spark: SparkSession,
        tables: RetailTables,
        master_path: str | None = None,
        train_path: str | None = None,
    ):
        self.spark = spark
        self.raw = tables
        self.master_path = master_path
        self.train_path = train_path
        self._first_summary: Summaries | None = None  # and those made after it, a report each

    def _stored(self, name: str, frame: DataFrame) -> DataFrame:
        path = fresh_path(self.spark, name)
        frame.write.parquet(path)
        return self.spark.read.schema(frame.schema).parquet(path)

    def _stored_by_year(
        self, name: str, frame: DataFrame, path: str | None = None, gathered: bool = False
    ) -> DataFrame:
        path = path or fresh_path(self.spark, name)
        write_by_year(frame, path, gathered=gathered)
        return read_by_year(self.spark, path, frame.schema)

    @property
    def train(self) -> DataFrame:
        return self.raw.train

    @cached_property
    def train_by_year(self) -> DataFrame:
        """The sales laid out by year and day, with their ``year``."""
        if self.train_path and path_exists(self.spark, f"{self.train_path}/_SUCCESS"):
            return read_by_year(self.spark, self.train_path, self.raw.train.schema)
        return self._stored_by_year("train", self.raw.train, self.train_path)

    @cached_property
    def transactions(self) -> DataFrame:
        return self._stored("transactions", self.raw.transactions)

    @cached_property
    def holidays_events(self) -> DataFrame:
        return self._stored("holidays_events", self.raw.holidays_events)

    @cached_property
    def stores(self) -> Lookup:
        return Lookup.of(self._stored("stores", self.raw.stores))

    @cached_property
    def items(self) -> Lookup:
        return Lookup.of(self._stored("items", self.raw.items))

    @cached_property
    def oil(self) -> DataFrame:
        return self._stored("oil", self.raw.oil)

    @cached_property
    def oil_clean(self) -> Lookup:
        return Lookup.of(self._stored("oil_clean", clean.oil_clean(self.oil)))

    @cached_property
    def holidays_clean(self) -> Lookup:
        merged = clean.holidays_clean(self.holidays_events)
        return Lookup.of(self._stored("holidays_clean", merged))

    @cached_property
    def holiday_events(self) -> enrich.HolidayEvents:
        """The holidays as the wide table joins them, stored and measured once."""
        return enrich.holiday_events(self.holidays_clean, self._stored)

    @cached_property
    def tables(self) -> RetailTables:
        """The input tables; ``train`` and ``test`` are read where they are."""
        return RetailTables(
            stores=self.stores.frame,
            items=self.items.frame,
            transactions=self.transactions,
            oil=self.oil,
            holidays_events=self.holidays_events,
            train=self.train,
            test=self.raw.test,
        )

    @cached_property
    def daily(self) -> DataFrame:
        """One row per day, the base of all series over time."""
        return self._stored("daily", explore.daily_sales(self.train))

    @cached_property
    def store_performance(self) -> DataFrame:
        found = explore.store_performance(self.train, self.stores.frame)
        return self._stored("store_performance", found)

    @cached_property
    def family_performance(self) -> DataFrame:
        found = explore.family_performance(self.train, self.items)
        return self._stored("family_performance", found)

    @cached_property
    def summaries(self) -> Summaries:
        """Sums by day, store, family and promotion, and coarser ones, from the wide table."""
        return Summaries.build(self.master, self.stores, self._stored_summary)

    def _stored_summary(self, name: str, frame: DataFrame) -> DataFrame:
        """The finest one by year and day; the others are small."""
        finest = set(FINEST) <= set(frame.columns)
        return self._stored_by_year(name, frame) if finest else self._stored(name, frame)

    def sales_by(self, *columns: str) -> DataFrame:
        """Sales with the given columns, from the smallest summary that covers them.

        Columns that no summary can cover are read from the wide table: none is built for them.
        A report that no summary made so far covers makes the one it needs.
        """
        needed = keys_needed(columns)
        if needed is None:
            return self.master
        if "summaries" in self.__dict__:
            return self.summaries.source(columns, self.master)
        if self._first_summary is None:
            self._first_summary = Summaries(self.stores)
        if not self._first_summary.choose(columns):
            self._add_summary(needed)
        return self._first_summary.source(columns, self.raw.train)

    def _add_summary(self, needed: frozenset[str]) -> None:
        """The summary that covers the keys, by one pass over the wide rows: the sales are
        shuffled as its cells, and not as rows of a table that is not asked for."""
        keys = next(each for each in BY_SIZE if needed <= set(each))
        cells = summarise(self.wide_rows(), keys)
        self._first_summary.add(keys, self._stored_summary(f"summary-{'-'.join(keys)}", cells))

    def wide_rows(self) -> DataFrame:
        """The wide sales table for one pass over it: as stored, or as a plan before it is."""
        return self.master if "master" in self.__dict__ else self.master_rows()

    def train_clean(self) -> DataFrame:
        return clean.train_clean(self.train, self.stores, self.items, self.raw.test)

    def sales(self) -> DataFrame:
        return clean.sales_rows(self.train, self.raw.test)

    def master_rows(self, **layout: Callable[[DataFrame], DataFrame]) -> DataFrame:
        """The wide sales table as a plan, not stored."""
        return enrich.master(
            self.sales(), self.stores, self.items, self.oil_clean, self.holiday_events, **layout
        )

    @cached_property
    def master(self) -> DataFrame:
        """Brought together by day before the sales are made wide."""
        rows = self.master_rows(gather=gather_by_day)
        return self._stored_by_year("master", rows, self.master_path, gathered=True)


_open: dict[tuple[str, str], tuple[tuple, Warehouse]] = {}


def open_warehouse(
    spark: SparkSession, source: str, load: Callable[[SparkSession, str], RetailTables]
) -> Warehouse:
    """The session's warehouse for a source folder, so that queries share its views.

    A folder that has changed gets a new one. Shuffles are sized for the folder.
    """
    key = (spark.sparkContext.applicationId, source)
    size, state = folder_state(spark, source)
    if key not in _open or _open[key][0] != state:
        fit_shuffles(spark, 4 * size)  # stored columns take about a quarter of their rows
        _open[key] = (state, Warehouse(spark, load(spark, source)))
    return _open[key][1]
