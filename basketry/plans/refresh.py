"""Views kept up to date with the batches that an incremental load brings in.

Each view is stored in a folder per year and month. A refresh looks up which batches it has
not seen, finds the months they have rows of, builds these months anew from all rows loaded and
replaces them; the files of other months are not touched, read or written. What has been
seen is noted last, in one small file: a refresh that was interrupted is done again, and
ends with the same views. If a small table has changed, everything is built anew.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketry import schemas
from basketry.operators import clean, enrich, explore
from basketry.operators.lookup import Lookup
from basketry.operators.rollup import FINEST, summarise
from basketry.session import finer_tasks
from basketry.sinks.stored import WIDER
from basketry.sources.stored import path_exists
from basketry.streaming.incremental import loaded_batches, read_loaded

_STATE = "batch int, tables string"
Month = tuple[int | None, int | None]


@dataclass(frozen=True)
class SmallTables:
    """What the views join to the sales, and the rows to predict."""

    stores: Lookup
    items: Lookup
    oil_clean: Lookup
    holidays_clean: Lookup
    test: DataFrame | None = None

    def state(self) -> str:
        """Counts and sums of row hashes, by which any change shows."""
        lookups = (self.stores, self.items, self.oil_clean, self.holidays_clean)
        frames = [each.frame for each in lookups] + [self.test] * (self.test is not None)
        found = []
        for frame in frames:
            hashed = F.xxhash64(*[F.col(f"`{name}`") for name in sorted(frame.columns)])
            total = F.sum(hashed.cast(T.DecimalType(38, 0))).cast("string")
            row = frame.agg(F.count("*").alias("rows"), total.alias("total")).first()
            found.append(f"{row['rows']}:{row['total']}")
        return " ".join(found)


@dataclass(frozen=True)
class Refreshed:
    """What a refresh has done: new batches, and months built anew (None: all)."""

    batches: tuple[int, ...]
    months: tuple[Month, ...] | None


def _train_clean(train: DataFrame, small: SmallTables, test: DataFrame | None) -> DataFrame:
    return clean.train_clean(train, small.stores, small.items, test)


def _master(train: DataFrame, small: SmallTables, test: DataFrame | None) -> DataFrame:
    """Brought together by month before the sales are made wide."""
    sales = clean.sales_rows(train, test)
    return enrich.master(sales, small.stores, small.items, small.oil_clean, small.holidays_clean, _gather)


def _daily(train: DataFrame, small: SmallTables, test: DataFrame | None) -> DataFrame:
    return explore.daily_sales(train)


#: Views over sales, in the order they are built.
_FROM_SALES: dict[str, Callable[..., DataFrame]] = {
    "train_clean": _train_clean,
    "master": _master,
    "daily": _daily,
}
#: All views; the summary is built from the wide table's new months.
VIEWS = (*_FROM_SALES, "summary")


def _dated(frame: DataFrame) -> DataFrame:
    return frame.withColumns({"year": F.year("date"), "month": F.month("date")})


def _of_months(frame: DataFrame, months: Sequence[Month] | None) -> DataFrame:
    """Rows of the months. The years are tested apart, so that they choose folders."""
    if months is None:
        return frame
    years = {year for year, _ in months}
    year = F.col("year") if "year" in frame.columns else F.year("date")
    month = F.col("month") if "month" in frame.columns else F.month("date")
    wanted = [year.eqNullSafe(F.lit(y)) & month.eqNullSafe(F.lit(m)) for y, m in months]
    return frame.where(_any([year.eqNullSafe(F.lit(y)) for y in years])).where(_any(wanted))


def _any(tests: Sequence[Column]) -> Column:
    found = F.lit(False)
    for test in tests:
        found = found | test
    return found


def _gather(frame: DataFrame) -> DataFrame:
    return _dated(frame).hint("rebalance", F.col("year"), F.col("month"))


def _replace(frame: DataFrame, path: str, everything: bool, gathered: bool = False) -> None:
    """Write the months in ``frame`` in place of those stored, or of all that is stored.

    Its rows may be ``gathered`` by month already.
    """
    order = [name for name in ("date", "store_nbr", "item_nbr") if name in frame.columns]
    with finer_tasks(frame.sparkSession, WIDER if gathered else 1):
        (
            (frame if gathered else _gather(frame))
            .sortWithinPartitions("year", "month", *order)
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "static" if everything else "dynamic")
            .partitionBy("year", "month")
            .parquet(path)
        )


def read_view(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A refreshed view; filters on ``year`` and ``month`` read only their folders."""
    return spark.read.parquet(f"{folder}/{name}")


def _seen(spark: SparkSession, folder: str) -> tuple[set[int], str | None]:
    path = f"{folder}/state"
    if not path_exists(spark, path):
        return set(), None
    rows = spark.read.schema(_STATE).parquet(path)
    latest = rows.agg(F.max_by("tables", "batch").alias("tables")).first()["tables"]
    return {row["batch"] for row in rows.select("batch").distinct().toLocalIterator()}, latest


def refresh(spark: SparkSession, loaded: str, folder: str, small: SmallTables) -> Refreshed:
    """Bring the views in ``folder`` up to date with the batches in ``loaded``."""
    known, tables_before = _seen(spark, folder)
    tables = small.state()
    batches = loaded_batches(spark, loaded)
    new = sorted(set(batches) - known)
    everything = tables_before != tables
    if not batches or not (new or everything):
        return Refreshed((), ())
    train = read_loaded(spark, loaded, batches)
    months: tuple[Month, ...] | None = None
    if not everything:
        fresh = train.where(F.col("batch").isin(new))
        found = fresh.select(F.year("date").alias("y"), F.month("date").alias("m")).distinct()
        months = tuple(sorted(((r["y"], r["m"]) for r in found.toLocalIterator()), key=str))
    rows = _of_months(train, months).select(*schemas.TRAIN.names)
    test = None if small.test is None else _of_months(small.test, months)
    for name, build in _FROM_SALES.items():
        _replace(build(rows, small, test), f"{folder}/{name}", everything, gathered=build is _master)
    master = _of_months(read_view(spark, folder, "master"), months)
    _replace(summarise(master, FINEST), f"{folder}/summary", everything)
    noted = new if not everything else batches
    state = spark.createDataFrame([(batch, tables) for batch in noted], _STATE).coalesce(1)
    state.write.mode("overwrite" if everything else "append").parquet(f"{folder}/state")
    return Refreshed(tuple(new), months)
