"""Stored tables: Parquet folders, catalog tables and yearly slices."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketry import schemas
from basketry.tables import RetailTables


def read_by_year(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A table written by ``sinks.write_by_year``: the columns of ``schema`` and ``year``.

    A filter on ``year`` reads only its folders.
    """
    fields = list(schema.fields)
    if "year" not in schema.names:
        fields.append(T.StructField("year", schemas.INT))
    return spark.read.schema(T.StructType(fields)).parquet(path).select(*[f.name for f in fields])


def read_master(spark: SparkSession, path: str) -> DataFrame:
    """The exported wide sales table; a filter on ``year`` reads only its folders."""
    return read_by_year(spark, path, schemas.MASTER)


def read_with_year(frame: DataFrame, column: str = "date") -> DataFrame:
    return frame.select("*", F.year(column).alias("year"))


def slice_years(frame: DataFrame, years: Sequence[int]) -> DataFrame:
    """Rows of the given years, by the stored ``year`` where there is one."""
    year = F.col("year") if "year" in frame.columns else F.year("date")
    return frame.where(year.isin(*years))


def month_predicates(years: Iterable[int], column: str = "date") -> list[str]:
    """Range predicates that cover each year once, month by month."""
    starts = [(year, month) for year in years for month in range(1, 13)]
    return [
        f"{column} >= '{year}-{month:02}-01' AND "
        f"{column} < '{year + month // 12}-{month % 12 + 1:02}-01'"
        for year, month in starts
    ]


def read_database_by_year(
    spark: SparkSession, url: str, table: str, years: Iterable[int], properties: Mapping[str, str]
) -> DataFrame:
    """The given years of a database table, each month fetched by its own task."""
    return spark.read.jdbc(
        url, table, predicates=month_predicates(years), properties=dict(properties)
    )


def folder_state(spark: SparkSession, folder: str) -> tuple[int, tuple]:
    """Bytes in a folder of tables, and names, sizes and times by which changes show."""
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(folder)
    files = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    waiting, found = [root], []
    while waiting:
        for status in files.listStatus(waiting.pop()):
            if status.isDirectory():
                waiting.append(status.getPath())
            else:
                name = status.getPath().toString()
                found.append((name, status.getLen(), status.getModificationTime()))
    return sum(size for _, size, _ in found), tuple(sorted(found))


def path_exists(spark: SparkSession, path: str) -> bool:
    context = spark.sparkContext
    file = context._jvm.org.apache.hadoop.fs.Path(path)
    return file.getFileSystem(context._jsc.hadoopConfiguration()).exists(file)


def folder_names(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders in a folder; none if it does not exist."""
    if not path_exists(spark, path):
        return []
    context = spark.sparkContext
    file = context._jvm.org.apache.hadoop.fs.Path(path)
    found = file.getFileSystem(context._jsc.hadoopConfiguration()).listStatus(file)
    return sorted(status.getPath().getName() for status in found if status.isDirectory())


def register_views(tables: RetailTables, prefix: str = "") -> None:
    for name, frame in tables.present().items():
        frame.createOrReplaceTempView(prefix + name)


def available_tables(spark: SparkSession) -> list[str]:
    return sorted(table.name for table in spark.catalog.listTables())


def table_counts(
    spark: SparkSession, names: Sequence[str] = schemas.LOADED_TABLES, prefix: str = ""
) -> DataFrame:
    """Rows per table. Each is counted by its own action, so that one that is missing or
    cannot be read reports its error and the rest go on."""
    report = []
    for name in names:
        try:
            report.append((name, spark.table(prefix + name).count(), None))
        except PySparkException as failure:
            report.append((name, None, failure.getCondition() or str(failure)))
        except Py4JJavaError as failure:  # a failed task
            report.append((name, None, str(failure.java_exception.getMessage()).split("\n")[0]))
    return spark.createDataFrame(report, "table_name string, row_count long, error string")
