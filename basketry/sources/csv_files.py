"""CSV sources: typed by name from the header line, never inferred."""

from __future__ import annotations

import logging

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketry import schemas

log = logging.getLogger(__name__)


def csv_header(spark: SparkSession, path: str) -> list[str]:
    """Column names of the files, from their header line."""
    return spark.read.option("header", True).csv(path).columns


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Read files with a header line; columns are matched by name.

    Columns the schema does not know are kept as text. A line that does not fit
    fails the read instead of turning into NULLs.
    """
    known = {field.name: field.dataType for field in schema.fields}
    names = csv_header(spark, path)
    ordered = T.StructType([T.StructField(n, known.get(n, T.StringType())) for n in names])
    return (
        spark.read.schema(ordered)
        .options(header=True, nullValue="", mode="FAILFAST", enforceSchema=False)
        .csv(path)
    )


def read_table(spark: SparkSession, path: str, name: str) -> DataFrame | None:
    """One of the input tables; a missing file is logged and gives None."""
    schema = schemas.TABLES[name]
    try:
        frame = read_csv(spark, path, schema)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        log.error("file not found: %s", path)
        return None
    return with_defaults(frame, name).select(*_load_columns(frame, schema))


def with_defaults(frame: DataFrame, name: str) -> DataFrame:
    """Add columns the source left out; a NULL the source did give stays NULL."""
    defaults = schemas.COLUMN_DEFAULTS.get(name, {})
    present = set(frame.columns)
    missing = {
        field.name: F.lit(defaults.get(field.name)).cast(field.dataType)
        for field in schemas.TABLES[name].fields
        if field.name not in present
    }
    return frame.withColumns(missing) if missing else frame


def _load_columns(frame: DataFrame, schema: T.StructType) -> list[str]:
    declared = [field.name for field in schema.fields]
    return declared + [name for name in frame.columns if name not in declared]


def surrogate_key() -> Column:
    """Unique, not dense. Use it right on a file scan, whose row order is fixed."""
    return F.monotonically_increasing_id()


def read_fact(spark: SparkSession, path: str) -> DataFrame | None:
    """The sales file; its own ``id`` gives way to a key assigned on load."""
    schema = schemas.TRAIN
    try:
        frame = read_csv(spark, path, schema)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        log.error("file not found: %s", path)
        return None
    keyed = frame.drop("id").withColumn("id", surrogate_key())
    return keyed.select(*[field.name for field in schema.fields])


def read_predictions(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return read_csv(spark, path, schema)


def data_lines(spark: SparkSession, path: str) -> DataFrame:
    """One row ``data_lines``: text lines of all files less one header line each."""
    lines = spark.read.text(path).groupBy(F.col("_metadata.file_path").alias("file")).count()
    return lines.agg(F.coalesce(F.sum(F.col("count") - 1), F.lit(0)).alias("data_lines"))
