"""Incremental load of sales files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketry import schemas
from basketry.sources.csv_files import surrogate_key
from basketry.sources.stored import folder_names, path_exists

#: Input of a batch for every task that can run at once.
TASK_INPUT_BYTES = 256 * 1024 * 1024

#: Bits of a key for the row within a task, and for the task within a batch.
_ROW_BITS, _TASK_BITS = 33, 15


def batch_key(batch: int) -> Column:
    """A key assigned on load, as by the batch load, and unique over all batches."""
    key = surrogate_key()
    fits = key < F.lit(1 << (_ROW_BITS + _TASK_BITS))
    return F.when(fits, F.lit(batch << (_ROW_BITS + _TASK_BITS)).bitwiseOR(key)).otherwise(
        F.raise_error(F.lit("too many tasks in a batch for unique keys"))
    )


def arriving_files(
    spark: SparkSession, source: str, schema: T.StructType, batch_bytes: int
) -> DataFrame:
    """Sales files as a stream, in batches of about so many bytes."""
    return (
        spark.readStream.schema(schema)
        .options(
            header=True, nullValue="", mode="FAILFAST", enforceSchema=False,
            maxBytesPerTrigger=batch_bytes,
        )
        .csv(source)
    )


def write_batch(rows: DataFrame, target: str, batch: int) -> None:
    """Replace the folder of a batch; rows are brought together by year and day."""
    dated = rows.withColumn("year", F.year("date"))
    (
        dated.hint("rebalance", F.col("year"), F.col("date"))
        .sortWithinPartitions("year", "date")
        .write.mode("overwrite")
        .partitionBy("year")
        .parquet(f"{target}/batch={batch}")
    )


def load_new_files(
    spark: SparkSession,
    source: str,
    target: str,
    checkpoint: str,
    schema: T.StructType = schemas.TRAIN,
    batch_bytes: int | None = None,
) -> None:
    """Load the files that earlier runs have not loaded, in batches sized for the cluster.

    Every batch has a folder of its own in ``target``, replaced as a whole when the batch
    is repeated: a run that was interrupted adds no row twice. Its rows are brought together
    by year and day, so that a batch writes few files per year. The files carry the columns
    of ``schema`` in order; their ``id`` gives way to a key assigned on load.
    """
    size = batch_bytes or TASK_INPUT_BYTES * spark.sparkContext.defaultParallelism
    arriving = arriving_files(spark, source, schema, size)

    def store(rows: DataFrame, batch: int) -> None:
        keyed = rows.drop("id").withColumn("id", batch_key(batch)).select(*schema.names)
        write_batch(keyed, target, batch)

    query = (
        arriving.writeStream.foreachBatch(store)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def loaded_batches(spark: SparkSession, target: str) -> list[int]:
    """Numbers of the batches that are complete."""
    folders = [name for name in folder_names(spark, target) if name.startswith("batch=")]
    done = [name for name in folders if path_exists(spark, f"{target}/{name}/_SUCCESS")]
    return sorted(int(name.removeprefix("batch=")) for name in done)


def read_loaded(
    spark: SparkSession, target: str, batches: list[int], schema: T.StructType = schemas.TRAIN
) -> DataFrame:
    """Rows of the given batches with their ``batch`` and ``year``, which choose folders."""
    parts = [T.StructField("year", schemas.INT), T.StructField("batch", schemas.INT)]
    stored = spark.read.schema(T.StructType([*schema.fields, *parts])).option("basePath", target)
    return stored.parquet(*[f"{target}/batch={number}" for number in batches])
