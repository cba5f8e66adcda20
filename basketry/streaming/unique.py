"""Incremental load that keeps out rows whose key has been loaded before.

Keys seen lately are held in the state store: a row that comes again within ``horizon`` of its first
arrival, in the same file, another file or the same file under another name, is dropped there. State
older than that is given up, so it stays as large as what arrives within the horizon. The
clock is the time of the batch, which never runs back, so no row is late and none is lost.
What comes again later still is found by its key among the stored rows of the same years.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketry import schemas
from basketry.streaming.incremental import (
    TASK_INPUT_BYTES,
    arriving_files,
    loaded_batches,
    read_loaded,
    write_batch,
)

_STORE = "spark.sql.streaming.stateStore"
#: A commit saves the keys that came, not the files of all keys; stored keys are not counted,
#: which would look up each once more; a batch without rows, only to give up state, is left
#: out, as the next one with rows does that.
_ON_DISK = {
    f"{_STORE}.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    f"{_STORE}.rocksdb.changelogCheckpointing.enabled": "true",
    f"{_STORE}.rocksdb.trackTotalNumberOfRows": "false",
    "spark.sql.streaming.noDataMicroBatches.enabled": "false",
}


@contextmanager
def _state_on_disk(spark: SparkSession) -> Iterator[None]:
    """State in RocksDB rather than in the memory of executors, for queries started inside."""
    before = {name: spark.conf.get(name, None) for name in _ON_DISK}
    for name, value in _ON_DISK.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def _no_key(keys: Sequence[str]) -> Column:
    test = F.lit(False)
    for key in keys:
        test = test | F.col(key).isNull()
    return test


def unique_within(stream: DataFrame, keys: Sequence[str], horizon: str) -> DataFrame:
    """The first row of each key; a row with a NULL in its key has none and stays."""
    timed = stream.withColumns(
        {"__arrived": F.current_timestamp(), "__own": F.when(_no_key(keys), F.expr("uuid()"))}
    )
    first = timed.withWatermark("__arrived", horizon).dropDuplicatesWithinWatermark([*keys, "__own"])
    return first.drop("__arrived", "__own")


def not_stored(
    rows: DataFrame, target: str, before: int, keys: Sequence[str], schema: T.StructType
) -> DataFrame:
    """Rows whose key no batch before number ``before`` has stored; reads the years of ``rows``."""
    spark = rows.sparkSession
    earlier = [batch for batch in loaded_batches(spark, target) if batch < before]
    if not earlier:
        return rows
    years = [row["year"] for row in rows.select(F.year("date").alias("year")).distinct().collect()]
    stored = read_loaded(spark, target, earlier, schema)
    stored = stored.where(F.col("year").isin([year for year in years if year is not None]))
    return rows.join(stored.select(*keys).distinct(), list(keys), "left_anti")


def load_unique_rows(
    spark: SparkSession,
    source: str,
    target: str,
    checkpoint: str,
    keys: Sequence[str] = schemas.PRIMARY_KEYS["train"],
    horizon: str = "7 days",
    schema: T.StructType = schemas.TRAIN,
    batch_bytes: int | None = None,
) -> None:
    """Load files not loaded yet, each key once, keeping the files' own ``id``.

    Batches are stored like those of ``incremental.load_new_files``.
    """
    size = batch_bytes or TASK_INPUT_BYTES * spark.sparkContext.defaultParallelism
    first = unique_within(arriving_files(spark, source, schema, size), keys, horizon)

    def store(rows: DataFrame, batch: int) -> None:
        # Read twice, for its years and to be written; the state is not read again.
        held = rows.persist()
        try:
            write_batch(not_stored(held, target, batch, keys, schema).select(*schema.names), target, batch)
        finally:
            held.unpersist()

    with _state_on_disk(spark):
        query = (
            first.writeStream.foreachBatch(store)
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()
