"""Tables between two jobs, written to the folder all executors share."""

from __future__ import annotations

import os
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from basketry.session import fresh_path


def stored(frame: DataFrame, name: str) -> DataFrame:
    """``frame`` computed once and read back from Parquet; cuts its lineage."""
    path = fresh_path(frame.sparkSession, name)
    frame.write.option("compression", "zstd").parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def discard(frame: DataFrame) -> None:
    """Delete a table of ``stored`` that nothing reads any more."""
    jvm, files = frame.sparkSession.sparkContext._jvm, frame.inputFiles()
    for folder in {x.rpartition("/")[0] for x in files}:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(frame.sparkSession._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


#: Bytes of a batch that a Python worker gets, unless the session says otherwise.
BATCH_BYTES = 4 << 20
_BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"


def importable(spark: SparkSession) -> SparkSession:
    """Let Python workers import this package from where the driver has it, and bound the
    batches they get by their size: rows can be whole books.

    On a cluster the package comes with ``--py-files`` or is installed; a path that does not
    exist there is harmless.
    """
    if spark.conf.get(_BATCH_SETTING, None) is None:
        spark.conf.set(_BATCH_SETTING, str(BATCH_BYTES))
    environment = spark.sparkContext.environment
    root = str(Path(__file__).resolve().parents[2])
    known = environment.get("PYTHONPATH", "").split(os.pathsep)
    if root not in known:
        environment["PYTHONPATH"] = os.pathsep.join([root, *filter(None, known)])
    return spark
