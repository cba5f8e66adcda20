"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import atexit
import logging
import math
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

log = logging.getLogger(__name__)

#: Adaptive execution merges small shuffle partitions and splits skewed ones.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
}

#: Says that a ``file:`` folder is a mount all executors share.
SHARED_MOUNT = "spark.basketry.sharedMount"

_local_dirs: dict[str, str] = {}
_scratch: dict[str, tuple[SparkSession, str]] = {}


#: Shuffle data one task should handle; fits in the memory of any usual executor core.
TASK_BYTES = 256 * 1024 * 1024


def shuffle_partitions(shuffled_bytes: int) -> int:
    """Partitions for the largest shuffle expected. Adaptive execution merges them for
    smaller ones but does not split evenly filled ones, so this must not be too low."""
    return max(200, math.ceil(shuffled_bytes / TASK_BYTES))


def build_session(
    app_name: str = "basketry",
    master: str | None = None,
    shuffled_bytes: int | None = None,
    **extra: str,
) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    sized = {}
    if shuffled_bytes is not None:
        sized["spark.sql.shuffle.partitions"] = str(shuffle_partitions(shuffled_bytes))
        sized["spark.sql.adaptive.advisoryPartitionSizeInBytes"] = str(TASK_BYTES)
    for key, value in {**SETTINGS, **sized, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def fit_shuffles(spark: SparkSession, shuffled_bytes: int) -> None:
    """Raise the session's shuffle partitions to what so many bytes need; never lower them."""
    needed = math.ceil(shuffled_bytes / TASK_BYTES)
    if needed > int(spark.conf.get("spark.sql.shuffle.partitions")):
        spark.conf.set("spark.sql.shuffle.partitions", str(needed))


_ADVISORY = "spark.sql.adaptive.advisoryPartitionSizeInBytes"


@contextmanager
def finer_tasks(spark: SparkSession, times: int) -> Iterator[None]:
    """Adaptive execution aims at shuffle partitions that many times smaller: for rows that
    are made wide, and sorted, after the shuffle."""
    before = spark.conf.get(_ADVISORY)
    size = spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(before)
    spark.conf.set(_ADVISORY, str(max(1, size // times)))
    try:
        yield
    finally:
        spark.conf.set(_ADVISORY, before)


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach.

    The cluster names it in ``spark.checkpoint.dir``. Only a local-mode session,
    where driver and executors are one process, falls back to a temporary folder.
    """
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if configured:
        own_disk = configured.startswith("file:") and spark.conf.get(SHARED_MOUNT, "") != "true"
        if own_disk and not context.master.startswith("local"):
            raise RuntimeError(
                f"{configured} is on each machine's own disk; name a shared folder in "
                f"spark.checkpoint.dir, or set {SHARED_MOUNT} if this is a shared mount"
            )
        return configured
    app = context.applicationId
    if app not in _local_dirs:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        _local_dirs[app] = tempfile.mkdtemp(prefix="basketry-")
        context.setCheckpointDir(_local_dirs[app])
    return _local_dirs[app]


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path under the shared folder that no earlier run has written to.

    What is written there is removed when the driver ends.
    """
    app = spark.sparkContext.applicationId
    root = f"{shared_dir(spark)}/basketry/{app}"
    if app not in _scratch:
        _scratch[app] = (spark, root)
        atexit.register(remove_scratch, app)
    return f"{root}/{name}-{uuid.uuid4().hex}"


def remove_scratch(app: str) -> None:
    """Delete the tables an application has written for itself; its results must be read."""
    spark, root = _scratch.pop(app, (None, ""))
    if spark is None:
        return
    try:
        jvm = spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(root)
        path.getFileSystem(jvm.org.apache.hadoop.conf.Configuration()).delete(path, True)
    except Exception:  # the JVM may have ended first
        log.warning("scratch tables are left in %s", root)
