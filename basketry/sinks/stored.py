"""Writing tables: appends, rebuilt views and the yearly Parquet export."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.session import finer_tasks

#: Shuffled bytes of a wide row, as a multiple of those of the sale it is made of.
WIDER = 4
#: Order of rows inside the files of the fact and of the wide sales table.
CLUSTER_BY = ("date", "store_nbr", "item_nbr")


def append_table(frame: DataFrame, name: str, path: str | None = None) -> None:
    """Add rows to a table of the catalog; a new one is stored at ``path`` if given."""
    writer = frame.write.mode("append")
    (writer.option("path", path) if path else writer).saveAsTable(name)


def rebuild_view(
    frame: DataFrame, name: str, sort_by: Sequence[str] = (), path: str | None = None
) -> None:
    """Replace a stored view; rows are ordered within files, never over all files."""
    ordered = frame.sortWithinPartitions(*sort_by) if sort_by else frame
    writer = ordered.write.mode("overwrite")
    (writer.option("path", path) if path else writer).saveAsTable(name)


def gather_by_day(frame: DataFrame) -> DataFrame:
    """Rows with their ``year``, brought together by day.

    The rebalancing shuffle merges small days and splits days larger than the advisory
    size into several partitions, however the rows are spread over the days.
    """
    return frame.withColumn("year", F.year("date")).hint("rebalance", F.col("year"), F.col("date"))


def write_by_year(
    frame: DataFrame,
    path: str,
    years: Sequence[int] | None = None,
    cluster_by: Sequence[str] = CLUSTER_BY,
    gathered: bool = False,
) -> None:
    """Parquet in one folder per year, each file holding few days in order.

    Without ``years`` the whole stored table is replaced; with them only those years.

    Rows are brought together by day, so that file statistics prune on the date, unless
    they are ``gathered`` so already: rows made wide are better shuffled before that.
    """
    order = [name for name in cluster_by if name in frame.columns]
    if years is not None:
        frame = frame.where(F.year("date").isin(*years))
    dated = frame if gathered else gather_by_day(frame)
    with finer_tasks(frame.sparkSession, WIDER if gathered else 1):
        (
            dated.sortWithinPartitions("year", *order)
            .write.mode("overwrite")
            .option("compression", "snappy")
            .option("partitionOverwriteMode", "static" if years is None else "dynamic")
            .partitionBy("year")
            .parquet(path)
        )


def rows_per_year(stored: DataFrame) -> DataFrame:
    return stored.groupBy("year").agg(F.count("*").alias("rows")).orderBy("year")


def write_csv(frame: DataFrame, path: str) -> None:
    """CSV files with a header line each, the format the sources read."""
    frame.write.mode("errorifexists").option("header", True).csv(path)
