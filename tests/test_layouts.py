"""Files of the clustered layout, and merged sketches."""

from pathlib import Path

import pyarrow.parquet as pq
import pytest
from plain import rows
from pyspark.sql import functions as F

from basketry.operators import sketches
from basketry.plans.queries import warehouse
from basketry.sinks.clustered import part_bounds, write_clustered

SF = "/root/testdata/sf0.01"


def files_with(folder, column, value):
    """Files whose least and largest values leave room for the value."""
    found = 0
    for file in Path(folder).glob("*.parquet"):
        footer = pq.ParquetFile(file)
        place = footer.schema_arrow.names.index(column)
        groups = [footer.metadata.row_group(i).column(place).statistics for i in range(footer.metadata.num_row_groups)]
        found += any(g.min <= value <= g.max for g in groups)
    return found


def test_every_column_prunes_files(spark, tmp_path):
    train = warehouse(spark, SF).train
    by_day, clustered = str(tmp_path / "by-day"), str(tmp_path / "clustered")
    train.repartitionByRange(256, "date").write.parquet(by_day)
    write_clustered(train, clustered, files=256)
    for column, value in (("store_nbr", 6), ("item_nbr", 700)):
        assert files_with(by_day, column, value) > 200
        assert files_with(clustered, column, value) < 110
    one_day = train.agg(F.max("date")).first()[0]
    assert files_with(clustered, "date", one_day) < 110
    assert rows(spark.read.parquet(clustered).agg(F.count("*"), F.sum("id"))) == rows(train.agg(F.count("*"), F.sum("id")))


def test_hot_and_missing_values(spark, tmp_path, make):
    """A third of all rows in one place of the curve are still several files; NULLs are kept."""
    lines = [(i, "2013-01-01", 1, 1, 1, None) for i in range(400)]
    lines += [(i, f"2013-0{i % 9 + 1}-02", i % 7, i % 11, 1, True) for i in range(400, 800)]
    lines += [(900, "2013-01-01", None, None, 1, None)]
    train = make("train", *lines)
    path = str(tmp_path / "hot")
    write_clustered(train, path, files=8)
    sizes = [pq.ParquetFile(f).metadata.num_rows for f in Path(path).glob("*.parquet")]
    assert sum(sizes) == 801 and max(sizes) < 400
    write_clustered(train.limit(0), str(tmp_path / "none"))
    assert part_bounds(train.limit(0), ["date"]) == {"date": []}


@pytest.mark.parametrize("slots_log", [8, 12])
def test_sketches_stay_within_their_error(spark, slots_log):
    train = warehouse(spark, SF).train
    made = sketches.daily_sketches(train, ["item_nbr"], slots_log=slots_log).cache()
    whole = sketches.merged_estimates(made, [], ["item_nbr"]).first()[0]
    exact = train.select("item_nbr").distinct().count()
    assert abs(whole - exact) <= sketches.relative_error(slots_log) * exact
    per_year = sketches.merged_estimates(made, [F.year("date").alias("year")], ["item_nbr"])
    assert per_year.count() == 7
