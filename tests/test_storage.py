"""Sources, sinks, stored views and the incremental load."""

import logging
from pathlib import Path
from types import SimpleNamespace

import pytest
from plain import rows
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketry import schemas, session
from basketry.plans import build
from basketry.plans.warehouse import Warehouse, open_warehouse
from basketry.session import fresh_path, shared_dir
from basketry.sinks.stored import (
    append_table,
    rebuild_view,
    rows_per_year,
    write_by_year,
    write_csv,
)
from basketry.sources import stored
from basketry.sources.csv_files import data_lines, read_fact, read_predictions, read_table
from basketry.streaming.incremental import load_new_files
from basketry.tables import RetailTables


def write(folder, name, *lines):
    path = Path(folder) / name
    path.write_text("\n".join(lines) + "\n")
    return str(path)


def test_columns_are_matched_by_name(spark, tmp_path):
    path = write(tmp_path, "oil.csv", "dcoilwtico,date", ",2013-01-01", "93.14,2013-01-02")
    oil = read_table(spark, path, "oil")
    assert [(f.name, f.dataType) for f in oil.schema] == [(f.name, f.dataType) for f in schemas.OIL]
    assert [(str(d), p and str(p)) for d, p in rows(oil, "date")] == [
        ("2013-01-01", None), ("2013-01-02", "93.14"),
    ]


def test_column_left_out_takes_its_default_and_given_null_stays(spark, tmp_path):
    head = "date,type,locale,locale_name,description"
    without = write(tmp_path, "a.csv", head, "2013-01-01,Holiday,Local,Q,x")
    given = write(tmp_path, "b.csv", f"{head},transferred", "2013-01-01,Holiday,Local,Q,x,")
    assert read_table(spark, without, "holidays_events").first()["transferred"] is False
    assert read_table(spark, given, "holidays_events").first()["transferred"] is None


def test_missing_file_is_logged(spark, tmp_path, caplog):
    with caplog.at_level(logging.ERROR):
        assert read_table(spark, f"{tmp_path}/none.csv", "oil") is None
        assert read_fact(spark, f"{tmp_path}/none.csv") is None
    assert "file not found" in caplog.text


def test_malformed_line_fails_the_load(spark, tmp_path):
    path = write(tmp_path, "oil.csv", "date,dcoilwtico", "2013-01-01,cheap")
    with pytest.raises(Exception, match="MALFORMED_RECORD"):
        read_table(spark, path, "oil").collect()


TRAIN_HEAD = "id,date,store_nbr,item_nbr,unit_sales,onpromotion"


def test_fact_gets_new_keys(spark, tmp_path):
    path = write(
        tmp_path, "train.csv", TRAIN_HEAD,
        "7,2013-01-01,25,103665,7.0,", "7,2013-01-01,25,105574,1.123456,True",
    )
    fact = read_fact(spark, path)
    assert fact.columns == schemas.TRAIN.names
    assert fact.select("id").distinct().count() == 2
    assert sorted((str(u), p) for u, p in rows(fact.select("unit_sales", "onpromotion"))) == [
        ("1.12346", True), ("7.00000", None),
    ]
    assert rows(data_lines(spark, path)) == [(2,)]


def test_lines_of_several_files(spark, tmp_path):
    for name in ("a.csv", "b.csv", "c.csv"):
        write(tmp_path, name, "x", "1", "2", "3")
    assert rows(data_lines(spark, str(tmp_path))) == [(9,)]


def test_predictions(spark, tmp_path):
    path = write(tmp_path, "submission.csv", "id,unit_sales", "1,2.5")
    schema = T.StructType([T.StructField("unit_sales", T.DoubleType())])
    assert rows(read_predictions(spark, path, schema)) == [("1", 2.5)]


def test_database_predicates_cover_each_day_once(spark):
    predicates = stored.month_predicates([2013, 2015])
    assert len(predicates) == 24
    assert predicates[0] == "date >= '2013-01-01' AND date < '2013-02-01'"
    assert predicates[11] == "date >= '2013-12-01' AND date < '2014-01-01'"
    days = spark.sql(
        "SELECT explode(sequence(DATE '2012-12-01', DATE '2016-02-01', INTERVAL 1 DAY)) AS date"
    )
    hits = sum((F.expr(p).cast("int") for p in predicates), F.lit(0))
    in_years = F.year("date").isin(2013, 2015).cast("int")
    assert days.where(hits != in_years).count() == 0


def test_counts_go_on_after_a_table_that_cannot_be_read(spark, tmp_path):
    spark.range(3).createOrReplaceTempView("counted")
    assert "counted" in stored.available_tables(spark)
    broken = tmp_path / "broken"
    broken.mkdir()
    (broken / "part.parquet").write_text("no parquet file")
    spark.read.schema("id long").parquet(str(broken)).createOrReplaceTempView("broken")
    counts = stored.table_counts(spark, ["counted", "broken", "gone"])
    report = {row["table_name"]: row for row in counts.collect()}
    assert (report["counted"]["row_count"], report["counted"]["error"]) == (3, None)
    assert report["broken"]["row_count"] is None and report["broken"]["error"]
    assert report["gone"]["row_count"] is None
    assert report["gone"]["error"] == "TABLE_OR_VIEW_NOT_FOUND"


def test_tables_are_appended_to_and_views_replaced(spark):
    append_table(spark.range(2), "appended")
    append_table(spark.range(2), "appended")
    assert spark.table("appended").count() == 4
    rebuild_view(spark.range(5), "rebuilt", ["id"])
    rebuild_view(spark.range(3), "rebuilt")
    assert spark.table("rebuilt").count() == 3


# --- yearly export -------------------------------------------------------------------


@pytest.fixture(scope="module")
def hot_day(spark):
    """30,000 sales of which a third fall on one day."""
    return spark.range(30_000).selectExpr(
        "id",
        "date_add(DATE '2013-12-01', CAST(if(id % 3 = 0, 5, id % 60) AS INT)) AS date",
        "CAST(hash(id) % 50 AS INT) AS store_nbr",
        "CAST(hash(id, 1) AS INT) AS item_nbr",
        "CAST(id % 9 AS DECIMAL(12, 5)) AS unit_sales",
    )


def test_export_by_year(spark, hot_day, tmp_path, capsys):
    path = f"{tmp_path}/export"
    write_by_year(hot_day, path)
    back = spark.read.parquet(path)
    assert rows(back.select(*hot_day.columns), "id") == rows(hot_day, "id")
    expected = hot_day.groupBy(F.year("date").alias("year")).count()
    assert rows(rows_per_year(back)) == rows(expected, "year")
    assert {field.name: field.dataType for field in back.schema}["year"] == T.IntegerType()
    assert all(name.endswith(".snappy.parquet") for name in
               (file.rsplit("/", 1)[-1] for file in back.inputFiles()))
    back.where("year = 2014").explain()
    plan = capsys.readouterr().out
    assert "PartitionFilters: [isnotnull(year" in plan


def test_rows_are_in_order_within_each_file(spark, hot_day, tmp_path):
    path = f"{tmp_path}/export"
    write_by_year(hot_day, path)
    for file in spark.read.parquet(path).inputFiles():
        found = rows(spark.read.parquet(file).select("date", "store_nbr", "item_nbr"))
        assert found == sorted(found)


def test_a_hot_day_is_split_over_files(spark, hot_day, tmp_path):
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "32k")
    try:
        write_by_year(hot_day.repartition(8), f"{tmp_path}/export")
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    back = spark.read.parquet(f"{tmp_path}/export")
    hot = back.where("date = DATE '2013-12-06'").select(F.col("_metadata.file_path"))
    assert back.count() == 30_000 and hot.distinct().count() > 1


def test_only_the_years_asked_for(spark, hot_day, tmp_path):
    path = f"{tmp_path}/export"
    write_by_year(hot_day, path, years=[2014])
    assert [row[0] for row in rows(rows_per_year(spark.read.parquet(path)))] == [2014]
    assert stored.slice_years(hot_day, [2013]).where("date >= DATE '2014-01-01'").count() == 0


def test_exporting_a_year_again_leaves_the_others(spark, hot_day, tmp_path):
    path = f"{tmp_path}/export"
    write_by_year(hot_day, path)
    first = dict(rows(rows_per_year(spark.read.parquet(path))))
    write_by_year(hot_day.where("id < 10000"), path, years=[2014])
    second = dict(rows(rows_per_year(spark.read.parquet(path))))
    assert second[2013] == first[2013] and second[2014] < first[2014]
    sales = stored.read_by_year(spark, path, hot_day.schema)
    assert sales.schema.names == [*hot_day.columns, "year"]
    write_by_year(hot_day.where("date < DATE '2014-01-01'"), path)
    assert [row[0] for row in rows(rows_per_year(spark.read.parquet(path)))] == [2013]


# --- incremental load ----------------------------------------------------------------


def test_files_are_loaded_once(spark, tmp_path):
    source, target, progress = (str(tmp_path / name) for name in ("in", "out", "progress"))
    Path(source).mkdir()
    for n in range(3):
        lines = [f"{n * 5 + i},201{n}-01-01,1,1,1.0," for i in range(5)]
        write(source, f"{n}.csv", TRAIN_HEAD, *lines)

    def loaded():
        load_new_files(spark, source, target, progress, batch_bytes=300)
        frame = spark.read.parquet(target)
        return frame.count(), frame.select("id").distinct().count()

    assert loaded() == (15, 15)
    assert loaded() == (15, 15)
    write(source, "3.csv", TRAIN_HEAD, *[f"{15 + i},2013-01-01,1,1,1.0,True" for i in range(5)])
    assert loaded() == (20, 20)
    back = spark.read.parquet(target)
    assert back.where("year = 2013 and onpromotion").count() == 5
    assert back.select("batch").distinct().count() >= 2
    # A batch writes one file per year here, however many tasks read it.
    assert len(back.inputFiles()) <= 4
    assert sorted(back.columns) == sorted([*schemas.TRAIN.names, "year", "batch"])


# --- whole run -----------------------------------------------------------------------


@pytest.fixture(scope="module")
def csv_folder(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("raw")
    write(folder, "stores.csv", "store_nbr,city,state,type,cluster", "1,Quay,North,A,1")
    write(folder, "items.csv", "item_nbr,family,class,perishable", "10,DAIRY,7,1")
    write(folder, "transactions.csv", "date,store_nbr,transactions", "2013-01-01,1,100")
    write(folder, "oil.csv", "date,dcoilwtico", "2013-01-01,", "2013-01-03,93.14")
    write(
        folder, "holidays_events.csv", "date,type,locale,locale_name,description,transferred",
        "2013-01-01,Holiday,National,Land,New year,False",
    )
    write(
        folder, "train.csv", TRAIN_HEAD,
        "0,2013-01-01,1,10,7.5,", "1,2013-01-02,1,10,2,True", "2,2014-01-02,1,10,-1,True",
    )
    return str(folder)


def test_whole_run_from_csv(spark, csv_folder, tmp_path, caplog):
    output = f"{tmp_path}/export"
    with caplog.at_level(logging.INFO):
        written = build.run(spark, csv_folder, output, "2017-08-16")
    assert rows(written) == [(2013, 2)]
    for report in ("oil_clean", "train_clean", "holidays_clean", "general", "families"):
        assert f"{report}: " in caplog.text
    master = stored.read_master(spark, output)
    assert master.schema.names == schemas.MASTER.names
    assert rows(master.select("item_family", "is_holiday", "holiday_type"), "date") == [
        ("DAIRY", True, "Holiday"), ("DAIRY", False, None),
    ]


def test_copy_of_some_years(spark, csv_folder, tmp_path):
    warehouse = Warehouse(spark, build.load_tables(spark, csv_folder))
    assert rows(build.export(warehouse, f"{tmp_path}/copy", [2012, 2013])) == [(2013, 2)]


def test_input_table_that_is_needed(spark, tmp_path):
    with pytest.raises(FileNotFoundError, match="stores"):
        build.load_tables(spark, str(tmp_path))


def test_views_are_stored_once_and_rebuilt_by_a_new_warehouse(spark, csv_folder):
    tables = build.load_tables(spark, csv_folder)
    first = Warehouse(spark, tables)
    assert first.master is first.master
    assert first.master.inputFiles() != Warehouse(spark, tables).master.inputFiles()
    assert all(shared_dir(spark) in file for file in first.master.inputFiles())


def test_views_can_be_read_by_name(spark, csv_folder, tmp_path):
    output = f"{tmp_path}/out"
    build.run(spark, csv_folder, output, "2017-08-16")
    build.run(spark, csv_folder, output, "2017-08-16")
    assert spark.table("train_clean").count() == 2
    assert spark.table("master").where("year = 2013").count() == 2
    assert spark.table("oil_clean").count() == 3
    for name in ("oil_clean", "train_clean", "holidays_clean", "master"):
        spark.sql(f"DROP TABLE {name}")


def test_layout_is_kept_for_later_sessions(spark, csv_folder, tmp_path):
    tables = build.load_tables(spark, csv_folder)
    path = f"{tmp_path}/layout"
    first = Warehouse(spark, tables, train_path=path).train_by_year.inputFiles()
    assert first and Warehouse(spark, tables, train_path=path).train_by_year.inputFiles() == first


def test_changed_input_changes_the_answer(spark, tmp_path):
    folder = str(tmp_path)
    load = lambda spark, source: RetailTables(
        *[spark.read.parquet(f"{source}/t.parquet")] * 7
    )
    spark.range(3).write.parquet(f"{folder}/t.parquet")
    assert open_warehouse(spark, folder, load).oil.count() == 3
    assert open_warehouse(spark, folder, load) is open_warehouse(spark, folder, load)
    spark.range(5).write.mode("overwrite").parquet(f"{folder}/t.parquet")
    assert open_warehouse(spark, folder, load).oil.count() == 5


def test_nothing_is_left_in_scratch(spark):
    path = fresh_path(spark, "gone")
    spark.range(3).write.parquet(path)
    app = spark.sparkContext.applicationId
    known = session._scratch[app]
    other = path.replace(app, "another-app")
    spark.range(3).write.parquet(other)
    session._scratch["another-app"] = (spark, other.rsplit("/", 1)[0])
    session.remove_scratch("another-app")
    assert not Path(other).exists() and Path(path).exists()
    assert session._scratch[app] == known


def test_shuffles_fit_the_input(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        session.fit_shuffles(spark, 10 * session.TASK_BYTES)
        assert spark.conf.get("spark.sql.shuffle.partitions") == "10"
        session.fit_shuffles(spark, session.TASK_BYTES)
        assert spark.conf.get("spark.sql.shuffle.partitions") == "10"
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_a_machines_own_disk_is_no_shared_folder():
    context = SimpleNamespace(master="spark://m:7077", applicationId="a", getCheckpointDir=lambda: None)
    settings = {"spark.checkpoint.dir": "file:/tmp/x"}
    cluster = SimpleNamespace(sparkContext=context, conf=settings)
    with pytest.raises(RuntimeError, match="own disk"):
        shared_dir(cluster)
    settings[session.SHARED_MOUNT] = "true"
    assert shared_dir(cluster) == "file:/tmp/x"


def test_csv_round_trip(spark, csv_folder):
    train = read_fact(spark, f"{csv_folder}/train.csv")
    path = fresh_path(spark, "csv")
    write_csv(train, path)
    assert read_fact(spark, path).drop("id").exceptAll(train.drop("id")).count() == 0
