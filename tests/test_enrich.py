import pytest
from plain import rows
from pyspark.sql import functions as F

from basketry import schemas
from basketry.functions.calendar import add_calendar, add_day_names, year_month
from basketry.functions.labels import PROMOTION_STATUS, label, title
from basketry.operators import clean, enrich, lookup
from basketry.operators.lookup import Lookup, lookup_join, salted_join
from basketry.plans.queries import warehouse


@pytest.fixture(scope="module")
def tables(make):
    return {
        "stores": make("stores", (1, "Quay", "North", "A", 1), (2, "Hill", "South", "B", 2)),
        "items": make("items", (10, "DAIRY", 7, 1)),
        "oil": make("oil", ("2013-01-01", 90), ("2013-01-03", 92)),
        "holidays": make(
            "holidays_events",
            ("2013-01-01", "Holiday", "National", "Land", "New year", False),
            ("2013-01-01", "Event", "National", "Other", "Fair", False),
            ("2013-01-01", "Event", "Regional", "North", "Match", False),
            ("2013-01-01", "Holiday", "Local", "Quay", "Harbour", False),
            ("2013-01-01", "Holiday", "Local", "North", "Not a city", False),
            ("2013-01-02", "Holiday", "Regional", "Quay", "Not a state", False),
        ),
        "train": make(
            "train",
            (1, "2013-01-01", 1, 10, 1, True),
            (2, "2013-01-01", 2, 10, 2, None),
            (3, "2013-01-01", 3, 11, 3, False),
            (4, "2013-01-02", 1, 10, 4, None),
            (5, "2013-02-01", 1, 10, 5, None),
        ),
    }


def build_master(tables):
    return enrich.master(
        clean.sales_rows(tables["train"]),
        tables["stores"],
        tables["items"],
        clean.oil_clean(tables["oil"]),
        clean.holidays_clean(tables["holidays"]),
    )


EXPECTED_HOLIDAYS = [
    (1, True, "Event", "Fair"),
    (1, True, "Event", "Match"),
    (1, True, "Holiday", "Harbour"),
    (1, True, "Holiday", "New year"),
    (2, True, "Event", "Fair"),
    (2, True, "Holiday", "New year"),
    (3, True, "Event", "Fair"),
    (3, True, "Holiday", "New year"),
    (4, False, None, None),
    (5, False, None, None),
]


def holidays_of(master):
    columns = ["id", "is_holiday", "holiday_type", "holiday_description"]
    return rows(master.select(*columns), "id", "holiday_type", "holiday_description")


def test_a_sale_appears_once_per_holiday_at_its_place(tables):
    assert holidays_of(build_master(tables)) == EXPECTED_HOLIDAYS


def test_master_is_the_same_with_lookups_too_big_to_broadcast(tables, monkeypatch):
    small = rows(build_master(tables), *schemas.MASTER.names)
    monkeypatch.setattr(lookup, "BROADCAST_BYTES", -1)
    monkeypatch.setattr(lookup, "ROWS_PER_TASK", 1)
    big = build_master(tables)
    assert rows(big, *schemas.MASTER.names) == small


def test_master_columns_and_attributes(tables):
    master = build_master(tables)
    assert [(f.name, f.dataType) for f in master.schema] == [
        (f.name, f.dataType) for f in schemas.MASTER
    ]
    sale = master.where("id = 5").first()
    assert (sale["city"], sale["store_type"], sale["item_family"], sale["perishable"]) == (
        "Quay", "A", "DAIRY", 1,
    )
    assert (sale["oil_price"], sale["oil_is_imputed"]) == (None, None)  # no price that late
    orphan = master.where("id = 3").first()
    assert (orphan["city"], orphan["item_family"], orphan["oil_price"]) == (None, None, 90)
    assert master.where("id = 4").first()["oil_is_imputed"] is True


def test_small_lookups_need_no_shuffle_of_the_sales(spark, capsys):
    stored = warehouse(spark, "/root/testdata/sf0.001")
    stored.master_rows().explain()
    plan = capsys.readouterr().out
    assert "SortMergeJoin" not in plan and "ShuffledHashJoin" not in plan
    assert plan.count("BroadcastHashJoin") == 6
    # the holiday lists of the three kinds are stored, so nothing is grouped either
    assert "Exchange hashpartitioning" not in plan


def test_calendar_flags(spark):
    dates = spark.createDataFrame(
        [("2017-01-01",), ("2016-02-29",), ("2017-02-15",), ("2017-03-24",), ("2017-03-07",)],
        "date string",
    ).select(F.to_date("date").alias("date"))
    found = add_calendar(dates).select(
        F.date_format("date", "MM-dd"),
        "week_of_year",
        "day_of_week",
        "is_weekend",
        "is_payday",
        "is_month_start",
        "is_month_end",
    )
    assert sorted(rows(found)) == [
        ("01-01", 52, 0, True, False, True, False),
        ("02-15", 7, 3, False, True, False, False),
        ("02-29", 9, 1, False, True, False, True),
        ("03-07", 10, 2, False, False, True, False),
        ("03-24", 12, 5, False, False, False, True),
    ]
    named = add_day_names(dates).where("year = 2017 and month = 1")
    assert rows(named.select("day_of_week", "day_name", "week_of_year")) == [(6, "Sunday", 52)]


def test_missing_date_gives_false_flags(spark):
    frame = add_calendar(spark.sql("select cast(null as date) as date"))
    flags = ["year", "is_weekend", "is_payday", "is_month_start", "is_month_end"]
    assert rows(frame.select(*flags)) == [(None, False, False, False, False)]


def test_labels(spark):
    frame = spark.createDataFrame([(True,), (False,), (None,)], "flag boolean")
    assert {row[0] for row in rows(frame.select(label(F.col("flag"), PROMOTION_STATUS)))} == {
        "With Promotion", "Without Promotion", None,
    }
    one = spark.range(1)
    assert rows(one.select(title(F.lit("item_family")), year_month(F.lit(2013), F.lit(3)))) == [
        ("Item Family", "2013-03")
    ]


# --- lookup joins --------------------------------------------------------------------


@pytest.fixture(scope="module")
def skewed(spark):
    """9,000 rows: a third on one key, a sixth without a key, some without a match."""
    return spark.range(9_000).select(
        "id",
        F.expr("CASE WHEN id % 3 = 0 THEN 1 WHEN id % 6 = 1 THEN NULL ELSE id % 50 END").alias("k"),
    )


@pytest.fixture(scope="module")
def keyed(spark):
    """Keys below 40, every even one twice."""
    return spark.range(40).selectExpr(
        "id AS k", "explode(if(id % 2 = 0, array('a', 'b'), array('a'))) AS v"
    )


@pytest.mark.parametrize("how", ["left", "inner"])
@pytest.mark.parametrize("rows_per_task", [7, 500, None])
@pytest.mark.parametrize("row_id", [(), ("id",)])
def test_salted_join_gives_the_plain_join(skewed, keyed, how, rows_per_task, row_id):
    plain = skewed.join(keyed, "k", how)
    salted = salted_join(skewed, keyed, ["k"], how, rows_per_task=rows_per_task, row_id=row_id)
    assert rows(salted, "id", "v") == rows(plain.select(*salted.columns), "id", "v")


def test_a_hot_key_is_spread_by_its_rows(skewed):
    frequent = skewed.where("k = 1").count()
    assert rows(lookup._hot_keys(skewed, ["k"], 500)) == [(1, -(-frequent // 500))]
    assert rows(lookup._hot_keys(skewed, ["k"], 5_000)) == []
    many = lookup._hot_keys(skewed, ["k"], 10)
    assert many.count() == skewed.dropna().groupBy("k").count().where("count > 10").count()
    assert many.where("k = 1").first()["_spread"] == -(-frequent // 10)


def test_equal_rows_of_a_hot_key_fall_into_many_partitions(spark, keyed):
    """Without adaptive execution, to see what the salt alone does."""
    same = spark.range(20_000).selectExpr("id", "1L AS k", "5 AS units")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    try:
        joined = salted_join(same, keyed, ["k"], rows_per_task=100, row_id=["id"])
        joined = joined.select("k", "units", F.spark_partition_id().alias("part"))
        counts = [row["count"] for row in joined.groupBy("part").count().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert sum(counts) == 20_000 and len(counts) > 40
    assert max(counts) < 4 * 20_000 / 64


def test_a_lookup_of_nulls_is_not_small(spark):
    nulls = spark.range(1_000).select("id", *[F.lit(None).cast("long").alias(f"c{i}") for i in range(50)])
    assert not Lookup.of(nulls, max_bytes=300_000).small
    lists = spark.range(100).select("id", F.sequence(F.lit(0), F.lit(200)).alias("v"))
    assert not Lookup.of(lists, max_bytes=30_000).small
    assert not Lookup.of(lists, max_bytes=30_000).measure(lists.limit(90)).small


def test_lookup_size_decides_the_join(skewed, keyed):
    assert Lookup.of(keyed).small
    assert not Lookup.of(keyed, max_bytes=100).small
    big = lookup_join(skewed, Lookup.of(keyed, max_bytes=100), ["k"])
    assert big.count() == skewed.join(keyed, "k", "left").count()
    empty = Lookup.of(keyed.where("k < 0"))
    assert empty.small and lookup_join(skewed, empty, ["k"]).count() == 9_000
