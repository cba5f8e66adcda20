"""Distinct counts by bitmaps against count_distinct."""

import datetime
import random

import pytest
from plain import rows
from pyspark.sql import functions as F

from basketry.operators import reports
from basketry.operators.distinct import counts_by_key, counts_of_all
from basketry.plans.warehouse import Warehouse
from basketry.sources.adapter import CUTOFF, adapt

SF = "/root/testdata/sf0.001"

START = datetime.date(1969, 12, 1)


@pytest.fixture(scope="module")
def sales(spark):
    rng = random.Random(1)

    def some(values):
        return None if rng.random() < 0.1 else rng.choice(values)

    numbers = [-(2**31), -65, -64, -1, 0, 1, 63, 64, 127, 2**31 - 1]
    made = [
        (some(["a", "b", "c"]), some(numbers), some(range(500)), START + datetime.timedelta(rng.randint(0, 90)), i)
        for i in range(3000)
    ]
    made += [("only nulls", None, None, None, 1)]
    return spark.createDataFrame(made, "k string, small int, long bigint, day date, v bigint").cache()


DISTINCT = {"smalls": "small", "longs": "long", "days": "day"}


def test_by_key(sales):
    sums = {"n": F.count("*"), "total": F.sum("v")}
    found = counts_by_key(sales, ["k"], DISTINCT, sums).select("k", "n", "total", *DISTINCT)
    expected = sales.groupBy("k").agg(
        F.count("*"), F.sum("v"), *(F.count_distinct(column) for column in DISTINCT.values())
    )
    assert rows(found, "k") == rows(expected, "k")


def test_of_all(sales):
    merged = {"n": (F.count("*"), F.sum("n")), "least": (F.min("v"), F.min("least"))}
    for frame in (sales, sales.limit(0)):
        found = counts_of_all(frame, DISTINCT, merged).select("n", "least", *DISTINCT)
        expected = frame.agg(
            F.nullif(F.count("*"), F.lit(0)), F.min("v"), *(F.count_distinct(c) for c in DISTINCT.values())
        )
        assert rows(found) == rows(expected)


def test_no_row_is_repeated(sales):
    found = counts_by_key(sales, ["k"], DISTINCT, {"n": F.count("*")})
    assert "Expand" not in found._jdf.queryExecution().executedPlan().toString()


def test_columns_with_few_values_are_counted_in_the_same_pass(spark):
    frame = spark.sql(
        """SELECT * FROM VALUES (1, 70, 'a', DATE '2020-01-01'), (1, 71, 'b', DATE '2020-01-01'),
           (200, CAST(NULL AS INT), NULL, DATE '2020-01-02'), (NULL, 70, 'a', NULL) AS t(s, i, kind, day)"""
    )
    merged = {"n": (F.count("*"), F.sum("n")), "last": (F.max("day"), F.max("last"))}
    for given, expected in (
        (frame, (2, 2, 4, datetime.date(2020, 1, 2), 2, 2)),
        (frame.limit(0), (0, 0, None, None, 0, 0)),
    ):
        found = counts_of_all(given, {"stores": "s", "items": "i"}, merged, {"kinds": "kind", "days": "day"})
        assert tuple(found.select("stores", "items", "n", "last", "kinds", "days").first()) == expected


def test_the_wide_rows_are_validated_in_one_pass_before_they_are_stored(spark):
    w = Warehouse(spark, adapt(spark, SF))
    stored = w.wide_rows()
    assert "master" not in w.__dict__
    report = reports.validate_master(stored, CUTOFF)
    plan = report._jdf.queryExecution().optimizedPlan().toString()
    assert "scalar-subquery" not in plan and plan.count("Expand") == 1
    assert report.collect() == reports.validate_master(w.master, CUTOFF).collect()
    assert w.wide_rows() is w.master
