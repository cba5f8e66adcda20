"""Ordered fills, moving means and exact quantiles against plain windows and sorting."""

import datetime
import math
import random
from decimal import Decimal

import pytest
from plain import rows
from pyspark.sql import Window
from pyspark.sql import functions as F

from basketry.operators import ordered
from basketry.operators.quantiles import describe_all, quantiles, values_at

START = datetime.date(1999, 12, 20)


@pytest.fixture(scope="module")
def series(spark):
    rng = random.Random(2)
    made = []
    for key in ("a", "b", None, "sparse"):
        for number in range(200 if key != "sparse" else 3):
            if rng.random() < 0.7 or key == "sparse":
                value = None if rng.random() < 0.4 else Decimal(rng.randint(0, 999)) / 8
                made.append((key, START + datetime.timedelta(number * (1 if key != "sparse" else 90)), value))
    made += [("unknown", START, None), ("unknown", START + datetime.timedelta(5), None)]
    return spark.createDataFrame(made, "k string, date date, v decimal(12,5)").cache()


@pytest.mark.parametrize("keys", [["k"], []])
@pytest.mark.parametrize("days", [1, 7, 10_000])
def test_fill(series, keys, days):
    frame = series if keys else series.where("k = 'a'")
    found = ordered.fill(frame, keys, "v", "filled", days=days).select("k", "date", "v", "filled")
    order = Window.partitionBy("k").orderBy("date")
    so_far = order.rowsBetween(Window.unboundedPreceding, 0)
    whole = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    plain = F.coalesce(F.last("v", True).over(so_far), F.first("v", True).over(whole))
    assert rows(found, "k", "date") == rows(frame.withColumn("filled", plain), "k", "date")


@pytest.mark.parametrize(("n", "block", "days"), [(1, 1, 3), (5, 5, 7), (7, 50, 30), (30, 64, 1)])
def test_moving_mean(series, n, block, days):
    frame = series.withColumn("v", F.coalesce("v", F.lit(0).cast("decimal(12,5)")))
    found = ordered.moving_mean(frame, ["k"], "v", n, "mean", days=days, block_rows=block)
    last = Window.partitionBy("k").orderBy("date").rowsBetween(1 - n, 0)
    plain = F.when(F.count("v").over(last) == n, F.sum("v").over(last).cast("double") / n)
    assert rows(found, "k", "date") == rows(frame.withColumn("mean", plain), "k", "date")


def test_daily_series_has_every_day_once(series):
    found = ordered.daily_series(series, ["k"])
    span = series.groupBy("k").agg((F.datediff(F.max("date"), F.min("date")) + 1).alias("n"))
    assert rows(found.groupBy("k").agg(F.count("*")), "k") == rows(span, "k")
    assert found.where("v IS NOT NULL").count() == series.where("v IS NOT NULL").count()


def test_no_series_is_in_one_partition(series):
    plan = ordered.fill(series.where("k = 'a'"), [], "v", "filled", days=7)
    text = plan._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("Window [last") == 2  # over the rows of a range, and over one row per range


@pytest.mark.parametrize("buckets", [2, 3, 4096])
def test_values_at_ranks(spark, buckets):
    rng = random.Random(buckets)
    cases = [
        [rng.gauss(0, 1) for _ in range(500)],
        [7.0] * 300 + [8.0],
        [1e308, -1e308, 0.0, 5e-324, -5e-324, 1.0],
        [rng.choice([1, 2, 3]) + rng.random() * 1e-13 for _ in range(200)],
    ]
    for values in cases:
        frame = spark.createDataFrame([(v,) for v in [*values, None, math.nan]], "x double")
        ranks = [0, len(values) // 3, len(values) // 2, len(values) - 1]
        expected = [sorted(values)[r] for r in ranks]
        assert values_at(frame, "x", ranks, buckets) == expected


def test_quantiles_and_empty_columns(spark):
    frame = spark.createDataFrame([(Decimal(n),) for n in (1, 2, 3, 10)], "x decimal(12,5)")
    assert quantiles(frame, "x", (0, 0.25, 0.5, 1), 4) == [1, 1.75, 2.5, 10]
    assert rows(describe_all(frame.where("x < 0"), "x")) == [("x", 0, *[None] * 7)]


@pytest.mark.parametrize("block", [1, 4, 4096])
def test_rows_out_of_order(spark, tmp_path, block):
    """Equal values, nulls and descents inside blocks and across their borders, in two files."""
    path = str(tmp_path / "files")
    for values in ([1, 2, 2, 3, 1, 5, 4, None, 3, 9, 8], [7, 6, 7, 8, 8]):
        made = [(None if v is None else START + datetime.timedelta(v),) for v in values]
        spark.createDataFrame(made, "date date").coalesce(1).write.mode("append").parquet(path)
    stored = spark.read.parquet(path)
    found = ordered.out_of_order(stored, block_rows=block)
    days = sorted(((r["date"] - START).days, (r["before"] - START).days) for r in found.collect())
    assert days == [(1, 3), (4, 5), (6, 7), (8, 9)]
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    window = next(line for line in plan.splitlines() if "Window [lag(" in line)
    assert "__file" not in window and "__block" in window
