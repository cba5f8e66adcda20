"""Reports from stored summaries equal those from all sales, and read nothing else."""

import itertools

import pytest
from plain import rows

from basketry.operators import dashboard, lookup, rollup
from basketry.plans.queries import warehouse
from basketry.plans.warehouse import Warehouse
from basketry.sinks.stored import gather_by_day
from basketry.sources.adapter import adapt

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def w(spark) -> Warehouse:
    return warehouse(spark, SF)


REPORTS = {
    "month": (("year", "month"), lambda f: dashboard.monthly_sales(f)),
    "city": (("city",), lambda f: dashboard.sales_by_dimension(f, "city", 5)),
    "promotion": (("onpromotion",), lambda f: dashboard.sales_by_dimension(f, "onpromotion")),
    "payday": (("is_payday",), lambda f: dashboard.sales_by_dimension(f, "is_payday")),
    "weekday": (("date", "day_of_week"), lambda f: dashboard.sales_by_day_of_week(f)),
}


@pytest.mark.parametrize("name", REPORTS)
def test_report_from_summary(w, name):
    columns, report = REPORTS[name]
    found = report(w.sales_by(*columns))
    assert [tuple(map(str, r)) for r in rows(found)] == [tuple(map(str, r)) for r in rows(report(w.master))]
    master_files = set(w.master.inputFiles())
    assert not master_files & set(found.inputFiles())


@pytest.mark.parametrize("chosen", itertools.product([None, 6], [None, "Brand#19"], [None, 1999]))
def test_filters(w, chosen):
    filters = dict(zip(("store_nbr", "item_family", "year"), chosen, strict=True))
    given = {name: value for name, value in filters.items() if value is not None}
    for report, column in ((dashboard.filtered_time_series, "date"), (dashboard.promotion_impact, "onpromotion")):
        found = report(w.sales_by(column, *given), **filters)
        expected = report(w.master, **filters)
        assert sorted(map(str, rows(found))) == sorted(map(str, rows(expected)))
        assert not set(w.master.inputFiles()) & set(found.inputFiles())


def test_the_smallest_that_covers_is_chosen(w):
    def keys(*columns):
        return w.summaries.choose(columns).keys

    assert keys("date") == ("date", "onpromotion")
    assert keys("year", "item_family") == ("date", "item_family", "onpromotion")
    assert set(keys("date", "store_nbr", "item_family")) == set(rollup.FINEST)
    assert "store_nbr" in keys("city")
    assert w.summaries.choose(["item_class"]) is None
    assert w.sales_by("item_class") is w.master


def test_a_year_reads_its_folders_only(w):
    one = dashboard.filter_sales(w.sales_by("date", "store_nbr", "item_family", "year"), 6, None, 1999)
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan and "= 1999" in plan


def test_unknown_sales_are_no_zero(spark, make):
    sales = spark.createDataFrame(
        [(1, "a", None), (1, "a", None), (2, "a", 3), (2, "a", None)], "store_nbr int, item_family string, unit_sales int"
    )
    made = rollup.summarise(sales, ["store_nbr"])
    assert rows(made, "store_nbr") == [(1, 2, 0, None), (2, 2, 1, 3)]


def test_no_summary_is_built_for_a_column_none_covers(spark, w):
    fresh = Warehouse(spark, adapt(spark, SF))
    fresh.__dict__["master"] = w.master
    assert fresh.sales_by("item_class") is w.master
    assert "summaries" not in fresh.__dict__


def test_sales_are_shuffled_before_they_are_made_wide(w):
    plan = w.master_rows(gather=gather_by_day)._jdf.queryExecution().optimizedPlan().toString()
    above, below = plan.split("RebalancePartitions")
    assert above.count("Join LeftOuter") == 6
    assert "item_family" not in below.split("Union")[0]


@pytest.mark.parametrize("limit", [lookup.BROADCAST_BYTES, 2_000])
def test_files_of_the_wide_table_are_in_order(spark, w, monkeypatch, limit):
    monkeypatch.setattr(lookup, "BROADCAST_BYTES", limit)
    fresh = Warehouse(spark, adapt(spark, SF))
    assert rows(fresh.master.groupBy("year").count()) == rows(w.master.groupBy("year").count())
    assert not rows(fresh.master.exceptAll(w.master)) and fresh.master.count() == w.master.count()
    for file in fresh.master.inputFiles():
        found = [tuple(r) for r in spark.read.parquet(file).select("date", "store_nbr", "item_nbr").toLocalIterator()]
        assert found == sorted(found)


def test_the_first_report_makes_one_summary_of_the_wide_rows(spark, w):
    def sums(frame, *key):
        return rows(rollup.coarsen(frame, key).orderBy(*key))

    fresh = Warehouse(spark, adapt(spark, SF))
    days = fresh.sales_by("date", "day_of_week")
    assert "master" not in fresh.__dict__ and "summaries" not in fresh.__dict__
    assert sums(days, "date", "day_of_week") == sums(w.summaries.source(["day_of_week"], w.master), "date", "day_of_week")
    assert [each.keys for each in fresh._first_summary.known] == [("date", "onpromotion")]
    fresh.sales_by("year", "month")  # that one covers these too
    assert "summaries" not in fresh.__dict__
    families = fresh.sales_by("date", "item_family")  # and not these: all are made
    assert len(fresh.summaries.known) == 1 + len(rollup.COARSER)
    assert sums(families, "date", "item_family") == sums(w.summaries.source(["date", "item_family"], w.master), "date", "item_family")


def test_a_report_makes_no_summary_but_its_own(spark, w):
    fresh = Warehouse(spark, adapt(spark, SF))
    fresh.sales_by("date", "day_of_week")
    families = fresh.sales_by("date", "item_family")
    assert "master" not in fresh.__dict__ and "summaries" not in fresh.__dict__
    assert [each.keys for each in fresh._first_summary.known] == [
        ("date", "onpromotion"), ("date", "item_family", "onpromotion"),
    ]
    key = ["date", "item_family"]
    expected = rollup.coarsen(w.summaries.source(key, w.master), key).orderBy(*key)
    assert rows(rollup.coarsen(families, key).orderBy(*key)) == rows(expected)
    fresh.sales_by("item_family")  # the second covers these too
    assert len(fresh._first_summary.known) == 2
