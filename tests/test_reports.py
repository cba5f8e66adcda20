"""Reports, dashboard figures and exploration on hand-made rows."""

from decimal import Decimal

import pytest
from plain import day, rows
from pyspark.sql import functions as F

from basketry import schemas
from basketry.operators import clean, dashboard, explore, quality, reports, topk
from basketry.tables import RetailTables


def master_of(spark, *sales):
    """Wide rows with the given columns; all others are NULL."""
    names = list(sales[0])
    kinds = {field.name: field.dataType for field in schemas.MASTER}
    frame = spark.createDataFrame(
        [tuple(sale[name] for name in names) for sale in sales],
        ", ".join(f"{name} string" for name in names),
    )
    return frame.select(
        *[
            (F.col(name) if name in names else F.lit(None)).cast(kind).alias(name)
            for name, kind in kinds.items()
        ]
    )


def test_kpis_of_nothing(spark, make):
    master = master_of(spark, {"id": "1", "unit_sales": None, "date": "2013-01-01"})
    kpi = dashboard.kpi_metrics(master, make("stores", (1, "Q", "P", "A", 1)), make("items"))
    assert rows(kpi) == [(0.0, 0.0, 0, 1, 0)]


def test_top_values_keep_the_unknown_one_and_break_ties_by_name(spark):
    master = master_of(
        spark,
        *[
            {"item_family": family, "unit_sales": units}
            for family, units in [("b", "5"), ("a", "5"), (None, "7"), ("c", "1"), ("d", None)]
        ],
    )
    top = dashboard.sales_by_dimension(master, "item_family", 3)
    assert [row[0] for row in rows(top)] == [None, "a", "b"]


def test_weekday_mean_is_over_days_not_over_rows(spark):
    master = master_of(
        spark,
        {"date": "2013-01-06", "day_of_week": "0", "unit_sales": "10"},
        {"date": "2013-01-06", "day_of_week": "0", "unit_sales": "20"},
        {"date": "2013-01-13", "day_of_week": "0", "unit_sales": "1"},
    )
    assert rows(dashboard.sales_by_day_of_week(master)) == [(0, 15.5, "Sunday")]


def test_promotion_groups(spark):
    master = master_of(
        spark,
        {"onpromotion": None, "unit_sales": "1", "store_nbr": "1", "year": "2013"},
        {"onpromotion": "true", "unit_sales": "2", "store_nbr": "1", "year": "2013"},
        {"onpromotion": "true", "unit_sales": "2", "store_nbr": "2", "year": "2013"},
        {"onpromotion": "false", "unit_sales": "4", "store_nbr": "1", "year": "2014"},
    )
    found = dashboard.promotion_impact(master, store_nbr=1, year=2013)
    assert set(rows(found)) == {(None, Decimal(1), None), (True, Decimal(2), "With Promotion")}
    assert dashboard.filtered_time_series(master, store_nbr=9).count() == 0
    assert rows(dashboard.filter_values(master, "onpromotion")) == [(False,), (True,)]


def test_means_round_halves_away_from_zero(spark):
    master = master_of(
        spark,
        *[
            {"date": "2013-01-01", "is_payday": flag, "unit_sales": units}
            for flag, units in [("true", "0.01"), ("true", "0"), ("false", "-0.01"), ("false", "0")]
        ],
    )
    found = reports.payday_impact(master, "2014-01-01").select("is_payday", "avg_sales")
    assert [(flag, float(mean)) for flag, mean in rows(found)] == [(True, 0.01), (False, -0.01)]


def test_history_ends_before_the_cutoff(spark):
    master = master_of(
        spark,
        {"date": "2017-08-15", "unit_sales": "1", "item_family": "a"},
        {"date": "2017-08-16", "unit_sales": None, "item_family": "b"},
    )
    assert rows(reports.top_families(master, "2017-08-16").select("item_family")) == [("a",)]
    assert reports.validate_master(master, "2017-08-16").first()["total_rows"] == 1


# --- exploration ---------------------------------------------------------------------


def daily_of(spark, *pairs):
    return spark.createDataFrame(
        [(day(date), Decimal(total), 1) for date, total in pairs],
        "date date, total_sales decimal(20,0), num_transactions bigint",
    )


def test_moving_average_waits_for_a_full_window(spark):
    daily = daily_of(spark, *[(f"2013-01-0{n}", n) for n in (1, 2, 4, 5)])
    assert [row[2] for row in rows(explore.moving_average(daily, 3))] == [None, None, 7 / 3, 11 / 3]


def test_refunds_are_all_sales_below_one_unit(make):
    train = make(
        "train",
        (1, "2013-01-01", 1, 1, 0.5, None),
        (2, "2013-01-01", 1, 1, -3, None),
        (3, "2013-01-01", None, 1, 1, None),
        (4, "2013-01-01", 1, None, None, None),
    )
    assert rows(explore.invalid_values(train)) == [(1, 2, 1, 1)]


def test_all_seven_weekdays_are_listed(spark):
    daily = daily_of(spark, ("2013-01-07", 10), ("2013-01-08", 30))  # Monday, Tuesday
    found = rows(explore.weekday_pattern(daily), "day_order")
    assert [row[1] for row in found][0::6] == ["Monday", "Sunday"] and len(found) == 7
    assert [row[4] for row in found] == [-50.0, 50.0, None, None, None, None, None]


def test_days_count_once_per_event(spark, make):
    daily = daily_of(spark, ("2013-01-01", 100), ("2013-01-02", 10), ("2013-01-03", 20))
    holidays = make(
        "holidays_events",
        ("2013-01-01", "Holiday", "Local", "Q", "a", True),
        ("2013-01-01", "Event", "Local", "R", "b", None),
        ("2013-01-02", "Event", "Local", "R", "b", False),
        ("2013-01-03", None, "Local", "R", "b", False),
        ("2019-01-01", "Event", "Local", "R", "b", False),
    )
    found = explore.holiday_comparison(daily, holidays)
    assert set(rows(found)) == {(True, 70.0, "Holidays"), (False, 20.0, "Regular Days")}
    assert rows(explore.holiday_lift(found)) == [(250.0,)]
    without = explore.holiday_comparison(daily, holidays.where("false"))
    assert rows(explore.holiday_lift(without)) == [(None,)]


def test_best_month_is_the_earlier_one_on_a_tie(spark):
    daily = daily_of(
        spark, ("2013-03-01", 5), ("2013-01-01", 9), ("2013-05-01", 9), ("2013-04-01", 5)
    )
    assert rows(explore.best_and_worst_month(explore.month_pattern(daily))) == [("Jan", "Mar")]


def test_month_means_round_halves_to_even(spark):
    daily = daily_of(spark, ("2013-01-01", 2), ("2013-01-02", 3))
    assert rows(explore.month_pattern(daily).select("total_sales", "month_name")) == [(2.0, "Jan")]


def test_quartiles_interpolate(spark):
    frame = spark.createDataFrame([(n,) for n in (1, 2, 3, 4)] + [(None,)], "x int")
    assert rows(explore.describe(frame, ["x"]).select("count", "p25", "p50", "p75")) == [
        (4, 1.75, 2.5, 3.25)
    ]


def test_value_counts_leave_out_the_unknown(spark):
    frame = spark.createDataFrame([("b",), ("a",), ("a",), (None,)], "x string")
    assert rows(explore.value_counts(frame, "x")) == [("a", 2), ("b", 1)]
    assert rows(explore.value_counts(frame, "x", 1)) == [("a", 2)]


def test_sales_of_unknown_stores_and_items_are_left_out(make):
    stores = make("stores", (1, "Q", "P", "A", 1), (3, "Q", "P", None, 1))
    items = make("items", (10, "F", 1, 2))
    train = make(
        "train",
        (1, "2013-01-01", 1, 10, 5, True),
        (2, "2013-01-01", 2, 11, 7, None),
        (3, "2013-01-02", 1, 10, -1, None),
        (4, "2013-01-02", 3, 10, 1, None),
    )
    performance = explore.store_performance(train, stores)
    assert rows(performance, "store_nbr")[0][:9] == (
        1, "Q", "P", "A", 1, 2, Decimal(4), 1, 2,
    )
    assert rows(explore.type_performance(performance)) == [("A", 1, 4.0, 4.0)]
    families = explore.family_performance(train, items)
    assert rows(families) == [("F", 3, Decimal(5), Decimal("1.67"), 1, 2)]
    split = explore.perishable_split(train, items).select("is_perishable", "perishability")
    assert rows(split) == [(2, None)]
    assert rows(explore.promotion_lift(explore.promotion_by_flag(train))) == [
        (pytest.approx((5 / 2.33 - 1) * 100),)
    ]


def test_concentration_with_fewer_stores_than_asked_for(make):
    stores = make("stores", (1, "Q", "P", "A", 1), (2, "Q", "P", "A", 1))
    train = make("train", (1, "2013-01-01", 1, 10, 5, True))
    performance = explore.store_performance(train, stores)
    found = explore.store_concentration(performance, stores)
    assert rows(found) == [(2, Decimal(5), 100.0, 100.0, 250.0, 500.0)]


# --- latest rows ---------------------------------------------------------------------


@pytest.fixture(scope="module")
def clumped(spark):
    """5,000 rows over 60 days; the last day but one holds a third, ids are clumped."""
    return spark.range(5_000).selectExpr(
        "if(id % 10 = 0, id * 1000000, id) AS id",
        "date_add(DATE '2013-01-01', CAST(if(id % 3 = 0, 58, id % 60) AS INT)) AS date",
        "CAST(id % 7 AS INT) AS store_nbr",
    )


@pytest.mark.parametrize("n", [1, 50, 60, 500, 1_700, 1_800, 4_999, 5_000, 9_000])
def test_latest_rows(clumped, n):
    wanted = sorted(
        (tuple(row) for row in clumped.select("date", "id", "store_nbr").collect()), reverse=True
    )[:n]
    found = topk.latest_rows(clumped, n).select("date", "id", "store_nbr")
    assert rows(found) == wanted


def test_latest_rows_with_equal_keys(spark):
    frame = spark.range(300).selectExpr("1 AS id", "DATE '2013-01-01' AS date", "id AS x")
    assert [row[2] for row in rows(topk.latest_rows(frame, 3))] == [299, 298, 297]


# --- constraints ---------------------------------------------------------------------


def test_constraint_reports(make):
    tables = RetailTables(
        stores=make("stores", (1, "Q", "P", "A", 1), (1, "Q", None, "A", 1)),
        items=make("items", (10, "F", 1, 0), (11, "F", 1, 2), (12, "F", 1, None)),
        transactions=make("transactions", ("2013-01-01", 1, 5), ("2013-01-01", 9, 5)),
        oil=make("oil", ("2013-01-01", None)),
        holidays_events=make("holidays_events"),
        train=make(
            "train",
            (1, "2013-01-01", 1, 10, 1, None),
            (1, "2013-01-01", 2, 99, 1, None),
            (1, "2013-01-02", 2, 99, 1, None),
            (2, "2018-01-01", None, 10, 1, None),
        ),
    )
    assert dict(rows(quality.primary_key_report(tables))) == {
        "stores": 1, "items": 0, "transactions": 0, "oil": 0, "train": 1,
    }
    assert rows(quality.foreign_key_report(tables)) == [
        ("transactions.store_nbr", 1, 1),
        ("train.store_nbr", 1, 2),
        ("train.item_nbr", 1, 2),
    ]
    missing = [row for row in rows(quality.not_null_report(tables)) if row[2]]
    assert missing == [
        ("stores", "state", 1), ("items", "perishable", 1), ("train", "store_nbr", 1),
    ]
    assert rows(quality.outside_domain(tables.items).select("item_nbr")) == [(11,)]
    late = quality.outside_range(tables.train, "2013-01-01", "2018-01-01")
    assert rows(late.select("id")) == [(2,)]


def test_cleaning_leaves_optional_test_rows_out(make):
    train = make("train", (1, "2013-01-01", 1, 10, 1, None))
    tables = RetailTables(
        make("stores"), make("items"), make("transactions"), make("oil"),
        make("holidays_events"), train,
    )
    assert "test" not in tables.present()
    assert clean.sales_rows(tables.train, tables.test).count() == 1
