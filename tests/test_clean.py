from decimal import Decimal

from plain import day, rows
from pyspark.sql import functions as F

from basketry.operators import clean


def test_prices_are_carried_forward_and_the_first_gap_backward(make):
    oil = make(
        "oil",
        ("2013-01-01", None),
        ("2013-01-02", 93.14),
        ("2013-01-04", None),
        ("2013-01-06", 91.5),
        ("2013-01-07", None),
    )
    assert rows(clean.oil_clean(oil), "date") == [
        (day("2013-01-01"), Decimal("93.14"), True),
        (day("2013-01-02"), Decimal("93.14"), False),
        (day("2013-01-03"), Decimal("93.14"), True),
        (day("2013-01-04"), Decimal("93.14"), True),
        (day("2013-01-05"), Decimal("93.14"), True),
        (day("2013-01-06"), Decimal("91.50"), False),
        (day("2013-01-07"), Decimal("91.50"), True),
    ]


def test_no_prices_at_all(make):
    assert rows(clean.oil_clean(make("oil"))) == []
    unknown = clean.oil_clean(make("oil", ("2013-01-01", None)))
    assert rows(unknown) == [(day("2013-01-01"), None, True)]


def test_refunds_go_and_rows_to_predict_stay(make):
    train = make(
        "train",
        (1, "2013-01-01", 1, 10, 5, True),
        (2, "2013-01-01", 1, 10, 0, None),
        (3, "2013-01-01", 1, 10, -2, False),
        (4, "2013-01-01", 1, 10, None, False),
        (5, "2013-01-01", 1, 10, 0.5, None),
    )
    test = make("test", (6, "2017-08-16", 1, 10, False))
    assert rows(clean.sales_rows(train, test).select("id", "unit_sales"), "id") == [
        (1, Decimal("5.00000")),
        (5, Decimal("0.50000")),
        (6, None),
    ]
    assert clean.sales_rows(train).count() == 2


def test_sales_of_unknown_stores_and_items_are_flagged(make):
    stores = make("stores", (1, "Q", "P", "A", 1))
    items = make("items", (10, "F", 1, 0))
    train = make(
        "train",
        (1, "2013-01-01", 1, 10, 5, None),
        (2, "2013-01-01", 2, 10, 5, None),
        (3, "2013-01-01", 1, 11, 5, None),
        (4, "2013-01-01", 2, 11, 5, None),
    )
    flags = clean.train_clean(train, stores, items).select(
        "id", "is_orphan_store", "is_orphan_item", "has_integrity_issues"
    )
    assert rows(flags, "id") == [
        (1, False, False, False),
        (2, True, False, True),
        (3, False, True, True),
        (4, True, True, True),
    ]


def test_holidays_of_one_place_are_merged(make):
    holidays = make(
        "holidays_events",
        ("2013-01-01", "Work Day", "Local", "Q", "b", False),
        ("2013-01-01", "Holiday", "Local", "Q", "b", False),
        ("2013-01-01", "Holiday", "Local", "Q", "a", False),
        ("2013-01-01", "Holiday", "Local", "R", "a", True),
        ("2013-01-01", "Holiday", "Local", "R", "a", None),
        ("2013-01-02", "Event", "National", None, None, False),
    )
    assert rows(clean.holidays_clean(holidays), "date") == [
        (day("2013-01-01"), "Holiday,Work Day", "Local", "Q", "a,b", 3, True),
        (day("2013-01-02"), "Event", "National", None, None, 1, False),
    ]


def test_equal_events_of_a_very_frequent_place_are_all_counted(make):
    one = make("holidays_events", ("2013-01-01", "Event", "National", "E", "x", False))
    many = one.withColumn("n", F.explode(F.sequence(F.lit(1), F.lit(20_000)))).drop("n")
    merged = clean.holidays_clean(many).select("description", "holiday_count", F.lit(1))
    assert rows(merged) == [("x", 20_000, 1)]
