"""Loads that keep out repeated keys, keep refused lines, and count while they write."""

from decimal import Decimal

import pytest
from plain import day, rows
from pyspark.sql import functions as F

from basketry import schemas
from basketry.operators.lookup import Lookup
from basketry.sinks import observed
from basketry.sinks.stored import write_by_year
from basketry.sources import checked
from basketry.streaming import unique

HEAD = "id,date,store_nbr,item_nbr,unit_sales,onpromotion"


def arrive(folder, name, *lines, head=HEAD):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join([head, *lines]) + "\n")


# --- keys kept once --------------------------------------------------------------------


@pytest.fixture
def load(spark, tmp_path):
    def run(horizon="7 days"):
        target = str(tmp_path / "loaded")
        unique.load_unique_rows(spark, str(tmp_path / "in"), target, str(tmp_path / "progress"), horizon=horizon)
        found = spark.read.parquet(target).select("id", "date", "store_nbr")
        return sorted(((r[0], str(r[1]), r[2]) for r in rows(found)), key=str)

    return run


def test_a_file_under_two_names_counts_once(load, tmp_path):
    lines = ["1,2013-01-01,1,10,1,", "2,2013-01-01,1,10,1,", "2,2014-01-01,2,10,1,"]
    arrive(tmp_path / "in", "a.csv", *lines, lines[0])
    arrive(tmp_path / "in", "b.csv", *lines)
    expected = [(1, "2013-01-01", 1), (2, "2013-01-01", 1), (2, "2014-01-01", 2)]
    assert load() == expected
    arrive(tmp_path / "in", "c.csv", *lines, "3,2012-05-05,1,10,1,")
    assert load() == [*expected, (3, "2012-05-05", 1)]


def test_no_batch_without_rows_goes_over_the_state(spark, load, tmp_path):
    settings = {name: spark.conf.get(name, None) for name in unique._ON_DISK}
    for number, name in enumerate(("a.csv", "b.csv"), 1):
        arrive(tmp_path / "in", name, f"{number},2013-01-01,1,10,1,")
        assert len(load()) == number
        assert unique.loaded_batches(spark, str(tmp_path / "loaded")) == list(range(number))
    assert settings == {name: spark.conf.get(name, None) for name in unique._ON_DISK}


def test_keys_the_state_has_given_up_are_found_in_what_is_stored(spark, load, tmp_path, monkeypatch):
    """With the state taken out of the way, repeats of earlier batches still stay out."""
    monkeypatch.setattr(unique, "unique_within", lambda stream, keys, horizon: stream)
    arrive(tmp_path / "in", "a.csv", "1,2013-01-01,1,10,1,", "2,2013-01-01,1,10,1,")
    first = load()
    arrive(tmp_path / "in", "b.csv", "2,2013-01-01,1,10,1,", "1,2014-01-01,1,10,1,")
    assert load() == sorted([*first, (1, "2014-01-01", 1)], key=str)


def test_rows_of_any_age_and_without_a_key_stay(load, tmp_path):
    """No row is late: old days come after new ones, within a batch and after it."""
    arrive(tmp_path / "in", "a.csv", "1,2017-01-01,1,10,1,", ",2017-01-01,7,10,1,", ",2017-01-01,7,10,1,", "5,,8,10,1,")
    assert len(load("1 second")) == 4
    arrive(tmp_path / "in", "b.csv", "1,1999-01-01,1,10,1,", "1,1999-01-01,1,10,1,")
    found = load("1 second")
    assert len(found) == 5 and (1, "1999-01-01", 1) in found


# --- refused lines ---------------------------------------------------------------------


def split(spark, path, make, rules=None, folder="split", tmp_path=None):
    stores = make("stores", (1, "Quay", "North", "A", 1))
    rules = checked.missing_values("train") | checked.outside("date", "2013-01-01", "2018-01-01")
    lines = checked.read_lines(spark, str(path), schemas.TRAIN)
    return checked.store_split(
        checked.judged(lines, rules, {"store_nbr": Lookup.of(stores)}, row_id=("id",)), str(tmp_path / folder)
    )


def test_every_line_is_kept_with_its_reasons(spark, make, tmp_path):
    good = ["1,2013-01-01,1,10,1.5,True", "2,2017-12-31,1,10,-1,"]
    bad = {
        "3,2013-01-01,1,10,many,True": [checked.MALFORMED],
        "4,2013-01-01,1,10": [checked.MALFORMED],
        "5,2013-01-01,1,10,1,True,more": [checked.MALFORMED],
        "x": [checked.MALFORMED],
        "6,,1,10,1,": ["date is missing"],
        "7,2018-01-01,2,10,1,": ["date is out of range", "store_nbr is unknown"],
        ",,,,,": [f"{c} is missing" for c in ("id", "date", "store_nbr", "item_nbr", "unit_sales")],
    }
    arrive(tmp_path / "in", "a.csv", *good, *bad)
    found = split(spark, tmp_path / "in", make, tmp_path=tmp_path)
    assert found.accepted.columns == HEAD.split(",")
    assert rows(found.accepted, "id") == [
        (1, day("2013-01-01"), 1, 10, Decimal("1.50000"), True),
        (2, day("2017-12-31"), 1, 10, Decimal("-1.00000"), None),
    ]
    refused = found.refused.select("id", checked.LINE, checked.REASONS).collect()
    assert sorted(map(str, (r[checked.REASONS] for r in refused))) == sorted(map(str, bad.values()))
    assert {r[checked.LINE] for r in refused if r[checked.LINE]} == {
        line for line, reasons in bad.items() if reasons == [checked.MALFORMED]
    }
    counts = dict(rows(checked.reasons_count(found.refused)))
    assert counts[checked.MALFORMED] == 4 and counts["date is missing"] == 2
    assert counts["store_nbr is unknown"] == 1


def test_one_kind_of_rows_only(spark, make, tmp_path):
    for name, lines in {"good": ["1,2013-01-01,1,10,1.5,True"], "bad": ["x"], "none": []}.items():
        arrive(tmp_path / name, "a.csv", *lines)
        if not lines:
            continue
        found = split(spark, tmp_path / name, make, folder=f"split-{name}", tmp_path=tmp_path)
        assert (found.accepted.count(), found.refused.count()) == ((1, 0) if name == "good" else (0, 1))


def test_the_sales_are_read_once_and_not_shuffled(spark, make, tmp_path):
    arrive(tmp_path / "in", "a.csv", "1,2013-01-01,1,10,1.5,True")
    stores = Lookup.of(make("stores", (1, "Quay", "North", "A", 1)))
    lines = checked.read_lines(spark, str(tmp_path / "in"), schemas.TRAIN)
    plan = checked.judged(lines, checked.missing_values("train"), {"store_nbr": stores})
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("FileScan csv") == 1 and "SortMergeJoin" not in text


# --- figures of a load -----------------------------------------------------------------


def test_figures_come_with_the_write(spark, make, tmp_path):
    train = make(
        "train", (1, "2013-01-01", 1, 1, 0.5, None), (2, "2014-01-02", 1, 1, -3, True), (3, "2013-05-01", 1, 2, 1, False)
    )
    reads = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            reads.add(batch.num_rows)
            yield batch

    path = str(tmp_path / "sales")
    figures = observed.write_observed(
        train.mapInArrow(counted, train.schema), lambda frame: frame.write.parquet(path), observed.load_figures()
    )
    assert figures == {
        "rows": 3, "total_sales": Decimal("-1.50000"), "unknown_promotions": 1, "promotions": 1,
        "first_date": day("2013-01-01"), "last_date": day("2014-01-02"),
    }
    assert reads.value == 3
    assert spark.read.parquet(path).count() == 3


def test_figures_of_nothing(spark, make, tmp_path):
    figures = observed.write_observed(
        make("train"), lambda frame: write_by_year(frame, str(tmp_path / "none")), {"rows": F.count("*"), "least": F.min("date")}
    )
    assert figures == {"rows": 0, "least": None}
