"""Refreshed views equal views built at once; months without new rows keep their files."""

import datetime
from pathlib import Path

import pytest
from plain import rows

from basketry.operators import clean
from basketry.operators.lookup import Lookup
from basketry.plans import refresh as r
from basketry.streaming.incremental import load_new_files, loaded_batches, read_loaded

HEAD = "id,date,store_nbr,item_nbr,unit_sales,onpromotion"


@pytest.fixture(scope="module")
def small(make):
    stores = make("stores", (1, "Quay", "North", "A", 1), (2, "Dale", "South", "B", 2))
    items = make("items", (10, "DAIRY", 7, 1), (11, "BREAD", 8, 0))
    oil = make("oil", ("2013-01-01", 90), ("2013-12-31", 95))
    holidays = make("holidays_events", ("2013-02-01", "Holiday", "National", "Land", "Day", False))

    def build(stores=stores, test=None):
        return r.SmallTables(
            Lookup.of(stores), Lookup.of(items), Lookup.of(clean.oil_clean(oil)),
            Lookup.of(clean.holidays_clean(holidays)), test,
        )

    return build


def arrive(folder, name, *lines):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join([HEAD, *lines]) + "\n")


def files(folder):
    return {
        str(p.relative_to(folder)): p.stat().st_mtime_ns
        for p in Path(folder).rglob("*.parquet") if "state" not in p.parts
    }


def content(spark, folder):
    found = {}
    for name in r.VIEWS:
        view = r.read_view(spark, str(folder), name)
        columns = sorted(c for c in view.columns if c != "id")
        found[name] = sorted(map(str, rows(view.select(*columns))))
    return found


def test_only_changed_months_are_built(spark, tmp_path, small, make):
    source, loaded, views = tmp_path / "in", str(tmp_path / "loaded"), tmp_path / "views"
    test = make("test", (9, "2013-03-09", 1, 10, True), (8, "2013-04-01", 2, 11, None))
    tables = small(test=test)

    def load():
        load_new_files(spark, str(source), loaded, str(tmp_path / "progress"))

    def renew(tables=tables):
        return r.refresh(spark, loaded, str(views), tables)

    arrive(source, "a.csv", "1,2013-01-05,1,10,2.5,True", "2,2013-02-01,2,11,1,", "3,2013-03-01,1,99,4,False", "4,2012-03-01,3,10,-1,")
    load()
    first = renew()
    assert first.months is None and len(first.batches) == 1
    before = files(views)
    assert renew() == r.Refreshed((), ())
    assert files(views) == before

    arrive(source, "b.csv", "5,2013-02-01,2,10,7,True", "6,2013-02-03,1,11,0.5,", "7,2014-07-01,1,10,3,")
    load()
    assert renew().months == ((2013, 2), (2014, 7))
    after = files(views)
    untouched = {name for name in before if "month=2/" not in name}
    assert untouched and all(after[name] == before[name] for name in untouched)
    assert not any(name in after for name in before if "year=2013/month=2/" in name)

    at_once = tmp_path / "at-once"
    r.refresh(spark, loaded, str(at_once), tables)
    assert content(spark, views) == content(spark, at_once)
    assert len(content(spark, views)["master"]) == 8

    changed = small(stores=make("stores", (1, "Harbour", "North", "A", 1)), test=test)
    assert renew(changed).months is None
    master = r.read_view(spark, str(views), "master")
    assert {row[0] for row in rows(master.select("city").distinct())} == {"Harbour", None}


def test_sales_are_gathered_before_they_are_made_wide(small, make):
    train = make("train", (1, "2013-01-05", 1, 10, 2.5, True))
    plan = r._master(train, small(), None)._jdf.queryExecution().analyzed().toString()
    above, below = plan.split("RebalancePartitions")
    assert above.count("Join LeftOuter") == 6 and "item_family" not in below.splitlines()[1]


def test_an_interrupted_refresh_is_done_again(spark, tmp_path, small, monkeypatch):
    source, loaded, views = tmp_path / "in", str(tmp_path / "loaded"), tmp_path / "views"
    arrive(source, "a.csv", "1,2013-01-05,1,10,2.5,True")
    load_new_files(spark, str(source), loaded, str(tmp_path / "progress"))
    r.refresh(spark, loaded, str(views), small())
    arrive(source, "b.csv", "2,2013-01-06,1,10,2.5,True", "3,,1,10,1,")
    load_new_files(spark, str(source), loaded, str(tmp_path / "progress"))
    with monkeypatch.context() as broken:
        broken.setattr(r, "summarise", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            r.refresh(spark, loaded, str(views), small())
    done = r.refresh(spark, loaded, str(views), small())
    assert set(done.months) == {(2013, 1), (None, None)}
    at_once = tmp_path / "at-once"
    r.refresh(spark, loaded, str(at_once), small())
    assert content(spark, views) == content(spark, at_once)
    days = rows(r.read_view(spark, str(views), "daily").select("date", "num_transactions"))
    assert set(days) == {(datetime.date(2013, 1, 5), 1), (datetime.date(2013, 1, 6), 1), (None, 1)}


def test_a_batch_being_written_is_left_out(spark, tmp_path, small):
    source, loaded = tmp_path / "in", tmp_path / "loaded"
    arrive(source, "a.csv", "1,2013-01-05,1,10,2.5,True")
    load_new_files(spark, str(source), str(loaded), str(tmp_path / "progress"))
    (loaded / "batch=7").mkdir()
    assert loaded_batches(spark, str(loaded)) == [0]
    assert read_loaded(spark, str(loaded), [0]).count() == 1
    assert r.refresh(spark, str(tmp_path / "none"), str(tmp_path / "views"), small()) == r.Refreshed((), ())
