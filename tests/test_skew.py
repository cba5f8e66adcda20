"""Every query with a third of all rows on one store, item and day."""

import duckdb
import pytest

from basketry.operators import lookup
from basketry.plans import queries as registry
from basketry.plans.warehouse import Warehouse
from basketry.sources.adapter import adapt
from checks import sql
from checks.compare import connect, differences

SOURCE = "/root/testdata/sf0.001"
HOT_DAY = "TIMESTAMP '2000-03-05 00:00:00'"
HOT = {
    "lineitem": {
        "l_suppkey": "7",
        "l_partkey": "42",
        "l_shipdate": HOT_DAY,
    },
    "orders": {"o_orderdate": HOT_DAY},
}
KEYS = {"lineitem": "l_orderkey", "orders": "o_orderkey"}


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    """The given tables with a third of the sales and events moved to one key."""
    target = tmp_path_factory.mktemp("skewed")
    connection = duckdb.connect()
    for table in ("region", "nation", "customer", "supplier", "part", "orders", "lineitem"):
        moved = ", ".join(
            f"CASE WHEN {KEYS[table]} % 3 = 0 THEN {value} ELSE {column} END AS {column}"
            for column, value in HOT.get(table, {}).items()
        )
        columns = f"* REPLACE ({moved})" if moved else "*"
        connection.execute(
            f"COPY (SELECT {columns} FROM '{SOURCE}/{table}.parquet') "
            f"TO '{target}/{table}.parquet' (FORMAT parquet)"
        )
    return str(target)


@pytest.mark.parametrize("name", registry.queries())
def test_query_on_skewed_tables(spark, folder, name):
    result = registry.queries()[name](spark, folder)
    assert differences(result, connect(folder), sql.oracle_sql()[name]) == []


@pytest.mark.parametrize("name", ["train_clean", "master", "family_perf"])
def test_salted_joins_on_skewed_tables(spark, folder, name, monkeypatch):
    monkeypatch.setattr(lookup, "BROADCAST_BYTES", -1)
    monkeypatch.setattr(lookup, "ROWS_PER_TASK", 100)
    fresh = Warehouse(spark, adapt(spark, folder))
    result = {
        "train_clean": fresh.train_clean,
        "master": fresh.master_rows,
        "family_perf": lambda: fresh.family_performance,
    }[name]()
    expected = registry.queries()[name](spark, folder)
    doubled = result.select(
        *[result[f.name].cast(f.dataType).alias(f.name) for f in expected.schema]
    )
    assert differences(doubled, connect(folder), sql.oracle_sql()[name]) == []
