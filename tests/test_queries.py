"""Every registered query against DuckDB on the same tables."""

import pytest

import __spark_entry__ as entry_points
from basketry.plans import queries as registry
from checks import sql
from checks.compare import connect, differences

SMALL = "/root/testdata/sf0.001"
MIDDLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def duck():
    return {folder: connect(folder) for folder in (SMALL, MIDDLE)}


def test_every_query_has_expected_sql():
    assert registry.queries().keys() == sql.oracle_sql().keys()


@pytest.mark.parametrize("folder", [SMALL, MIDDLE])
@pytest.mark.parametrize("name", registry.queries())
def test_query(spark, duck, name, folder):
    result = entry_points.queries()[name](spark, folder)
    assert differences(result, duck[folder], entry_points.oracle_sql()[name]) == []


def test_entry(spark):
    result = entry_points.entry(spark)
    assert result.columns == ["year", "month", "total_sales", "year_month"]
    assert result.count() == 80
