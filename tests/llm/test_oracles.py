"""Queries of operators that SQL can express against DuckDB, on the given tables."""

import pytest

from basketry.llm import queries as llm
from checks.compare import connect, differences


@pytest.mark.parametrize("folder", ["/root/testdata/sf0.001", "/root/testdata/sf0.01"])
@pytest.mark.parametrize("name", [name for name in llm.oracle_sql() if name != "op7_jaccard_join"])
def test_query(spark, name, folder):
    result = llm.queries()[name](spark, folder)
    assert differences(result, connect(folder), llm.oracle_sql()[name]) == []
