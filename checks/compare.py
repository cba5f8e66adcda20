"""Exact comparison of a Spark result with DuckDB's on the same Parquet files."""

from __future__ import annotations

from pathlib import Path
from typing import Any

import duckdb
from pyspark.sql import DataFrame


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for file in sorted(Path(folder).glob("*.parquet")):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    return connection


def _canonical(columns: list[str], rows: list[tuple]) -> list[tuple]:
    order = sorted(range(len(columns)), key=columns.__getitem__)
    picked = [tuple(row[i] for i in order) for row in rows]
    return sorted(picked, key=lambda row: tuple((value is not None, str(value)) for value in row))


def differences(result: DataFrame, connection: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    """What differs in columns, row count, value types and values; empty if nothing."""
    cursor = connection.execute(sql)
    expected_columns = [column[0] for column in cursor.description]
    expected = _canonical(expected_columns, cursor.fetchall())
    actual = _canonical(result.columns, [tuple(row) for row in result.collect()])
    if sorted(result.columns) != sorted(expected_columns):
        return [f"columns {sorted(result.columns)} != {sorted(expected_columns)}"]
    if len(actual) != len(expected):
        return [f"{len(actual)} rows != {len(expected)} rows"]
    return [
        f"{mine} != {theirs}"
        for mine, theirs in zip(actual, expected, strict=True)
        if not _same(mine, theirs)
    ]


def _same(mine: tuple[Any, ...], theirs: tuple[Any, ...]) -> bool:
    return all(type(a) is type(b) and a == b for a, b in zip(mine, theirs, strict=True))
