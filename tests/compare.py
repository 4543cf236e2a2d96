"""Order-insensitive comparison of a Spark result with its DuckDB counterpart."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame
from pyspark.sql import types as T

KINDS = {
    "VARCHAR": T.StringType,
    "INTEGER": T.IntegerType,
    "BIGINT": T.LongType,
    "DOUBLE": T.DoubleType,
    "BOOLEAN": T.BooleanType,
    "DATE": T.DateType,
    "TIMESTAMP": T.TimestampNTZType,
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in Path(sf_dir).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


def _sort_key(row: tuple) -> tuple:
    return tuple((value is None, str(value)) for value in row)


def _plain(value: object) -> object:
    if isinstance(value, Decimal):
        raise AssertionError("decimals must not reach a result")
    assert value is None or isinstance(value, (str, bool, int, float, dt.date, dt.datetime))
    return value


def assert_same(df: DataFrame, connection: duckdb.DuckDBPyConnection, sql: str) -> int:
    """Equal column names, types and rows; returns the number of rows."""
    expected = connection.sql(sql)
    names = sorted(expected.columns)
    assert sorted(df.columns) == names
    kinds = dict(zip(expected.columns, expected.types))
    for name in names:
        assert isinstance(df.schema[name].dataType, KINDS[str(kinds[name])]), (
            name,
            df.schema[name].dataType,
            kinds[name],
        )
    ours = [tuple(map(_plain, row)) for row in df.select(*names).collect()]
    theirs = expected.select(*[duckdb.ColumnExpression(n) for n in names]).fetchall()
    ours.sort(key=_sort_key)
    theirs.sort(key=_sort_key)
    assert len(ours) == len(theirs)
    wrong = [(a, b) for a, b in zip(ours, theirs) if a != b]
    assert not wrong, (names, len(wrong), wrong[:3])
    return len(ours)
