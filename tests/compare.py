"""Order-insensitive comparison of a Spark result with a DuckDB result."""

from __future__ import annotations

import datetime
import math
from collections import Counter

import duckdb
from pyspark.sql import DataFrame

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{folder}/{table}.parquet')")
    return con


def _plain(value):
    if isinstance(value, float) and not math.isnan(value):
        return value + 0.0
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    return value


def _rows(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def spark_rows(df: DataFrame) -> Counter:
    return _rows(df.columns, df.collect())


def assert_same(df: DataFrame, con: duckdb.DuckDBPyConnection, sql: str) -> None:
    result = con.execute(sql)
    columns = [d[0] for d in result.description]
    assert sorted(columns) == sorted(df.columns)
    expected, actual = _rows(columns, result.fetchall()), spark_rows(df)
    missing, extra = expected - actual, actual - expected
    assert not missing and not extra, (
        f"{sum(expected.values())} expected, {sum(actual.values())} actual; "
        f"missing {list(missing)[:3]}; extra {list(extra)[:3]}"
    )
