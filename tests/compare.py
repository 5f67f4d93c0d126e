"""Comparison of a Spark result with a DuckDB statement, row for row."""

from __future__ import annotations

import datetime as dt
import glob
import math
import os
from collections import Counter

import duckdb


def open_tables(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    connection.execute("SET TimeZone = 'UTC'")
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return connection


def _plain(value):
    if isinstance(value, float) and math.isfinite(value):
        return float(f"{value:.12g}")
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    return value


def rows_of(names, rows) -> Counter:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def differences(df, connection, sql: str) -> str:
    """Empty when both sides hold the same columns and the same bag of rows."""
    result = connection.execute(sql)
    expected_names = [column[0] for column in result.description]
    if sorted(expected_names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(expected_names)}"
    expected = rows_of(expected_names, result.fetchall())
    actual = rows_of(df.columns, df.collect())
    if actual == expected:
        return ""
    return f"only in Spark {list((actual - expected).items())[:3]}, only in SQL {list((expected - actual).items())[:3]}"
