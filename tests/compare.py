"""Runs a query and its SQL over the same tables and compares the rows."""

from __future__ import annotations

import datetime as dt
import glob
import math
import os
from collections import Counter

import duckdb

TESTDATA = "/root/testdata"


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return connection


def _plain(value: object) -> object:
    if isinstance(value, float):
        return "NaN" if math.isnan(value) else repr(value)
    if isinstance(value, (dt.datetime, dt.date)):
        return value.isoformat()
    return value


def rows_of(columns: list[str], rows: list[tuple]) -> Counter:
    order = sorted(range(len(columns)), key=lambda position: columns[position])
    return Counter(tuple(_plain(row[position]) for position in order) for row in rows)


def differences(spark, sf_dir: str, query, sql: str) -> str | None:
    """None when both give the same rows, else what differs."""
    frame = query(spark, sf_dir)
    left = rows_of(frame.columns, [tuple(row) for row in frame.collect()])
    cursor = connect(sf_dir).execute(sql)
    names = [column[0] for column in cursor.description]
    right = rows_of(names, cursor.fetchall())
    if sorted(frame.columns) != sorted(names):
        return f"columns {sorted(frame.columns)} against {sorted(names)}"
    if left != right:
        return f"{sum(left.values())} rows against {sum(right.values())}; only left {list((left - right).items())[:3]}; only right {list((right - left).items())[:3]}"
    return None if left else "no rows"
