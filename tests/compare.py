"""Compare Spark results with SQL on the same tables, the way the driver's check does."""

from __future__ import annotations

import datetime
import glob
import math
import os

import duckdb


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return connection


TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
}


def plain(value):
    """Dates and midnight timestamps alike, numbers by value."""
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    if isinstance(value, datetime.date):
        return datetime.datetime(value.year, value.month, value.day).isoformat()
    if isinstance(value, float) and math.isnan(value):
        return None
    return value


def sorted_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda at: columns[at])
    tidy = [tuple(plain(row[at]) for at in order) for row in rows]
    return sorted(tidy, key=repr)


def compare(result, connection, sql: str) -> str | None:
    """None when columns, types and values agree; else what differs."""
    answer = connection.execute(sql)
    columns = [part[0] for part in answer.description]
    if sorted(columns) != sorted(result.columns):
        return f"columns {sorted(result.columns)} != {sorted(columns)}"
    types = {part[0]: str(part[1]) for part in answer.description}
    for name, kind in result.dtypes:
        if types[name] != TYPES[kind]:
            return f"{name}: {kind} != {types[name]}"
    expected = sorted_rows(columns, answer.fetchall())
    actual = sorted_rows(result.columns, [tuple(row) for row in result.collect()])
    if len(actual) != len(expected):
        return f"{len(actual)} rows != {len(expected)}"
    for left, right in zip(actual, expected):
        if left != right:
            return f"{left} != {right}"
    return None
