"""Order-free comparison of a Spark result with a DuckDB result."""

from __future__ import annotations

import datetime as dt
import math
from collections import Counter
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

SPARK_KINDS = {
    "int": "INTEGER",
    "bigint": "BIGINT",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
    "boolean": "BOOLEAN",
}


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES:
        if Path(folder, f"{table}.parquet").exists():
            connection.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{folder}/{table}.parquet')")
    return connection


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value + 0.0
    if isinstance(value, dt.datetime):
        return value.isoformat()
    return value


def _bag(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def differences(df, sql: str, connection) -> list[str]:
    """Empty when names, types and the bag of rows agree."""
    relation = connection.sql(sql)
    found = []
    mine = {name: SPARK_KINDS.get(kind, kind) for name, kind in df.dtypes}
    theirs = dict(zip(relation.columns, (str(t) for t in relation.types), strict=True))
    if mine != theirs:
        found.append(f"schema {mine} != {theirs}")
    left = _bag(df.columns, df.collect())
    right = _bag(relation.columns, relation.fetchall())
    if left != right:
        only_left, only_right = left - right, right - left
        found.append(
            f"rows {sum(left.values())} / {sum(right.values())}, differing {sum(only_left.values())}: "
            f"{list(only_left)[:3]} != {list(only_right)[:3]}"
        )
    return found
