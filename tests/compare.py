"""Compare a registered query with its DuckDB equivalent, row by row, in any order."""

from __future__ import annotations

import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"create view {name} as from '{sf_dir}/{name}.parquet'")
    return connection


def _plain(value):
    if isinstance(value, float) and math.isnan(value):
        return None
    return value


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = [tuple(_plain(row[i]) for i in order) for row in rows]
    return sorted(plain, key=lambda row: tuple((v is None, str(type(v)), str(v)) for v in row))


def difference(spark_df, connection, sql: str) -> str | None:
    """None when equal, else what differs."""
    relation = connection.sql(sql)
    expected_columns = relation.columns
    if sorted(spark_df.columns) != sorted(expected_columns):
        return f"columns {sorted(spark_df.columns)} against {sorted(expected_columns)}"
    actual = _rows(spark_df.columns, spark_df.collect())
    expected = _rows(expected_columns, relation.fetchall())
    if len(actual) != len(expected):
        return f"{len(actual)} rows against {len(expected)}"
    for a, b in zip(actual, expected):
        if a != b:
            return f"{a} against {b}"
        for x, y in zip(a, b):
            if type(x) is not type(y):
                return f"types of {a} against {b}"
    return None
