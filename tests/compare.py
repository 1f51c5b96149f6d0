"""Runs a registered query in Spark and its SQL in DuckDB and compares the rows."""

from __future__ import annotations

import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
)


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES.split():
        con.execute(f"create view {name} as select * from read_parquet('{folder}/{name}.parquet')")
    return con


def _plain(value):
    if value is None:
        return (0, "")
    if isinstance(value, bool):
        return (1, str(value))
    if isinstance(value, int):
        return (2, str(value))
    if isinstance(value, float):
        return (3, "nan" if math.isnan(value) else repr(value + 0.0))
    return (4, str(value))


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_plain(row[i]) for i in order) for row in rows)


def difference(spark_frame, con, sql: str) -> str | None:
    """None if both give the same columns and rows, else what differs."""
    found = con.execute(sql)
    sql_columns = [d[0] for d in found.description]
    expected = rows_of(sql_columns, found.fetchall())
    actual = rows_of(spark_frame.columns, [tuple(r) for r in spark_frame.collect()])
    if sorted(sql_columns) != sorted(spark_frame.columns):
        return f"columns {sorted(spark_frame.columns)} and {sorted(sql_columns)}"
    if len(actual) != len(expected):
        return f"{len(actual)} rows and {len(expected)}"
    wrong = [(a, e) for a, e in zip(actual, expected) if a != e]
    return f"{len(wrong)} of {len(actual)} rows, first {wrong[0]}" if wrong else None
