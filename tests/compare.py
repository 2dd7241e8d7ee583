"""Spark result against the SQL counterpart: names, number of rows, values without order."""

from __future__ import annotations

import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return connection


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else value + 0.0
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_plain(row[i]) for i in order) for row in rows), key=repr)


def differences(spark_frame, connection, sql) -> list[str]:
    cursor = connection.execute(sql)
    names = [d[0] for d in cursor.description]
    expected = rows_of(names, cursor.fetchall())
    found = rows_of(spark_frame.columns, [tuple(r) for r in spark_frame.collect()])
    problems = []
    if sorted(names) != sorted(spark_frame.columns):
        problems.append(f"columns {sorted(spark_frame.columns)} for {sorted(names)}")
    if len(expected) != len(found):
        problems.append(f"{len(found)} rows for {len(expected)}")
    if expected != found:
        different = [(f, e) for f, e in zip(found, expected) if f != e]
        types = lambda row: [type(v).__name__ for v in row]
        problems.append(f"{len(different)} rows differ, first: {str(different[:1])[:1500]}")
        if different:
            problems.append(f"types {types(different[0][0])} for {types(different[0][1])}")
    return problems
