"""Run the queries and their SQL side by side: ``python -m verification.compare DIR [name ...]``."""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb
from pyspark.sql import SparkSession

from verification.oracle import all_sql
from verification.queries import all_queries

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"create view {name} as select * from '{folder}/{name}.parquet'")
    return connection


def rows_of(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(row[i] for i in order) for row in rows), key=repr)


def type_names(row: tuple) -> list[str]:
    return [type(value).__name__ for value in row]


def differences(spark: SparkSession, connection, name: str, folder: str) -> list[str]:
    """What differs between the two results; nothing when they are equal."""
    frame = all_queries()[name](spark, folder)
    got = rows_of(frame.columns, frame.collect())
    cursor = connection.execute(all_sql()[name])
    expected_columns = [column[0] for column in cursor.description]
    expected = rows_of(expected_columns, cursor.fetchall())
    found = []
    if sorted(frame.columns) != sorted(expected_columns):
        found.append(f"columns {sorted(frame.columns)} != {sorted(expected_columns)}")
    if len(got) != len(expected):
        found.append(f"{len(got)} rows != {len(expected)}")
    if not found and got != expected:
        pairs = [(a, b) for a, b in zip(got, expected) if a != b]
        close = all(_close(x, y) for a, b in pairs for x, y in zip(a, b))
        found.append(f"{len(pairs)} rows differ{' by rounding only' if close else ''}: {pairs[0]}")
    if got and expected and type_names(got[0]) != type_names(expected[0]):
        found.append(f"types {type_names(got[0])} != {type_names(expected[0])}")
    return found


def _close(a, b) -> bool:
    if isinstance(a, float) and isinstance(b, float):
        return math.isclose(a, b, rel_tol=1e-12)
    return a == b


def main(folder: str, names: list[str]) -> int:
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", os.environ.get("COMPARE_ZONE", "UTC"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection = connect(folder)
    bad = 0
    for name in names or all_queries():
        started = time.time()
        if name not in all_sql():
            print(f"NOSQL {name}", flush=True)
            continue
        try:
            found = differences(spark, connection, name, folder)
        except Exception as problem:
            found = [f"{type(problem).__name__}: {str(problem)[:1500]}"]
        bad += bool(found)
        print(f"{'BAD ' if found else 'ok  '} {name} {time.time() - started:.1f}s", *found, sep="\n      ", flush=True)
    print(f"{bad} differ")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1], sys.argv[2:]) else 0)
