"""Compare queries with their SQL: ``python tests/oracle.py [folder] [names...]``."""

from __future__ import annotations

import glob
import os
import sys
import time
from decimal import Decimal

import duckdb
from pyspark.sql import DataFrame

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

_TYPES = {
    "int": "INTEGER",
    "bigint": "BIGINT",
    "string": "VARCHAR",
    "double": "DOUBLE",
    "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
    "boolean": "BOOLEAN",
}


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def _value(value):
    if isinstance(value, float):
        return round(value, 9)
    if isinstance(value, Decimal):
        return str(value)
    return value


def _rows(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_value(row[i]) for i in order) for row in rows), key=repr)


def differences(df: DataFrame, sql: str, connection) -> list[str]:
    """What differs between a frame and the result of a statement."""
    found = []
    have = {name: _TYPES.get(kind, kind.upper()) for name, kind in df.dtypes}
    cursor = connection.execute(sql)
    want = {item[0]: str(item[1]) for item in cursor.description}
    want_rows = cursor.fetchall()
    have_rows = df.collect()
    if have != want:
        found.append(f"schema: {sorted(set(have.items()) ^ set(want.items()))}")
    if len(have_rows) != len(want_rows):
        found.append(f"rows: {len(have_rows)} instead of {len(want_rows)}")
    if not found or set(have) == set(want):
        left, right = _rows(list(have), have_rows), _rows(list(want), want_rows)
        wrong = [pair for pair in zip(left, right) if pair[0] != pair[1]]
        if wrong:
            found.append(f"values: {len(wrong)} rows, first {wrong[0]}")
    return found


if __name__ == "__main__":
    from __spark_entry__ import oracle_sql, queries
    from larder.session import local_session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session("oracle")
    connection = connect(folder)
    statements = oracle_sql()
    for name, run in queries().items():
        if sys.argv[2:] and name not in sys.argv[2:]:
            continue
        started = time.time()
        try:
            frame = run(spark, folder)
            result = differences(frame, statements[name], connection) if name in statements else []
            rows = "" if result else f"{frame.count()} rows"
        except Exception as error:  # noqa: BLE001
            result, rows = [f"{type(error).__name__}: {str(error)[:600]}"], ""
        print(f"{name}: {result or 'ok'} {rows} {time.time() - started:.1f}s", flush=True)
