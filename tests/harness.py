"""Compares a registered query with its DuckDB statement, value by value."""

from __future__ import annotations

import datetime as dt
import os
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()
TESTDATA = os.environ.get("TESTDATA_ROOT", "/root/testdata")


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    connection.execute("SET TimeZone = 'UTC'")
    for table in TABLES:
        path = f"{sf_dir}/{table}.parquet"
        if os.path.exists(path):
            connection.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{path}')")
    return connection


def _plain(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, float):
        return repr(value + 0.0)
    return str(value)


def rows_of(columns, rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def differences(frame, connection, sql: str) -> str:
    """Empty when columns, types of kind, and the multiset of rows agree."""
    result = connection.execute(sql)
    columns = [c[0] for c in result.description]
    kinds = {c[0]: str(c[1]) for c in result.description}
    if sorted(columns) != sorted(frame.columns):
        return f"columns differ: only spark {set(frame.columns) - set(columns)}, only duckdb {set(columns) - set(frame.columns)}"
    expected = rows_of(columns, result.fetchall())
    got = rows_of(frame.columns, [tuple(r) for r in frame.collect()])
    if expected == got:
        wide = [c for c, kind in kinds.items() if "HUGEINT" in kind or "DECIMAL" in kind]
        odd = [f.name for f in frame.schema.fields if f.dataType.simpleString().startswith("decimal")]
        return f"types to align: duckdb {wide}, spark {odd}" if wide or odd else ""
    only_spark, only_duck = got - expected, expected - got
    return (
        f"{sorted(frame.columns)}\n{sum(got.values())} vs {sum(expected.values())} rows\n"
        f"only spark: {list(only_spark)[:3]}\nonly duckdb: {list(only_duck)[:3]}"
    )


def plan_text(df) -> str:
    jvm = df.sparkSession._jvm
    return jvm.org.apache.spark.sql.api.python.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
