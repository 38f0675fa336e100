"""Runs queries next to their SQL on DuckDB and compares the results row by row."""

from __future__ import annotations

import datetime
import glob
import os
from collections import Counter

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return connection


TYPES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "timestamp_ntz": "TIMESTAMP",
         "date": "DATE", "boolean": "BOOLEAN"}


def _plain(value):
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    if isinstance(value, float):
        return repr(value)
    return value


def _counted(columns, rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def differences(df, connection, sql: str) -> str:
    """Empty if the two results have the same columns, types and rows, floats to the last bit."""
    cursor = connection.execute(sql)
    columns = [d[0] for d in cursor.description]
    types = sorted((d[0], str(d[1])) for d in cursor.description)
    expected = _counted(columns, cursor.fetchall())
    found_types = sorted((name, TYPES.get(kind, kind)) for name, kind in df.dtypes)
    if types != found_types:
        return f"columns {found_types} but SQL has {types}"
    found = _counted(df.columns, df.collect())
    if not expected:
        return "the SQL gives no rows"
    if found == expected:
        return ""
    return (f"{sum(found.values())} rows, SQL {sum(expected.values())}; "
            f"only Spark {list((found - expected).items())[:3]}; only SQL {list((expected - found).items())[:3]}")
