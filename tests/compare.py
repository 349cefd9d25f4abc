"""Run a registered query and its SQL, and compare rows regardless of order."""

from __future__ import annotations

import glob
import math
import os

import duckdb
from pyspark.sql import SparkSession

import __spark_entry__ as registered


def oracle_connection(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    return repr(value)


def _sorted_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_plain(row[i]) for i in order) for row in rows)


def both(spark: SparkSession, name: str, folder: str, con: duckdb.DuckDBPyConnection):
    """(columns, rows) of the query and of its SQL."""
    frame = registered.queries()[name](spark, folder)
    got = sorted(frame.columns), _sorted_rows(frame.columns, [tuple(r) for r in frame.collect()])
    cursor = con.execute(registered.oracle_sql()[name])
    columns = [item[0] for item in cursor.description]
    return got, (sorted(columns), _sorted_rows(columns, cursor.fetchall()))
