"""Audit rows: load time, process date and a random identifier."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foldlog.functions.times import date_to_text
from foldlog.sinks.loads import insert_rows
from foldlog.sources.tables import run_query

# Columns of the audit table.
AUDIT_COLUMNS = ("id_timestamp_update", "id_date", "data_uuid")


def audit_row(spark: SparkSession, process_date: str) -> DataFrame:
    """One row for a process date given as ``yyyy-MM-dd``."""
    return run_query(
        spark,
        """SELECT current_timestamp() AS id_timestamp_update,
                  to_date(:process_date) AS id_date,
                  uuid() AS data_uuid""",
        {"process_date": process_date},
    )


def audit_rows(spark: SparkSession, dates: DataFrame) -> DataFrame:
    """One row per row of ``dates``, whose column ``process_date`` is ``yyyy-MM-dd`` text."""
    return spark.sql(
        """SELECT current_timestamp() AS id_timestamp_update,
                  to_date(process_date) AS id_date,
                  uuid() AS data_uuid
           FROM {dates}""",
        dates=dates,
    )


def audit_days(days: DataFrame, column: str) -> DataFrame:
    """One row per different date of a column, through the text that a job is called with."""
    texts = days.select(date_to_text(F.col(column)).alias("process_date")).where("process_date IS NOT NULL")
    return audit_rows(days.sparkSession, texts.distinct())


def today_text(spark: SparkSession) -> str:
    """Today in UTC, as ``yyyy-MM-dd``; evaluated at each call."""
    return spark.range(1).select(date_to_text(F.current_date()).alias("d")).first()["d"]


def insert_audit(rows: DataFrame, table: str) -> None:
    insert_rows(rows, table, AUDIT_COLUMNS)


def insert_query(
    spark: SparkSession, table: str, columns: Sequence[str], text: str, args: Mapping[str, Any] | None = None
) -> None:
    """Insert what a query with named parameters returns into the named columns of a table, matched
    by position. The query may read any view or table by name, so one statement inserts a set."""
    insert_rows(run_query(spark, text, args), table, columns)
