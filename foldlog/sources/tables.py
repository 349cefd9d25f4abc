"""Tables by name, path or SQL text."""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.sql import DataFrame, SparkSession


def read_table(
    spark: SparkSession,
    source: str,
    fmt: str | None = None,
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """A catalog table, or ``source`` read through ``fmt``.

    Warehouse connectors whose jars the cluster provides are reached by their format name.
    """
    if fmt is None:
        return spark.table(source)
    return spark.read.format(fmt).options(**(options or {})).load(source)


def run_query(spark: SparkSession, text: str, args: Mapping[str, Any] | None = None) -> DataFrame:
    """SQL text with named parameters; table names go through ``IDENTIFIER(:name)``."""
    return spark.sql(text, args=dict(args or {}))
