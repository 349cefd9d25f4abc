"""Deleted keys, surviving rows and the latest row of each key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from foldlog.staging import stage

_RANK = "__rank"


def deleted_keys(log: DataFrame, key: str = "document_id", deleted: Column | None = None) -> DataFrame:
    """Distinct keys with a delete row. NULL keys are left out, as they match no row."""
    marker = F.col("operation") == "DELETE" if deleted is None else deleted
    return log.filter(marker & F.col(key).isNotNull()).select(key).distinct()


def live_rows(log: DataFrame, deleted: DataFrame, key: str = "document_id") -> DataFrame:
    """Rows of ``log`` whose key was never deleted; rows with a NULL key stay.

    The distinct deleted keys are staged, so the planner knows their true size: below
    ``spark.sql.autoBroadcastJoinThreshold`` they are broadcast and the log is not shuffled,
    above it both sides are shuffled. The staged side is then a bare scan under its exchange,
    which adaptive execution needs to split a key that holds much of the log.
    """
    gone = stage(deleted.select(key).distinct(), "deleted")
    return log.join(gone, log[key] == gone[key], "left_anti")


def latest_per_key(df: DataFrame, key: str, newest_first: Sequence[Column]) -> DataFrame:
    """First row of each key in the given order, which must be total; NULL keys are dropped.

    ``row_number() = 1`` is also applied before the shuffle, per input partition, so a key that
    holds much of the data sends one row per partition.
    """
    window = Window.partitionBy(key).orderBy(*newest_first)
    return (
        df.filter(F.col(key).isNotNull())
        .withColumn(_RANK, F.row_number().over(window))
        .filter(F.col(_RANK) == 1)
        .drop(_RANK)
    )


def require_unique(rows: DataFrame, columns: Sequence[str]) -> None:
    """Raise ValueError where a value of the columns is NULL or occurs twice."""
    null = F.coalesce(*(F.when(F.col(name).isNull(), F.lit(True)) for name in columns), F.lit(False))
    found = rows.groupBy(*columns).agg(F.count(F.lit(1)).alias("__rows")).where(null | (F.col("__rows") > 1))
    example = found.limit(1).collect()
    if example:
        raise ValueError(f"{', '.join(columns)} must tell all rows apart; not so: {tuple(example[0])[:-1]}")
