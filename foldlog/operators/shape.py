"""Projection, defaults, text conversion and union. None of these shuffles."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foldlog.functions.numbers import float_text, truth_text
from foldlog.functions.times import local_time_to_text, timestamp_to_text

_DIGEST = "__digest"


def project_rename(df: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    """Select (source, target) pairs in order; a source may be used twice, a target may not."""
    targets = [target for _, target in pairs]
    if len(set(targets)) < len(targets):
        raise ValueError("a target name is used twice")
    return df.select(*(F.col(f"`{source}`").alias(target) for source, target in pairs))


def with_constant(df: DataFrame, name: str, value: Any) -> DataFrame:
    return df.withColumn(name, F.lit(value))


def null_to_default(df: DataFrame, defaults: Mapping[str, Any]) -> DataFrame:
    """Replace NULL in the named columns; each default takes the type of its column."""
    return df.withColumns(
        {
            name: F.coalesce(F.col(name), F.lit(value).cast(df.schema[name].dataType))
            for name, value in defaults.items()
        }
    )


def _as_text(field: T.StructField) -> Column:
    name = "`" + field.name.replace("`", "``") + "`"
    column, kind = F.col(name), field.dataType
    if isinstance(kind, (T.StructType, T.ArrayType, T.MapType, T.VariantType)):
        text = F.to_json(column)
    elif isinstance(kind, T.TimestampType):
        text = timestamp_to_text(column)
    elif isinstance(kind, T.TimestampNTZType):
        text = local_time_to_text(column)
    elif isinstance(kind, (T.DoubleType, T.FloatType)):
        text = F.expr(float_text(name))
    elif isinstance(kind, T.BooleanType):
        text = F.expr(truth_text(name))
    else:
        text = column.cast("string")
    return text.alias(field.name)


def stringify_all(df: DataFrame) -> DataFrame:
    """Every column as text: nested values as JSON, NULL stays NULL.

    Floating numbers, truth values and times print as the original job prints them: ``1e+16``,
    ``nan``, ``True``, an offset for timestamps and none for times without a zone.
    """
    return df.select(*(_as_text(field) for field in df.schema))


def union_fill(first: DataFrame, second: DataFrame) -> DataFrame:
    """All rows of both, matched by column name; columns missing on one side are NULL."""
    return first.unionByName(second, allowMissingColumns=True)


def without_brackets(df: DataFrame, column: str) -> DataFrame:
    """The text of a column without square brackets, wherever they stand."""
    return df.withColumn(column, F.translate(F.col(f"`{column}`"), "[]", ""))


def keyed_payload(df: DataFrame, key: str, payload: str = "data", name: str = "keyed") -> DataFrame:
    """Add a JSON object whose only member is the payload, named by the key; the payload is a JSON
    text and stays as it is written. NULL where either is NULL."""
    key_text = F.col(f"`{key}`").cast("string")
    # The name is escaped as the only element of a list, whose brackets go.
    listed = F.to_json(F.array(key_text))
    member = F.when(key_text.isNotNull(), F.substring(listed, F.lit(2), F.length(listed) - 2))
    return df.withColumn(name, F.concat(F.lit("{"), member, F.lit(":"), F.col(f"`{payload}`"), F.lit("}")))


def distinct_rows(df: DataFrame) -> DataFrame:
    """One of each group of rows that agree in every column, nested and variant ones included.

    Rows are told apart by a digest of all their values as JSON text, in which NULL is written out
    and binary values are in base64. Each partition drops its own copies before the shuffle, so a
    row that occurs very often is sent once per partition.
    """
    whole = F.to_json(F.struct(*(F.col("`" + name.replace("`", "``") + "`") for name in df.columns)), {"ignoreNullFields": "false"})
    return df.withColumn(_DIGEST, F.sha2(whole, 256)).dropDuplicates([_DIGEST]).drop(_DIGEST)


def preview_rows(df: DataFrame, order: Sequence[Column], rows: int = 5) -> DataFrame:
    """The first rows in a total order, as a frame."""
    return df.orderBy(*order).limit(rows)
