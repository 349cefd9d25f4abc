"""Append, replace and insert into tables."""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foldlog.staging import drop_path


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _lossless(column: Column, source: T.DataType, target: T.DataType) -> Column:
    """Whether a value comes back from ``target`` as it was; NULL does."""
    back = column.try_cast(target).try_cast(source)
    return column.isNull() | F.coalesce(back == column, F.lit(False))


def _any_null(source: T.DataType) -> T.DataType:
    """The type as it is when every part of it may be NULL."""
    if isinstance(source, T.StructType):
        return T.StructType([T.StructField(f.name, _any_null(f.dataType)) for f in source])
    if isinstance(source, T.ArrayType):
        return T.ArrayType(_any_null(source.elementType))
    if isinstance(source, T.MapType):
        return T.MapType(_any_null(source.keyType), _any_null(source.valueType))
    return source


def fitted(df: DataFrame, fields: Sequence[T.StructField]) -> DataFrame:
    """The columns of ``df`` in the types of ``fields``, matched by position.

    Values decide, not types: whole numbers in a floating column fit a whole-number target. All
    columns whose type differs are checked in one aggregation: a value that does not come back
    the same from the target's type is refused. Columns of one type, or bound for text, are not
    read for that.
    """
    pairs = list(zip(df.columns, df.schema.fields, fields))
    differ = [
        (name, own, target)
        for name, own, target in pairs
        if _any_null(own.dataType) != _any_null(target.dataType) and not isinstance(own.dataType, T.NullType)
    ]
    checked = [(name, own, target) for name, own, target in differ if not isinstance(target.dataType, T.StringType)]
    if checked:
        refused = df.agg(
            *(
                F.count_if(~_lossless(F.col(_quoted(name)), own.dataType, target.dataType)).alias(f"c{k}")
                for k, (name, own, target) in enumerate(checked)
            )
        ).first()
        for k, (_, own, target) in enumerate(checked):
            if refused[k]:
                raise ValueError(
                    f"column {target.name!r} is {target.dataType.simpleString()}; {refused[k]} values "
                    f"of type {own.dataType.simpleString()} do not fit"
                )
    changed = {name: target.dataType for name, _, target in differ}
    return df.select(
        *(
            F.col(_quoted(name)).cast(changed[name]).alias(name) if name in changed else F.col(_quoted(name))
            for name in df.columns
        )
    )


def _create(df: DataFrame, table: str, fmt: str, path: str | None, partitions: Sequence[str] = ()) -> None:
    writer = df.write.format(fmt).mode("errorifexists")
    if path is not None:
        writer = writer.option("path", path)
    if partitions:
        writer = writer.partitionBy(*partitions)
    writer.saveAsTable(table)


def append_load(df: DataFrame, table: str, fmt: str = "parquet", path: str | None = None) -> None:
    """Add the rows to a table, which is created when missing. A second run adds them again.

    Columns are matched by name, and must be those of the table. Values that the table's types cannot hold without loss, such as
    fractions for whole numbers, are refused before anything is written.
    """
    if df.sparkSession.catalog.tableExists(table):
        known = {f.name.lower(): f for f in df.sparkSession.table(table).schema}
        if sorted(known) != sorted(name.lower() for name in df.columns):
            raise ValueError(f"{table} has the columns {sorted(known)}, not {df.columns}")
        ready = fitted(df, [known[name.lower()] for name in df.columns])
        # Inserts are by position, into whatever partitions and buckets the table has.
        ready.select(*(_quoted(f.name) for f in known.values())).write.insertInto(table)
    else:
        _create(df, table, fmt, path)


def insert_rows(source: DataFrame, table: str, columns: Sequence[str]) -> None:
    """Insert into the named columns of a table, matched by position. Values that the columns
    cannot hold without loss are refused."""
    spark = source.sparkSession
    known = {f.name.lower(): f for f in spark.table(table).schema}
    unknown = [name for name in columns if name.lower() not in known]
    if unknown or len(columns) != len(source.columns):
        raise ValueError(f"cannot insert {source.columns} into {list(columns)} of {table}")
    names = ", ".join(_quoted(name) for name in columns)
    spark.sql(
        f"INSERT INTO IDENTIFIER(:target) ({names}) SELECT * FROM {{source}}",
        args={"target": table},
        source=fitted(source, [known[name.lower()] for name in columns]),
    )


def _described(spark: SparkSession, table: str) -> dict[str, Any]:
    """Location, provider, partitioning and properties of a table in the session catalog."""
    text = spark.sql("DESCRIBE TABLE EXTENDED IDENTIFIER(:t) AS JSON", args={"t": table}).first()[0]
    return json.loads(text)


def _beside(table: str, suffix: str) -> str:
    """The name of another table in the same schema."""
    *schema, name = table.split(".")
    return ".".join([*schema, f"{name}__{suffix}"])


def _same_columns(df: DataFrame, spark: SparkSession, table: str) -> bool:
    """Whether the table has these columns, in any order, in types that need no cast."""
    kinds = lambda schema: {f.name: _any_null(f.dataType) for f in schema}
    return kinds(df.schema) == kinds(spark.table(table).schema)


def replace_load(df: DataFrame, table: str, fmt: str = "parquet", path: str | None = None) -> None:
    """Make the rows the whole content of a table, which is created when missing.

    The rows are written once, beside the old ones; then the table is made to hold them and the
    old files are dropped. Until that change the table holds the old rows, whatever fails, and
    after it the new ones. ``path`` is where a table begins; a replacement of a table that has a
    path lies beside it.

    Partitioning, buckets and properties are kept. With the same columns and no partitions the
    change is that of the table's location. Otherwise a new table takes the name of the old one,
    which gets it back if that fails; partition columns that are no longer there are left out.
    """
    spark = df.sparkSession
    if not spark.catalog.tableExists(table):
        _create(df, table, fmt, path)
        return
    old = _described(spark, table)
    same = _same_columns(df, spark, table)
    moves = same and not old.get("partition_columns")
    fresh = None
    if moves or old["type"] != "MANAGED":
        first = re.sub("-rows-[0-9a-f]{32}$", "", old["location"].rstrip("/"))
        fresh = f"{first}-rows-{uuid.uuid4().hex}"
    shadow = _beside(table, uuid.uuid4().hex)
    try:
        if same:
            _write_like(df, table, shadow, fresh)
        else:
            _write_new(df, shadow, fresh, old)
        if moves:
            spark.sql(f"ALTER TABLE {table} SET LOCATION {_text(fresh)}")
        else:
            _keep_properties(spark, shadow, old)
            _exchange(spark, table, shadow)
    except BaseException:
        # Nothing of the new rows is left, and the table is as it was.
        spark.sql("DROP TABLE IF EXISTS IDENTIFIER(:shadow)", args={"shadow": shadow})
        if fresh is not None:
            drop_path(spark, fresh)
        raise
    if moves:
        # Its location was given, so dropping this table leaves the files.
        spark.sql("DROP TABLE IDENTIFIER(:shadow)", args={"shadow": shadow})
    spark.catalog.refreshTable(table)
    if fresh is not None:
        drop_path(spark, old["location"])


def _write_like(df: DataFrame, table: str, shadow: str, location: str | None) -> None:
    """The rows in another table of the same make."""
    spark = df.sparkSession
    at = "" if location is None else f" LOCATION {_text(location)}"
    spark.sql(f"CREATE TABLE IDENTIFIER(:shadow) LIKE IDENTIFIER(:t){at}", args={"shadow": shadow, "t": table})
    _fill(df, shadow)


def _write_new(df: DataFrame, shadow: str, location: str | None, old: dict[str, Any]) -> None:
    """The rows in a new table, partitioned like the old one as far as the columns are there."""
    partitions = [name for name in old.get("partition_columns", []) if name in df.columns]
    _create(df.where(F.lit(False)), shadow, old["provider"], location, partitions)
    _fill(df, shadow)


def _fill(df: DataFrame, shadow: str) -> None:
    # Partitions that an insert adds have no location of their own, so they move with the table.
    names = [_quoted(name) for name in df.sparkSession.table(shadow).columns]
    df.select(*names).write.insertInto(shadow, overwrite=True)


def _keep_properties(spark: SparkSession, shadow: str, old: dict[str, Any]) -> None:
    pairs = ", ".join(f"{_text(key)} = {_text(value)}" for key, value in old.get("table_properties", {}).items())
    if pairs:
        spark.sql(f"ALTER TABLE {shadow} SET TBLPROPERTIES ({pairs})")


def _exchange(spark: SparkSession, table: str, shadow: str) -> None:
    """Give the name of a table to another one; the first is dropped once that is done."""
    aside = _beside(table, uuid.uuid4().hex)
    spark.sql(f"ALTER TABLE {table} RENAME TO {aside}")
    try:
        spark.sql(f"ALTER TABLE {shadow} RENAME TO {table}")
    except BaseException:
        spark.sql(f"ALTER TABLE {aside} RENAME TO {table}")
        raise
    spark.sql("DROP TABLE IDENTIFIER(:aside)", args={"aside": aside})


def _text(value: str) -> str:
    """A text literal."""
    escaped = value.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"
