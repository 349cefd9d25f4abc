"""CSV files with a header row and inferred column types."""

from __future__ import annotations

from collections import Counter
from collections.abc import Sequence
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foldlog.functions.cells import FALSE_TOKENS, INTEGER, NUMBER, TRUE_TOKENS, null_if_token
from foldlog.sources.files import literal_path

_RECORD = "__record"


def quoted_newlines(spark: SparkSession, path: str) -> dict[str, bool]:
    """For each file that is not empty, whether some line has an odd number of quotes, so that a
    record may span lines."""
    value = F.col("value")
    quotes = F.length(value) - F.length(F.replace(value, F.lit('"'), F.lit("")))
    found = (
        spark.read.text(path)
        .select(F.col("_metadata.file_path").alias("file"), (quotes % 2 == 1).alias("odd"))
        .groupBy("file")
        .agg(F.bool_or("odd").alias("odd"))
    )
    return {unquote(r["file"]): r["odd"] for r in found.collect()}


def header_names(cells: Sequence[str | None]) -> list[str]:
    """Column names from the cells of a header: a blank one is named by its place, a repeated one
    gets the first free number."""
    names = [cell if cell else f"Unnamed: {k}" for k, cell in enumerate(cells)]
    taken, seen, out = set(names), Counter(), []
    for name in names:
        new = name
        if seen[name]:
            number = seen[name]
            while f"{name}.{number}" in taken:
                number += 1
            new = f"{name}.{number}"
            taken.add(new)
        seen[name] += 1
        out.append(new)
    return out


def read_csv(spark: SparkSession, path: str, multi_line: bool | None = None) -> DataFrame:
    """Read a CSV, or a folder of CSVs with one header: missing-value texts become NULL, and columns
    that hold only integers, numbers or truth values take that type. A record with more fields than
    the header is an error, as is a CSV without a header.

    A file without quoted line breaks is read in splits, one with them by one task. By default one
    pass over the lines finds out which is which; ``multi_line`` says it for all files. The first
    file by name gives the columns their names.
    """
    if multi_line is None:
        files = quoted_newlines(spark, path)
    else:
        files = {unquote(file): multi_line for file in spark.read.text(path).inputFiles()}
    if not files:
        raise ValueError(f"no header in {path}")
    first = min(files)
    header = _reader(spark, files[first], header=False).csv(literal_path(first)).first()
    if header is None:
        raise ValueError(f"no header in {path}")
    names = header_names([cell and cell.removeprefix("\ufeff") for cell in header])
    parts = []
    for spans in sorted(set(files.values())):
        own = [literal_path(file) for file, odd in files.items() if odd == spans]
        parts.append(_read_cells(spark, path if len(own) == len(files) else own, spans, len(names)))
    cells = reduce(DataFrame.unionByName, parts)
    return _with_types(cells.select(*(null_if_token(F.col(c)).alias(c) for c in cells.columns))).toDF(*names)


def _reader(spark: SparkSession, multi_line: bool, header: bool):
    return spark.read.options(header=header, multiLine=multi_line, quote='"', escape='"')


def _read_cells(spark: SparkSession, paths: str | list[str], multi_line: bool, width: int) -> DataFrame:
    """The cells as text, in columns c0, c1 and so on."""
    names = [f"c{k}" for k in range(width)]
    fields = [T.StructField(name, T.StringType()) for name in [*names, _RECORD]]
    reader = _reader(spark, multi_line, header=True).option("columnNameOfCorruptRecord", _RECORD)
    cells = reader.schema(T.StructType(fields)).csv(paths)
    # Spark keeps the whole record here when its length differs from the header's.
    unquoted = F.regexp_replace(_RECORD, '"(?:[^"]|"")*+"', "")
    commas = F.length(unquoted) - F.length(F.replace(unquoted, F.lit(","), F.lit("")))
    too_long = F.col(_RECORD).isNotNull() & (commas >= width)
    # The first cell is named too, as Spark refuses to read the record column on its own.
    first = F.coalesce(F.col(names[0]), F.lit(""))
    refused = F.raise_error(F.concat(F.lit("too many fields after "), first, F.lit(": "), F.col(_RECORD)))
    return cells.filter(F.when(too_long, refused.cast("boolean")).otherwise(F.lit(True))).select(*names)


def _with_types(cells: DataFrame) -> DataFrame:
    """Decide each column's type from all of its cells, in one aggregation."""
    names = cells.columns
    counts = []
    for i, name in enumerate(names):
        cell = F.col(name)
        integer = cell.rlike(INTEGER)
        fits = cell.try_cast("bigint").isNotNull()
        counts += [
            F.count(cell).alias(f"all{i}"),
            F.count_if(integer & fits).alias(f"integer{i}"),
            F.count_if(integer & ~fits).alias(f"wide{i}"),
            F.count_if(cell.rlike(NUMBER)).alias(f"number{i}"),
            F.count_if(cell.isin(*TRUE_TOKENS, *FALSE_TOKENS)).alias(f"truth{i}"),
        ]
    seen = cells.agg(*counts).first()

    def typed(i: int, name: str) -> Column:
        cell, rows = F.col(name), seen[f"all{i}"]
        if rows and seen[f"integer{i}"] == rows:
            cell = cell.try_cast("bigint")
        elif seen[f"number{i}"] == rows and not seen[f"wide{i}"]:
            cell = cell.try_cast("double")
        elif seen[f"truth{i}"] == rows:
            cell = cell.isin(*TRUE_TOKENS)
        return cell.alias(name)

    return cells.select(*(typed(i, name) for i, name in enumerate(names)))
