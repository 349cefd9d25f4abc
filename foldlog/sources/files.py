"""List the files of a folder, and choose from a listing."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# MIME types by file name extension.
MIME_TYPES = {
    "csv": "text/csv",
    "tsv": "text/tab-separated-values",
    "txt": "text/plain",
    "json": "application/json",
    "jsonl": "application/jsonl",
    "xml": "application/xml",
    "html": "text/html",
    "pdf": "application/pdf",
    "zip": "application/zip",
    "gz": "application/gzip",
    "xls": "application/vnd.ms-excel",
    "xlsx": "application/vnd.openxmlformats-officedocument.spreadsheetml.sheet",
    "parquet": "application/vnd.apache.parquet",
}
OTHER_TYPE = "application/octet-stream"


def literal_path(path: str) -> str:
    """A path that readers, which take paths for patterns, find as it is."""
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", path)


def _qualified(spark: SparkSession, folder: str) -> str:
    """The folder as the reader writes paths: with scheme, absolute, without a closing slash."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    return path.getFileSystem(conf).makeQualified(path).toString().rstrip("/")


def list_files(spark: SparkSession, folder: str, trash: Sequence[str] = ("Trash",)) -> DataFrame:
    """Files in ``folder`` and the folders below it: id (path), name, parent, mime_type, trashed,
    modified, bytes.

    ``parent`` begins with ``folder`` as it is given. The type follows from the last extension of
    the name. A file is trashed if a folder below ``folder`` that holds it is named in ``trash``.
    File contents are not read. Names that begin with a dot or an underscore are not listed.
    """
    root = _qualified(spark, folder)
    # Without the lookup folders named like a=1 would be read as partitions.
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(literal_path(folder))
    inside = F.substring("path", len(root) + 1, 1 << 30)
    below = F.regexp_extract(inside, "^(.*)/[^/]*$", 1)
    name = F.regexp_extract(inside, "[^/]*$", 0)
    types = F.create_map(*(F.lit(x) for pair in MIME_TYPES.items() for x in pair))
    extension = F.lower(F.regexp_extract(name, r"\.([^.]*)$", 1))
    return found.select(
        F.col("path").alias("id"),
        name.alias("name"),
        F.concat(F.lit(folder.rstrip("/")), below).alias("parent"),
        F.coalesce(F.try_element_at(types, extension), F.lit(OTHER_TYPE)).alias("mime_type"),
        F.arrays_overlap(F.split(below, "/"), F.array(*map(F.lit, trash))).alias("trashed"),
        F.col("modificationTime").alias("modified"),
        F.col("length").alias("bytes"),
    )


def select_files(
    listing: DataFrame, parent: str, name_contains: str, mime_type: str | Sequence[str] = "text/csv"
) -> DataFrame:
    """Entries of one folder, by part of the name and MIME type, that are not in the trash."""
    types = [mime_type] if isinstance(mime_type, str) else list(mime_type)
    return listing.filter(
        (F.col("parent") == parent.rstrip("/"))
        & F.col("name").contains(name_contains)
        & F.col("mime_type").isin(types)
        & ~F.col("trashed")
    )


def newest_file(listing: DataFrame) -> DataFrame:
    """The entry modified last; equal times are settled by name, then id. Empty when none."""
    return listing.orderBy(F.desc("modified"), F.desc("name"), F.desc("id")).limit(1)
