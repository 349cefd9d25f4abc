"""File and document ingests."""

from __future__ import annotations

from pyspark.sql import SparkSession

from foldlog.sinks.loads import append_load, replace_load
from foldlog.sources.csv import read_csv
from foldlog.sources.documents import action_records, read_documents, structured_actions
from foldlog.sources.files import list_files, literal_path, newest_file, select_files


def ingest_csv(
    spark: SparkSession,
    folder: str,
    name_contains: str,
    table: str,
    fmt: str = "parquet",
    path: str | None = None,
) -> str | None:
    """Append the newest matching CSV of ``folder`` to ``table``.

    Returns the file taken, or None, with nothing loaded, when no file matches.
    """
    matching = select_files(list_files(spark, folder), folder, name_contains)
    chosen = newest_file(matching).first()
    if chosen is None:
        return None
    append_load(read_csv(spark, literal_path(chosen["id"])), table, fmt, path)
    return chosen["id"]


def snapshot_actions(
    spark: SparkSession,
    export: str,
    table: str,
    replace: bool = False,
    fmt: str = "parquet",
    path: str | None = None,
    structured: bool = False,
) -> None:
    """Load id and corrective actions of every exported document; each run appends a full copy
    unless ``replace`` is set. The actions are JSON text, or a variant where ``structured``."""
    records = (structured_actions if structured else action_records)(read_documents(spark, export))
    (replace_load if replace else append_load)(records, table, fmt, path)
