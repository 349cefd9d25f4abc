"""The second register: a worksheet exported to CSV."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foldlog.functions.cells import sheet_value_text


def read_register(spark: SparkSession, path: str) -> DataFrame:
    """Records of the sheet as text, with numbers in plain form and missing cells as ``''``."""
    # A worksheet holds at most some million cells, so quoted line breaks are always allowed.
    sheet = spark.read.options(header=True, multiLine=True, quote='"', escape='"').csv(path)
    return sheet.select(*(sheet_value_text(F.col(f"`{name}`")).alias(name) for name in sheet.columns))
