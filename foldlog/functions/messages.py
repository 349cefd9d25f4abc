"""Message bodies: record to JSON text to base64."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def record_json(*fields: Column) -> Column:
    """One JSON object per row; NULL fields are written as ``null``."""
    return F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})


def encoded(text: Column) -> Column:
    """UTF-8 bytes of ``text`` in base64, on one line whatever line length Spark is set to."""
    return F.translate(F.base64(F.encode(text, "UTF-8")), "\r\n", "")


def attribute_map(attributes: dict[str, Column | str]) -> Column:
    """String-to-string map from names and values; plain strings are literals."""
    pairs: list[Column] = []
    for name, value in attributes.items():
        column = F.lit(value) if isinstance(value, str) else value.cast("string")
        pairs += [F.lit(name), column]
    return F.create_map(*pairs)
