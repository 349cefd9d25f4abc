"""Message envelopes from rows."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foldlog.functions.messages import attribute_map, encoded


def message_envelope(
    df: DataFrame, body: Column, attributes: Mapping[str, Column | str] | None = None
) -> DataFrame:
    """One message per row: base64 ``data`` and string ``attributes``, NULL when none are given."""
    extras = attribute_map(dict(attributes)) if attributes else F.lit(None).cast("map<string,string>")
    return df.select(encoded(body).alias("data"), extras.alias("attributes"))
