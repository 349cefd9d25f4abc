"""Write message envelopes."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def kafka_rows(messages: DataFrame) -> DataFrame:
    """Envelopes in the shape of the Kafka sink: body bytes as value, attributes as headers."""
    headers = F.transform(
        F.map_entries("attributes"),
        lambda entry: F.struct(entry["key"].alias("key"), F.encode(entry["value"], "UTF-8").alias("value")),
    )
    return messages.select(F.unbase64("data").alias("value"), headers.alias("headers"))


def publish(
    messages: DataFrame,
    fmt: str = "json",
    path: str | None = None,
    options: Mapping[str, str] | None = None,
) -> None:
    """Append envelopes to JSON lines, or to another sink such as ``kafka`` where its jar is
    on the cluster."""
    rows = kafka_rows(messages) if fmt == "kafka" else messages
    rows.write.format(fmt).mode("append").options(**(options or {})).save(path)
