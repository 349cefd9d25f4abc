"""A document collection exported as JSON lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foldlog.operators.payload import document_fields, parse_payload

_TEXT = "__text"


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """A variant column, ``document``, and its JSON text, per exported document; blank lines are
    left out, and a line that is not one JSON object is an error."""
    lines = spark.read.text(path).where(F.trim("value") != "").withColumnRenamed("value", _TEXT)
    return parse_payload(lines, _TEXT, name="document")


def _with_id(documents: DataFrame, *columns: str) -> DataFrame:
    """The id as text beside some columns."""
    fields = {"id": "id", **{name: name for name in columns}}
    return document_fields(documents, fields, "document", source=_TEXT).drop(_TEXT)


def action_records(documents: DataFrame) -> DataFrame:
    """Document id and its corrective actions (JSON text); ``''`` where absent."""
    return _with_id(documents, "correctiveActions")


def structured_actions(documents: DataFrame) -> DataFrame:
    """Document id and its corrective actions as a variant: a JSON null is a variant, an absent
    member is NULL."""
    actions = F.variant_get("document", "$.correctiveActions", "variant")
    return _with_id(documents.withColumn("correctiveActions", actions)).select("id", "correctiveActions")


def action_elements(actions: DataFrame) -> DataFrame:
    """A row per element of a list of actions (``pos``, ``value``) or member of an object (with its
    ``key``); a single row of NULLs for any other value, none being dropped."""
    return actions.sparkSession.sql(
        """SELECT a.id, e.pos, e.key, e.value
           FROM {actions} a, LATERAL variant_explode_outer(a.correctiveActions) e""",
        actions=actions,
    )


def exploded_actions(actions: DataFrame) -> DataFrame:
    """The elements of ``action_elements`` with their fields as text columns: ``corrective``,
    ``created_at`` and ``closed_at``. A field that an object lacks is ``''``; all are NULL where the
    element is no object, or where there is none."""
    fields = {name: name for name in ("corrective", "created_at", "closed_at")}
    return document_fields(action_elements(actions), fields, "value")
