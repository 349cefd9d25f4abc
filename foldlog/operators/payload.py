"""Widen a frame with the fields of its JSON payload."""

from __future__ import annotations

from collections.abc import Collection, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foldlog.functions.payload import (
    member_text,
    members,
    object_text,
    only_element,
    parse_listed,
    written_member,
)

# Payload fields of a quality event, as column and path.
PAYLOAD_FIELDS = {
    "workOrder": "workOrder",
    "responsibleWorkshop": "analysis.responsibleWorkshop.workshopName",
    "id": "id",
    "eventType": "eventType",
    "state": "state",
    "workShop": "workShop",
    "miningOperation": "miningOperation",
    "packageNumber": "packageNumber",
    "question1": "question1",
    "enventDetail": "enventDetail",
    "component": "component",
    "partNumber": "partNumber",
    "generalImages": "generalImages",
    "correctiveActions": "correctiveActions",
    "observation": "analysis.observation",
    "process": "analysis.process",
    "bahia": "analysis.bahia",
    "basicCause": "analysis.basicCause",
    "responsable": "analysis.responsable",
    "causeFailure": "analysis.causeFailure",
    "processAt": "processAt._seconds",
    "finalizedAt": "finalizedAt._seconds",
    "tracingAt": "tracingAt._seconds",
    "createdBy_email": "createdBy.email",
    "reportingWorkshop": "reportingWorkshop.workshopName",
    "specialist": "specialist.name",
    "createdAt": "createdAt._seconds",
}

_DOCUMENT, _LISTED = "__document", "__listed"


def parse_payload(
    df: DataFrame, column: str = "data", mode: str = "fail", name: str = _DOCUMENT
) -> DataFrame:
    """Add the JSON object in a text column as a variant column.

    ``mode="fail"`` raises on text that is NULL, malformed or not one object; ``mode="null"``
    gives NULL for it.
    """
    return (
        df.withColumn(_LISTED, parse_listed(F.col(column), mode))
        .withColumn(name, only_element(F.col(_LISTED), mode))
        .drop(_LISTED)
    )


def document_fields(
    df: DataFrame,
    fields: Mapping[str, str],
    document: str = _DOCUMENT,
    objects: Collection[str] = (),
    source: str | None = None,
) -> DataFrame:
    """Add text columns read from a variant column, which is dropped.

    ``fields`` gives a dotted path per column. An absent value reads as ``''``, a JSON null as
    NULL, lists and objects as JSON text; a parent that is missing or not an object counts as
    absent. Columns named in ``objects`` keep a value only where it is an object, and are ``''``
    elsewhere. ``source`` names the column with the JSON text itself, from which whole numbers are
    taken that a variant cannot hold. A new column may not bear the name of one that stays. The
    members of one object are taken in one step, level by level: looking each
    path up from the root costs several times as much.
    """

    def quoted(name: str) -> str:
        return "`" + name.replace("`", "``") + "`"

    def holder(parent: tuple[str, ...]) -> str:
        """Column that holds the members of the object at ``parent``."""
        return quoted(".".join(("__members", *parent)))

    wanted: dict[tuple[str, ...], dict[str, None]] = {}
    for path in fields.values():
        parts = tuple(path.split("."))
        for depth, member in enumerate(parts):
            wanted.setdefault(parts[:depth], {})[member] = None

    def value(parts: tuple[str, ...]) -> str:
        if not parts:
            return quoted(document)
        return f"{holder(parts[:-1])}.{quoted(parts[-1])}"

    staying = [name for name in df.columns if name != document]
    taken = {name.lower() for name in staying} & {name.lower() for name in fields}
    if taken:
        raise ValueError(f"columns {sorted(taken)} are there already")
    kept = [quoted(name) for name in staying]
    for depth in range(1 + max(map(len, wanted))):
        level = {parent: names for parent, names in wanted.items() if len(parent) == depth}
        df = df.selectExpr(
            "*", *(f"{members(value(parent), names)} AS {holder(parent)}" for parent, names in level.items())
        )

    def plain(name: str) -> str:
        """Column that holds the member's cast to text, which is looked at several times."""
        return quoted(f"__text.{name}")

    scalars = {name: tuple(path.split(".")) for name, path in fields.items() if name not in objects}
    df = df.selectExpr("*", *(f"cast({value(parts)} AS string) AS {plain(name)}" for name, parts in scalars.items()))

    def text(name: str, path: str) -> str:
        parts = tuple(path.split("."))
        if name in objects:
            found = object_text(value(parts), holder(()))
        else:
            written = None if source is None else written_member(quoted(source), parts)
            found = member_text(value(parts), plain(name), holder(()), written)
        return f"{found} AS {quoted(name)}"

    return df.selectExpr(*kept, *(text(name, path) for name, path in fields.items()))


def flatten_payload(
    df: DataFrame, column: str = "data", mode: str = "fail", leaf: str = "object"
) -> DataFrame:
    """Add the 27 payload fields, all text, next to the other columns of ``df``.

    ``leaf="object"`` keeps the responsible workshop only where it is an object; ``leaf="any"``
    keeps every value. The document is parsed once per row.
    """
    if leaf not in ("object", "any"):
        raise ValueError(f"leaf must be 'object' or 'any', not {leaf!r}")
    objects = ("responsibleWorkshop",) if leaf == "object" else ()
    return document_fields(parse_payload(df, column, mode), PAYLOAD_FIELDS, objects=objects, source=column)
