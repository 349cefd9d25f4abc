"""Current state of a change log, and the quality report built on it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foldlog.functions.times import epoch_to_text
from foldlog.operators.changelog import deleted_keys, latest_per_key, live_rows, require_unique
from foldlog.operators.ordinals import ascending, global_ordinal
from foldlog.operators.payload import document_fields, flatten_payload, parse_payload
from foldlog.operators.shape import (
    null_to_default,
    project_rename,
    stringify_all,
    union_fill,
    with_constant,
)
from foldlog.sinks.loads import replace_load
from foldlog.staging import staged_tables

# Report columns, as (source, report name), in report order.
REPORT_COLUMNS = (
    ("id", "id"),
    ("eventType", "TipoEvento"),
    ("state", "estado_final"),
    ("timestamp", "Ultima_mod"),
    ("creacion", "Fecha_creacion"),
    ("finalizacion", "Fecha_fin"),
    ("seguimiento", "fecha_seguimiento"),
    ("indice", "indice"),
    ("state", "estado"),
    ("workOrder", "workorder"),
    ("workShop", "Taller"),
    ("partNumber", "NumParte"),
    ("generalImages", "Imagen"),
    ("miningOperation", "OperacionMin"),
    ("specialist", "Especialista"),
    ("enventDetail", "DetalleEvento"),
    ("observation", "Observacion"),
    ("process", "Proceso"),
    ("bahia", "Bahia"),
    ("basicCause", "CausaBasica"),
    ("responsable", "Responsable"),
    ("causeFailure", "CausaFalla"),
    ("reportingWorkshop", "TallerReporta"),
    ("createdBy_email", "email_registro"),
    ("correctiveActions", "AccionCorrectiva"),
    ("component", "component"),
    ("proceso_inicio", "proceso_inicio"),
    ("question1", "question1"),
    ("packageNumber", "plaqueteo"),
    ("responsibleWorkshop", "responsibleWorkshop"),
)

# Columns of the second register, as (sheet header, report name), and its event type.
REGISTER_COLUMNS = (
    ("N° CASO PAT-AFA", "id"),
    ("ESTADO", "estado_final"),
    ("INICIO DESARMADO", "Fecha_creacion"),
    ("EMISION", "Fecha_fin"),
    ("ESTADO", "estado"),
    ("OT MAIN", "workorder"),
    ("TALLER", "Taller"),
    ("PN FALLA", "NumParte"),
    ("ANALISTA", "Especialista"),
    ("Modo de Falla", "DetalleEvento"),
    ("Causa", "CausaBasica"),
    ("CARGO TÉCNICO AFA", "Responsable"),
    ("TALLER", "TallerReporta"),
    ("COMPONENTE", "component"),
    ("AGRUPADOR", "responsibleWorkshop"),
)
REGISTER_EVENT = "SNC AFA"


def latest_live(
    log: DataFrame,
    key: str,
    newest_first: Sequence[Column],
    document: str = "document_id",
    deleted: Column | None = None,
) -> DataFrame:
    """Latest row per key among the documents that were never deleted."""
    live = live_rows(log, deleted_keys(log, document, deleted), document)
    return latest_per_key(live, key, newest_first)


def register_rows(sheet: DataFrame) -> DataFrame:
    """Register records under report names, with their constant event type."""
    return with_constant(project_rename(sheet, REGISTER_COLUMNS), "TipoEvento", REGISTER_EVENT)


def current_events(
    log: DataFrame, unique: Sequence[str], mode: str = "fail", leaf: str = "object"
) -> DataFrame:
    """Latest event per payload id, numbered among all live rows, under report names.

    ``unique`` names the log columns that tell all rows apart and settle ties between equal ones;
    a repeated or NULL value there is refused. The latest rows are found first, by an order that
    the ordinals follow, so ordinals are staged beside ``unique`` alone and joined to the rows that
    stay: no payload is staged. Only the id is read from every payload.
    """
    columns = ["document_id", "data", "timestamp"]
    live = live_rows(log, deleted_keys(log)).select(*dict.fromkeys([*columns, *unique]))
    order = [ascending(name) for name in columns]
    ordinals = global_ordinal(live, order, unique, finish=lambda rows: rows.drop(*set(columns) - set(unique)))
    require_unique(ordinals, unique)
    total = [*order, *(ascending(name) for name in unique)]
    newest_first = [F.desc_nulls_last("timestamp"), *(key.sorted(key.column()) for key in total)]
    named = document_fields(parse_payload(live, "data", mode), {"__read": "id"}, source="data")
    # A generator keeps the filter on the id from being moved below the parse, which it would repeat.
    named = named.withColumn("__id", F.explode(F.array("__read"))).drop("__read")
    latest = latest_per_key(named, "__id", newest_first).join(ordinals, list(unique))
    latest = latest.select("data", "timestamp", "indice")
    flat = flatten_payload(latest, "data", mode, leaf)
    dated = null_to_default(flat, {"finalizedAt": 0, "tracingAt": 0, "processAt": 0}).withColumns(
        {
            "creacion": epoch_to_text(F.col("createdAt")),
            "finalizacion": epoch_to_text(F.col("finalizedAt")),
            "proceso_inicio": epoch_to_text(F.col("processAt")),
            "seguimiento": epoch_to_text(F.col("tracingAt")),
        }
    )
    return stringify_all(project_rename(dated, REPORT_COLUMNS))


def quality_report(
    log: DataFrame,
    sheet: DataFrame,
    unique: Sequence[str],
    mode: str = "fail",
    leaf: str = "object",
) -> DataFrame:
    """Current events and register records in one frame of text columns."""
    events = current_events(log, unique, mode, leaf)
    return union_fill(events, stringify_all(register_rows(sheet)))


def refresh_quality_report(
    log: DataFrame,
    sheet: DataFrame,
    table: str,
    unique: Sequence[str],
    mode: str = "fail",
    leaf: str = "object",
    fmt: str = "parquet",
    path: str | None = None,
) -> None:
    """Build the report and make it the whole content of ``table``."""
    with staged_tables(log.sparkSession):
        replace_load(quality_report(log, sheet, unique, mode, leaf), table, fmt, path)
