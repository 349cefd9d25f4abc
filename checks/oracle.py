"""The same results in DuckDB SQL."""

from __future__ import annotations

from checks.inputs import PAYLOAD_SQL

_SECONDS = "CAST(floor(epoch(ts)) AS BIGINT)"
_PAYLOAD = PAYLOAD_SQL.format(seconds=_SECONDS)
_EVENTS = f"""SELECT CAST(user_id AS VARCHAR) AS document_id,
    event_type = 'error' AND value > 150 AS deleted, ts, event_id, {_PAYLOAD} AS data FROM events"""


def _text(path: str) -> str:
    return (
        f"CASE WHEN json_type(data, '{path}') IS NULL THEN '' "
        f"ELSE json_extract_string(data, '{path}') END"
    )


def _object(path: str) -> str:
    return (
        f"CASE WHEN json_type(data, '{path}') = 'OBJECT' "
        f"THEN json_extract_string(data, '{path}') ELSE '' END"
    )


# Top-level payload fields.
_TOP = (
    "workOrder",
    "id",
    "eventType",
    "state",
    "workShop",
    "miningOperation",
    "packageNumber",
    "question1",
    "enventDetail",
    "component",
    "partNumber",
    "generalImages",
    "correctiveActions",
)
_PATHS = {name: f"$.{name}" for name in _TOP} | {
    "observation": "$.analysis.observation",
    "process": "$.analysis.process",
    "bahia": "$.analysis.bahia",
    "basicCause": "$.analysis.basicCause",
    "responsable": "$.analysis.responsable",
    "causeFailure": "$.analysis.causeFailure",
    "processAt": "$.processAt._seconds",
    "finalizedAt": "$.finalizedAt._seconds",
    "tracingAt": "$.tracingAt._seconds",
    "createdAt": "$.createdAt._seconds",
    "createdBy_email": "$.createdBy.email",
    "reportingWorkshop": "$.reportingWorkshop.workshopName",
    "specialist": "$.specialist.name",
}
_FIELDS = ",\n  ".join(f"{_text(path)} AS \"{name}\"" for name, path in _PATHS.items())
_WORKSHOP = _object("$.analysis.responsibleWorkshop.workshopName")
_FLAT = f"{_FIELDS},\n  {_WORKSHOP} AS \"responsibleWorkshop\""

_DAY = "%d/%m/%Y %H:%M:%S"


def _moment(field: str, filled: bool) -> str:
    seconds = f"coalesce({field}, '0')" if filled else field
    return f"strftime(make_timestamp(TRY_CAST({seconds} AS BIGINT) * 1000000), '{_DAY}')"


_LOCAL = """strftime(ts, '%Y-%m-%d %H:%M:%S') ||
  CASE WHEN microsecond(ts) % 1000000 = 0 THEN '' ELSE strftime(ts, '.%f') END"""
_ISO = f"{_LOCAL} || '+00:00'"

_SHEET = """SELECT CAST(s_suppkey AS VARCHAR) AS id, 'state ' || s_nationkey AS estado_final,
  '' AS "Fecha_creacion",
  printf('%02d/%02d/2024', s_nationkey + 1, s_nationkey % 12 + 1) AS "Fecha_fin",
  'state ' || s_nationkey AS estado, CAST(s_suppkey AS VARCHAR) AS workorder,
  s_name AS "Taller", s_nationkey || '.5' AS "NumParte",
  '"a", ' || s_nationkey AS "Especialista",
  'line' || chr(10) || 'break ' || s_nationkey AS "DetalleEvento", '0' AS "CausaBasica",
  '-0.' || rtrim('5' || s_nationkey, '0') AS "Responsable",
  s_name AS "TallerReporta", s_nationkey || '_0' AS component,
  CAST(s_suppkey AS VARCHAR) AS "responsibleWorkshop", 'SNC AFA' AS "TipoEvento"
FROM supplier"""

_REPORT = f"""WITH log AS ({_EVENTS}),
live AS (
  SELECT *, row_number() OVER (ORDER BY document_id NULLS FIRST, data NULLS FIRST,
    ts NULLS FIRST, event_id) AS indice
  FROM log WHERE document_id NOT IN (SELECT document_id FROM log WHERE deleted)
),
flat AS (SELECT ts, indice, {_FLAT} FROM live),
latest AS (
  SELECT * FROM flat WHERE id IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY id ORDER BY ts DESC NULLS LAST, indice) = 1
)
SELECT id, "eventType" AS "TipoEvento", state AS estado_final, {_ISO} AS "Ultima_mod",
  {_moment('"createdAt"', False)} AS "Fecha_creacion",
  {_moment('"finalizedAt"', True)} AS "Fecha_fin",
  {_moment('"tracingAt"', True)} AS fecha_seguimiento,
  CAST(indice AS VARCHAR) AS indice, state AS estado, "workOrder" AS workorder,
  "workShop" AS "Taller", "partNumber" AS "NumParte", "generalImages" AS "Imagen",
  "miningOperation" AS "OperacionMin", specialist AS "Especialista",
  "enventDetail" AS "DetalleEvento", observation AS "Observacion", process AS "Proceso",
  bahia AS "Bahia", "basicCause" AS "CausaBasica", responsable AS "Responsable",
  "causeFailure" AS "CausaFalla", "reportingWorkshop" AS "TallerReporta",
  "createdBy_email" AS email_registro, "correctiveActions" AS "AccionCorrectiva", component,
  {_moment('"processAt"', True)} AS proceso_inicio, question1,
  "packageNumber" AS plaqueteo, "responsibleWorkshop"
FROM latest UNION ALL BY NAME ({_SHEET})"""

ORACLE = {
    "action_elements": """SELECT 'c' || c_custkey AS id, CAST(pos AS INTEGER) AS pos, key, corrective, created_at, closed_at
        FROM (
          SELECT c_custkey, pos, NULL AS key,
            CASE pos WHEN 0 THEN 'fix ' || c_name END AS corrective,
            CASE pos WHEN 0 THEN CAST(c_nationkey AS VARCHAR) WHEN 1 THEN '' END AS created_at,
            CASE pos WHEN 0 THEN '' WHEN 1 THEN '0.5' END AS closed_at
          FROM customer, (SELECT unnest([0, 1, 2]) AS pos) WHERE c_custkey % 4 = 0
          UNION ALL
          SELECT c_custkey, pos, CASE pos WHEN 0 THEN 'first' ELSE 'last' END,
            CASE pos WHEN 0 THEN 'one' END, CASE pos WHEN 0 THEN '' END, CASE pos WHEN 0 THEN '' END
          FROM customer, (SELECT unnest([0, 1]) AS pos) WHERE c_custkey % 4 = 1
          UNION ALL
          SELECT c_custkey, NULL, NULL, NULL, NULL, NULL FROM customer WHERE c_custkey % 4 > 1)""",
    "action_records": """SELECT 'd' || vec_id AS id, CASE WHEN label % 2 = 0 THEN
        '[' || array_to_string(list_transform(embedding,
          lambda x: CAST(floor(CAST(x AS FLOAT) * CAST(1000 AS FLOAT)) AS BIGINT)), ',') || ']'
        ELSE '' END AS "correctiveActions" FROM embeddings""",
    "append_load": "SELECT * FROM customer UNION ALL SELECT * FROM customer",
    "audit_row": """SELECT DISTINCT CAST(o_orderdate AS DATE) AS id_date,
        CAST(36 AS BIGINT) AS uuid_length, true AS stamped FROM orders""",
    "audit_insert": """SELECT DISTINCT CAST(o_orderdate AS DATE) AS id_date,
        CAST(36 AS BIGINT) AS uuid_length, true AS stamped FROM orders WHERE o_orderstatus = 'F'""",
    "csv_job": """SELECT CAST(n_nationkey AS BIGINT) AS n_nationkey,
        n_name || chr(10) || 'of region' AS "Unnamed: 1", CAST(n_regionkey AS BIGINT) AS "n_nationkey.1",
        n_nationkey * CAST(0.5 AS DOUBLE) AS half FROM nation, range(2)""",
    "distinct_report": """SELECT DISTINCT user_id, event_type, json_extract_string(props, '$.k') AS k FROM events""",
    "file_listing": """SELECT '/region=' || n_regionkey || CASE WHEN name = 'trash' THEN '/Trash' ELSE '' END AS place,
        kind AS mime_type, name = 'trash' AS trashed, name = 'wanted' AND n_regionkey = 1 AS chosen
        FROM (SELECT DISTINCT n_regionkey FROM nation), (VALUES ('wanted', 'text/csv'),
          ('json', 'application/json'), ('text', 'text/plain'), ('trash', 'text/csv')) AS v(name, kind)""",
    "number_text": """SELECT event_id, '1234567890123456789012345678901234567890' || lpad(CAST(event_id AS VARCHAR), 7, '0') AS id,
        event_id || '.5' AS half, event_id || '.0' AS whole, event_id % 9 + 1 || 'e+20' AS large,
        event_id % 9 + 1 || 'e-07' AS small, CASE WHEN event_id % 2 = 0 THEN 'True' ELSE 'False' END AS flag,
        CAST(value AS VARCHAR) AS value, event_id || '.0' AS quoted FROM events""",
    "report_load": _REPORT,
    "snapshot_load": """SELECT 'd' || vec_id AS id, CASE WHEN label % 2 = 0 THEN
        '[' || array_to_string(list_transform(embedding,
          lambda x: CAST(floor(CAST(x AS FLOAT) * CAST(1000 AS FLOAT)) AS BIGINT)), ',') || ']'
        ELSE '' END AS "correctiveActions" FROM embeddings, range(2)""",
    "sql_source": """SELECT o_custkey, count(*) AS orders, CAST(sum(l_quantity) AS DOUBLE) AS quantity
        FROM orders JOIN lineitem ON o_orderkey = l_orderkey
        WHERE l_returnflag = 'R' AND o_totalprice > 1000 GROUP BY o_custkey""",
    "csv_ingest": """SELECT c_custkey, 'the "' || c_name || '", ltd' AS c_name,
        CAST(nullif(c_nationkey, 7) AS BIGINT) AS c_nationkey, c_acctbal,
        CASE WHEN c_mktsegment NOT IN ('FURNITURE', 'MACHINERY') THEN c_mktsegment END AS c_mktsegment,
        c_acctbal < 0 AS in_debt FROM customer""",
    "deleted_keys": "SELECT DISTINCT l_orderkey FROM lineitem WHERE l_returnflag = 'R'",
    "epoch_to_text": f"""SELECT event_id,
        CASE WHEN event_id % 5 <> 0 THEN strftime(ts, '{_DAY}') END AS moment FROM events""",
    "file_selection": """SELECT page_id AS id, url AS name FROM pages
        WHERE url LIKE 'https:%' AND url LIKE '%example.org%' AND url NOT LIKE '%#%'
          AND page_id % 10 <> 0
        ORDER BY page_id % 13 DESC, url DESC, page_id DESC LIMIT 1""",
    "flatten_nested": """SELECT o_orderkey, c_name AS name, CAST(c_nationkey AS VARCHAR) AS nation,
        '' AS scalar_parent, '' AS absent_parent,
        '{"key":' || c_nationkey || ',"segment":"' || c_mktsegment || '"}' AS home_object,
        '' AS segment_object
        FROM orders JOIN customer ON o_custkey = c_custkey""",
    "flatten_payload": f"""SELECT event_id, data, json_extract_string(props, '$.k') AS props_k,
        '' AS props_missing, {_FLAT}
        FROM (SELECT event_id, props, {_PAYLOAD} AS data FROM events)""",
    "global_ordinal": """SELECT *, CAST(row_number() OVER
        (ORDER BY o_custkey NULLS FIRST, o_orderdate NULLS FIRST, o_orderkey) AS BIGINT) AS indice
        FROM orders""",
    "keyed_payload": f"""WITH log AS ({_EVENTS})
        SELECT event_id, '{{"' || row_number() OVER (ORDER BY document_id NULLS FIRST, event_id)
          || '":' || data || '}}' AS keyed FROM log""",
    "without_brackets": """SELECT event_id, '"' || event_type || '","' || user_id || '","a1"' AS actions FROM events""",
    "latest_live": """SELECT * FROM orders o WHERE NOT EXISTS (SELECT 1 FROM orders d
          WHERE d.o_custkey = o.o_custkey AND d.o_orderpriority = '1-URGENT')
        QUALIFY row_number() OVER
          (PARTITION BY o_custkey ORDER BY o_orderdate DESC NULLS LAST, o_orderkey) = 1""",
    "latest_per_key": """SELECT * FROM events QUALIFY row_number() OVER
        (PARTITION BY user_id ORDER BY ts DESC NULLS LAST, event_id) = 1""",
    "live_rows": """SELECT * FROM lineitem l WHERE NOT EXISTS (SELECT 1 FROM lineitem d
        WHERE d.l_orderkey = l.l_orderkey AND d.l_returnflag = 'R')""",
    "message_envelope": """SELECT to_base64(encode(CAST(to_json(
          {'conv_id': conv_id, 'turn': turn, 'text': text}) AS VARCHAR))) AS data,
        role AS role_attribute, CAST(turn AS VARCHAR) AS turn_attribute, 'turn' AS kind_attribute
        FROM conversations""",
    "null_to_default": """SELECT c_custkey, coalesce(nullif(c_mktsegment, 'FURNITURE'), '0') AS segment,
        coalesce(nullif(c_nationkey, 7), 0) AS nation, nullif(c_nationkey, 8) AS untouched
        FROM customer""",
    "preview_rows": """SELECT * FROM orders
        ORDER BY o_orderdate DESC NULLS LAST, o_orderkey LIMIT 5""",
    "project_rename": """SELECT o_orderkey AS id, o_orderstatus AS final_state,
        o_orderdate AS changed, o_orderstatus AS state FROM orders""",
    "quality_report": _REPORT,
    "register_rows": _SHEET,
    "replace_load": "SELECT * REPLACE (upper(c_name) AS c_name) FROM customer",
    "running_count": """SELECT *, CAST(row_number() OVER
        (PARTITION BY user_id ORDER BY ts DESC NULLS LAST, event_id) AS BIGINT) AS running_count
        FROM events""",
    "stringify_all": f"""SELECT CAST(event_id AS VARCHAR) AS event_id, {_LOCAL} AS ts, {_ISO} AS at, event_type,
        CAST(value AS VARCHAR) AS value, CASE WHEN value > 100 THEN 'True' ELSE 'False' END AS large,
        '{{"user_id":' || user_id || ',"event_type":"' || event_type || '"}}' AS nested FROM events""",
    "union_fill": """SELECT c_custkey AS id, c_name AS name, c_mktsegment AS segment, NULL AS kind
        FROM customer UNION ALL
        SELECT s_suppkey, s_name, NULL, 'supplier' FROM supplier""",
}
