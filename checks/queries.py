"""One query per operator, each over whole tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.inputs import SPARK_PAYLOAD, change_log, sheet_export, table
from foldlog.functions.messages import record_json
from foldlog.functions.times import epoch_to_text
from foldlog.operators import changelog, ordinals, shape
from foldlog.operators import payload as payload_ops
from foldlog.plans import audit, ingest, report
from foldlog.plans import messages as message_plan
from foldlog.sinks import loads
from foldlog.sinks import messages as message_sink
from foldlog.sources import csv as csv_source
from foldlog.sources import documents as document_source
from foldlog.sources import files
from foldlog.sources.tables import run_query
from foldlog.staging import new_path


def _new_table() -> str:
    return f"foldlog_{uuid.uuid4().hex}"


def deleted_keys(spark: SparkSession, folder: str) -> DataFrame:
    lines = table(spark, folder, "lineitem")
    return changelog.deleted_keys(lines, "l_orderkey", F.col("l_returnflag") == "R")


def live_rows(spark: SparkSession, folder: str) -> DataFrame:
    return changelog.live_rows(table(spark, folder, "lineitem"), deleted_keys(spark, folder), "l_orderkey")


def global_ordinal(spark: SparkSession, folder: str) -> DataFrame:
    order = [ordinals.ascending("o_custkey"), ordinals.ascending("o_orderdate")]
    return ordinals.global_ordinal(table(spark, folder, "orders"), order, ["o_orderkey"])


def running_count(spark: SparkSession, folder: str) -> DataFrame:
    order = [ordinals.descending("ts")]
    return ordinals.running_count(table(spark, folder, "events"), "user_id", order, ["event_id"])


def latest_per_key(spark: SparkSession, folder: str) -> DataFrame:
    newest_first = [F.desc_nulls_last("ts"), F.asc("event_id")]
    return changelog.latest_per_key(table(spark, folder, "events"), "user_id", newest_first)


def latest_live(spark: SparkSession, folder: str) -> DataFrame:
    newest_first = [F.desc_nulls_last("o_orderdate"), F.asc("o_orderkey")]
    urgent = F.col("o_orderpriority") == "1-URGENT"
    return report.latest_live(table(spark, folder, "orders"), "o_custkey", newest_first, "o_custkey", urgent)


def flatten_payload(spark: SparkSession, folder: str) -> DataFrame:
    events = table(spark, folder, "events").select(
        "event_id", "props", F.expr(SPARK_PAYLOAD).alias("data")
    )
    props = payload_ops.document_fields(
        payload_ops.parse_payload(events, "props"), {"props_k": "k", "props_missing": "missing"}
    )
    return payload_ops.flatten_payload(props.drop("props"))


def flatten_nested(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders")
    customers = table(spark, folder, "customer")
    nested = F.struct(
        F.struct(
            F.col("c_name").alias("name"),
            F.struct(F.col("c_nationkey").alias("key"), F.col("c_mktsegment").alias("segment")).alias("home"),
        ).alias("customer"),
        F.col("o_orderstatus").alias("status"),
    )
    documents = orders.join(customers, orders.o_custkey == customers.c_custkey).select(
        "o_orderkey", F.to_json(nested).alias("data")
    )
    fields = {
        "name": "customer.name",
        "nation": "customer.home.key",
        "scalar_parent": "status.name",
        "absent_parent": "absent.name",
        "home_object": "customer.home",
        "segment_object": "customer.home.segment",
    }
    return payload_ops.document_fields(
        payload_ops.parse_payload(documents), fields, objects=("home_object", "segment_object")
    ).drop("data")


def epoch_text(spark: SparkSession, folder: str) -> DataFrame:
    seconds = F.unix_seconds(F.col("ts").cast("timestamp"))
    as_text = F.when(F.col("event_id") % 5 == 0, F.lit("")).otherwise(seconds.cast("string"))
    return table(spark, folder, "events").select("event_id", epoch_to_text(as_text).alias("moment"))


def without_brackets(spark: SparkSession, folder: str) -> DataFrame:
    listed = F.to_json(F.array("event_type", F.col("user_id").cast("string"), F.lit("a[1]")))
    return shape.without_brackets(table(spark, folder, "events").select("event_id", listed.alias("actions")), "actions")


def keyed_payload(spark: SparkSession, folder: str) -> DataFrame:
    """Each payload under its ordinal in the log."""
    log = change_log(spark, folder).select("document_id", "event_id", "data")
    numbered = ordinals.global_ordinal(log, [ordinals.ascending("document_id")], ["event_id"])
    return shape.keyed_payload(numbered, "indice").select("event_id", "keyed")


def null_to_default(spark: SparkSession, folder: str) -> DataFrame:
    customers = table(spark, folder, "customer").select(
        "c_custkey",
        F.nullif("c_mktsegment", F.lit("FURNITURE")).alias("segment"),
        F.nullif("c_nationkey", F.lit(7)).alias("nation"),
        F.nullif("c_nationkey", F.lit(8)).alias("untouched"),
    )
    return shape.null_to_default(customers, {"segment": 0, "nation": 0})


def project_rename(spark: SparkSession, folder: str) -> DataFrame:
    pairs = [
        ("o_orderkey", "id"),
        ("o_orderstatus", "final_state"),
        ("o_orderdate", "changed"),
        ("o_orderstatus", "state"),
    ]
    return shape.project_rename(table(spark, folder, "orders"), pairs)


def register_rows(spark: SparkSession, folder: str) -> DataFrame:
    return report.register_rows(sheet_export(spark, folder))


def union_fill(spark: SparkSession, folder: str) -> DataFrame:
    customers = shape.project_rename(
        table(spark, folder, "customer"),
        [("c_custkey", "id"), ("c_name", "name"), ("c_mktsegment", "segment")],
    )
    suppliers = shape.project_rename(
        table(spark, folder, "supplier"), [("s_name", "name"), ("s_suppkey", "id")]
    )
    return shape.union_fill(customers, shape.with_constant(suppliers, "kind", "supplier"))


def stringify_all(spark: SparkSession, folder: str) -> DataFrame:
    events = table(spark, folder, "events")
    return shape.stringify_all(
        events.select(
            "event_id",
            "ts",
            F.col("ts").cast("timestamp").alias("at"),
            "event_type",
            "value",
            (F.col("value") > 100).alias("large"),
            F.struct("user_id", "event_type").alias("nested"),
        )
    )


def number_text(spark: SparkSession, folder: str) -> DataFrame:
    written = F.concat(
        F.lit('{"id":1234567890123456789012345678901234567890'),
        F.lpad(F.col("event_id").cast("string"), 7, "0"),
        F.format_string(
            ',"half":%d.50,"whole":%d.0,"large":%de20,"small":%de-7,"flag":%s,"value":',
            "event_id", "event_id", F.col("event_id") % 9 + 1, F.col("event_id") % 9 + 1, F.col("event_id") % 2 == 0,
        ),
        F.col("value").cast("string"),
        F.format_string(',"quoted":"%d.0"}', "event_id"),
    )
    events = table(spark, folder, "events").select("event_id", written.alias("data"))
    names = ("id", "half", "whole", "large", "small", "flag", "value", "quoted")
    parsed = payload_ops.parse_payload(events)
    return payload_ops.document_fields(parsed, {name: name for name in names}, source="data").drop("data")


def distinct_report(spark: SparkSession, folder: str) -> DataFrame:
    props = F.parse_json("props")
    events = table(spark, folder, "events").select("user_id", "event_type", props.alias("props"))
    return shape.distinct_rows(events).select(
        "user_id", "event_type", F.variant_get("props", "$.k", "string").alias("k")
    )


def preview_rows(spark: SparkSession, folder: str) -> DataFrame:
    order = [F.desc_nulls_last("o_orderdate"), F.asc("o_orderkey")]
    return shape.preview_rows(table(spark, folder, "orders"), order)


def quality_report(spark: SparkSession, folder: str) -> DataFrame:
    return report.quality_report(change_log(spark, folder), sheet_export(spark, folder), ["event_id"])


def report_load(spark: SparkSession, folder: str) -> DataFrame:
    name, path = _new_table(), new_path(spark, "table")
    for _ in range(2):
        report.refresh_quality_report(
            change_log(spark, folder), sheet_export(spark, folder), name, ["event_id"], path=path
        )
    return spark.table(name)


def sql_source(spark: SparkSession, folder: str) -> DataFrame:
    for name in ("orders", "lineitem"):
        table(spark, folder, name).createOrReplaceTempView(f"source_{name}")
    return run_query(
        spark,
        """SELECT o_custkey, count(*) AS orders, sum(l_quantity) AS quantity
           FROM IDENTIFIER(:orders) JOIN IDENTIFIER(:lines) ON o_orderkey = l_orderkey
           WHERE l_returnflag = :flag AND o_totalprice > :least GROUP BY o_custkey""",
        {"orders": "source_orders", "lines": "source_lineitem", "flag": "R", "least": 1000},
    )


def csv_ingest(spark: SparkSession, folder: str) -> DataFrame:
    path = new_path(spark, "csv")
    table(spark, folder, "customer").select(
        "c_custkey",
        F.concat(F.lit('the "'), "c_name", F.lit('", ltd')).alias("c_name"),
        F.when(F.col("c_nationkey") == 7, "n/a")
        .otherwise(F.col("c_nationkey").cast("string"))
        .alias("c_nationkey"),
        "c_acctbal",
        F.when(F.col("c_mktsegment") == "FURNITURE", "NA")
        .when(F.col("c_mktsegment") == "MACHINERY", "")
        .otherwise(F.col("c_mktsegment"))
        .alias("c_mktsegment"),
        F.when(F.col("c_acctbal") < 0, "True").otherwise("false").alias("in_debt"),
    ).write.options(header=True, escape='"').csv(path)
    name = _new_table()
    loads.append_load(csv_source.read_csv(spark, path), name, path=new_path(spark, "table"))
    return spark.table(name)


def csv_job(spark: SparkSession, folder: str) -> DataFrame:
    """The newest CSV of a folder, loaded twice, beside an older one, other types and folders. Its
    header has a repeated and a blank name, and its records span lines."""
    name, inbox, columns = _new_table(), new_path(spark, "inbox"), "c0 string, c1 string, c2 string, c3 string"
    header = spark.createDataFrame([("n_nationkey", None, "n_nationkey", "half")], columns)
    nations = table(spark, folder, "nation")
    lines = nations.select(
        F.col("n_nationkey").cast("string").alias("c0"),
        F.concat("n_name", F.lit("\nof region")).alias("c1"),
        F.col("n_regionkey").cast("string").alias("c2"),
        (F.col("n_nationkey") * 0.5).cast("string").alias("c3"),
    )
    for place, rows in (("kit", header), ("kit/Trash", header), ("other", header), ("kit", header.union(lines))):
        rows.coalesce(1).write.mode("append").options(escape='"', emptyValue="").csv(f"{inbox}/{place}")
    nations.write.mode("append").json(f"{inbox}/kit")
    for _ in range(2):
        ingest.ingest_csv(spark, f"{inbox}/kit", ".csv", name, path=f"{inbox}-table")
    return spark.table(name)


def file_listing(spark: SparkSession, folder: str) -> DataFrame:
    """Folders of a region each, with decoys: other types, and a folder of what was thrown away."""
    root = new_path(spark, "listing")
    regions = [r["n_regionkey"] for r in table(spark, folder, "nation").select("n_regionkey").distinct().collect()]
    nations = table(spark, folder, "nation").coalesce(1)
    for region in regions:
        own, place = nations.where(F.col("n_regionkey") == region), f"{root}/region={region}"
        own.write.csv(place)
        own.write.mode("append").json(place)
        own.select("n_name").write.mode("append").text(place)
        own.write.csv(f"{place}/Trash")
    listing = files.list_files(spark, root)
    chosen = files.select_files(listing, f"{root}/region=1", "part-").select("id", F.lit(True).alias("chosen"))
    return listing.join(chosen, "id", "left").select(
        F.substring("parent", len(root) + 1, 1000).alias("place"),
        "mime_type",
        "trashed",
        F.coalesce("chosen", F.lit(False)).alias("chosen"),
    )


def file_selection(spark: SparkSession, folder: str) -> DataFrame:
    url = F.col("url")
    listing = table(spark, folder, "pages").select(
        F.col("page_id").alias("id"),
        url.alias("name"),
        F.split(url, ":")[0].alias("parent"),
        F.when(url.contains("#"), "text/html").otherwise("text/csv").alias("mime_type"),
        (F.col("page_id") % 10 == 0).alias("trashed"),
        (F.col("page_id") % 13).alias("modified"),
    )
    return files.newest_file(files.select_files(listing, "https", "example.org")).select("id", "name")


def action_records(spark: SparkSession, folder: str) -> DataFrame:
    label, path = F.col("label"), new_path(spark, "documents")
    # JSON lines leave out NULL fields: some documents have no actions.
    table(spark, folder, "embeddings").select(
        F.concat(F.lit("d"), "vec_id").alias("id"),
        F.when(label % 2 == 0, F.transform("embedding", lambda x: F.floor(x * 1000))).alias("correctiveActions"),
    ).write.json(path)
    return document_source.action_records(document_source.read_documents(spark, path))


def snapshot_load(spark: SparkSession, folder: str) -> DataFrame:
    path, name = new_path(spark, "documents"), _new_table()
    table(spark, folder, "embeddings").select(
        F.concat(F.lit("d"), "vec_id").alias("id"),
        F.when(F.col("label") % 2 == 0, F.transform("embedding", lambda x: F.floor(x * 1000))).alias("correctiveActions"),
    ).write.json(path)
    for _ in range(2):
        ingest.snapshot_actions(spark, path, name, path=f"{path}-table")
    return spark.table(name)


def action_elements(spark: SparkSession, folder: str) -> DataFrame:
    """Actions that are a list, an object, null and absent, loaded as variants and taken apart."""
    path, name = new_path(spark, "documents"), _new_table()
    kind = F.col("c_custkey") % 4
    listed = F.format_string(
        ',"correctiveActions":[{"corrective":"fix %s","created_at":%d},{"corrective":null,"closed_at":5e-1},7]',
        "c_name", "c_nationkey",
    )
    rest = (
        F.when(kind == 0, listed)
        .when(kind == 1, ',"correctiveActions":{"first":{"corrective":"one"},"last":[1]}')
        .when(kind == 2, ',"correctiveActions":null')
        .otherwise("")
    )
    table(spark, folder, "customer").select(F.concat(F.format_string('{"id":"c%d"', "c_custkey"), rest, F.lit("}"))).write.text(path)
    ingest.snapshot_actions(spark, path, name, path=f"{path}-table", structured=True)
    return document_source.exploded_actions(spark.table(name))


def append_load(spark: SparkSession, folder: str) -> DataFrame:
    name, path = _new_table(), new_path(spark, "table")
    for _ in range(2):
        loads.append_load(table(spark, folder, "customer"), name, path=path)
    return spark.table(name)


def replace_load(spark: SparkSession, folder: str) -> DataFrame:
    name, path = _new_table(), new_path(spark, "table")
    customers = table(spark, folder, "customer")
    loads.replace_load(customers, name, path=path)
    loads.replace_load(customers.withColumn("c_name", F.upper("c_name")), name, path=path)
    return spark.table(name)


def _audit_table(spark: SparkSession) -> str:
    name, path = _new_table(), new_path(spark, "table")
    spark.sql(
        f"CREATE TABLE {name} (id_timestamp_update TIMESTAMP, id_date DATE, data_uuid STRING) "
        f"USING parquet LOCATION '{path}'"
    )
    return name


def _audited(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name).select(
        "id_date",
        F.length("data_uuid").cast("long").alias("uuid_length"),
        F.col("id_timestamp_update").isNotNull().alias("stamped"),
    )


def audit_row(spark: SparkSession, folder: str) -> DataFrame:
    name = _audit_table(spark)
    audit.insert_audit(audit.audit_days(table(spark, folder, "orders"), "o_orderdate"), name)
    return _audited(spark, name)


def audit_insert(spark: SparkSession, folder: str) -> DataFrame:
    name = _audit_table(spark)
    table(spark, folder, "orders").createOrReplaceTempView("audited_orders")
    audit.insert_query(
        spark,
        name,
        audit.AUDIT_COLUMNS,
        """SELECT current_timestamp(), day, uuid() FROM (
             SELECT DISTINCT to_date(o_orderdate) AS day FROM IDENTIFIER(:source) WHERE o_orderstatus = :status)""",
        {"source": "audited_orders", "status": "F"},
    )
    return _audited(spark, name)


def message_envelope(spark: SparkSession, folder: str) -> DataFrame:
    turns = table(spark, folder, "conversations")
    messages = message_plan.message_envelope(
        turns,
        record_json(F.col("conv_id"), F.col("turn"), F.col("text")),
        {"role": F.col("role"), "turn": F.col("turn"), "kind": "turn"},
    )
    topic = new_path(spark, "topic")
    message_sink.publish(messages, path=topic)
    published = spark.read.schema(messages.schema).json(topic)
    attributes = [F.col("attributes")[key].alias(f"{key}_attribute") for key in ("role", "turn", "kind")]
    return published.select("data", *attributes)


QUERIES = {
    "action_elements": action_elements,
    "action_records": action_records,
    "append_load": append_load,
    "audit_insert": audit_insert,
    "audit_row": audit_row,
    "csv_ingest": csv_ingest,
    "csv_job": csv_job,
    "deleted_keys": deleted_keys,
    "distinct_report": distinct_report,
    "epoch_to_text": epoch_text,
    "file_listing": file_listing,
    "file_selection": file_selection,
    "flatten_nested": flatten_nested,
    "flatten_payload": flatten_payload,
    "global_ordinal": global_ordinal,
    "keyed_payload": keyed_payload,
    "latest_live": latest_live,
    "latest_per_key": latest_per_key,
    "live_rows": live_rows,
    "message_envelope": message_envelope,
    "null_to_default": null_to_default,
    "number_text": number_text,
    "preview_rows": preview_rows,
    "project_rename": project_rename,
    "quality_report": quality_report,
    "register_rows": register_rows,
    "replace_load": replace_load,
    "report_load": report_load,
    "running_count": running_count,
    "snapshot_load": snapshot_load,
    "sql_source": sql_source,
    "stringify_all": stringify_all,
    "union_fill": union_fill,
    "without_brackets": without_brackets,
}
