"""Loads, audit rows, messages, shaping and staging."""

import base64
import datetime as dt
import json
import os
import uuid

import pytest
from pyspark.sql import functions as F

from foldlog.operators import shape
from foldlog.plans import audit
from foldlog.plans.messages import message_envelope
from foldlog.sinks.loads import append_load, insert_rows, replace_load
from foldlog.sinks.messages import kafka_rows, publish
from foldlog.staging import shared_folder, stage, stage_from, staged_tables


def test_append_and_replace(spark):
    append_load(spark.range(3), "loaded")
    append_load(spark.range(2), "loaded")
    assert sorted(row.id for row in spark.table("loaded").collect()) == [0, 0, 1, 1, 2]
    replace_load(spark.range(5, 7), "loaded")
    assert sorted(row.id for row in spark.table("loaded").collect()) == [5, 6]


def test_insert_matches_columns_by_position(spark):
    spark.sql("CREATE TABLE inserted (a STRING, b INT, c STRING) USING parquet")
    insert_rows(spark.sql("SELECT 1 AS x, 'v' AS y"), "inserted", ["b", "a"])
    assert [tuple(row) for row in spark.table("inserted").collect()] == [("v", 1, None)]


def test_audit_row(spark):
    spark.sql("CREATE TABLE audited (id_timestamp_update TIMESTAMP, id_date DATE, data_uuid STRING) USING parquet")
    for day in ("2024-02-29", "2024-03-01"):
        audit.insert_audit(audit.audit_row(spark, day), "audited")
    rows = spark.table("audited").orderBy("id_date").collect()
    assert [row.id_date for row in rows] == [dt.date(2024, 2, 29), dt.date(2024, 3, 1)]
    assert len({uuid.UUID(row.data_uuid) for row in rows}) == 2
    assert all(row.id_timestamp_update is not None for row in rows)
    dt.date.fromisoformat(audit.today_text(spark))


def test_messages_are_published_as_json_lines(spark, tmp_path):
    turns = spark.createDataFrame([("hello", "user")], "text string, role string")
    path = str(tmp_path / "topic")
    publish(message_envelope(turns, F.col("text"), {"role": F.col("role"), "kind": "turn"}), path=path)
    publish(message_envelope(turns, F.col("text")), path=path)
    lines = [json.loads(row.value) for row in spark.read.text(path).collect()]
    body = base64.b64encode(b"hello").decode()
    assert sorted(lines, key=len) == [
        {"data": body},
        {"data": body, "attributes": {"role": "user", "kind": "turn"}},
    ]


def test_kafka_shape(spark):
    turns = spark.createDataFrame([("hé", "user")], "text string, role string")
    (row,) = kafka_rows(message_envelope(turns, F.col("text"), {"role": F.col("role")})).collect()
    assert bytes(row.value).decode() == "hé"
    assert [(h.key, bytes(h.value)) for h in row.headers] == [("role", b"user")]


def test_shape_helpers(spark):
    df = spark.createDataFrame([(1, None)], "`a.b` int, c double")
    twice = shape.project_rename(df, [("a.b", "x"), ("a.b", "y"), ("c", "c")])
    assert [tuple(row) for row in shape.null_to_default(twice, {"c": 0}).collect()] == [(1, 1, 0.0)]
    with pytest.raises(ValueError):
        shape.project_rename(df, [("a.b", "x"), ("c", "x")])
    nested = spark.sql("SELECT array(1, 2) AS l, map('k', 1) AS m, parse_json('[1]') AS v, CAST(NULL AS int) AS n")
    assert tuple(shape.stringify_all(nested).first()) == ("[1,2]", '{"k":1}', "[1]", None)
    assert [row.id for row in shape.preview_rows(spark.range(9), [F.desc("id")], 2).collect()] == [8, 7]


def test_staged_tables_are_dropped_after_the_block(spark):
    with staged_tables(spark):
        inside = stage(spark.range(3), "kept")
        files = inside.inputFiles()
        assert inside.count() == 3 and files
    outside = stage(spark.range(2), "left")
    assert outside.count() == 2
    with pytest.raises(Exception):
        spark.read.parquet(*files).count()
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")


def test_what_is_staged_on_the_way_is_dropped(spark):
    seen = []

    def make():
        seen.extend(stage(spark.range(k), "inner") for k in (3, 4))
        return seen[0].union(seen[1])

    frame = stage_from(spark, make, "outer")
    assert frame.count() == 7
    left = os.listdir(shared_folder(spark).removeprefix("file:"))
    assert not any(name.startswith("foldlog-inner") for name in left)
    assert sum(name.startswith("foldlog-outer") for name in left) == 1


def test_brackets_and_keyed_payloads(spark):
    df = spark.createDataFrame([('["a[0]"]', 7, '{"x": [1]}'), (None, None, "{}"), ("", 8, None)], "t string, k long, data string")
    assert [r.t for r in shape.without_brackets(df, "t").collect()] == ['"a0"', None, ""]
    assert [r.keyed for r in shape.keyed_payload(df, "k").collect()] == ['{"7":{"x": [1]}}', None, None]
    odd = spark.createDataFrame([('a"b\\c', "{}")], "k string, data string")
    assert [json.loads(r.keyed) for r in shape.keyed_payload(odd, "k").collect()] == [{'a"b\\c': {}}]
