"""Hand-written change logs: deletes, NULL keys, ties and payload defaults."""

import datetime as dt
import json
import os

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from foldlog.operators import ordinals
from foldlog.operators.changelog import deleted_keys, latest_per_key, live_rows
from foldlog.operators.payload import flatten_payload
from foldlog.plans.report import (
    REGISTER_COLUMNS,
    REPORT_COLUMNS,
    current_events,
    quality_report,
    refresh_quality_report,
)
from tests.plan import executed

LOG = "event string, document_id string, operation string, data string, timestamp timestamp"
FAILURES = (PySparkException, Py4JJavaError)
HEADERS = list(dict.fromkeys(source for source, _ in REGISTER_COLUMNS))


def at(second):
    return dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc) + dt.timedelta(seconds=second)


def log_of(spark, *rows):
    """Rows of (document, operation, payload, second); events are numbered in order."""
    return spark.createDataFrame(
        [
            (f"e{i:03}", doc, op, data if isinstance(data, str) else json.dumps(data), at(second))
            for i, (doc, op, data, second) in enumerate(rows)
        ],
        LOG,
    )


def sheet_of(spark, *rows):
    return spark.createDataFrame(list(rows), ", ".join(f"`{name}` string" for name in HEADERS))


def by_id(frame):
    return {row["id"]: row for row in frame.collect()}


def test_deleted_document_stays_deleted_after_recreation(spark):
    log = log_of(
        spark,
        ("a", "CREATE", {"id": "a"}, 1),
        ("a", "DELETE", {}, 2),
        ("a", "DELETE", {}, 3),
        ("a", "CREATE", {"id": "a"}, 4),
        ("b", "CREATE", {"id": "b"}, 1),
        ("b", "UPDATE", {"id": "b"}, 2),
        (None, "CREATE", {"id": "n"}, 1),
        (None, "DELETE", {"id": "n"}, 2),
    )
    deleted = deleted_keys(log)
    assert [row.document_id for row in deleted.collect()] == ["a"]
    live = live_rows(log, deleted)
    assert live.columns == log.columns
    assert sorted((row.document_id or "") for row in live.collect()) == ["", "", "b", "b"]


def test_latest_is_per_payload_id(spark):
    log = log_of(
        spark,
        ("a", "CREATE", {"id": "x", "state": "old"}, 1),
        ("b", "CREATE", {"id": "x", "state": "new"}, 2),
        ("c", "CREATE", {"id": None, "state": "null id"}, 3),
        ("d", "CREATE", {"state": "no id, old"}, 4),
        ("e", "CREATE", {"state": "no id, new"}, 5),
    )
    rows = by_id(current_events(log, ["event"]))
    assert set(rows) == {"x", ""}
    assert rows["x"]["estado_final"] == rows["x"]["estado"] == "new"
    assert rows[""]["estado_final"] == "no id, new"


def test_tie_goes_to_the_lower_ordinal(spark):
    log = log_of(
        spark,
        ("b", "UPDATE", {"id": "x", "state": "b"}, 1),
        ("a", "UPDATE", {"id": "x", "state": "z"}, 1),
        ("a", "UPDATE", {"id": "x", "state": "a"}, 1),
        ("a", "UPDATE", {"id": "x", "state": "a"}, 1),
    )
    (row,) = current_events(log, ["event"]).collect()
    assert (row.estado, row.indice) == ("a", "1")


def test_ordinal_counts_rows_that_are_dropped_later(spark):
    log = log_of(
        spark,
        ("a", "UPDATE", {"id": "x", "v": 1}, 1),
        ("a", "UPDATE", {"id": "x", "v": 2}, 2),
        ("b", "UPDATE", {"id": None}, 1),
        ("c", "UPDATE", {"id": "y"}, 1),
        ("d", "DELETE", {"id": "z"}, 1),
    )
    assert {k: v.indice for k, v in by_id(current_events(log, ["event"])).items()} == {"x": "2", "y": "4"}


def test_missing_timestamp_is_oldest(spark):
    log = log_of(spark, ("a", "UPDATE", {"id": "x", "state": "dated"}, 1)).union(
        spark.createDataFrame([("n", "a", "UPDATE", '{"id":"x","state":"undated"}', None)], LOG)
    )
    (row,) = current_events(log, ["event"]).collect()
    assert row.estado == "dated"


def test_absent_null_and_empty_fields(spark):
    log = log_of(
        spark,
        (
            "a",
            "UPDATE",
            {
                "id": "x",
                "workOrder": None,
                "partNumber": "",
                "packageNumber": 7,
                "specialist": "a name",
                "reportingWorkshop": {"workshopName": None},
                "analysis": {"process": None, "observation": "seen"},
                "createdBy": "not an object",
                "correctiveActions": [{"a": 1}, "b"],
            },
            1,
        ),
    )
    (row,) = flatten_payload(log).collect()
    assert row.workOrder is None
    assert (row.partNumber, row.component, row.packageNumber) == ("", "", "7")
    assert (row.specialist, row.reportingWorkshop) == ("", None)
    assert (row.process, row.observation, row.bahia) == (None, "seen", "")
    assert (row.createdBy_email, row.processAt) == ("", "")
    assert row.correctiveActions == '[{"a":1},"b"]'
    assert len(row) == len(log.columns) + 27


def test_parent_that_is_null_or_no_object_reads_as_absent(spark):
    log = log_of(
        spark,
        ("a", "UPDATE", {"id": "x", "analysis": None, "createdAt": 5, "specialist": [1]}, 1),
    )
    (row,) = flatten_payload(log).collect()
    assert (row.observation, row.createdAt, row.specialist, row.responsibleWorkshop) == ("",) * 4


def test_responsible_workshop_leaf(spark):
    def workshop(value):
        return {"id": "x", "analysis": {"responsibleWorkshop": {"workshopName": value}}}

    log = log_of(spark, *(("a", "UPDATE", workshop(v), 1) for v in ("plain", '{"quoted"', {"k": 1}, None)))
    strict = [row.responsibleWorkshop for row in flatten_payload(log).collect()]
    loose = [row.responsibleWorkshop for row in flatten_payload(log, leaf="any").collect()]
    assert strict == ["", "", '{"k":1}', ""]
    assert loose == ["plain", '{"quoted"', '{"k":1}', None]
    with pytest.raises(ValueError):
        flatten_payload(log, leaf="other")


def test_repeated_json_key_keeps_the_last(spark):
    (row,) = flatten_payload(log_of(spark, ("a", "UPDATE", '{"id":"first","id":"last"}', 1))).collect()
    assert row.id == "last"


@pytest.mark.parametrize("broken", ["{oops", "", "[1]", '"text"', "null"])
def test_malformed_payload(spark, broken):
    log = log_of(spark, ("a", "UPDATE", broken, 1))
    with pytest.raises(FAILURES):
        flatten_payload(log).collect()
    with pytest.raises(FAILURES):
        current_events(log, ["event"]).collect()
    (row,) = flatten_payload(log, mode="null").collect()
    assert row.id is None and row.state is None and row.responsibleWorkshop is None
    assert current_events(log, ["event"], mode="null").collect() == []


def test_missing_payload_fails_like_a_malformed_one(spark):
    log = log_of(spark).union(spark.createDataFrame([("e", "a", "UPDATE", None, at(1))], LOG))
    with pytest.raises(FAILURES):
        flatten_payload(log).collect()
    assert flatten_payload(log, mode="null").first().id is None


def test_white_space_before_the_object(spark):
    (row,) = flatten_payload(log_of(spark, ("a", "UPDATE", ' \n\t\r{"id": "x"}', 1))).collect()
    assert row.id == "x"


def test_epochs_in_the_report(spark):
    def seconds(**fields):
        return {"id": "x"} | {name: {"_seconds": value} for name, value in fields.items()}

    start = "01/01/1970 00:00:00"
    null = seconds(finalizedAt=None, tracingAt=None, processAt=None, createdAt=None)
    zero = seconds(finalizedAt=0, tracingAt=0, processAt=0, createdAt=0)
    late = seconds(finalizedAt=1700000000, tracingAt=1.5, processAt="60", createdAt=1700000000)
    names = ["Fecha_fin", "fecha_seguimiento", "proceso_inicio", "Fecha_creacion"]

    def report_of(payload):
        (row,) = current_events(log_of(spark, ("a", "UPDATE", payload, 1)), ["event"]).collect()
        return [row[name] for name in names]

    assert report_of(null) == [start, start, start, None]
    assert report_of({"id": "x"}) == [None, None, None, None]
    assert report_of(zero) == [start] * 4
    late_text = "14/11/2023 22:13:20"
    assert report_of(late) == [late_text, "01/01/1970 00:00:01", "01/01/1970 00:01:00", late_text]


def test_report_joins_both_registers(spark):
    log = log_of(spark, ("a", "UPDATE", {"id": "x", "eventType": "E"}, 0))
    sheet = sheet_of(spark, [f"v{i}" for i in range(len(HEADERS))])
    report = quality_report(log, sheet, ["event"])
    assert report.columns == [target for _, target in REPORT_COLUMNS]
    assert set(dict(report.dtypes).values()) == {"string"}
    rows = by_id(report)
    assert rows["x"].TipoEvento == "E"
    assert rows["x"].Ultima_mod == "2024-01-01 00:00:00+00:00"
    case = rows["v0"]
    assert case.TipoEvento == "SNC AFA"
    assert case.estado == case.estado_final == "v1"
    assert case.Taller == case.TallerReporta == "v5"
    only_events = {
        "Ultima_mod", "fecha_seguimiento", "indice", "Imagen", "OperacionMin", "Observacion",
        "Proceso", "Bahia", "CausaFalla", "email_registro", "AccionCorrectiva", "proceso_inicio",
        "question1", "plaqueteo",
    }
    assert {name for name in report.columns if case[name] is None} == only_events


def test_all_documents_deleted_gives_empty_report(spark):
    log = log_of(spark, ("a", "UPDATE", {"id": "x"}, 0), ("a", "DELETE", {}, 1))
    report = current_events(log, ["event"])
    assert report.collect() == []
    assert report.columns == [target for _, target in REPORT_COLUMNS]


def test_refresh_replaces_the_table_and_drops_its_staging(spark, tmp_path):
    sheet = sheet_of(spark)
    folder = spark.conf.get("spark.checkpoint.dir")
    before = set(os.listdir(folder))
    for name in ("x", "y"):
        log = log_of(spark, ("a", "UPDATE", {"id": name}, 0))
        refresh_quality_report(log, sheet, "report_table", ["event"], path=str(tmp_path / "report"))
    assert [row.id for row in spark.table("report_table").collect()] == ["y"]
    assert set(os.listdir(folder)) == before


@pytest.fixture(scope="module")
def hot_log(spark, tmp_path_factory):
    """A third of the rows in one live document, and as many deletes of another."""
    hot = spark.range(60_000).select(F.lit("hot").alias("document_id"), F.lit("UPDATE").alias("operation"), "id")
    gone = spark.range(60_000).select(F.lit("gone"), F.lit("DELETE"), F.col("id") + 60_000)
    rest = spark.range(60_000).select(
        F.concat(F.lit("d"), F.col("id") % 5000),
        F.when(F.col("id") % 500 == 3, "DELETE").otherwise("UPDATE"),
        F.col("id") + 120_000,
    )
    path = str(tmp_path_factory.mktemp("hot") / "log")
    hot.union(gone).union(rest).repartition(16, "id").write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture
def no_broadcast(spark):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "32KB",
    }
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield
    for key in settings:
        spark.conf.unset(key)


def test_hot_document_is_split_when_both_sides_shuffle(spark, hot_log, no_broadcast):
    log = hot_log
    live = live_rows(log, deleted_keys(log))
    plan = executed(live)
    assert "SortMergeJoin(skew=true)" in plan and "LeftAnti" in plan
    rest = 60_000 - 10 * 12  # ten documents are deleted, each with twelve rows
    assert live.count() == 60_000 + rest


def test_hot_document_is_split_also_before_a_window_on_the_same_key(spark, hot_log, no_broadcast):
    log = hot_log
    latest = latest_per_key(live_rows(log, deleted_keys(log)), "document_id", [F.desc("id")])
    assert "SortMergeJoin(skew=true)" in executed(latest)
    rows = {row.document_id: row.id for row in latest.collect()}
    assert len(rows) == 1 + 5000 - 10
    assert rows["hot"] == 59_999 and "gone" not in rows


def test_no_payload_is_staged_for_the_report(spark):
    rows = [(f"d{k % 9}", "UPDATE", {"id": f"x{k % 20}", "state": f"payload {k}"}, k) for k in range(200)]
    staged = []
    stage = ordinals.stage

    def seen(df, label):
        out = stage(df, label)
        staged.append((label, out.columns))
        return out

    ordinals.stage = seen
    try:
        assert current_events(log_of(spark, *rows), ["event"]).count() == 20
    finally:
        ordinals.stage = stage
    assert [(label, sorted(columns)) for label, columns in staged] == [("ranges", ["__range", "__slot", "event"])]


@pytest.mark.parametrize("events", [("a", "a", "b"), ("a", None, "b")])
def test_report_refuses_columns_that_do_not_tell_rows_apart(spark, events):
    log = spark.createDataFrame([(e, "d", "UPDATE", '{"id":1}', None) for e in events], LOG)
    with pytest.raises(ValueError, match="event must tell all rows apart"):
        current_events(log, ["event"])


def test_unique_columns_may_bear_payload_names(spark):
    log = log_of(spark, ("a", "UPDATE", {"id": "x", "state": "s"}, 1)).withColumnRenamed("event", "id")
    (row,) = current_events(log, ["id"]).collect()
    assert (row.id, row.estado) == ("x", "s")
