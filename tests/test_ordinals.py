"""Distributed numbering against one plain window, on skewed and tied data."""

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from foldlog.operators import ordinals
from foldlog.operators.ordinals import ascending, descending, global_ordinal, running_count
from tests.plan import planned

SCHEMA = "k string, v int, n long"


def numbered(rows):
    return [(k, v, n) for n, (k, v) in enumerate(rows)]


def plain_ordinal(rows):
    smallest_first = lambda r: (r[0] is not None, r[0] or "", r[1] is not None, r[1] or 0, r[2])
    return {r[2]: i for i, r in enumerate(sorted(rows, key=smallest_first), 1)}


def plain_running(rows):
    newest_first = lambda r: (r[1] is None, -(r[1] or 0), r[2])
    counts, result = {}, {}
    for k, v, n in sorted(rows, key=newest_first):
        counts[k] = counts.get(k, 0) + 1
        result[n] = None if k is None else counts[k]
    return result


def check(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    ordinal = global_ordinal(df, [ascending("k"), ascending("v")], ["n"])
    assert {r.n: r.indice for r in ordinal.collect()} == plain_ordinal(rows)
    running = running_count(df, "k", [descending("v")], ["n"])
    assert {r.n: r.running_count for r in running.collect()} == plain_running(rows)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    st.lists(
        st.tuples(st.sampled_from([None, "", "a", "b", "é"]), st.one_of(st.none(), st.integers(0, 3))),
        max_size=60,
    )
)
def test_any_rows(spark, rows):
    check(spark, numbered(rows))


@pytest.fixture
def small_partitions(spark):
    """Keep all range partitions, so that keys span several of them."""
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(key, "false")
    yield
    spark.conf.unset(key)


def test_copies_and_hot_keys_span_ranges(spark, small_partitions):
    rows = [("hot", 1)] * 3000 + [("warm", i % 7) for i in range(2000)] + [(None, 1)] * 1500
    rows += [(f"k{i}", i) for i in range(1000)]
    df = spark.createDataFrame(numbered(rows), SCHEMA)
    ordinal = global_ordinal(df, [ascending("k"), ascending("v")], ["n"])
    sizes = [
        row["count"] for row in spark.read.parquet(*ordinal.inputFiles()).groupBy("__range").count().collect()
    ]
    assert len(sizes) == 8 and max(sizes) < 0.2 * len(rows)
    check(spark, numbered(rows))


def test_equals_one_window_over_all_rows(spark):
    events = spark.read.parquet("/root/testdata/sf0.01/events.parquet").select("user_id", "ts", "event_id")
    order = [ascending("user_id"), ascending("ts")]
    window = Window.orderBy(F.asc_nulls_first("user_id"), F.asc_nulls_first("ts"), "event_id")
    plain = events.withColumn("indice", F.row_number().over(window).cast("long"))
    ours = global_ordinal(events, order, ["event_id"])
    assert ours.exceptAll(plain).isEmpty() and plain.exceptAll(ours).isEmpty()


def test_rows_never_meet_in_one_partition(spark):
    events = spark.read.parquet("/root/testdata/sf0.01/events.parquet").select("user_id", "event_id")
    plan = planned(global_ordinal(events, [ascending("user_id")], ["event_id"]))
    single = plan[plan.index("SinglePartition"):]
    assert "event_id" not in single and "HashAggregate" in single


def test_unique_columns_are_required(spark):
    with pytest.raises(ValueError):
        global_ordinal(spark.range(3), [ascending("id")], [])


def test_finish_runs_before_staging(spark):
    ours = global_ordinal(
        spark.range(10), [descending("id")], ["id"], finish=lambda rows: rows.withColumn("twice", F.col("id") * 2)
    )
    assert {(r.id, r.twice, r.indice) for r in ours.collect()} == {(i, 2 * i, 10 - i) for i in range(10)}


@pytest.fixture
def every_group_counts(spark, monkeypatch):
    """Look at small groups too, so that small tables take all paths, with few characters per level."""
    monkeypatch.setattr(ordinals, "_FEW", 1)
    monkeypatch.setattr(ordinals, "LENGTHS", (2, 4))


TEXTS = st.one_of(st.none(), st.text("aé", max_size=6), st.sampled_from(["aaaaaa", "aaaaab", "aaaa", "\U0001f600aaa"]))


@settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(TEXTS, TEXTS, st.integers(0, 2)), min_size=30, max_size=150), st.booleans(), st.booleans())
def test_cut_text_sorts_like_whole_text(spark, every_group_counts, small_partitions, rows, down, last):
    rows = [(a, b, c, n) for n, (a, b, c) in enumerate(rows * 3)]
    df = spark.createDataFrame(rows, "a string, b string, c int, n long").repartition(3)
    keys = [ordinals.Key("a", down, last), ordinals.Key("b", not down, last), descending("c")]
    window = Window.orderBy(*(key.sorted(key.column()) for key in keys), "n")
    plain = {r.n: r.i for r in df.select("n", F.row_number().over(window).alias("i")).collect()}
    assert {r.n: r.indice for r in global_ordinal(df, keys, ["n"]).collect()} == plain
    within = Window.partitionBy("c").orderBy(*(key.sorted(key.column()) for key in keys[:2]), "n")
    plain = {r.n: r.i for r in df.select("n", F.row_number().over(within).alias("i")).collect()}
    assert {r.n: r.running_count for r in running_count(df, "c", keys[:2], ["n"]).collect()} == plain


def _exchanged(plan):
    """What the range exchange of a plan is keyed by."""
    return plan[plan.index("rangepartitioning(") :].split("\n")[0]


def test_documents_are_not_sampled(spark):
    payload = F.concat(F.lit('{"id":"'), F.col("id").cast("string"), F.lit('","text":"'), F.repeat(F.lit("x"), 100_000))
    log = spark.range(400).select(F.concat(F.lit("document "), F.col("id") % 50).alias("document_id"), payload.alias("data"), "id")
    keys = [ascending("document_id"), ascending("data"), ascending("id")]
    plan = _exchanged(planned(ordinals.ranged(log, keys)))
    assert "substring(data" in plan and "data#" not in plan.replace("substring(data#", "").replace("length(data#", "")
    found = global_ordinal(log, keys[:2], ["id"], finish=lambda rows: rows.drop("data"))
    expected = sorted((f"document {i % 50}", f'{{"id":"{i}","', i) for i in range(400))
    assert [r.id for r in found.orderBy("indice").collect()] == [i for _, _, i in expected]


def test_only_groups_that_are_too_large_take_longer_keys(spark):
    log = spark.range(20_000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("document_id"),
        F.concat(F.lit("the same beginning "), F.col("id") % 1000).alias("data"),
        "id",
    )
    keys = [ascending("document_id"), ascending("data"), ascending("id")]
    plan = _exchanged(planned(ordinals.ranged(log, keys)))
    assert "substring(data" in plan and "CASE WHEN coalesce(__frequent0" in plan and "__frequent1" not in plan


def test_a_running_count_shuffles_once(spark):
    events = spark.read.parquet("/root/testdata/sf0.01/events.parquet")
    plan = planned(running_count(events, "user_id", [descending("ts")], ["event_id"]))
    assert plan.count("Exchange hashpartitioning") <= 1 and "rangepartitioning" not in plan


def test_a_hot_key_is_dealt_into_even_blocks(spark, small_partitions):
    rows = [("hot", i * 7919 % 6000) for i in range(6000)] + [(f"k{i % 400}", i) for i in range(6000)]
    rows += [("same", 1)] * 5000 + [(None, i) for i in range(3000)]
    df = spark.createDataFrame(numbered(rows), SCHEMA).repartition(4)
    counted = running_count(df, "k", [descending("v")], ["n"])
    assert counted.columns == ["k", "v", "n", "running_count"]
    assert {r.n: r.running_count for r in counted.collect()} == plain_running(numbered(rows))
    blocks = spark.read.parquet(*counted.inputFiles()).groupBy("k", "__block").count().collect()
    assert max(r["count"] for r in blocks) < 0.1 * len(rows)
