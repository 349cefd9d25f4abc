"""Numbers, truth values and times as text, against Python's own."""

import datetime
import math
import random
import struct

from pyspark.sql import functions as F

from foldlog.functions.numbers import float_text
from foldlog.operators.shape import distinct_rows, stringify_all
from tests.plan import planned


def _doubles():
    rng = random.Random(1)
    some = [float(m) * 10.0**e for m in (1, -1, 1.5, 9.75, 123456789) for e in range(-30, 31)]
    some += [round(rng.uniform(-1e9, 1e9), rng.randrange(6)) for _ in range(2000)]
    some += [struct.unpack("d", rng.randbytes(8))[0] for _ in range(3000)]
    return [x for x in some if not math.isnan(x)] + [math.nan, math.inf, -math.inf, 0.0, -0.0]


def test_float_text_is_pythons(spark):
    df = spark.createDataFrame([(x,) for x in _doubles()], "x double")
    rows = df.select("x", F.expr(float_text("x")).alias("text")).collect()
    differ = [r for r in rows if r.text != repr(r.x)]
    # Of two shortest forms that give the number back Java may print the other one.
    assert all(float(r.text) == r.x and len(r.text) == len(repr(r.x)) for r in differ)
    assert len(differ) < 0.001 * len(rows)
    null = spark.createDataFrame([(None,)], "x double").select(F.expr(float_text("x")).alias("text"))
    assert null.first().text is None


def test_stringify_prints_like_the_original(spark):
    moment = datetime.datetime(2024, 1, 2, 3, 4, 5, 60)
    df = spark.createDataFrame(
        [(1e16, 0.1, True, moment, 7), (None, None, False, None, None), (math.nan, 2.0, None, moment, 1)],
        "d double, f float, b boolean, local timestamp_ntz, i bigint",
    ).withColumn("at", F.col("local").cast("timestamp"))
    rows = [tuple(r) for r in stringify_all(df).collect()]
    text = "2024-01-02 03:04:05.000060"
    assert rows == [
        ("1e+16", "0.1", "True", text, "7", text + "+00:00"),
        (None, None, "False", None, None, None),
        ("nan", "2.0", None, text, "1", text + "+00:00"),
    ]


def test_distinct_rows_with_nested_values(spark):
    rows = [
        (1, {"a": 1}, [1, None], "x"),
        (1, {"a": 1}, [1, None], "x"),
        (1, {"a": None}, [1, None], "x"),
        (1, {"a": 1}, [1], "x"),
        (1, None, None, None),
        (1, None, None, None),
        (1, {}, [], ""),
        (None, {"b": 1}, [], ""),
    ]
    df = spark.createDataFrame(rows, "`a.b` int, m map<string,int>, l array<int>, t string")
    df = df.withColumn("v", F.parse_json(F.when(F.col("t") == "x", F.lit('{"k":[1,null]}'))))
    kept = distinct_rows(df)
    assert kept.columns == df.columns and kept.count() == 6


def test_copies_of_a_row_go_before_the_shuffle(spark):
    df = spark.range(0, 30_000, 1, 8).select(F.when(F.col("id") % 3 > 0, F.lit(-1)).otherwise(F.col("id")).alias("a"))
    kept = distinct_rows(df)
    plan = planned(kept)
    assert plan.count("Aggregate") >= 2 and plan.index("Exchange hashpartitioning") > plan.index("Aggregate")
    assert kept.count() == 10_001
