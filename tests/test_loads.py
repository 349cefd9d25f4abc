"""Appends, replacements and inserts: what is refused, and what a table holds after a failure."""

import json
import os

import pytest
from pyspark.sql import functions as F

import foldlog.sinks.loads as loads
from foldlog.sinks.loads import append_load, insert_rows, replace_load


def values(spark, table):
    return sorted((tuple(r) for r in spark.table(table).collect()), key=str)


def described(spark, table):
    return json.loads(spark.sql(f"DESCRIBE TABLE EXTENDED {table} AS JSON").first()[0])


def files_of(spark, table):
    return sorted(n for n in os.listdir(described(spark, table)["location"].removeprefix("file:")) if n.startswith("part-"))


def one(spark, kind, *cells):
    return spark.createDataFrame([(c,) for c in cells], f"id {kind}")


@pytest.mark.parametrize(
    "target, kind, good, bad",
    [
        ("bigint", "double", [7.0, None, -0.0], 2.5),
        ("double", "bigint", [3, None, 2**53], 2**53 + 1),
        ("int", "bigint", [2**31 - 1], 2**31),
        ("bigint", "string", ["12", "-3", None], "007"),
        ("double", "string", ["1.5"], "x"),
        ("float", "double", [0.5, float("nan"), float("inf")], 0.1),
        ("date", "string", ["2024-02-29"], "2024-02-30"),
        ("boolean", "string", ["true"], "yes"),
    ],
)
def test_values_decide_whether_a_column_fits(spark, target, kind, good, bad):
    table = f"fits_{target}_{kind}"
    spark.sql(f"CREATE TABLE {table} (id {target}) USING parquet")
    append_load(one(spark, kind, *good), table)
    insert_rows(one(spark, kind, *good).toDF("other"), table, ["id"])
    before = values(spark, table)
    assert len(before) == 2 * len(good)
    with pytest.raises(ValueError, match=f"'id' is {target}; 1 values of type {kind}"):
        append_load(one(spark, kind, *good, bad), table)
    with pytest.raises(ValueError, match="do not fit"):
        insert_rows(one(spark, kind, bad), table, ["id"])
    assert values(spark, table) == before or target == "float"


def test_any_value_fits_text_and_a_column_of_nulls_fits_all(spark):
    spark.sql("CREATE TABLE fits_text (a STRING, b BIGINT) USING parquet")
    append_load(spark.createDataFrame([(2.5, None)], "a double, b void"), "fits_text")
    assert values(spark, "fits_text") == [("2.5", None)]


def test_a_whole_number_file_follows_one_with_fractions(spark):
    append_load(one(spark, "double", 2.5), "loads_csv")
    append_load(one(spark, "bigint", 3), "loads_csv")
    assert values(spark, "loads_csv") == [(2.5,), (3.0,)]


def test_checks_take_one_job(spark):
    spark.sql("CREATE TABLE loads_job (a DOUBLE, b INT, c STRING) USING parquet")
    wide = spark.range(10).select(F.col("id").alias("a"), F.col("id").alias("b"), F.col("id").alias("c"))
    spark.sparkContext.setJobGroup("one", "check")
    loads.fitted(wide, spark.table("loads_job").schema.fields)
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    # An aggregation runs as two jobs under adaptive execution: its shuffle, then its result.
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup("one")) <= 2


def test_insert_needs_known_columns(spark):
    spark.sql("CREATE TABLE loads_i (a INT, b STRING) USING parquet")
    insert_rows(spark.createDataFrame([(2.0,)], "x double"), "loads_i", ["a"])
    assert values(spark, "loads_i") == [(2, None)]
    for columns in (["c"], ["a", "b"]):
        with pytest.raises(ValueError, match="cannot insert"):
            insert_rows(one(spark, "int", 1), "loads_i", columns)


PROPERTIES = "TBLPROPERTIES ('made.by' = 'it''s me')"
MAKES = {
    "managed": "",
    "partitioned": "PARTITIONED BY (p)",
    "bucketed": "CLUSTERED BY (id) INTO 3 BUCKETS",
    "external": "LOCATION '{}'",
    "external_partitioned": "PARTITIONED BY (p) LOCATION '{}'",
}
NEW_COLUMNS = {True: lambda df: df, False: lambda df: df.withColumn("more", F.lit(1.5))}


def make(spark, tmp_path, name, clause):
    spark.sql(f"CREATE TABLE {name} (id BIGINT, p STRING) USING parquet {clause.format(tmp_path / name)} {PROPERTIES}")
    append_load(rows_of(spark, 2), name)


def rows_of(spark, n):
    return spark.range(n).select("id", (F.col("id") % 2).cast("string").alias("p"))


@pytest.mark.parametrize("same", [True, False])
@pytest.mark.parametrize("kind", MAKES)
def test_replace_keeps_what_the_table_is(spark, tmp_path, kind, same):
    name = f"kept_{kind}_{same}".lower()
    make(spark, tmp_path, name, MAKES[kind])
    before = described(spark, name)
    for n in (5, 3, 4):
        new = NEW_COLUMNS[same](rows_of(spark, n))
        replace_load(new, name)
        assert sorted(tuple(r) for r in spark.table(name).select(*new.columns).collect()) == sorted(
            tuple(r) for r in new.collect()
        )
    after = described(spark, name)
    for key in ("type", "provider", "table_properties", "partition_columns"):
        assert after.get(key) == before.get(key), key
    if same:
        assert after.get("bucket_columns") == before.get("bucket_columns")
    # Old files, and the other tables that were made meanwhile, are gone.
    where = before["location"].removeprefix("file:")
    beside = [d for d in os.listdir(os.path.dirname(where)) if d.startswith(os.path.basename(where))]
    assert beside == [os.path.basename(after["location"])]
    assert [t.name for t in spark.catalog.listTables() if t.name.startswith(name)] == [name]
    replace_load(spark.table(name).where("id > 1"), name)
    assert spark.table(name).count() == 2


def test_rows_are_written_once(spark, tmp_path):
    make(spark, tmp_path, "written_once", "")
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    replace_load(rows_of(spark, 100).mapInArrow(count, "id bigint, p string"), "written_once")
    assert seen.value == 100 and spark.table("written_once").count() == 100


class Stopped(Exception):
    pass


@pytest.mark.parametrize("same", [True, False])
@pytest.mark.parametrize("kind", MAKES)
@pytest.mark.parametrize("when", ["write", "after"])
def test_a_failure_leaves_old_rows_and_nothing_else(spark, tmp_path, monkeypatch, kind, same, when):
    name = f"failed_{kind}_{same}_{when}".lower()
    make(spark, tmp_path, name, MAKES[kind])
    before = described(spark, name)
    new = NEW_COLUMNS[same](rows_of(spark, 5))
    if when == "write":
        bad = F.when(F.col("id") < 4, F.col("id")).otherwise(F.raise_error("no").cast("bigint"))
        new = new.withColumn("id", bad)
    else:
        # The last step: the table is pointed to the new rows, or gets the name.
        run = type(spark).sql

        def stopped(session, text, *args, **kwargs):
            if "SET LOCATION" in text or f"RENAME TO {name}" in text and "__" in text.split(" RENAME")[0] and not stopped.done:
                stopped.done = True
                raise Stopped("no")
            return run(session, text, *args, **kwargs)

        stopped.done = False
        monkeypatch.setattr(type(spark), "sql", stopped)
    with pytest.raises(Exception, match="no"):
        replace_load(new, name)
    monkeypatch.undo()
    assert values(spark, name) == [(0, "0"), (1, "1")]
    assert described(spark, name)["location"] == before["location"]
    where = before["location"].removeprefix("file:")
    assert [d for d in os.listdir(os.path.dirname(where)) if d.startswith(os.path.basename(where))] == [os.path.basename(where)]
    assert [t.name for t in spark.catalog.listTables() if t.name.startswith(name)] == [name]


def test_a_missing_table_is_created(spark):
    replace_load(rows_of(spark, 3), "replace_creates")
    assert spark.table("replace_creates").count() == 3
    with pytest.raises(Exception, match="no"):
        replace_load(spark.range(1).select(F.raise_error("no").alias("x")), "replace_never_made")
