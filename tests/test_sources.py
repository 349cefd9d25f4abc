"""Files, CSV, worksheet and document exports."""

import json
import os

import numpy as np
import pandas as pd
import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from foldlog.plans.ingest import ingest_csv, snapshot_actions
from foldlog.plans.report import REGISTER_COLUMNS, register_rows
from foldlog.sources.csv import header_names, quoted_newlines, read_csv
from foldlog.sources.documents import action_records, exploded_actions, read_documents
from foldlog.sources.files import list_files, newest_file, select_files
from foldlog.sources.register import read_register
from foldlog.sources.tables import read_table, run_query
from tests.plan import planned

FAILURES = (PySparkException, Py4JJavaError)


def write(folder, name, text, age=0):
    path = folder / name
    path.write_bytes(text.encode())
    os.utime(path, (1_700_000_000 - age, 1_700_000_000 - age))
    return str(path)


def same_as_pandas(spark, path):
    ours = read_csv(spark, path)
    theirs = pd.read_csv(path)
    assert ours.columns == list(theirs.columns)
    plain = lambda v: None if pd.isna(v) else v.item() if isinstance(v, np.generic) else v
    expected = [tuple(plain(v) for v in row) for row in theirs.astype(object).itertuples(index=False)]
    assert [tuple(row) for row in ours.collect()] == expected
    return dict(ours.dtypes), {name: str(kind) for name, kind in theirs.dtypes.items()}


def test_csv_values_and_types(spark, tmp_path):
    path = write(
        tmp_path,
        "kit.csv",
        "code,qty,price,flag,name,empty,mixed,wide\n"
        '007,1,1.5,True,"say ""hi"", x",,1,1\n'
        "8,-2,2,false,NA,,x,12345678901234567890123\n"
        '9, 3,1e3,TRUE,"",NULL,3,3\n'
        "\n"
        "10,4,n/a,False, padded ,None,,4\n",
    )
    ours, theirs = same_as_pandas(spark, path)
    assert ours == {
        "code": "bigint", "qty": "bigint", "price": "double", "flag": "boolean",
        "name": "string", "empty": "double", "mixed": "string", "wide": "string",
    }
    assert theirs["code"] == theirs["qty"] == "int64" and theirs["price"] == "float64"


def test_integers_with_gaps_stay_integers(spark, tmp_path):
    frame = read_csv(spark, write(tmp_path, "gaps.csv", "a,b\n1,x\n,y\n3,z\n"))
    assert dict(frame.dtypes)["a"] == "bigint"
    assert [row.a for row in frame.collect()] == [1, None, 3]


def test_java_only_number_forms_are_text(spark, tmp_path):
    frame = read_csv(spark, write(tmp_path, "forms.csv", "a,b\n1d,1f\n2d,0x1p3\n"))
    assert dict(frame.dtypes) == {"a": "string", "b": "string"}


def test_line_break_inside_quotes(spark, tmp_path):
    path = write(tmp_path, "lines.csv", 'a,b\n1,"two\nlines"\n2,one\n')
    assert list(quoted_newlines(spark, path).values()) == [True]
    same_as_pandas(spark, path)
    plain = write(tmp_path, "plain.csv", 'a,b\n1,"say ""x"""\n')
    assert list(quoted_newlines(spark, plain).values()) == [False]


def test_short_record_is_filled_and_long_record_is_refused(spark, tmp_path):
    same_as_pandas(spark, write(tmp_path, "short.csv", "a,b,c\n1,2,3\n4,5\n"))
    long = write(tmp_path, "long.csv", 'a,b\n1,"x,y"\n1,2,3\n')
    with pytest.raises(FAILURES):
        read_csv(spark, long).collect()
    with pytest.raises(FAILURES):
        read_csv(spark, long, multi_line=True).select("a").collect()
    quoted = write(tmp_path, "quoted.csv", 'a,b,c\n"p,q,r,s","t ""u"", v"\n')
    assert [tuple(r) for r in read_csv(spark, quoted).collect()] == [("p,q,r,s", 't "u", v', None)]


def test_header_only_and_odd_names(spark, tmp_path):
    frame = read_csv(spark, write(tmp_path, "header.csv", "a.b,c`d,N° é\n"))
    assert frame.columns == ["a.b", "c`d", "N° é"] and frame.isEmpty()
    same_as_pandas(spark, write(tmp_path, "odd.csv", "a.b,c`d,N° é\n1,2,x\n"))


def test_newest_matching_file(spark, tmp_path):
    write(tmp_path, "KIT_old.csv", "a\n1\n", age=50)
    write(tmp_path, "KIT new a.csv", "a\n2\n", age=10)
    write(tmp_path, "KIT new b.csv", "a\n3\n", age=10)
    write(tmp_path, "other.csv", "a\n4\n")
    write(tmp_path, "KIT.txt", "a\n5\n")
    (tmp_path / "below").mkdir()
    write(tmp_path / "below", "KIT_deep.csv", "a\n6\n")
    folder = str(tmp_path)
    listing = list_files(spark, folder)
    assert listing.count() == 6
    assert {r.parent for r in listing.collect()} == {folder, f"{folder}/below"}
    matching = select_files(listing, folder, "KIT")
    assert {row.name for row in matching.collect()} == {"KIT_old.csv", "KIT new a.csv", "KIT new b.csv"}
    assert newest_file(matching).first().name == "KIT new b.csv"
    taken = ingest_csv(spark, folder, "KIT", "kit_table", path=str(tmp_path / "out_table"))
    assert taken.endswith("KIT new b.csv")
    ingest_csv(spark, folder, "KIT", "kit_table", path=str(tmp_path / "out_table"))
    assert [row.a for row in spark.table("kit_table").collect()] == [3, 3]


@pytest.mark.parametrize("name", ["KIT[1].csv", "KIT{x,y}.csv", "KIT*.csv", "KIT?.csv"])
def test_chosen_file_is_no_pattern(spark, tmp_path, name):
    write(tmp_path, "KIT1.csv", "a\n1\n", age=9)
    write(tmp_path, "KITx.csv", "a\n2\n", age=9)
    write(tmp_path, name, "a\n3\n")
    table = f"literal_{abs(hash(name))}"
    assert ingest_csv(spark, str(tmp_path), "KIT", table, path=str(tmp_path / "out_table")).endswith(name)
    assert [row.a for row in spark.table(table).collect()] == [3]


def test_listing_predicates(spark):
    listing = spark.createDataFrame(
        [
            ("1", "kit", "p", "text/csv", False, 1),
            ("2", "kit", "q", "text/csv", False, 2),
            ("3", "kit", "p", "text/html", False, 3),
            ("4", "kit", "p", "text/csv", True, 4),
            ("5", "other", "p", "text/csv", False, 5),
        ],
        "id string, name string, parent string, mime_type string, trashed boolean, modified int",
    )
    assert [row.id for row in select_files(listing, "p", "kit").collect()] == ["1"]


def test_no_matching_file_loads_nothing(spark, tmp_path):
    write(tmp_path, "other.csv", "a\n1\n")
    assert ingest_csv(spark, str(tmp_path), "KIT", "never_made") is None
    assert not spark.catalog.tableExists("never_made")


def test_worksheet_register(spark, tmp_path):
    headers = list(dict.fromkeys(source for source, _ in REGISTER_COLUMNS))
    cells = ["007", "open", "", "01/02/2024", "+5", "main", "1.50", 'a "b", c', "two\nlines", "x", "y", "z", "w"]
    path = str(tmp_path / "sheet.csv")
    pd.DataFrame([cells], columns=headers).to_csv(path, index=False)
    (row,) = register_rows(read_register(spark, path)).collect()
    assert (row.id, row.workorder, row.NumParte) == ("7", "5", "1.5")
    assert (row.Fecha_creacion, row.Fecha_fin) == ("", "01/02/2024")
    assert (row.Especialista, row.DetalleEvento) == ('a "b", c', "two\nlines")
    assert row.TipoEvento == "SNC AFA"


DOCUMENTS = [
    {"id": "a", "correctiveActions": [{"x": 1}], "more": {"y": 2}},
    {"id": "b"},
    {"id": None, "correctiveActions": None},
    {"correctiveActions": "text"},
]


def export(folder):
    path = folder / "export.json"
    path.write_text("\n".join(json.dumps(document) for document in DOCUMENTS))
    return str(path)


def test_action_records(spark, tmp_path):
    rows = action_records(read_documents(spark, export(tmp_path))).collect()
    assert [tuple(row) for row in rows] == [("a", '[{"x":1}]'), ("b", ""), (None, None), ("", "text")]


def test_malformed_document_fails(spark, tmp_path):
    path = tmp_path / "broken.json"
    path.write_text('{"id": "a"}\n{"id": \n')
    with pytest.raises(FAILURES):
        action_records(read_documents(spark, str(path))).collect()


def test_snapshot_appends_and_can_replace(spark, tmp_path):
    source, target = export(tmp_path), str(tmp_path / "actions_table")
    for _ in range(2):
        snapshot_actions(spark, source, "actions_table", path=target)
    assert spark.table("actions_table").count() == 2 * len(DOCUMENTS)
    snapshot_actions(spark, source, "actions_table", replace=True, path=target)
    assert spark.table("actions_table").count() == len(DOCUMENTS)


def test_tables_by_path_name_and_query(spark):
    path = "/root/testdata/sf0.001/nation.parquet"
    by_path = read_table(spark, path, "parquet")
    by_path.createOrReplaceTempView("nation_view")
    by_query = run_query(
        spark,
        "SELECT * FROM IDENTIFIER(:source) WHERE n_nationkey < :below",
        {"source": "nation_view", "below": 3},
    )
    assert (by_path.count(), read_table(spark, "nation_view").count(), by_query.count()) == (25, 25, 3)


@pytest.mark.parametrize(
    "header",
    ["a,a,b", "a,,b", ",a,", "a,a,a.1", "a,a.1,a", "a.1,a,a", "x,x,x,x", "a,A,a", ",,", "a,b,a,b,a.1"],
)
def test_headers_are_named_like_pandas_names_them(spark, tmp_path, header):
    width = header.count(",") + 1
    path = write(tmp_path, "names.csv", f"{header}\n" + ",".join(map(str, range(width))) + "\n")
    assert read_csv(spark, path).columns == list(pd.read_csv(path).columns)
    assert [tuple(r) for r in read_csv(spark, path).collect()] == [tuple(range(width))]


def test_header_names_are_all_different():
    assert header_names(["a", "a", None, "", "a.1", "a"]) == ["a", "a.2", "Unnamed: 2", "Unnamed: 3", "a.1", "a.3"]


def test_a_csv_without_a_header_is_refused(spark, tmp_path):
    with pytest.raises(ValueError, match="no header"):
        read_csv(spark, write(tmp_path, "nothing.csv", ""))
    with pytest.raises(ValueError, match="no header"):
        read_csv(spark, write(tmp_path, "nothing.csv", ""), multi_line=True)


def test_one_file_with_quoted_line_breaks_leaves_the_others_split(spark, tmp_path):
    (tmp_path / "in parts %20").mkdir()
    folder = tmp_path / "in parts %20"
    for k in range(10):
        text = "a,b\n" + "".join(f'{k},"plain {i}"\n' for i in range(5_000))
        write(folder, f"part {k} [x].csv", text + (f'{k},"two\nlines"\n' if k == 4 else ""))
    flags = quoted_newlines(spark, str(folder))
    assert sum(flags.values()) == 1 and len(flags) == 10
    key = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key)
    spark.conf.set(key, "20000")
    try:
        frame = read_csv(spark, str(folder))
        tasks = frame.rdd.getNumPartitions()
        spread = [
            (r.file, r.tasks)
            for r in frame.select(F.input_file_name().alias("file"), F.spark_partition_id().alias("task"))
            .groupBy("file")
            .agg(F.countDistinct("task").alias("tasks"))
            .collect()
        ]
    finally:
        spark.conf.set(key, before)
    assert tasks > 9 * 4
    assert sorted(n for file, n in spread if "part%204" in file or "part 4" in file) == [1]
    assert min(n for file, n in spread if "part%204" not in file and "part 4" not in file) >= 4
    assert frame.count() == 50_001
    assert frame.where(F.col("b").contains("\n")).count() == 1 and dict(frame.dtypes) == {"a": "bigint", "b": "string"}


def test_listing_of_nested_folders_types_and_trash(spark, tmp_path):
    for place in ("a=1", "a=1/Trash", "b/c", "Trash/d"):
        (tmp_path / place).mkdir(parents=True)
    for name in ("x.csv", "a=1/y.CSV", "a=1/z.tar.gz", "a=1/Trash/y.csv", "b/c/no extension", "b/c/w.json", "Trash/d/v.csv"):
        write(tmp_path, name, "a\n1\n")
    for folder in (str(tmp_path), f"{tmp_path}/", f"file://{tmp_path}"):
        shown = folder.rstrip("/")
        listing = list_files(spark, folder)
        assert {(r.name, r.parent.removeprefix(shown), r.mime_type, r.trashed) for r in listing.collect()} == {
            ("x.csv", "", "text/csv", False),
            ("y.CSV", "/a=1", "text/csv", False),
            ("z.tar.gz", "/a=1", "application/gzip", False),
            ("y.csv", "/a=1/Trash", "text/csv", True),
            ("no extension", "/b/c", "application/octet-stream", False),
            ("w.json", "/b/c", "application/json", False),
            ("v.csv", "/Trash/d", "text/csv", True),
        }
        both = select_files(listing, f"{folder.rstrip('/')}/a=1/", "", ["text/csv", "application/gzip"])
        assert {r.name for r in both.collect()} == {"y.CSV", "z.tar.gz"}
        assert select_files(listing, f"{shown}/a=1/Trash", "y").isEmpty()
    assert "content" not in planned(list_files(spark, str(tmp_path))).split("ReadSchema")[-1]


def test_structured_actions_survive_a_load(spark, tmp_path):
    long = 10**45 + 1
    lines = [
        {"id": "list", "correctiveActions": [{"corrective": "c", "created_at": 1.0, "closed_at": None}, 5, []]},
        {"id": "object", "correctiveActions": {"k": {"corrective": "d"}}},
        {"id": "null", "correctiveActions": None},
        {"id": "text", "correctiveActions": "x"},
        {"id": "empty", "correctiveActions": []},
        {"id": long},
        {},
    ]
    write(tmp_path, "export.json", "\n\n".join(map(json.dumps, lines)) + "\n")
    snapshot_actions(spark, str(tmp_path / "export.json"), "structured", path=str(tmp_path / "t"), structured=True)
    loaded = spark.table("structured")
    assert dict(loaded.dtypes) == {"id": "string", "correctiveActions": "variant"}
    found = exploded_actions(loaded).orderBy("id", "pos").collect()
    assert [tuple(r) for r in found] == [
        ("", None, None, None, None, None),
        (str(long), None, None, None, None, None),
        ("empty", None, None, None, None, None),
        ("list", 0, None, "c", "1.0", None),
        ("list", 1, None, None, None, None),
        ("list", 2, None, None, None, None),
        ("null", None, None, None, None, None),
        ("object", 0, "k", "d", "", ""),
        ("text", None, None, None, None, None),
    ]


def test_a_malformed_line_of_an_export_is_an_error(spark, tmp_path):
    write(tmp_path, "bad.json", '{"id":1}\n{"id":\n')
    with pytest.raises(FAILURES):
        action_records(read_documents(spark, str(tmp_path / "bad.json"))).collect()
