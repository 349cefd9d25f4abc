"""The stages of the pipeline, one after the other, against a plain pass, and on odd and empty tables."""

import collections
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from foldlog.llm import pii, repetition, toxicity

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
CLEAN = " ".join(f"word{k}" for k in range(60))
ODD = [
    (1_000_001, None, "en", None, 0),
    (1_000_002, "", None, "s", None),
    (None, CLEAN, "en", "s", 1),
    (1_000_003, "word " * 30_000, "en", "s", 1),
    (1_000_004, "z" * 50_000, "en", "s", 1),
    (1_000_005, " ".join(f"w{k}" for k in range(20_000)), "en", "s", 1),
    (1_000_006, CLEAN + " mail a.b@example.com", "en", "s", 1),
    (1_000_006, CLEAN + " mail a.b@example.com", "en", "s", 1),
    (1_000_007, CLEAN.upper() + " mail a.b@example.com", "en", "s", 1),
]


def _folder(spark, path, docs, labels):
    docs.write.parquet(f"{path}/documents.parquet")
    labels.write.parquet(f"{path}/labels.parquet")
    return str(path)


def _run(spark, folder):
    """The rows after each stage, each written and read again."""
    docs, out = spark.read.parquet(f"{folder}/documents.parquet"), []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, folder).write.parquet(f"{folder}/{k}")
        docs = spark.read.parquet(f"{folder}/{k}")
        out.append(docs)
    return out


def _set(text):
    words = (text or "").encode().lower().split()
    wide = min(5, len(words))
    return frozenset(tuple(words[k : k + wide]) for k in range(len(words) - wide + 1)) if words else frozenset()


def _one_of_each(rows):
    """Rows of the smallest id of each group linked at 0.8, comparing all pairs."""
    sets = [(r[0], _set(r[1])) for r in rows if r[0] is not None]
    root = {i: i for i, _ in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for k, (i, s) in enumerate(sets):
        for j, t in sets[:k]:
            if s and t and 100 * len(s & t) >= 80 * len(s | t):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [r for r in rows if r[0] is None or find(r[0]) == r[0]]


@pytest.fixture(scope="module")
def made(spark, tmp_path_factory):
    given = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{given}/documents.parquet").where("doc_id < 300")
    docs = docs.unionByName(spark.createDataFrame(ODD, SCHEMA))
    folder = _folder(spark, tmp_path_factory.mktemp("pipeline"), docs, spark.read.parquet(f"{given}/labels.parquet"))
    return folder, _run(spark, folder)


def _rows(df):
    return collections.Counter(tuple(r) for r in df.collect())


def test_each_stage_equals_a_plain_pass(spark, made):
    folder, (kept, mild, single, private, packed) = made
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    assert kept.columns == mild.columns == single.columns == private.columns == docs.columns
    texts = [tuple(r) for r in docs.collect()]
    verdicts = repetition.measure([r[1] for r in texts])["kept"]
    assert _rows(kept) == collections.Counter(r for r, keep in zip(texts, verdicts) if keep)
    model = toxicity.fit_toxicity(kept, spark.read.parquet(f"{folder}/labels.parquet"))
    left = [tuple(r) for r in kept.collect()]
    scores = toxicity.scores_of([r[1] for r in left], model)
    assert _rows(mild) == collections.Counter(r for r, s in zip(left, scores) if s < 0.5)
    assert _rows(single) == collections.Counter(_one_of_each([tuple(r) for r in mild.collect()]))
    judge = pii.fit_pii_model(single)
    assert _rows(private) == collections.Counter(
        (r.doc_id, pii.redact(r.text, judge), r.lang, r.source, r.n_chars) for r in single.collect()
    )
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    library.no_truncation()
    expected = collections.Counter()
    for r in private.collect():
        ids = np.array([*library.encode(r.text or "", add_special_tokens=False).ids, 0], "<u4")
        for start in range(0, len(ids), 1024):
            piece = ids[start : start + 1024]
            expected[r.doc_id, start, len(piece), zlib.crc32(piece.tobytes()), len(ids)] += 1
    pieces = packed.collect()
    assert collections.Counter((r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in pieces) == expected
    filled = collections.defaultdict(list)
    for r in pieces:
        filled[r.sequence_id].append((r.offset, r.length))
    for own in filled.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 1024


def test_odd_rows_and_what_becomes_of_them(made):
    _, (kept, mild, single, private, _) = made
    ids = {r.doc_id for r in kept.collect()}
    assert not ids & {1_000_001, 1_000_002, 1_000_003, 1_000_004} and {None, 1_000_005, 1_000_006} <= ids
    assert {None, 1_000_005} <= {r.doc_id for r in single.collect()}
    assert not single.where("doc_id = 1000007").count()
    found = private.where("doc_id = 1000006").select("text").distinct().collect()
    assert [r.text for r in found] == [CLEAN + " mail [EMAIL]"]


def test_empty_tables(spark, tmp_path):
    docs = spark.createDataFrame([], SCHEMA)
    labels = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    for df in _run(spark, _folder(spark, tmp_path, docs, labels)):
        assert df.count() == 0


def test_extra_columns_with_clashing_names_stay(spark, tmp_path):
    docs = spark.createDataFrame(
        [(k, f"{CLEAN} and number {k} of {k * k}", "en", "s", 1, 0.5, "d", 7) for k in range(30)],
        SCHEMA + ", score double, digest string, component_id int",
    )
    labels = spark.createDataFrame([(k, 1, 0) for k in range(30)], "doc_id bigint, quality int, toxic int")
    folder = _folder(spark, tmp_path, docs, labels)
    kept, mild, single, private, packed = _run(spark, folder)
    assert private.columns == docs.columns and kept.count() == 30
    assert single.select(F.min("doc_id")).first()[0] == 0 and packed.count() >= single.count()


@pytest.mark.parametrize(
    "name, operator",
    [
        ("quality rules", "keep_unrepetitive"),
        ("toxicity", "drop_toxic"),
        ("n-gram Jaccard join", "keep_one_of_each"),
        ("PII", "redacted"),
        ("packing", "packed_documents"),
    ],
)
def test_a_stage_run_by_itself_gets_small_batches(spark, tmp_path, monkeypatch, name, operator):
    def sizes(docs, *_):
        return docs.mapInArrow(lambda batches: (pa.record_batch({"n": [b.num_rows]}) for b in batches), "n bigint")

    for fit in ("fit_toxicity", "fit_pii_model"):
        monkeypatch.setattr(corpus_pipeline, fit, lambda *_: None)
    monkeypatch.setattr(corpus_pipeline, operator, sizes)
    fresh = spark.newSession()  # without the settings
    fresh.createDataFrame([(1, 0)], "doc_id bigint, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    found = dict(corpus_pipeline.STAGES)[name](fresh, fresh.range(0, 1000, 1, 1), str(tmp_path))
    rows = [r.n for r in found.collect()]
    assert sum(rows) == 1000 and max(rows) <= 256
