"""The subsequence kernel against brute force, and the machine on documents it has not seen."""

import itertools
import math
import random
import zlib

import numpy as np
import pytest

from foldlog.llm import toxicity

FOLDER = "/root/testdata/sf0.1"
SCHEMA = "doc_id bigint, text string, score string"


def _weights(string):
    """Weight of each sequence of ORDER codes, over all its occurrences."""
    out = {}
    for places in itertools.combinations(range(len(string)), toxicity.ORDER):
        span = places[-1] - places[0] + 1
        if span <= toxicity.SPAN:
            key = tuple(string[p] for p in places)
            out[key] = out.get(key, 0.0) + toxicity.DECAY**span
    return out


def _kernel(left, right):
    x, y = _weights(left), _weights(right)
    dot = lambda a, b: sum(w * b.get(k, 0.0) for k, w in a.items())
    length = math.sqrt(dot(x, x) * dot(y, y))
    return dot(x, y) / length if length else 0.0


def test_kernel_equals_brute_force():
    rng = random.Random(2)
    strings = [bytes([31, *rng.choices(range(1, rng.choice([2, 4, 27])), k=rng.randint(1, 14)), 31]) for _ in range(60)]
    got = toxicity.kernel_with(strings, strings[:20])
    for i, j in itertools.product(range(60), range(20)):
        assert got[i, j] == pytest.approx(_kernel(strings[i], strings[j]), abs=1e-6)
    row, sequence, weight = toxicity.sequence_weights(strings)
    for i, own in enumerate(strings):
        expected = _weights(own)
        length = math.sqrt(sum(w * w for w in expected.values()))
        found = dict(zip(sequence[row == i].tolist(), weight[row == i].tolist()))
        number = lambda key: sum(c << 5 * (toxicity.ORDER - 1 - k) for k, c in enumerate(key))
        assert found == pytest.approx({number(k): w / length for k, w in expected.items()}, abs=1e-9)


@pytest.mark.parametrize("word", ["idiot", "banana", "mississippi", "aaaaaaaa", "ab"])
def test_a_string_has_kernel_one_with_itself(word):
    (own,) = toxicity.strings_of(word)
    assert toxicity.kernel_with([own], [own])[0, 0] == pytest.approx(1.0, abs=1e-6)


def test_strings_of_words():
    find = toxicity.strings_of
    assert find("I-d.I0t") == find("idiot") == find("i d i o t") and len(find("you i d i o t you")) == 3
    assert find(None) == find("") == find(" ... \n") == []
    long = find("x" * 10 + "idiot" * 20)
    assert all(len(s) <= toxicity.WINDOW + 2 for s in long) and find("idiotidiot")[0][1:-1] in long[2]
    whole = b"".join(s[1 : 1 + toxicity.WINDOW // 2] for s in long[:-1]) + long[-1][1:-1]
    assert whole == find("x")[0][1:2] * 10 + find("idiot")[0][1:-1] * 20
    assert len(find("z" * 50_000)) < 50_000 / 12


@pytest.fixture(scope="module")
def fitted(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    return docs, labels, toxicity.fit_toxicity(docs, labels)


def test_held_out_documents(fitted):
    docs, labels, model = fitted
    rows = toxicity.toxicity_scores(docs, model).join(labels, "doc_id").collect()
    unseen = [r for r in rows if zlib.crc32(str(r.doc_id).encode()) % 5 == 0]
    toxic = np.array([r.score for r in unseen if r.toxic])
    clean = np.array([r.score for r in unseen if not r.toxic])
    assert (toxic[:, None] > clean[None, :]).mean() > 0.95
    assert (clean < 0.5).mean() > 0.97 and (toxic >= 0.5).mean() > 0.85


def test_letters_put_between_and_marks(fitted):
    model = fitted[2]
    text = "The report was sent to all members on Monday. You are such a {} today. They had some tea."
    score = lambda word: toxicity.scores_of([text.format(word)], model)[0]
    plain = score("idiot")
    assert plain > 0.5 > 0.05 > score("friend")
    assert score("i-d.i_o*t") == score("1d10t") == pytest.approx(plain)
    rng, kept = random.Random(4), []
    for word in ("idiot", "moron", "stupid", "worthless", "pathetic", "disgusting"):
        (own,) = toxicity.strings_of(word)
        scorer = toxicity.Scorer(model)
        values = scorer.values([[toxicity.with_letters_between(own, rng) for _ in range(50)], [own]])
        other = scorer.values([[toxicity.strings_of(w)[0] for w in ("report", "members", "monday", "friend")]])[0]
        kept.append((values[0] > other.max()).mean())
    assert np.mean(kept) > 0.8


def test_odd_tables_and_labels(spark):
    rows = [
        (1, "You idiot. Fine day.", "x"), (2, None, "x"), (3, "", None), (None, "idiot", "x"), (5, "a b", "x"),
        (5, "a b", "x"), (6, "word " * 30_000, "x"), (7, "z" * 50_000, "x"),
    ]
    odd = spark.createDataFrame(rows, SCHEMA).repartition(2)
    empty = spark.createDataFrame([], SCHEMA)
    labels = spark.createDataFrame(
        [(1, 1, 1), (2, 1, 1), (3, 0, 0), (5, None, 0), (6, 0, None), (None, 1, 1), (7, 0, 0), (99, 0, 1)],
        "doc_id bigint, quality int, toxic int",
    )
    for how in (labels, labels.limit(0), labels.where("toxic = 1")):
        model = toxicity.fit_toxicity(odd, how)
        scores = toxicity.toxicity_scores(odd, model).collect()
        assert len(scores) == len(rows) and all(0 <= r.score <= 1 for r in scores)
        kept = toxicity.drop_toxic(odd, model)
        assert kept.columns == odd.columns and kept.count() == sum(r.score < 0.5 for r in scores)
    assert toxicity.toxicity_scores(empty, toxicity.fit_toxicity(empty, labels)).count() == 0


def test_a_batch_is_scored_in_parts():
    held = []

    class Watched(toxicity.Scorer):
        def values(self, texts):
            held.append(len(texts))
            return super().values(texts)

    model = toxicity.ToxicityModel(np.arange(1 << 10), np.ones(1 << 10), -1.0, (1.0, 0.0))
    texts = [f"abc aab ba{chr(97 + k % 26)} {k}" if k % 7 else None for k in range(200)]
    found = toxicity.document_values(texts, Watched(model))
    assert max(held) <= toxicity._TEXTS_AT_ONCE < 200
    assert found == [toxicity.document_values([t], toxicity.Scorer(model))[0] for t in texts]
