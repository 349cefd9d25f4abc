"""Automaton search against a plain scorer and on odd tables."""

import math
import random
import re
from collections import Counter

import pytest

from foldlog.llm import scanning

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _terms(text):
    return TERM.findall((text or "").translate(LOWER))


def _ranking(docs, items, most):
    """The same ranking, one document at a time."""
    counts = [(i, Counter(_terms(text))) for i, text, _ in docs]
    n_docs, total = sum(bool(c) for _, c in counts), sum(sum(c.values()) for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    wanted = {}
    for item, text in items:
        if item is not None:
            wanted.setdefault(item, set()).update(_terms(text))
    out = []
    for item, terms in wanted.items():
        scored = []
        for doc_id, c in counts:
            score = 0
            for t in terms & set(c):
                w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                m = 50 + 50 * sum(c.values()) * n_docs // total
                score += w * (10**9 * c[t] // (1000 * c[t] + 20 * m))
            if score > 0:
                scored.append((-score, doc_id is None, doc_id or 0))
        for k, (score, null, doc_id) in enumerate(sorted(scored)[:most], 1):
            out.append((item, k, None if null else doc_id, -score))
    return sorted(out, key=str)


def _got(found):
    return sorted((tuple(r) for r in found.collect()), key=str)


def _word(rng):
    return "".join(rng.choice("abAB9éÉ漢") for _ in range(rng.randint(1, 2)))


def _texts(rng, many, most):
    breaks = [" ", ", ", "-", "\x00", "\x7f", "'", "\n", "  ", "_"]
    return ["".join(_word(rng) + rng.choice(breaks) for _ in range(rng.randint(0, most))) for _ in range(many)]


@pytest.mark.parametrize("pairs", [200_000, 60])
def test_ranking_equals_brute_force(spark, pairs):
    rng = random.Random(11)
    docs = [(i, text, "x") for i, text in enumerate(_texts(rng, 300, 40))]
    docs += [(300 + i, docs[5][1], "x") for i in range(70)]  # ties
    docs += [(None, docs[5][1], "x"), (None, "ab", None), (3, "ab ab 9", "x"), (3, "ab ab 9", "x")]
    docs += [(900, None, "x"), (901, "", "x"), (902, " -- \n", "x"), (903, "ab " * 60_000, "x"), (904, "z" * 90_000, "x")]
    items = list(enumerate(_texts(rng, 20, 8)))
    items += [(50, "ab"), (50, "AB é"), (51, "absent"), (52, ""), (53, None), (None, "ab"), (54, "z" * 90_000)]
    found = scanning.ranked_search(
        spark.createDataFrame(docs, "doc_id bigint, text string, score string").repartition(5),
        spark.createDataFrame(items, "item_id bigint, text string"),
        most=30,
        pairs=pairs,
    )
    assert _got(found) == _ranking(docs, items, 30)


def test_automaton_finds_whole_terms_only():
    block = scanning.ItemBlock.of([(1, "ab"), (1, "b"), (2, "ab"), (2, "é")])
    form = scanning.scanned_form("ab AB,ab xab abx b\té É")
    found = scanning.frequencies(block.automaton(), form)
    assert {block.terms[t]: n for t, n in found.items()} == {"ab": 3, "b": 1, "é": 1}
    assert scanning.count_terms(form) == len(_terms("ab AB,ab xab abx b\té É")) == 8


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "ab", "x")], "doc_id bigint, text string, score string")
    items = spark.createDataFrame([(1, "ab")], "item_id bigint, text string")
    assert scanning.ranked_search(docs.limit(0), items).count() == 0
    assert scanning.ranked_search(docs, items.limit(0)).count() == 0
    assert _got(scanning.ranked_search(docs, items))[0][:3] == (1, 1, 1)
