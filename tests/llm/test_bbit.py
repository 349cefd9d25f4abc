"""b-bit MinHash against brute force, its estimate against true similarity, and odd tables."""

import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from foldlog.llm import bbit
from foldlog.llm.common import mix64


def _hashes(rng, n):
    return mix64(rng.integers(0, 2**63, n).astype(np.uint64))


def _set(text, width):
    words = (text or "").encode().lower().split()
    if not words:
        return frozenset()
    wide = min(width, len(words))
    return frozenset(tuple(words[k : k + wide]) for k in range(len(words) - wide + 1))


def _components(rows, width, percent):
    """(id, size, component) of each row with an id, comparing all pairs of texts."""
    own = [(i, _set(text, width)) for i, text, _ in rows if i is not None]
    root = {i: i for i, _ in own}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    sets = list(dict.fromkeys((i, s) for i, s in own if s))
    for k, (i, s) in enumerate(sets):
        for j, t in sets[k + 1 :]:
            if i == j or 100 * len(s & t) >= percent * len(s | t):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return Counter((i, len(s), find(i), find(i) == i) for i, s in own)


def _got(found):
    return Counter(tuple(r) for r in found.where("doc_id IS NOT NULL").collect())


def _texts(rng):
    """Groups of near copies around the limit, chains, copies and a shared passage."""
    passage = [f"p{k}" for k in range(120)]
    rows = []
    for group in range(6):
        base = [f"g{group}w{k}" for k in range(150)]
        for _ in range(40):
            own = list(base)
            for _ in range(rng.choice([0, 1, 2, 3, 5])):
                own[rng.randrange(150)] = f"n{rng.random()}"
            rows.append(" ".join(own))
        chain = list(base)
        for k in range(30):  # each links with the next only
            chain[5 * k] = f"c{group}{k}"
            rows.append(" ".join(chain))
    rows += [" ".join(passage + [f"u{rng.random()}" for _ in range(rng.randrange(10, 60))]) for _ in range(150)]
    rows += [rows[0]] * 30 + [rows[0].upper()]
    rng.shuffle(rows)
    return rows


def test_components_equal_brute_force(spark):
    rng = random.Random(5)
    rows = [(i, text, "x") for i, text in enumerate(_texts(rng), 10)]
    rows += [(1, None, "x"), (2, "", "x"), (3, " \n\t ", None), (4, "one two", "x"), (5, "One  two", "x"), (6, "one", "x")]
    rows += [(7, "word " * 40_000, "x"), (8, "word " * 9, "x"), (9, "z" * 100_000, "x")]
    rows += [(10, rows[7][1], "x"), (10, "some other text of the same id", "x"), (10, "some other text of the same id", "x")]
    rows += [(2000, "SOME other text of the same id", "x"), (None, rows[0][1], "x"), (None, None, "x")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, kept string").repartition(4)
    found = bbit.near_duplicates(df)
    assert _got(found) == _components(rows, 5, 85)
    lost = found.where("doc_id IS NULL").collect()
    assert len(lost) == 2 and all(r.component_id is None and r.kept for r in lost)


@pytest.mark.parametrize("width, percent", [(5, 80), (2, 60)])
def test_other_limits(spark, width, percent):
    rows = [(i, text, "x") for i, text in enumerate(_texts(random.Random(8)))]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, kept string")
    assert _got(bbit.near_duplicates(df, width=width, percent=percent)) == _components(rows, width, percent)


def test_members_outside_the_largest_component_are_all_compared(spark, monkeypatch):
    monkeypatch.setattr(bbit, "ROUNDS", 0)
    rows = [(i, text, "x") for i, text in enumerate(_texts(random.Random(9)))]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, kept string")
    assert _got(bbit.near_duplicates(df)) == _components(rows, 5, 85)


def test_empty_table(spark):
    assert bbit.near_duplicates(spark.createDataFrame([], "doc_id bigint, text string")).count() == 0


@pytest.mark.parametrize("minima, bits", [(bbit.MINIMA, bbit.BITS), (bbit.LONG, 1)])
@pytest.mark.parametrize("share", [0.0, 0.3, 0.7, 0.85, 0.95])
def test_estimate_is_unbiased_and_as_sharp_as_promised(spark, share, minima, bits):
    rng = np.random.default_rng(int(share * 100))
    rows = []
    for _ in range(200):
        both, own = round(400 * share), (400 - round(400 * share)) // 2
        common = _hashes(rng, both)
        sets = [np.concatenate((common, _hashes(rng, own))) for _ in range(2)]
        signed = bbit.packed_bits(np.array([bbit.minima_of(s, minima) for s in sets]), bits)
        rows.append(tuple(x.tolist() for x in signed))
    df = spark.createDataFrame(rows, "x array<bigint>, y array<bigint>")
    seen = [r.e for r in df.select(bbit.estimated(F.col("x"), F.col("y"), minima, bits).alias("e")).collect()]
    chance = 2.0**-bits
    agree = chance + (1 - chance) * share
    spread = (agree * (1 - agree) / minima) ** 0.5 / (1 - chance)
    assert abs(np.mean(seen) - share) < 5 * spread / 200**0.5 + 0.003
    assert np.std(seen) < 1.25 * spread + 1e-9
    if share == 0.85:
        assert min(seen) > bbit.least_estimate(85, minima, bits)


def test_bands_meet_as_often_as_computed():
    rng, rows, met = np.random.default_rng(1), 6, 0
    assert bbit.band_rows(85) == rows
    for _ in range(300):
        common = _hashes(rng, 100)
        minima = np.array([bbit.minima_of(np.concatenate((common, _hashes(rng, 50)))) for _ in range(2)])
        met += len(set(bbit.band_keys(minima, rows)[0]) & set(bbit.band_keys(minima, rows)[1]))
    expected = 300 * 32 * 0.5**rows
    assert abs(met - expected) < 5 * expected**0.5
