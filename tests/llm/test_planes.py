"""Bit-plane clusters against plain arithmetic, SQL and odd tables."""

import hashlib
import math
import random

import numpy as np
import pytest

from foldlog.llm import planes

SCHEMA = "vec_id bigint, embedding array<double>, cluster string"


def _clusters(rows, clusters, rounds):
    """The same clusters, one vector at a time."""
    kept = [
        (i, [math.floor(256 * x) for x in v])
        for i, v, _ in rows
        if v is not None and len(v) == 64 and all(x is not None and math.isfinite(x) for x in v)
    ]
    digest = lambda i: hashlib.sha256(f"2:{'' if i is None else i}".encode()).hexdigest()
    low = min((min(v) for _, v in kept), default=0)
    plane_key = lambda v: planes.planes_of(np.array([v]) - low, 28).tobytes()
    centroids = [v for _, v in sorted(kept, key=lambda r: (digest(r[0]), plane_key(r[1])))][:clusters]
    assign = lambda v: min((sum((a - b) ** 2 for a, b in zip(v, c)), k) for k, c in enumerate(centroids))
    for _ in range(rounds):
        own = [[] for _ in centroids]
        for _, v in kept:
            own[assign(v)[1]].append(v)
        centroids = [[sum(x) // len(m) for x in zip(*m)] if m else c for m, c in zip(own, centroids)]
    found = [(i, *assign(v)[::-1]) for i, v in kept]
    sums = [sum(d for _, k, d in found if k == c) for c in range(len(centroids))]
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return sorted((str(i), k, d, sums[k], sum(sums), digests[k]) for i, k, d in found)


def _got(df, **how):
    return sorted((str(r[0]), *r[1:]) for r in planes.cluster_vectors(df, **how).collect())


@pytest.mark.parametrize("bits", [1, 2, 9, 13, 28])
def test_products_and_planes_are_exact(bits):
    rng = np.random.default_rng(bits)
    x, c = (rng.integers(0, 2**bits, (n, 64)) for n in (50, 7))
    x[0], c[0] = 2**bits - 1, 0
    px, pc = planes.planes_of(x, bits), planes.planes_of(c, bits)
    assert (planes.values_of(px) == x).all()
    assert (planes.plane_products(px, pc) == x @ c.T).all()
    far = ((x[:, None] - c) ** 2).sum(axis=2)
    chosen, distance = planes.nearest(px, pc)
    assert (chosen == far.argmin(axis=1)).all() and (distance == far.min(axis=1)).all()


def test_clusters_equal_brute_force(spark):
    rng = random.Random(3)
    rows = [(i, [rng.gauss(i % 3, 0.4) for _ in range(64)], "x") for i in range(150)]
    rows += [(1000 + i, rows[0][1], "x") for i in range(60)]  # many copies of one vector
    rows += [(7, [rng.random() for _ in range(64)], None), (None, [0.5] * 64, "x"), (None, [-0.5] * 64, "x")]
    rows += [(500, None, "x"), (501, [], "x"), (502, [0.1] * 63, "x"), (503, [0.1] * 65, "x")]
    rows += [(504, [math.nan] * 64, "x"), (505, [math.inf] + [0.1] * 63, "x"), (506, [None] + [0.1] * 63, "x")]
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    for clusters, rounds in ((5, 3), (40, 2), (1000, 1)):
        assert _got(df, clusters=clusters, rounds=rounds) == _clusters(rows, clusters, rounds)


def test_the_same_id_a_hundred_times_starts_once_per_row(spark):
    rows = [(1, [float(i % 50)] * 64, None) for i in range(100)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert _got(df, clusters=10, rounds=2) == _clusters(rows, 10, 2)


def test_small_and_far_tables(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert planes.cluster_vectors(empty).count() == 0
    one = spark.createDataFrame([(1, [0.25] * 64, "x")], SCHEMA)
    assert [(r.cluster, r.distance) for r in planes.cluster_vectors(one).collect()] == [(0, 0)]
    far = spark.createDataFrame([(1, [0.0] * 64, "x"), (2, [1e300] * 64, "x")], SCHEMA)
    with pytest.raises(ValueError, match="apart"):
        planes.cluster_vectors(far)
