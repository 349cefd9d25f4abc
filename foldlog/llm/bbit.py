"""Near duplicates by b-bit MinHash: bands find candidates, packed low bits estimate, sets confirm.

A document is the set of its different word shingles; documents with equal sets are one node. A
node keeps ``MINIMA`` smallest hashes only long enough to make two things of them: a key for each
band of a few whole minima, and a signature of the low ``BITS`` bits of every minimum, one plane of
bits per place. Nodes with a key in common are candidates. How many minima of two nodes agree is
counted on the planes by XOR, OR and bit counts; chance agreement (one in 2**BITS) is taken off,
and pairs whose estimate is more than ``SPREADS`` standard deviations below the limit go. What is
left is compared on the full sets. With the limit at 0.85 a pair that links is missed with a
probability below 10**-6 by the bands and the estimate together.

Members of a bucket are not paired with each other. In each round one member of every bucket is
compared with the members of other components; links join components, and buckets of a single
component drop out. What is left after a few rounds are groups whose members are alike, but mostly
not enough to link. There a member outside the largest component of its bucket has to be held
against all the others, so no link between components is left out; that is done on signatures of
``LONG`` minima with one bit each, which tell 0.80 from 0.85, and in the first bucket only that two
members share, so few pairs leave the join.
"""

from __future__ import annotations

import hashlib
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foldlog.llm.common import map_columns, mix64
from foldlog.llm.graph import components
from foldlog.llm.signatures import _WordHashes as WordHashes
from foldlog.llm.signatures import linked, shingle_sets
from foldlog.staging import stage

MINIMA, BITS = 192, 4
#: Minima of one bit each in the signatures of nodes that are still in doubt.
LONG = 4096
#: The bits of a minimum that are retained: the highest are nearly always 0 in a minimum.
_SHIFT = np.uint64(20)
#: Standard deviations that the estimate of a linked pair may fall short.
SPREADS = 5
#: Rounds in which one member of each bucket is compared with the others there.
ROUNDS = 3
#: Products that are held at once.
_AT_ONCE = 1 << 19
_GOLDEN = 0x9E3779B97F4A7C15
_MULTIPLIERS = mix64(np.arange(1, LONG + 1, dtype=np.uint64) * np.uint64(_GOLDEN)) | np.uint64(1)


def band_rows(percent: int, miss: float = 1e-6) -> int:
    """The most minima per band with which a pair at the limit shares no band with a probability
    of at most ``miss``; as many bands are made as ``MINIMA`` allows."""
    share = percent / 100
    return max([r for r in range(1, 13) if (1 - share**r) ** (MINIMA // r) <= miss], default=1)


def minima_of(hashes: np.ndarray, minima: int = MINIMA) -> np.ndarray:
    """The smallest products of a set's hashes, one per multiplier."""
    out = np.full(minima, np.iinfo(np.uint64).max, np.uint64)
    step = _AT_ONCE // minima
    for begin in range(0, len(hashes), step):
        np.minimum(out, (hashes[begin : begin + step, None] * _MULTIPLIERS[:minima]).min(axis=0), out=out)
    return out


def packed_bits(minima: np.ndarray, bits: int = BITS) -> np.ndarray:
    """The retained bits of each row of minima: plane by plane, 64 minima in a word."""
    low = minima >> _SHIFT
    planes = [
        np.packbits(((low >> np.uint64(bit)) & np.uint64(1)).astype(np.uint8), axis=1, bitorder="little").view("<i8")
        for bit in range(bits)
    ]
    return np.concatenate(planes, axis=1)


def band_keys(minima: np.ndarray, rows: int) -> np.ndarray:
    """One key per band: a hash of its minima and its number."""
    bands = MINIMA // rows
    taken = minima[:, : bands * rows].reshape(len(minima), bands, rows)
    key = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64), (len(minima), bands))
    for r in range(rows):
        key = mix64(key * np.uint64(_GOLDEN) + taken[:, :, r])
    return key.view(np.int64)


def agreeing(x: Column, y: Column, minima: int = MINIMA, bits: int = BITS) -> Column:
    """How many of the packed minima have the same bits in both signatures."""
    words = minima // 64
    unequal = [
        F.bit_count(reduce(Column.bitwiseOR, (x[p * words + w].bitwiseXOR(y[p * words + w]) for p in range(bits))))
        for w in range(words)
    ]
    return F.lit(minima) - reduce(Column.__add__, unequal)


def estimated(x: Column, y: Column, minima: int = MINIMA, bits: int = BITS) -> Column:
    """The similarity of two sets by their signatures, less the agreement that chance makes."""
    chance = 2.0**-bits
    return (agreeing(x, y, minima, bits) / minima - chance) / (1 - chance)


def least_estimate(percent: int, minima: int = MINIMA, bits: int = BITS) -> float:
    """Estimates of linked pairs fall below this with a probability of less than 10**-6."""
    share, chance = percent / 100, 2.0**-bits
    agree = chance + (1 - chance) * share
    return share - SPREADS * (agree * (1 - agree) / minima) ** 0.5 / (1 - chance)


_SETS = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("n", pa.int64()),
        ("digest", pa.binary()),
        ("sig", pa.list_(pa.int64())),
        ("keys", pa.list_(pa.int64())),
    ]
)
_GRAMS = pa.schema([("id", pa.int64()), ("grams", pa.binary())])
_PAIRS = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def described_sets(rows: DataFrame, width: int, band: int) -> DataFrame:
    """Per row: size and digest of the set, its signature and its band keys."""

    def make():
        hashes = WordHashes()

        def step(batch):
            sets = shingle_sets(batch["text"], width, hashes)
            minima = np.array([minima_of(own) for own in sets]).reshape(len(sets), MINIMA)
            return {
                "doc_id": batch["doc_id"],
                "n": [len(own) for own in sets],
                "digest": [hashlib.blake2b(own.tobytes(), digest_size=16).digest() for own in sets],
                "sig": list(packed_bits(minima)),
                "keys": list(band_keys(minima, band)),
            }

        return step

    return map_columns(rows, make, _SETS)


def _sets_of(rows: DataFrame, ids: DataFrame, width: int) -> DataFrame:
    """The sets of the documents in ``ids``, from their texts."""

    def make():
        hashes = WordHashes()

        def step(batch):
            return {"id": batch["doc_id"], "grams": [s.tobytes() for s in shingle_sets(batch["text"], width, hashes)]}

        return step

    return map_columns(rows.join(ids.withColumnRenamed("id", "doc_id"), "doc_id", "left_semi"), make, _GRAMS)


def _confirmed(pairs: DataFrame, grams: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets link."""

    def make():
        def step(batch):
            out = {"a": [], "b": []}
            for a, b, ga, gb in zip(batch["a"], batch["b"], batch["ga"], batch["gb"]):
                x, y = np.frombuffer(ga, np.uint64), np.frombuffer(gb, np.uint64)
                both = np.concatenate((x, y))
                both.sort()
                if linked(len(x), len(y), int((both[1:] == both[:-1]).sum()), percent):
                    out["a"].append(a)
                    out["b"].append(b)
            return out

        return step

    first, second = grams.toDF("a", "ga"), grams.toDF("b", "gb")
    return map_columns(pairs.join(first, "a").join(second, "b").select("a", "b", "ga", "gb"), make, _PAIRS)


def _possible(n: str, m: str, percent: int) -> Column:
    """Whether sets of these sizes can link at all."""
    return (100 * F.least(n, m)) >= (percent * F.greatest(n, m))


def _likely(pairs: DataFrame, signed: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose sizes and estimate do not rule a link out."""
    return (
        pairs.join(signed.toDF("a", "n", "x"), "a")
        .join(signed.toDF("b", "m", "y"), "b")
        .where(_possible("n", "m", percent) & (estimated(F.col("x"), F.col("y")) >= least_estimate(percent)))
        .select("a", "b")
    )


def _long_signatures(grams: DataFrame, ids: DataFrame) -> DataFrame:
    """(id, sig): ``LONG`` minima of one bit each."""

    def make():
        def step(batch):
            minima = [minima_of(np.frombuffer(own, np.uint64), LONG) for own in batch["grams"]]
            return {"id": batch["id"], "sig": list(packed_bits(np.array(minima).reshape(-1, LONG), 1))}

        return step

    schema = pa.schema([("id", pa.int64()), ("sig", pa.list_(pa.int64()))])
    return map_columns(grams.join(ids, "id", "left_semi"), make, schema)


def _mixed(members: DataFrame) -> DataFrame:
    """The members (key, id, comp) of buckets that have several components."""
    keys = members.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo <> hi")
    return members.join(keys.select("key"), "key")


def _pivot_pairs(members: DataFrame, number: int) -> DataFrame:
    """One member of each bucket, another in every round, with those of other components."""
    pivot = members.groupBy("key").agg(
        F.min_by(F.struct("id", "comp"), F.xxhash64("id", F.lit(number))).alias("pivot")
    )
    return (
        members.join(pivot, "key")
        .where("comp <> pivot.comp")
        .select(F.least("id", "pivot.id").alias("a"), F.greatest("id", "pivot.id").alias("b"))
        .distinct()
    )


def _other_pairs(members: DataFrame, signed: DataFrame, grams: DataFrame, percent: int) -> DataFrame:
    """Members outside the largest component of their bucket, with those of other components there;
    only pairs that sizes and the long signatures do not rule out leave the join."""
    sizes = members.groupBy("key", "comp").agg(F.count("*").alias("size"))
    largest = sizes.groupBy("key").agg(F.max(F.struct("size", "comp"))["comp"].alias("largest"))
    long = stage(_long_signatures(grams, members.select("id").distinct()), "long")
    placed = stage(
        members.join(largest, "key").join(signed.select("id", "n", "keys"), "id").join(long, "id"), "placed"
    )
    names = ("id", "comp", "n", "sig", "keys")
    left = placed.where("comp <> largest").select("key", *(F.col(c).alias(f"l_{c}") for c in names))
    # Two members outside the largest component meet once.
    once = (F.col("comp") == F.col("largest")) | (F.col("l_id") < F.col("id"))
    likely = estimated(F.col("l_sig"), F.col("sig"), LONG, 1) >= least_estimate(percent, LONG, 1)
    return (
        left.join(placed, "key")
        .where(
            (F.col("l_comp") != F.col("comp"))
            & once
            & _possible("l_n", "n", percent)
            & likely
            & (F.array_intersect("l_keys", "keys")[0] == F.col("key"))
        )
        .select(F.least("id", "l_id").alias("a"), F.greatest("id", "l_id").alias("b"))
        .distinct()
    )


def _links(buckets: DataFrame, signed: DataFrame, grams: DataFrame, percent: int) -> list[DataFrame]:
    """Confirmed links (a, b) that join all nodes of a component. ``buckets``: (key, id)."""
    members, found = buckets.withColumn("comp", F.col("id")), []
    for number in range(ROUNDS + 1):
        members = stage(_mixed(members), "mixed")
        if members.isEmpty():
            break
        if number < ROUNDS:
            pairs = _likely(_pivot_pairs(members, number), signed.select("id", "n", "sig"), percent)
        else:
            pairs = _other_pairs(members, signed, grams, percent)
        links = stage(_confirmed(pairs, grams, percent), "links")
        found.append(links)
        if number < ROUNDS:
            named = members.select("id", "comp").distinct()
            joined = components(
                links.join(named.toDF("a", "p"), "a").join(named.toDF("b", "q"), "b").select(F.col("p").alias("a"), F.col("q").alias("b"))
            )
            members = members.join(joined.toDF("comp", "root"), "comp", "left").select(
                "key", "id", F.coalesce("root", "comp").alias("comp")
            )
    return found


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    width: int = 5,
    percent: int = 85,
) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of each row: of each component the smallest id is kept.

    Two documents link when 100 * shared >= ``percent`` * union of their sets of ``width``-word
    shingles, whole texts of any length included. Documents with equal sets link. Null, empty and
    blank texts have no shingles, link with nothing and are kept. Rows with one id are one document
    whose texts are linked; all are kept or none. A row with a null id has no component and is
    kept. Other columns are not read; an empty table gives no rows.
    """
    rows = docs.select(
        F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text")
    )
    sets = stage(described_sets(rows, width, band_rows(percent)), "sets")
    own = sets.where("n > 0 AND doc_id IS NOT NULL")
    nodes = stage(own.groupBy("digest").agg(F.min("doc_id").alias("node")), "nodes")
    # A set is looked for under one document that has it.
    named = nodes.withColumnRenamed("node", "doc_id")
    keys = own.join(named, ["digest", "doc_id"], "left_semi").select(F.explode("keys").alias("key"), F.col("doc_id").alias("id"))
    met = keys.groupBy("key").agg(F.min("id").alias("lo"), F.max("id").alias("hi")).where("lo <> hi").select("key")
    buckets = stage(keys.join(met, "key").distinct(), "buckets")
    ids = stage(buckets.select("id").distinct(), "ids")
    signed = stage(
        own.select(F.col("doc_id").alias("id"), "n", "sig", "keys").join(ids, "id", "left_semi").dropDuplicates(["id", "sig"]),
        "signed",
    )
    grams = stage(_sets_of(rows.where("doc_id IS NOT NULL"), ids, width), "grams")
    links = _links(buckets, signed, grams, percent)
    # Several sets of one id: the id stands for them all.
    repeated = own.groupBy("doc_id").agg(F.countDistinct("digest").alias("k")).where("k > 1").select("doc_id")
    same_id = (
        own.join(repeated, "doc_id", "left_semi")
        .join(nodes, "digest")
        .where("doc_id <> node")
        .select(F.col("doc_id").alias("a"), F.col("node").alias("b"))
    )
    final = components(reduce(DataFrame.unionByName, [*links, same_id]))
    return (
        sets.select("doc_id", "n", "digest")
        .join(nodes, "digest", "left")
        .withColumn("id", F.when(F.col("n") > 0, F.col("node")).otherwise(F.col("doc_id")))
        .join(final, "id", "left")
        .withColumn("component_id", F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "id")))
        .select(
            "doc_id",
            F.col("n").alias("n_shingles"),
            "component_id",
            F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"),
        )
    )
