"""N-gram Jaccard join with signature trees: exact links, reported as components.

A document is the set of its different word shingles. Documents with equal sets are one node. Two
sets with enough in common must share one of their rarest shingles (prefix filter), so nodes meet
by shingle; shingles that only one node has drop out before anything else is done.

Among the nodes that meet at a shingle, links are looked for in two steps. First each node is
compared with the smallest node there, which joins most copies into components. Then a signature
tree is built over the nodes of each shingle that still has several components: its nodes hold the
OR of the bitmaps below, the range of set sizes, and the component if there is only one. A dual
traversal drops pairs of tree nodes whose greatest possible overlap is too small, or which are of
one component, so thousands of copies are not paired with each other. What is left is compared
exactly. Links inside a component that is known already change nothing and are left out.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from foldlog.llm.common import map_columns, mix64
from foldlog.llm.graph import components
from foldlog.staging import stage, stage_from

SIGNATURE_BITS = 1024
#: Members of a leaf of the tree; nodes that one task pairs at one shingle at most.
LEAF, BLOCK = 8, 1024
#: Bits of the filter on documents that are compared; a document that passes by chance costs only time.
_FILTER_BITS = 1 << 25
_HELD = 200_000


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        self[word] = value = xxhash.xxh3_64_intdigest(word)
        return value


def shingle_sets(texts: list[str | None], width: int, hashes: _WordHashes) -> list[np.ndarray]:
    """The sorted different shingle hashes of each text.

    A text of fewer than ``width`` words has its whole sequence as one shingle, without words none.
    """
    if len(hashes) > _HELD:
        hashes.clear()
    step, out = np.uint64(0x9E3779B97F4A7C15), []
    for text in texts:
        own = (text or "").encode().lower().split()
        n = len(own)
        if not n:
            out.append(np.zeros(0, np.uint64))
            continue
        h = np.fromiter(map(hashes.__getitem__, own), np.uint64, n)
        wide = min(n, width)
        value = np.full(n - wide + 1, wide, np.uint64)
        for k in range(wide):
            value = value * step + h[k : n - wide + 1 + k]
        out.append(np.unique(mix64(value)))
    return out


def least_overlap(size: int, percent: int) -> int:
    """Shingles that a set of so many shares with any set it links to, at least."""
    return -(-percent * size // 100)


def linked(a: int, b: int, shared: int, percent: int) -> bool:
    return 100 * shared >= percent * (a + b - shared)


def signature(hashes: np.ndarray) -> bytes:
    bits = np.zeros(SIGNATURE_BITS, np.uint8)
    bits[(hashes >> np.uint64(20)).astype(np.int64) % SIGNATURE_BITS] = 1
    return np.packbits(bits).tobytes()


_SETS = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("n", pa.int64()),
        ("digest", pa.binary()),
        ("sig", pa.binary()),
        ("n0", pa.int32()),
        ("kept", pa.list_(pa.int64())),
    ]
)
_GRAMS = pa.schema([("id", pa.int64()), ("grams", pa.binary())])
_PAIRS = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def _first_layer(percent: int) -> int:
    """Shingles with hashes below this come first in the order of the prefix filter: with 85 per
    cent a quarter of them, so that a prefix lies in the first layer with some choice."""
    return min((1 << 63) - 1, (1 << 64) * (100 - percent) * 5 // 300)


def described_sets(rows: DataFrame, width: int, percent: int) -> DataFrame:
    """Per row: size and digest of the set, its bitmap, and the hashes that can be in its prefix.

    The order of the prefix filter is: first layer before the rest, then rare before frequent, then
    by hash. Only hashes of the first layer are kept, or all where these are fewer than the prefix.
    """
    bound = np.uint64(_first_layer(percent))

    def make():
        hashes = _WordHashes()

        def step(batch):
            out = {name: [] for name in _SETS.names}
            for doc_id, own in zip(batch["doc_id"], shingle_sets(batch["text"], width, hashes)):
                n = len(own)
                n0 = int(np.searchsorted(own, bound))
                prefix = n - least_overlap(n, percent) + 1
                kept = own[:n0] if n0 >= prefix else own
                out["doc_id"].append(doc_id)
                out["n"].append(n)
                out["digest"].append(hashlib.blake2b(own.tobytes(), digest_size=16).digest())
                out["sig"].append(signature(own))
                out["n0"].append(n0)
                out["kept"].append(kept.view(np.int64))
            return out

        return step

    return map_columns(rows, make, _SETS)


def prefix_rows(sets: DataFrame, percent: int) -> DataFrame:
    """(token, id, n): the prefixes of all nodes, without tokens that only one node has."""
    nodes = sets.where("n > 0 AND doc_id IS NOT NULL").groupBy("digest").agg(
        F.min_by(F.struct("doc_id", "n", "n0", "kept"), "doc_id").alias("r")
    )
    tokens = nodes.select(
        F.explode("r.kept").alias("token"),
        F.col("r.doc_id").alias("id"),
        F.col("r.n").cast("int").alias("n"),
        F.col("r.n0").alias("n0"),
        F.size("r.kept").alias("nk"),
    )
    shared = tokens.groupBy("token").agg(F.count("*").alias("df")).where("df > 1")
    rows = stage(tokens.join(shared, "token"), "shared")
    first = (F.col("token") >= 0) & (F.col("token") < _first_layer(percent))
    own = Window.partitionBy("id", "layer")
    least = F.ceil(F.col("n") * percent / 100).cast("bigint")
    least = F.when((least - 1) * 100 >= F.col("n") * percent, least - 1).otherwise(least)
    # Tokens of this node alone are the rarest, so they come before all others of their layer.
    before = F.when(F.col("layer") == 0, F.col("n0")).otherwise(F.col("nk"))
    place = before - F.count("*").over(own) + F.row_number().over(own.orderBy("df", "token"))
    return (
        rows.withColumn("layer", F.when(first, 0).otherwise(1))
        .withColumn("place", place)
        .where(F.col("place") <= F.col("n") - least + 1)
        .select("token", "id", "n")
    )


class _Tree:
    """A signature tree over members (id, size, bitmap as an integer, component)."""

    def __init__(self, members: list[tuple[int, int, int, int]]):
        members = sorted(members, key=lambda m: (m[3], m[1], m[0]))
        level = []
        for i in range(0, len(members), LEAF):
            own = members[i : i + LEAF]
            bits = 0
            for m in own:
                bits |= m[2]
            sizes = [m[1] for m in own]
            level.append(
                (bits, min(sizes), max(sizes), max(m[1] - m[2].bit_count() for m in own),
                 own[0][3] if own[0][3] == own[-1][3] else None, None, own)
            )
        while len(level) > 1:
            level = [self._over(level[i : i + 4]) for i in range(0, len(level), 4)]
        self.root = level[0]

    @staticmethod
    def _over(below: list) -> tuple:
        bits = 0
        for x in below:
            bits |= x[0]
        same = {x[4] for x in below}
        return (
            bits, min(x[1] for x in below), max(x[2] for x in below), max(x[3] for x in below),
            same.pop() if len(same) == 1 else None, below, None,
        )


def tree_pairs(left: _Tree, right: _Tree, percent: int):
    """Pairs of members of different components that can link, by a dual traversal."""
    stack = [(left.root, right.root)]
    while stack:
        x, y = stack.pop()
        if x[4] is not None and x[4] == y[4]:
            continue
        if percent * x[1] > 100 * y[2] or percent * y[1] > 100 * x[2]:
            continue
        # A member has at most (size - bits) shingles on bits that it has set twice or more, and
        # at most one on each bit that both sides have.
        both = (x[0] & y[0]).bit_count()
        most = min(x[2], y[2], x[3] + both, y[3] + both)
        if (100 + percent) * most < percent * (x[1] + y[1]):
            continue
        if x[6] is not None and y[6] is not None:
            for a, na, sa, ca in x[6]:
                for b, nb, sb, cb in y[6]:
                    if ca == cb or (x is y and a >= b):
                        continue
                    both = (sa & sb).bit_count()
                    most = min(na - sa.bit_count() + both, nb - sb.bit_count() + both, na, nb)
                    if (100 + percent) * most >= percent * (na + nb):
                        yield (a, b) if a < b else (b, a)
        elif x is y:
            below = x[5]
            stack.extend((below[i], below[j]) for i in range(len(below)) for j in range(i, len(below)))
        else:
            xs, ys = x[5] or [x], y[5] or [y]
            stack.extend((i, j) for i in xs for j in ys)


def _tree_candidates(mixed: DataFrame, percent: int) -> DataFrame:
    """Pairs that survive the trees. ``mixed``: (token, members, id, n, sig, comp).

    A token with more than ``BLOCK`` members is dealt over pairs of blocks, each in its own group.
    """
    blocks = F.ceil(F.col("members") / BLOCK).cast("int")
    dealt = (
        mixed.withColumn("blocks", blocks)
        .withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select(
            "token",
            F.least("block", "other").alias("i"),
            F.greatest("block", "other").alias("j"),
            "block",
            "id",
            "n",
            "sig",
            "comp",
        )
        .repartition("token", "i", "j")
        .sortWithinPartitions("token", "i", "j")
    )

    def run(batches):
        key, own, seen, out = None, ([], []), set(), []

        def close():
            left, right = own
            if left and (right or key[1] == key[2]):
                tree = _Tree(left)
                for pair in tree_pairs(tree, tree if key[1] == key[2] else _Tree(right), percent):
                    if pair not in seen:
                        seen.add(pair)
                        out.append(pair)

        def made():
            batch = pa.RecordBatch.from_arrays(
                [pa.array([p[k] for p in out], pa.int64()) for k in (0, 1)], schema=_PAIRS
            )
            out.clear()
            return batch

        for batch in batches:
            data = batch.to_pydict()
            for *now, block, id_, n, sig, comp in zip(*(data[name] for name in batch.schema.names)):
                if now != key:
                    if key is not None:
                        close()
                    key, own = now, ([], [])
                own[block != now[1]].append((id_, n, int.from_bytes(sig, "big"), comp))
            if len(out) > 10_000:
                yield made()
                if len(seen) > 1_000_000:
                    seen.clear()
        if key is not None:
            close()
        yield made()

    return dealt.mapInArrow(run, "a bigint, b bigint").distinct()


def _grams_of(rows: DataFrame, ids: DataFrame, width: int) -> DataFrame:
    """The sets of the documents in ``ids``, and of a few others. The filter is a bitmap of fixed
    size on hashes of ids, which is sent to all workers: texts need not be shuffled."""
    spot = F.pmod(F.xxhash64("id"), F.lit(_FILTER_BITS)) + 1
    found = (
        ids.select(spot.alias("spot"))
        .groupBy(F.bitmap_bucket_number("spot").alias("bucket"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("spot")).alias("bits"))
        .collect()
    )
    bits = bytearray(_FILTER_BITS // 8)
    for r in found:  # buckets count from 1
        start = (r.bucket - 1) * len(r.bits)
        bits[start : start + len(r.bits)] = r.bits
    shared = rows.sparkSession.sparkContext.broadcast(bytes(bits))
    marked = rows.select(
        "doc_id", "text", F.pmod(F.xxhash64("doc_id"), F.lit(_FILTER_BITS)).alias("spot")
    ).where("doc_id IS NOT NULL")

    def make():
        held, hashes = shared.value, _WordHashes()

        def step(batch):
            keep = [k for k, s in enumerate(batch["spot"]) if held[s >> 3] >> (s & 7) & 1]
            sets = shingle_sets([batch["text"][k] for k in keep], width, hashes)
            return {"id": [batch["doc_id"][k] for k in keep], "grams": [s.tobytes() for s in sets]}

        return step

    return map_columns(marked, make, _GRAMS)


def _verified(pairs: DataFrame, grams: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose sets link, compared exactly."""

    def make():
        def step(batch):
            out = {"a": [], "b": []}
            for a, b, ga, gb in zip(batch["a"], batch["b"], batch["ga"], batch["gb"]):
                x, y = np.frombuffer(ga, np.uint64), np.frombuffer(gb, np.uint64)
                both = np.concatenate((x, y))
                both.sort()
                shared = int((both[1:] == both[:-1]).sum())
                if linked(len(x), len(y), shared, percent):
                    out["a"].append(a)
                    out["b"].append(b)
            return out

        return step

    first = grams.toDF("a", "ga")
    second = grams.toDF("b", "gb")
    return map_columns(pairs.join(first, "a").join(second, "b").select("a", "b", "ga", "gb"), make, _PAIRS)


def jaccard_components(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    width: int = 4,
    percent: int = 85,
) -> DataFrame:
    """doc_id, n_shingles, component_id of each row: the smallest id that links lead to.

    Two documents link when 100 * shared >= ``percent`` * union of their shingle sets. Documents
    with equal sets link. Null, empty and blank texts have no shingles and link with nothing. Rows
    with one id are one document: its sets are linked. A row with a null id has no component.
    Other columns are not read; an empty table gives no rows.
    """
    rows = docs.select(
        F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text")
    )
    sets = stage(described_sets(rows, width, percent), "sets")

    def meeting() -> DataFrame:
        prefixes = stage(prefix_rows(sets, percent), "prefixes")
        met = prefixes.groupBy("token").agg(F.count("*").alias("members"), F.min("id").alias("a")).where("members > 1")
        return prefixes.join(met, "token")

    here = stage_from(docs.sparkSession, meeting, "met")
    grams = stage(_grams_of(rows, here.select("id").distinct(), width), "grams")
    stars = stage(
        here.where("a <> id").select("a", F.col("id").alias("b")).distinct(), "stars"
    )
    links = stage(_verified(stars, grams, percent), "links")
    known = components(links)
    placed = here.join(known, "id", "left").withColumn("comp", F.coalesce("component", "id"))
    mixed = (
        placed.groupBy("token")
        .agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"))
        .where("lo <> hi")
        .select("token")
    )
    signatures = sets.where("n > 0").groupBy(F.col("doc_id").alias("id")).agg(F.first("sig").alias("sig"))
    several = (
        placed.join(mixed, "token")
        .join(signatures, "id")
        .select("token", "members", "id", F.col("n").cast("bigint").alias("n"), "sig", "comp")
    )
    more = _verified(
        _tree_candidates(several, percent).join(stars, ["a", "b"], "left_anti"), grams, percent
    )
    all_links = links.unionByName(more)
    nodes = sets.where("n > 0 AND doc_id IS NOT NULL").groupBy("digest").agg(F.min("doc_id").alias("node"))
    # Several sets of one id: the id stands for them all.
    same_id = sets.where("n > 0").join(nodes, "digest").where("doc_id <> node").select(
        F.col("doc_id").alias("a"), F.col("node").alias("b")
    )
    repeated = sets.where("n > 0").groupBy("doc_id").agg(F.countDistinct("digest").alias("k")).where("k > 1")
    same_id = same_id.join(repeated.select(F.col("doc_id").alias("a")), "a", "left_semi")
    final = components(all_links.unionByName(same_id))
    return (
        sets.select("doc_id", "n", "digest")
        .join(nodes, "digest", "left")
        .withColumn("id", F.when(F.col("n") > 0, F.col("node")).otherwise(F.col("doc_id")))
        .join(final, "id", "left")
        .select(
            "doc_id",
            F.col("n").alias("n_shingles"),
            F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "id")).alias("component_id"),
        )
    )


def keep_one_of_each(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5, percent: int = 80
) -> DataFrame:
    """Of each component the rows of its smallest id, with all their columns.

    Rows that link with nothing stay, also those without id. Ids that go are joined to the rows.
    """
    found = jaccard_components(docs, id_col, text_col, width, percent)
    gone = found.where("component_id <> doc_id").select(F.col("doc_id").alias(id_col)).distinct()
    return docs.join(gone, id_col, "left_anti")
