"""Lempel-Ziv fingerprints: minimum hashes of the set of phrases of the LZ78 parse of a text.

The parse cuts a text into phrases: each is the shortest prefix of what is left that is not yet in
the dictionary, and joins it. Texts that would compress each other share phrases.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foldlog.llm.common import ddl, mix64

#: Hashes that a fingerprint keeps: the smallest ones, as 32-bit numbers.
FINGERPRINT_HASHES = 128

_BASE = 0x9E3779B97F4A7C15  # odd, so that it has an inverse modulo 2**64
_INVERSE = pow(_BASE, -1, 1 << 64)


@lru_cache(maxsize=4)
def _powers(base: int, size: int) -> np.ndarray:
    steps = np.full(size, base, np.uint64)
    steps[0] = 1
    return np.cumprod(steps)


def _power(base: int, size: int) -> np.ndarray:
    return _powers(base, max(1 << 14, 1 << size.bit_length()))[:size]


def parse(text: str, seen: set[str]) -> list[str]:
    """Phrases of ``text``, which are added to ``seen``; a rest that is in ``seen`` is no phrase.

    Every prefix of a phrase in the dictionary is there too, so the shortest new one can be looked
    for from the length of the phrase before it, up or down.
    """
    phrases: list[str] = []
    new, add = phrases.append, seen.add
    at, size, n = 0, 1, len(text)
    while at < n:
        end = at + size
        phrase = text[at:end]
        if phrase in seen:
            while phrase in seen:
                if end >= n:
                    return phrases
                end += 1
                phrase = text[at:end]
        else:
            if end > n:
                end = n
            while end - at > 1:
                shorter = text[at : end - 1]
                if shorter in seen:
                    break
                phrase = shorter
                end -= 1
        add(phrase)
        new(phrase)
        size = end - at
        at = end
    return phrases


def phrase_hashes(phrases: list[str]) -> np.ndarray:
    """A 64-bit hash of each phrase, from running sums over their code points."""
    if not phrases:
        return np.zeros(0, np.uint64)
    points = np.frombuffer("".join(phrases).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum((points + np.uint64(1)) * _power(_BASE, len(points)))))
    sizes = np.fromiter(map(len, phrases), np.int64, len(phrases))
    ends = np.cumsum(sizes)
    starts = ends - sizes
    own = (sums[ends] - sums[starts]) * _power(_INVERSE, len(points) + 1)[starts]
    return mix64(own + sizes.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def smallest(hashes: np.ndarray, k: int = FINGERPRINT_HASHES) -> np.ndarray:
    """The ``k`` smallest different values, in order, as 32-bit numbers."""
    if len(hashes) > k:
        hashes = np.partition(hashes, k - 1)[:k]
    return np.unique((hashes >> np.uint64(32)).astype(np.uint32))


def likeness(a: np.ndarray, b: np.ndarray, k: int = FINGERPRINT_HASHES) -> float:
    """Estimated Jaccard similarity of the phrase sets: the share of both among the smallest of
    either. Two empty fingerprints are alike (1), an empty and another one are not (0)."""
    if not len(a) and not len(b):
        return 1.0
    both = np.concatenate((a, b))
    both.sort()
    first = np.concatenate(([True], both[1:] != both[:-1]))
    twice = ~first
    union = int(first.sum())
    if union > k:
        last = np.flatnonzero(first)[k]
        return float(twice[:last].sum() / k)
    return float(twice.sum() / union)


def to_hex(fingerprint: np.ndarray) -> str:
    return fingerprint.astype(">u4").tobytes().hex()


class _Document:
    def __init__(self, doc_id: int | None, text: str):
        self.doc_id, self.text = doc_id, text
        self.phrases = parse(text, set())
        self.hashes = phrase_hashes(self.phrases)
        self.fingerprint = smallest(self.hashes)

    def edited(self, other: str) -> tuple[str, np.ndarray]:
        """The text with its last half replaced from ``other``, and its fingerprint. The parse of
        the first half is that of the own text; it goes on from the phrase at the cut."""
        half = len(self.text) // 2
        cut = len(self.text) - half
        text = self.text[:cut] + other[:half]
        ends = np.cumsum(np.fromiter(map(len, self.phrases), np.int64, len(self.phrases)))
        same = int(np.searchsorted(ends, cut, side="right"))
        at = int(ends[same - 1]) if same else 0
        rest = parse(text[at:], set(self.phrases[:same]))
        return text, smallest(np.concatenate((self.hashes[:same], phrase_hashes(rest))))


_FOUND = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("n_chars", pa.int64()),
        ("edited_sha256", pa.string()),
        ("fingerprint", pa.string()),
        ("edited_fingerprint", pa.string()),
        ("near_edited", pa.float64()),
        ("near_next", pa.float64()),
    ]
)


def _compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come by block and key; the last row of each block is the first of the block after it."""
    held: tuple[int, _Document] | None = None
    for batch in batches:
        rows = batch.to_pydict()
        out: dict[str, list] = {name: [] for name in _FOUND.names}
        for block, borrowed, doc_id, text in zip(
            rows["__block"], rows["__borrowed"], rows["doc_id"], rows["text"]
        ):
            if held is None and borrowed:
                continue
            here = _Document(doc_id, text or "")
            if held is not None and held[0] == block:
                own = held[1]
                edited, print_ = own.edited(here.text)
                for name, value in zip(
                    _FOUND.names,
                    (
                        own.doc_id,
                        len(own.text),
                        hashlib.sha256(edited.encode()).hexdigest(),
                        to_hex(own.fingerprint),
                        to_hex(print_),
                        likeness(own.fingerprint, print_),
                        likeness(own.fingerprint, here.fingerprint),
                    ),
                ):
                    out[name].append(value)
            held = None if borrowed else (block, here)
        yield pa.RecordBatch.from_pydict(out, schema=_FOUND)


def fingerprint_column(df: DataFrame, text_col: str = "text", out_col: str = "fingerprint") -> DataFrame:
    """Add the fingerprint of each text as hex; null and empty texts have the empty one."""

    @F.pandas_udf("string")
    def printed(texts):
        return texts.map(lambda t: to_hex(smallest(phrase_hashes(parse(t or "", set())))))

    return df.withColumn(out_col, printed(F.col(text_col).cast("string")))


def neighbour_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each document's fingerprint, and its likeness to an edited copy and to the next document.

    The next document is the one after it by id (equal ids: by text; a null id comes first); the
    last one is followed by the first. Null texts count as empty. An only document follows itself.
    Other columns are not read; an empty table gives no rows.

    Rows are dealt once, into blocks of neighbouring ids. A block gets a copy of the first row of
    the block after it, so no window holds more than a block. The bounds of the blocks are
    quantiles of the ids: as many as there are shuffle partitions times four.
    """
    spark = docs.sparkSession
    key = F.coalesce(F.col("doc_id"), F.lit(-(1 << 63)))
    rows = docs.select(
        F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text")
    ).withColumn("__key", key)
    blocks = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    shares = F.array(*[F.lit(k / blocks) for k in range(1, blocks)])
    bounds = rows.select(F.percentile_approx("__key", shares, F.lit(20 * blocks))).first()[0]
    bounds = sorted(set(bounds or []))
    block = F.size(F.filter(F.array(*[F.lit(b).cast("bigint") for b in bounds]), lambda b: b <= F.col("__key")))
    rows = rows.withColumn("__block", block if bounds else F.lit(0))
    # At most one row for each block.
    firsts = [tuple(r) for r in rows.groupBy("__block").agg(F.min("__key")).orderBy("__block").collect()]
    first: list[int | None] = [None] * (len(bounds) + 1)
    to = [0] * (len(bounds) + 1)
    for i, (own, key_of_first) in enumerate(firsts):
        first[own], to[own] = key_of_first, firsts[i - 1][0]
    place = F.col("__block") + 1
    first_key = F.element_at(F.array(*[F.lit(k).cast("bigint") for k in first]), place)
    borrower = F.when(
        F.col("__key") == first_key, F.element_at(F.array(*[F.lit(k) for k in to]), place)
    )
    dealt = (
        rows.withColumn("__to", borrower)
        .select(
            "doc_id",
            "text",
            "__key",
            F.explode(
                F.when(
                    F.col("__to").isNull(),
                    F.array(F.struct(F.col("__block").alias("block"), F.lit(False).alias("borrowed"))),
                ).otherwise(
                    F.array(
                        F.struct(F.col("__block").alias("block"), F.lit(False).alias("borrowed")),
                        F.struct(F.col("__to").alias("block"), F.lit(True).alias("borrowed")),
                    )
                )
            ).alias("__at"),
        )
        .select("doc_id", "text", "__key", F.col("__at.block").alias("__block"), F.col("__at.borrowed").alias("__borrowed"))
        .repartition("__block")
        .sortWithinPartitions("__block", "__borrowed", "__key", F.coalesce("text", F.lit("")))
        .select("__block", "__borrowed", "doc_id", "text")
    )
    return dealt.mapInArrow(_compared, ddl(_FOUND))
