"""Byte-pair encoding and decoding with the contiguous rank array, for existing vocabularies.

A short word is held as the array of its parts and the array of the ranks of adjacent parts. The
smallest rank is looked for, the boundary there is deleted, both arrays close up, and the two
ranks beside it are refreshed, until no rank is left. Words of about one length are worked on
together as rows of a matrix. A long word would make these scans quadratic, so it goes through a
heap of ranks instead, with the same result.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Iterable
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, types as T
from pyspark.sql import functions as F

from foldlog.llm.common import RELEASE_EVERY, release_memory

#: Unicode's White_Space, and the pattern that cuts text before the merges.
_SPACE = r"\t-\r \x85\xa0  -     　"
PATTERN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+"
    rf"| ?[^{_SPACE}\p{{L}}\p{{N}}]+|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]+"
)

_NO_PAIR = np.int64(1) << 62
_ID_BITS = 32
_SPREAD, _UINT64 = 0x9E3779B97F4A7C15, (1 << 64) - 1
_LONGEST_ROW = 64
#: Bytes of pieces, with what a table of Python takes for each, that a codec remembers in a task.
_CACHED_BYTES, _PIECE_BYTES = 48 << 20, 200


def printable_bytes() -> list[str]:
    """The character that stands for each byte in the vocabulary file.

    Bytes that are visible Latin-1 characters stand for themselves, the others, in order, for the
    characters from 256 on.
    """
    visible = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = iter(range(256, 512))
    return [chr(b) if b in visible else chr(next(hidden)) for b in range(256)]


class _Pairs:
    """Finds rank and result of a pair of ids: an open-addressing table on arrays."""

    _BITS = 19

    def __init__(self, pairs: dict[tuple[int, int], tuple[int, int]]):
        bits = max(self._BITS, (4 * len(pairs)).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.keys = np.full(1 << bits, -1, np.int64)
        self.values = np.full(1 << bits, _NO_PAIR, np.int64)
        keys = np.array([a << _ID_BITS | b for a, b in pairs], np.int64)
        values = np.array([rank << _ID_BITS | made for rank, made in pairs.values()], np.int64)
        slots, left = self._slot(keys), np.arange(len(keys))
        self.probes = 1
        while len(left):
            # Of the keys that want one free slot the last written stays; the others move on.
            free = self.keys[slots[left]] < 0
            self.keys[slots[left[free]]] = keys[left[free]]
            stays = self.keys[slots[left]] == keys[left]
            self.values[slots[left[stays]]] = values[left[stays]]
            left = left[~stays]
            slots[left] = (slots[left] + 1) & self.mask
            self.probes += bool(len(left))
        self._keys, self._values = memoryview(self.keys), memoryview(self.values)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        spread = keys.astype(np.uint64) * np.uint64(_SPREAD)
        return (spread >> self.shift).astype(np.int64)

    def find(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """rank << 32 | id of the merged part for each pair; a large number where none is."""
        shape, left, right = left.shape, left.ravel(), right.ravel()
        keys = (left.astype(np.int64) << _ID_BITS) | right
        keys[(left < 0) | (right < 0)] = -2
        slots = self._slot(keys)
        out = np.where(self.keys[slots] == keys, self.values[slots], _NO_PAIR)
        look = np.flatnonzero((self.keys[slots] != keys) & (self.keys[slots] >= 0) & (keys >= 0))
        for _ in range(self.probes - 1):
            if not len(look):
                break
            slots[look] = (slots[look] + 1) & self.mask
            at = self.keys[slots[look]]
            hit = at == keys[look]
            out[look[hit]] = self.values[slots[look[hit]]]
            look = look[~hit & (at >= 0)]
        return out.reshape(shape)

    def get(self, left: int, right: int) -> tuple[int, int] | None:
        """Rank and merged id of one pair of ids, read from the same table."""
        key = left << _ID_BITS | right
        slot = (key * _SPREAD & _UINT64) >> int(self.shift)
        while (at := self._keys[slot]) != key:
            if at < 0:
                return None
            slot = (slot + 1) & self.mask
        return divmod(self._values[slot], 1 << _ID_BITS)


class _Pieces(dict):
    """Pieces of text seen so far, numbered in order, with their ids in one array."""

    def __init__(self):
        super().__init__()
        self.new: list[str | int] = []
        self.flat = np.zeros(0, np.int32)
        self.starts = np.zeros(0, np.int64)
        self.counts = np.zeros(0, np.int64)
        self.uses = np.zeros(0, np.int64)
        self.size = 0

    def __missing__(self, key):
        self[key] = number = len(self)
        self.new.append(key)
        self.size += _PIECE_BYTES + (2 * len(key) if isinstance(key, str) else 0)
        return number

    def append(self, flat: np.ndarray, counts: np.ndarray) -> None:
        """Note the ids of the new pieces."""
        starts = len(self.flat) + np.cumsum(counts) - counts
        self.flat = np.concatenate((self.flat, flat.astype(np.int32)))
        self.starts = np.concatenate((self.starts, starts))
        self.counts = np.concatenate((self.counts, counts))
        self.uses = np.concatenate((self.uses, np.zeros(len(counts), np.int64)))
        self.new = []

    def count(self, used: np.ndarray) -> None:
        self.uses += np.bincount(used, minlength=len(self.uses))

    def forget(self) -> None:
        """Keep the pieces used most, an eighth of the room at most and no long ones; the others are
        encoded again."""
        room = _CACHED_BYTES // (8 * _PIECE_BYTES)
        least = max(2, int(np.sort(self.uses)[-room])) if len(self) > room else 2
        keep = np.flatnonzero(self.uses > least)
        keys = list(self)
        keep = keep[[isinstance(keys[i], int) or len(keys[i]) <= _LONGEST_ROW for i in keep.tolist()]]
        kept = [keys[i] for i in keep.tolist()]
        counts, starts = self.counts[keep], self.starts[keep]
        ends = np.cumsum(counts)
        total = int(ends[-1]) if len(ends) else 0
        flat = self.flat[np.repeat(starts - (ends - counts), counts) + np.arange(total)]
        self.clear()
        self.__init__()
        for key in kept:
            self[key]
        self.append(flat, counts)


class BytePairCodec:
    """Encodes and decodes texts as the vocabulary file of a byte-level tokenizer says."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        vocab, merges = spec["model"]["vocab"], spec["model"]["merges"]
        shown = printable_bytes()
        self.byte_ids = np.array([vocab[c] for c in shown], np.int64)
        pairs: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, merge in enumerate(merges):
            a, b = merge.split(" ") if isinstance(merge, str) else merge
            pairs.setdefault((vocab[a], vocab[b]), (rank, vocab[a + b]))
        self.pairs = _Pairs(pairs)
        value = {c: b for b, c in enumerate(shown)}
        special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        size = 1 + max([*vocab.values(), *special.values()])
        self.part_bytes: list[bytes] = [b""] * size
        for token, i in vocab.items():
            self.part_bytes[i] = bytes(value[c] for c in token)
        for token, i in special.items():
            self.part_bytes[i] = token.encode()
        self.special = special
        self._special = (
            regex.compile("(" + "|".join(map(regex.escape, sorted(special, key=len, reverse=True))) + ")")
            if special
            else None
        )
        self._cut = regex.compile(PATTERN)
        self._plain = regex.compile(rf" (?=[^{_SPACE}])")
        spaces = [chr(c) for c in range(0x3001) if chr(c) != " " and regex.match(f"[{_SPACE}]", chr(c))]
        self._odd = ["  ", *(" " + c for c in spaces)]
        self._pieces = _Pieces()

    def encode_batch(self, texts: Iterable[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts one after the other, and the position where each text begins,
        with the total last; a null text has no ids."""
        if self._pieces.size > _CACHED_BYTES:
            self._pieces.forget()
        number = self._pieces.__getitem__
        numbers, sizes = [], []
        for text in texts:
            own = list(map(number, self._cut_text(text))) if text else []
            numbers.extend(own)
            sizes.append(len(own))
        self._learn()
        used = np.array(numbers, np.int64)
        self._pieces.count(used)
        counts = self._pieces.counts[used]
        ends = np.cumsum(counts)
        total = int(ends[-1]) if len(ends) else 0
        shift = self._pieces.starts[used] - (ends - counts)
        flat = self._pieces.flat[np.repeat(shift, counts) + np.arange(total)]
        return flat, np.concatenate(([0], ends))[np.concatenate(([0], np.cumsum(sizes)))]

    def close(self) -> None:
        """Give back the memory of pieces: a worker outlives its task, other stages follow."""
        self._pieces = _Pieces()

    def decode(self, ids: Iterable[int]) -> str:
        return b"".join(map(self.part_bytes.__getitem__, ids)).decode("utf-8", "replace")

    def _cut_text(self, text: str) -> list[str | int]:
        """Keys of pieces: ids of special tokens; a piece at a start, behind a space; the other
        pieces, which stand after a space, without it."""
        if self._special is None or "<" not in text:
            return self._cut_plain(text)
        out: list[str | int] = []
        for k, part in enumerate(self._special.split(text)):
            if k % 2:
                out.append(self.special[part])
            elif part:
                out.extend(self._cut_plain(part))
        return out

    def _cut_plain(self, text: str) -> list[str]:
        # A space before a visible character always begins a new part; other spaces may not.
        odd = text[-1] == " " or any(map(text.__contains__, self._odd))
        pieces = self._plain.split(text) if odd else text.split(" ")
        pieces[0] = " " + pieces[0]
        return pieces

    def _learn(self) -> None:
        """Encode the pieces that have come up for the first time."""
        texts, cuts, words = [], [], []
        for key in self._pieces.new:
            if isinstance(key, int):
                texts.append(None)
            else:
                texts.append(key[1:] if key[:1] == " " else " " + key)
        for text in texts:
            if text is None:
                cut = []
            elif text[1:].isalpha() and (text[0] == " " or text[0].isalpha()):
                cut = [text.encode()]
            else:
                cut = [w.encode() for w in self._cut.findall(text)]
            words.extend(cut)
            cuts.append(len(cut))
        flat, counts = self.encode_words(words)
        ends = np.concatenate(([0], np.cumsum(counts)))
        at = np.concatenate(([0], np.cumsum(np.array(cuts, np.int64))))
        made = ends[at[1:]] - ends[at[:-1]]
        for k, key in enumerate(self._pieces.new):
            if isinstance(key, int):
                flat = np.insert(flat, int(made[:k].sum()), key)
                made[k] = 1
        self._pieces.append(flat, made)

    def encode_words(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the words one after the other, and how many each has."""
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        data = self.byte_ids[np.frombuffer(b"".join(words), np.uint8)]
        starts = np.cumsum(sizes) - sizes
        counts = np.zeros(len(words), np.int64)
        found: list[tuple[np.ndarray, np.ndarray]] = []
        widths = np.minimum((sizes + 3) // 4 * 4, _LONGEST_ROW + 1)
        for width in np.unique(widths).tolist():
            members = np.flatnonzero(widths == width)
            if width > _LONGEST_ROW:
                for i in members.tolist():
                    ids = self._merge_long(data[starts[i] : starts[i] + sizes[i]].tolist())
                    counts[i] = len(ids)
                    found.append((np.array([i]), np.array(ids, np.int64)))
                continue
            cols = np.arange(width)
            inside = cols < sizes[members, None]
            parts = self._merge_rows(
                np.where(inside, data[np.where(inside, starts[members, None] + cols, 0)], -1)
            )
            counts[members] = (parts >= 0).sum(1)
            found.append((members, parts[parts >= 0]))
        ends = np.cumsum(counts)
        flat = np.zeros(int(ends[-1]) if len(ends) else 0, np.int64)
        for members, ids in found:
            own = counts[members]
            shift = (ends - counts)[members] - (np.cumsum(own) - own)
            flat[np.repeat(shift, own) + np.arange(len(ids))] = ids
        return flat, counts

    def _merge_rows(self, ids: np.ndarray) -> np.ndarray:
        """The parts left of each row of bytes' ids, closed up to the left, then -1."""
        out, width = ids.copy(), ids.shape[1]
        cols = np.arange(width)
        live = np.arange(len(ids))
        # One column more than pairs, always without a pair, so that argmin has a column.
        ranks = np.full(ids.shape, _NO_PAIR)
        ranks[:, :-1] = self.pairs.find(ids[:, :-1], ids[:, 1:])
        while True:
            at = ranks.argmin(1)
            best = ranks[np.arange(len(ranks)), at]
            go = best < _NO_PAIR
            if not go.all():
                out[live[~go]] = ids[~go]
                live, ids, ranks, at, best = live[go], ids[go], ranks[go], at[go], best[go]
            if not len(live):
                return out
            row = np.arange(len(live))
            closing = cols[:-1] > at[:, None]
            ids[:, :-1] = np.where(closing, ids[:, 1:], ids[:, :-1])
            ids[:, -1] = -1
            ids[row, at] = best & ((1 << _ID_BITS) - 1)
            ranks[:, :-1] = np.where(closing, ranks[:, 1:], ranks[:, :-1])
            ranks[:, -1] = _NO_PAIR
            nxt = np.minimum(at + 1, width - 1)
            ranks[row, at] = np.where(at + 1 < width, self.pairs.find(ids[row, at], ids[row, nxt]), _NO_PAIR)
            some = at > 0
            before = at[some] - 1
            ranks[row[some], before] = self.pairs.find(ids[row[some], before], ids[row[some], at[some]])

    def _merge_long(self, ids: list[int]) -> list[int]:
        """The same merges for a long word: parts as a linked list, ranks in a heap."""
        n = len(ids)
        nxt, prev = [*range(1, n), -1], [-1, *range(n - 1)]
        heap: list[tuple[int, int, int, int, int]] = []

        def offer(i: int) -> None:
            if i >= 0 and nxt[i] >= 0 and (found := self.pairs.get(ids[i], ids[nxt[i]])):
                heapq.heappush(heap, (found[0], i, ids[i], ids[nxt[i]], found[1]))

        for i in range(n - 1):
            offer(i)
        while heap:
            _, i, a, b, made = heapq.heappop(heap)
            j = nxt[i]
            if ids[i] != a or j < 0 or ids[j] != b:
                continue
            ids[i], ids[j] = made, -1
            nxt[i] = nxt[j]
            if nxt[j] >= 0:
                prev[nxt[j]] = i
            nxt[j] = -1
            offer(prev[i])
            offer(i)
        return [x for x in ids if x >= 0]


@lru_cache(maxsize=2)
def codec(path: str) -> BytePairCodec:
    """The codec of a file, read once by each Python worker."""
    return BytePairCodec(path)


def _with_column(df: DataFrame, source: str, name: str, kind: T.DataType, path: str, make) -> DataFrame:
    """Add a column made of another one by ``make(codec)``."""
    if name in df.columns:
        raise ValueError(f"the rows have a column {name!r} already")

    def run(batches):
        own = codec(path)
        step = make(own)
        for k, batch in enumerate(batches):
            if k and not k % RELEASE_EVERY:
                release_memory()
            column = step(batch.column(batch.schema.get_field_index(source)))
            yield pa.RecordBatch.from_arrays([*batch.columns, column], names=[*batch.schema.names, name])
        own.close()
        batch = column = None
        release_memory()

    return df.mapInArrow(run, T.StructType([*df.schema.fields, T.StructField(name, kind)]))


def encode_texts(df: DataFrame, path: str, text_col: str = "text", ids_col: str = "ids") -> DataFrame:
    """Add the token ids of each whole text as ``array<int>``; a null or empty text has none.

    ``path`` names the vocabulary file, which every worker can open (it comes with a package).
    Strings of special tokens in a text become their ids. All rows and columns stay; a column
    named ``ids_col`` is refused.
    """

    def make(own: BytePairCodec):
        def step(texts: pa.Array) -> pa.Array:
            values, offsets = own.encode_batch(texts.to_pylist())
            return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values))

        return step

    return _with_column(df, text_col, ids_col, T.ArrayType(T.IntegerType()), path, make)


def decode_ids(df: DataFrame, path: str, ids_col: str = "ids", text_col: str = "decoded") -> DataFrame:
    """Add the text of each row's ids, special tokens included; null ids give an empty text.

    Bytes that are no UTF-8 become U+FFFD. All rows and columns stay; ``text_col`` must be new.
    """

    def make(own: BytePairCodec):
        def step(ids: pa.Array) -> pa.Array:
            # Python's integers of one row at a time: they take many times what Arrow's do.
            flat, at = ids.values.to_numpy(zero_copy_only=False), ids.offsets.to_pylist()
            there = ids.is_valid().to_pylist()
            rows = (flat[i:j].tolist() if x else () for i, j, x in zip(at, at[1:], there))
            return pa.array(map(own.decode, rows), pa.string())

        return step

    return _with_column(df, ids_col, text_col, T.StringType(), path, make)


def round_trip_digests(
    docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id, n_tokens, and digests of the ids and of the text decoded from them, per row."""
    rows = docs.select(
        F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text")
    )
    ids = encode_texts(rows, path).drop("text")
    return decode_ids(ids, path).select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
