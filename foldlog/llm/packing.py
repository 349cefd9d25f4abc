"""Packing token pieces into sequences: first-fit decreasing on a tournament tree.

Documents are cut at multiples of the sequence length. Full pieces are sequences by themselves.
The others are dealt into random groups of bounded size, and each group is packed by itself:
pieces in decreasing length, each into the first bin with room. A tournament tree over the bins
holds the largest room of each subtree, so the first bin is found in logarithmic time.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foldlog.llm.bpe import codec
from foldlog.llm.common import ddl, map_columns
from foldlog.staging import stage

SEQUENCE_TOKENS = 1024
#: Pieces that a group has on average. Padding falls with it, the work of one task grows with it.
GROUP_PIECES = 2048

_PIECES = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("start", pa.int64()),
        ("length", pa.int64()),
        ("ids_crc32", pa.int64()),
        ("doc_tokens", pa.int64()),
    ]
)
_PACKED = pa.schema([*_PIECES, ("sequence_id", pa.int64()), ("offset", pa.int64())])


def first_fit_decreasing(lengths: np.ndarray, room: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each piece. Pieces of one length keep their order."""
    n = len(lengths)
    leaves = 1 << max(0, n - 1).bit_length()
    tree = [room] * (2 * leaves)  # tree[1] is the root; bin b is leaf leaves + b
    bins, offsets = np.zeros(n, np.int64), np.zeros(n, np.int64)
    for i in np.argsort(-lengths, kind="stable").tolist():
        need, node = int(lengths[i]), 1
        while node < leaves:
            node *= 2
            if tree[node] < need:
                node += 1
        bins[i], offsets[i] = node - leaves, room - tree[node]
        tree[node] -= need
        while node > 1:
            node //= 2
            largest = max(tree[2 * node], tree[2 * node + 1])
            if tree[node] == largest:
                break
            tree[node] = largest
    return bins, offsets


def token_pieces(
    docs: DataFrame,
    path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    end_id: int = 0,
    room: int = SEQUENCE_TOKENS,
) -> DataFrame:
    """One row per piece of at most ``room`` ids of each document, its closing ``end_id`` included."""

    def make():
        own = codec(path)

        def step(batch):
            flat, at = own.encode_batch(batch["text"])
            out = {name: [] for name in _PIECES.names}
            for doc_id, a, b in zip(batch["doc_id"], at.tolist(), at[1:].tolist()):
                ids = np.append(flat[a:b], end_id).astype("<u4")
                for start in range(0, len(ids), room):
                    piece = ids[start : start + room]
                    out["doc_id"].append(doc_id)
                    out["start"].append(start)
                    out["length"].append(len(piece))
                    out["ids_crc32"].append(zlib.crc32(piece.tobytes()))
                    out["doc_tokens"].append(len(ids))
            return out

        return step

    rows = docs.select(
        F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text")
    )
    return map_columns(rows, make, _PIECES, done=lambda: codec(path).close())


def pack_pieces(
    pieces: DataFrame, room: int = SEQUENCE_TOKENS, group_pieces: int = GROUP_PIECES, seed: int = 7
) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to pieces of at most ``room`` ids.

    The pieces are written to the shared folder first, with a random number and a row number each:
    a task that runs again reads the same groups. Full pieces get odd sequence ids from their row
    number, packed ones even ids from group and bin. A group of equal documents, or many rows with
    one id, is spread over the groups, as the random number does not depend on the row.
    """
    drawn = stage(
        pieces.withColumn("__draw", F.rand(seed)).withColumn("__row", F.monotonically_increasing_id()),
        "pieces",
    )
    full = F.col("length") >= room
    n = drawn.filter(~full).count()
    groups = max(1, -(-n // group_pieces))
    whole = drawn.filter(full).select(
        *_PIECES.names,
        (F.col("__row") * 2 + 1).alias("sequence_id"),
        F.lit(0).cast("bigint").alias("offset"),
    )

    def pack(table: pa.Table) -> pa.Table:
        table = table.sort_by([("length", "descending"), ("__row", "ascending")])
        bins, offsets = first_fit_decreasing(table.column("length").to_numpy(), room)
        group = table.column("__group")[0].as_py()
        return table.select(_PIECES.names).append_column(
            "sequence_id", pa.array(((group << 31) + bins) * 2)
        ).append_column("offset", pa.array(offsets))

    packed = (
        drawn.filter(~full)
        .withColumn("__group", F.floor(F.col("__draw") * groups).cast("bigint"))
        .groupBy("__group")
        .applyInArrow(pack, ddl(_PACKED))
    )
    return whole.unionByName(packed)


def packed_documents(
    docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Pieces of all documents with their places in sequences of at most 1024 ids.

    Every row of ``docs`` is one document: a null or empty text has the closing id alone, a null
    id stays null, repeated rows are packed each. Other columns are not read. An empty table gives
    no rows.
    """
    return pack_pieces(token_pieces(docs, path, id_col, text_col))
