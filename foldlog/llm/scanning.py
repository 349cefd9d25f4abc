"""Ranked lexical search by scanning documents with an Aho-Corasick automaton.

There is no index of documents. The terms of the items are one automaton, in which each term stands
between two boundary marks. A document is brought into the same form: letters A-Z are lowered and
every character that belongs to no term becomes a boundary. So the automaton finds whole terms only,
all of them in one pass, and the counts of its outputs are the term frequencies.

The documents are scanned twice: one scan counts documents and terms, one scores. A task keeps the
best documents of each item that it has met; those meet in a ranking by item. Items are dealt into
blocks of bounded size, each with an automaton and two scans of its own.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from operator import itemgetter

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from foldlog.llm.common import ddl, release_memory
from foldlog.staging import stage

#: ASCII characters of terms, beside all characters from U+0080 on.
_TERM_ASCII = b"0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
_TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_MARK = b" "
_FORM = bytes(
    c + 32 if 65 <= c <= 90 else c if c >= 128 or c in _TERM_ASCII else _MARK[0] for c in range(256)
)
#: Pairs of item and term, and items, of one block; a single item is never split.
PAIRS, ITEMS = 200_000, 4_096
#: Stand for the sums of all documents among the numbers of terms.
_DOCUMENTS, _TERMS = -1, -2


def scanned_form(text: str | None) -> bytes:
    """A text as terms between boundary marks, in UTF-8. A term may stand next to several marks."""
    return _MARK + (text or "").encode("utf-8", "surrogatepass").translate(_FORM) + _MARK


def count_terms(form: bytes) -> int:
    """Terms in a scanned form, with repeats."""
    marks = np.frombuffer(form, np.uint8) == _MARK[0]
    return int(np.count_nonzero(marks[:-1] & ~marks[1:]))


def lowered_terms(text: Column) -> Column:
    """The terms of a text, A-Z lowered, in order and with repeats."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return F.regexp_extract_all(F.translate(text, upper, lower), F.lit(f"({_TERM})"), F.lit(1))


@dataclass
class ItemBlock:
    """Some items and their terms: ``places`` and ``starts`` list the items of each term."""

    items: list
    terms: list[str]
    starts: np.ndarray
    places: np.ndarray

    @classmethod
    def of(cls, pairs: list[tuple]) -> ItemBlock:
        items = {item: k for k, item in enumerate(dict.fromkeys(item for item, _ in pairs))}
        by_term: dict[str, list[int]] = {}
        for item, term in pairs:
            by_term.setdefault(term, []).append(items[item])
        starts = np.cumsum([0, *map(len, by_term.values())])
        places = np.array([k for own in by_term.values() for k in own], np.int64)
        return cls(list(items), list(by_term), starts, places)

    def automaton(self) -> ahocorasick.Automaton:
        """Its outputs are numbers of terms. Bytes are read as characters of one byte each."""
        found = ahocorasick.Automaton()
        for number, term in enumerate(self.terms):
            found.add_word((_MARK + term.encode("utf-8", "surrogatepass") + _MARK).decode("latin-1"), number)
        if self.terms:
            found.make_automaton()
        return found


def frequencies(automaton: ahocorasick.Automaton, form: bytes) -> Counter:
    """Occurrences of each term of the automaton in a scanned form."""
    return Counter(map(itemgetter(1), automaton.iter(form.decode("latin-1")))) if len(automaton) else Counter()


def staged_terms(items: DataFrame, id_col: str, text_col: str, pairs: int, most: int) -> tuple[DataFrame, int]:
    """(item_id, term, block) of all items, written, and the number of blocks."""
    terms = stage(
        items.where(F.col(id_col).isNotNull())
        .select(F.col(id_col).alias("item_id"), F.explode(lowered_terms(F.col(text_col))).alias("term"))
        .distinct(),
        "terms",
    )
    size = terms.agg(F.count("*").alias("pairs"), F.approx_count_distinct("item_id").alias("items")).first()
    blocks = max(1, math.ceil(size["pairs"] / pairs), math.ceil(size["items"] / most))
    return terms.withColumn("block", F.pmod(F.xxhash64("item_id"), F.lit(blocks))), blocks


def corpus_counts(texts: DataFrame, block: ItemBlock) -> tuple[int, int, np.ndarray]:
    """(documents with a term, all terms, documents that hold each term of the block).

    A task sends a row per term of the block and two for the sums, of which the driver gets one each.
    """
    schema = pa.schema([("term", pa.int64()), ("n", pa.int64())])
    held = texts.sparkSession.sparkContext.broadcast(block)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton, holding = held.value.automaton(), Counter()
        for batch in batches:
            for text in batch.column(0).to_pylist():
                form = scanned_form(text)
                n = count_terms(form)
                holding[_TERMS] += n
                holding[_DOCUMENTS] += n > 0
                holding.update(frequencies(automaton, form).keys())
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(holding.keys()), pa.int64()), pa.array(list(holding.values()), pa.int64())], schema=schema
        )
        automaton = holding = None
        release_memory()

    seen = texts.mapInArrow(run, ddl(schema)).groupBy("term").agg(F.sum("n").alias("n")).collect()
    counts = {r["term"]: r["n"] for r in seen}
    df = np.array([counts.get(term, 0) for term in range(len(block.terms))], np.int64)
    return counts.get(_DOCUMENTS, 0), counts.get(_TERMS, 0), df


def term_weights(documents: int, df: np.ndarray) -> np.ndarray:
    return np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * n + 1))) for n in df.tolist()], np.int64)


class BestOfItems:
    """The ``most`` best documents of each item so far; equal scores by ascending id, null ids last."""

    def __init__(self, items: int, most: int):
        self.most, self.held = most, 0
        self.least = np.zeros(items, np.int64)
        self.parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    def add(self, scores: np.ndarray, ids: np.ndarray) -> None:
        """``scores``: documents by items, 0 for none; a document that ties the last one may still count."""
        rows, items = np.nonzero((scores > 0) & (scores >= self.least))
        self.parts.append((items, scores[rows, items], ids[rows]))
        self.held += len(rows)
        if self.held > 4 * self.most * len(self.least):
            self.best()

    def best(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(item, score, document id), cut to the best; what is kept becomes the only part."""
        if not self.parts:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, object)
        items, scores, ids = (np.concatenate(x) for x in zip(*self.parts))
        order = np.lexsort((_id_order(ids), -scores, items))
        items, scores, ids = items[order], scores[order], ids[order]
        first = np.searchsorted(items, np.arange(len(self.least)))
        keep = np.arange(len(items)) - first[items] < self.most
        last = np.flatnonzero(np.arange(len(items)) - first[items] == self.most - 1)
        self.least[items[last]] = scores[last]
        self.parts = [(items[keep], scores[keep], ids[keep])]
        self.held = int(keep.sum())
        return self.parts[0]


def _id_order(ids: np.ndarray) -> np.ndarray:
    """Places of ids in ascending order, None last."""
    known = {x: k for k, x in enumerate(sorted({x for x in ids.tolist() if x is not None}))}
    return np.array([known.get(x, len(known)) for x in ids.tolist()], np.int64)


def document_scores(
    block: ItemBlock, weights: np.ndarray, counted: list[Counter], sizes: list[int], documents: int, total: int
) -> np.ndarray:
    """Scores of some documents (their counts by term and numbers of terms) for all items of a block."""
    row = np.repeat(np.arange(len(counted)), [len(c) for c in counted])
    term = np.array([t for c in counted for t in c], np.int64)
    tf = np.array([n for c in counted for n in c.values()], np.int64)
    m = np.array([50 + 50 * n * documents // total if total else 50 for n in sizes], np.int64)
    value = weights[term] * (1_000_000_000 * tf // (1000 * tf + 20 * m[row])) if len(term) else tf
    many = block.starts[term + 1] - block.starts[term]
    # Each count is handed to all items of its term.
    before = np.cumsum(many) - many
    place = block.places[np.arange(many.sum()) + np.repeat(block.starts[term] - before, many)]
    out = np.zeros((len(counted), len(block.items)), np.int64)
    np.add.at(out, (np.repeat(row, many), place), np.repeat(value, many))
    return out


def _best_in_block(texts: DataFrame, block: ItemBlock, item_type: str, most: int) -> DataFrame:
    """item_id, rank, doc_id and score for the items of one block, after two scans of the texts."""
    spark = texts.sparkSession
    documents, total, df = corpus_counts(texts.select("text"), block)
    held = spark.sparkContext.broadcast((block, term_weights(documents, df)))
    schema = pa.schema([("item", pa.int32()), ("doc_id", pa.int64()), ("score", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, weights = held.value
        automaton, best = block.automaton(), BestOfItems(len(block.items), most)
        for batch in batches:
            forms = [scanned_form(text) for text in batch.column(0).to_pylist()]
            sizes = [count_terms(form) for form in forms]
            counted = [frequencies(automaton, form) for form in forms]
            ids = np.array([*batch.column(1).to_pylist(), None], object)[:-1]
            best.add(document_scores(block, weights, counted, sizes, documents, total), ids)
        found, scores, ids = best.best()
        yield pa.RecordBatch.from_arrays(
            [pa.array(found, pa.int32()), pa.array(ids.tolist(), pa.int64()), pa.array(scores, pa.int64())],
            schema=schema,
        )
        automaton = best = None
        release_memory()

    place = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = (
        texts.mapInArrow(run, ddl(schema)).withColumn("rank", F.row_number().over(place)).where(F.col("rank") <= most)
    )
    names = spark.createDataFrame(list(enumerate(block.items)), f"item int, item_id {item_type}")
    # A block has a bounded number of items.
    return ranked.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score")


def ranked_search(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    most: int = 50,
    pairs: int = PAIRS,
    block_items: int = ITEMS,
) -> DataFrame:
    """item_id, rank, doc_id, score: the ``most`` best documents with a score above 0 for each item.

    Every row of ``docs`` is a document of its own and every row is scanned, whole, however long.
    Null and empty texts have no terms and are not counted. Rows of equal score are in ascending
    order of id, a null id last; rows of one id and score are alike. Rows of ``items`` with one id
    are one item; a null id is no item, and an item without terms has no rows. Empty tables give
    none. Other columns are not read.

    Items are taken in blocks of about ``pairs`` terms and ``block_items`` items, one after the
    other, so neither the driver nor a task ever holds more than one block.
    """
    spark = docs.sparkSession
    item_type = items.schema[item_col].dataType.simpleString()
    texts = docs.select(F.col(text_col).cast("string").alias("text"), F.col(id_col).cast("bigint").alias("doc_id"))
    terms, blocks = staged_terms(items, item_col, item_text_col, pairs, block_items)
    found = []
    for k in range(blocks):
        rows = terms.where(F.col("block") == k).orderBy("item_id", "term").collect()
        if rows:
            block = ItemBlock.of([(r["item_id"], r["term"]) for r in rows])
            best = _best_in_block(texts, block, item_type, most)
            found.append(stage(best, "ranked") if blocks > 1 else best)
    none = spark.createDataFrame([], f"item_id {item_type}, rank int, doc_id bigint, score bigint")
    return reduce(DataFrame.unionByName, found) if found else none


#: The same ranking in SQL.
SEARCH_SQL = f"""WITH words AS MATERIALIZED (
  SELECT doc_id, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{_TERM}')) AS term FROM documents),
sizes AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM words GROUP BY doc_id),
totals AS (SELECT count(*) AS documents, CAST(sum(n) AS BIGINT) AS total FROM sizes),
wanted AS MATERIALIZED (SELECT DISTINCT item_id, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{_TERM}')) AS term FROM benchmark),
counts AS MATERIALIZED (SELECT doc_id, term, count(*) AS tf FROM words SEMI JOIN wanted USING (term) GROUP BY doc_id, term),
weights AS (SELECT term, CAST(floor(1000 * ln((2 * any_value(documents) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
  FROM counts, totals GROUP BY term),
parts AS (SELECT doc_id, term,
    w * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + (50 * n * documents) // total))) AS part
  FROM counts JOIN weights USING (term) JOIN sizes USING (doc_id), totals),
scores AS (SELECT item_id, doc_id, CAST(sum(part) AS BIGINT) AS score
  FROM wanted JOIN parts USING (term) GROUP BY item_id, doc_id)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM scores WHERE score > 0)
WHERE rank <= 50"""
