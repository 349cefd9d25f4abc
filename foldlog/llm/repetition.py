"""Quality rule on repetition inside one document, from a suffix array over its words.

Neighbours in the suffix array share prefixes; the longest common prefix (LCP) of a suffix with
either neighbour is the depth of the deepest LCP interval that holds it, hence the longest
substring from that word on which occurs twice or more in the document. Occurrences that are not
the tail of a longer repeated one (left-maximal) are the maximal repeats; the union of their
spans is the covered part of the text.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foldlog.llm.common import WORD_SPACE, filter_rows, map_columns, words

#: The characters counted as symbols.
SYMBOLS = "#*$%&|<>"

#: Documents are worked on together up to so many words; a longer one alone.
_WORDS_AT_ONCE = 1 << 17


@dataclass(frozen=True)
class RepetitionLimits:
    """What the rule allows.

    ``min_words``: fewer words are rejected. ``window``: the window of the base count and the
    shortest repeat that counts. ``max_window_percent``: highest share of words in windows found
    twice or more. ``max_covered``: highest share of words in maximal repeats. ``max_longest``:
    the longest repeat allowed, as a share of the document's words, once it has
    ``longest_words`` words: a long text may quote one of its own sentences, but not half of itself.
    """

    min_words: int = 20
    window: int = 8
    max_window_percent: int = 30
    max_covered: float = 0.25
    max_longest: float = 0.2
    longest_words: int = 50


PRODUCTION = RepetitionLimits()


class _Numbering(dict):
    """Numbers keys from 1 in order of appearance."""

    def __missing__(self, key):
        self[key] = number = len(self) + 1
        return number


def repeat_lengths(ids: np.ndarray, ends: np.ndarray, shortest: int) -> np.ndarray:
    """For each word, the length of the longest repeat of its document that starts there.

    ``ids`` are the words of several documents one after the other, numbered from 1; ``ends`` has
    for each word the position after its document. Lengths below ``shortest`` are given as 0.
    """
    n = len(ids)
    length = np.zeros(n, np.int64)
    if n == 0:
        return length
    # Prefix doubling: levels[k] ranks words by their next 2**k words, within their document.
    # Only words whose rank is shared go on to the next level. Ranks are slots of the final order.
    levels = [ids.astype(np.int64)]
    rank = np.zeros(n, np.int64)
    active = np.arange(n)
    key = ends * (int(ids.max()) + 1) + ids
    step, candidates = 1, None
    while True:
        order = np.argsort(key, kind="stable")
        active, key = active[order], key[order]
        base = rank[active]
        fresh = np.empty(len(key), bool)
        fresh[0] = True
        np.not_equal(key[1:], key[:-1], out=fresh[1:])
        old = np.empty(len(key), bool)
        old[0] = True
        np.not_equal(base[1:], base[:-1], out=old[1:])
        place = np.arange(len(key))
        slot = base + place - np.maximum.accumulate(np.where(old, place, 0))
        rank = rank.copy()
        rank[active] = slot[np.maximum.accumulate(np.where(fresh, place, 0))]
        if step > 1:
            levels.append(rank + 1)
        single = fresh.copy()
        single[:-1] &= fresh[1:]
        active = active[~single]
        if step * 2 > shortest and candidates is None:
            candidates = active
        if not len(active):
            break
        if step == 1:
            levels[0] = rank + 1
        nxt = active + step
        inside = nxt < ends[active]
        follow = np.where(inside, rank[np.where(inside, nxt, 0)] + 1, 0)
        key = rank[active] * (n + 1) + follow
        step *= 2
    if candidates is None or len(candidates) < 2:
        return length
    in_order = candidates[np.argsort(rank[candidates])]
    left, right = in_order[:-1], in_order[1:]
    same = ends[left] == ends[right]
    left, right, end = left[same], right[same], ends[left[same]]
    a, b = left.copy(), right.copy()
    common = np.zeros(len(a), np.int64)
    for k in range(len(levels) - 1, -1, -1):
        width = 1 << k
        fits = (a + width <= end) & (b + width <= end)
        equal = fits & (levels[k][np.where(fits, a, 0)] == levels[k][np.where(fits, b, 0)])
        a, b, common = a + equal * width, b + equal * width, common + equal * width
    np.maximum.at(length, left, common)
    np.maximum.at(length, right, common)
    length[length < shortest] = 0
    return length


def covered_words(length: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per document: words in the union of maximal repeats, longest repeat, number of maximal ones.

    ``starts`` are the positions at which the documents begin, all of them with words.
    """
    n = len(length)
    first = np.zeros(n, bool)
    first[starts] = True
    before = np.concatenate(([0], length[:-1]))
    maximal = (length > 0) & (first | (before != length + 1))
    at = np.flatnonzero(maximal)
    change = np.zeros(n + 1, np.int64)
    np.add.at(change, at, 1)
    np.add.at(change, at + length[at], -1)
    inside = (np.cumsum(change)[:-1] > 0).astype(np.int64)
    return (
        np.add.reduceat(inside, starts),
        np.maximum.reduceat(length, starts),
        np.add.reduceat(maximal.astype(np.int64), starts),
    )


def repetition_of(tokens: list[list[bytes]], shortest: int) -> list[tuple[int, int, int]]:
    """(covered words, longest repeat, maximal repeats) of each document, given its words."""
    out: list[tuple[int, int, int]] = [(0, 0, 0)] * len(tokens)
    group: list[int] = []
    held = 0

    def flush() -> None:
        number = _Numbering()
        sizes = np.array([len(tokens[i]) for i in group])
        ids = np.fromiter(
            (x for i in group for x in map(number.__getitem__, tokens[i])), np.int64, int(sizes.sum())
        )
        ends = np.cumsum(sizes)
        length = repeat_lengths(ids, np.repeat(ends, sizes), shortest)
        for i, *found in zip(group, *(x.tolist() for x in covered_words(length, ends - sizes))):
            out[i] = tuple(found)

    for i, own in enumerate(tokens):
        if not own:
            continue
        if group and held + len(own) > _WORDS_AT_ONCE:
            flush()
            group, held = [], 0
        group.append(i)
        held += len(own)
    if group:
        flush()
    return out


def measure(texts: list[str | None], limits: RepetitionLimits = PRODUCTION) -> dict[str, list]:
    """All counts and the verdict for each text; a null text has no words and is rejected."""
    tokens = [words(text) for text in texts]
    found = repetition_of(tokens, limits.window)
    out: dict[str, list] = {field.name: [] for field in MEASURES}
    for text, own, (covered, longest, repeats) in zip(texts, tokens, found):
        text, n = text or "", len(own)
        lines = [line for line in text.split("\n") if line.strip(WORD_SPACE)] if n else []
        # A window found twice starts a repeat of at least its length, so the union of windows
        # found twice and the union of the maximal repeats hold the same words.
        failed = n < limits.min_words or 100 * covered > limits.max_window_percent * n
        long = longest >= limits.longest_words and longest > limits.max_longest * n
        out["n_words"].append(n)
        out["word_chars"].append(len(text) - sum(map(text.count, WORD_SPACE)))
        out["n_symbols"].append(sum(map(text.count, SYMBOLS)))
        out["n_dup_lines"].append(len(lines) - len(set(lines)))
        out["n_repeat_words"].append(covered)
        out["base_failed"].append(failed)
        out["kept"].append(not failed and covered <= limits.max_covered * n and not long)
        out["longest_repeat"].append(longest)
        out["n_maximal_repeats"].append(repeats)
    return out


MEASURES = pa.schema(
    [
        ("n_words", pa.int64()),
        ("word_chars", pa.int64()),
        ("n_symbols", pa.int64()),
        ("n_dup_lines", pa.int64()),
        ("n_repeat_words", pa.int64()),
        ("base_failed", pa.bool_()),
        ("kept", pa.bool_()),
        ("longest_repeat", pa.int64()),
        ("n_maximal_repeats", pa.int64()),
    ]
)


def repetition_measures(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", limits: RepetitionLimits = PRODUCTION
) -> DataFrame:
    """One row per input row: its id, the counts and the verdict ``kept``.

    Nulls: a null text counts as empty and is rejected (too few words); a null id stays null.
    Repeated rows are measured each. Other columns, whatever their names, are not read. An empty
    table gives no rows. A text of any length is one suffix array, in memory linear in its words.
    """
    schema = pa.schema([pa.field("doc_id", pa.int64()), *MEASURES])

    def make():
        return lambda batch: {"doc_id": batch["doc_id"], **measure(batch["text"], limits)}

    rows = docs.select(
        F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text")
    )
    return map_columns(rows, make, schema)


def keep_unrepetitive(
    docs: DataFrame, text_col: str = "text", limits: RepetitionLimits = PRODUCTION
) -> DataFrame:
    """The rows whose text passes, with all their columns."""
    return filter_rows(docs, text_col, lambda: lambda texts: measure(texts, limits)["kept"])
