"""Language-model scores from the lattice of subword segmentations.

The pieces are those of an existing vocabulary, and weigh by the scores of its file. The probability
of a word is the sum over all its segmentations, by the forward recursion; words never share a piece,
as only the first piece of a word carries the mark of its start, so the probability of a text is the
product over its words and its end. How often a text ends after a word is counted in the training
documents.

A model that learns more gives each different training word to the recursion and its mirror: the
uses that each piece is expected to have, over all segmentations as the file weighs them, become its
new weight, with the file's weights as a prior. A word then has its discounted share of the training
words, and the lattice gets what the discounts leave; a text draws its words from an urn that holds
these shares, and puts one more of its kind back with each.

Each different word of all documents goes through the recursion once; its value is then joined to
the documents that have it, together with its training count.
"""

from __future__ import annotations

import math
from collections import Counter
from functools import lru_cache

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foldlog.llm.common import map_columns, release_memory
from foldlog.staging import stage

_START = "▁"
_LOG10 = math.log(10)
#: Distinct words that a task holds at once.
_HELD = 200_000
#: Words sent to all workers: the most frequent ones of at most so many bytes each.
HEAD_WORDS, HEAD_BYTES = 100_000, 48
#: A probability below this is computed in log space.
_LEAST = 1e-250
#: Uses that the file's weights count for, as a share of the number of pieces, beside the learnt ones.
_PRIOR = 0.1
#: Words that a text's urn holds at its start. On held-out documents of sf0.1 scores change by
#: less than 1 % between 400 and 1600.
URN_WORDS = 1000.0

_COUNTS = pa.schema([("word", pa.string()), ("n", pa.int64())])
_USES = pa.schema([("piece", pa.int64()), ("uses", pa.float64())])
_VALUED = pa.schema([("word", pa.string()), ("n", pa.int64()), ("value", pa.float64())])


class Lattice:
    """Pieces with log probabilities, and the sums over the segmentations of a word."""

    def __init__(self, names: list[str], weights: list[float]):
        """``names``: pieces, and ``<0xHH>`` for bytes; ``weights``: natural log probabilities."""
        #: Probability, its log, and place of each piece; of a mere beginning of pieces 0.
        self.pieces: dict[str, tuple[float, float, int]] = {}
        self.bytes: dict[int, tuple[float, int]] = {}
        for k, (name, weight) in enumerate(zip(names, weights)):
            if len(name) == 6 and name.startswith("<0x"):
                self.bytes[int(name[3:5], 16)] = weight, k
            else:
                self.pieces[name] = math.exp(weight), weight, k
        for name in list(self.pieces):
            for k in range(1, len(name)):
                self.pieces.setdefault(name[:k], (0.0, -math.inf, -1))

    def arcs(self, text: str) -> list[tuple[int, int, float, int]]:
        """(begin, end, log weight, place of the piece) of all arcs, by where they begin.

        A character that is no piece by itself is spelt by its bytes, and has the place -1.
        """
        out, n, find = [], len(text), self.pieces.get
        for i in range(n):
            found = find(text[i])
            if found is None or not found[0]:
                out.append((i, i + 1, sum(self.bytes[b][0] for b in text[i].encode()), -1))
                if found is None:
                    continue
            else:
                out.append((i, i + 1, *found[1:]))
            for j in range(i + 2, n + 1):
                found = find(text[i:j])
                if found is None:
                    break
                if found[0]:
                    out.append((i, j, *found[1:]))
        return out

    def word_log(self, word: str) -> float:
        """Natural log of the probability of a word: of all ways from its start to its end."""
        text = _START + word
        n, find = len(text), self.pieces.get
        alpha = [1.0] + [0.0] * n
        for i in range(n):
            here = alpha[i]
            if here < _LEAST:
                return _sums(self.arcs(text), n)[-1]
            found = find(text[i])
            if found is None or not found[0]:
                alpha[i + 1] += here * math.exp(sum([self.bytes[b][0] for b in text[i].encode()]))
                if found is None:
                    continue
            else:
                alpha[i + 1] += here * found[0]
            for j in range(i + 2, n + 1):
                found = find(text[i:j])
                if found is None:
                    break
                if found[0]:
                    alpha[j] += here * found[0]
        return math.log(alpha[n]) if alpha[n] >= _LEAST else _sums(self.arcs(text), n)[-1]

    def add_uses(self, word: str, uses: list[float]) -> None:
        """Add to ``uses``, by place, how often each piece is expected in the word."""
        text = _START + word
        n, arcs = len(text), self.arcs(text)
        alpha = [1.0] + [0.0] * n
        shares = [math.exp(w) for _, _, w, _ in arcs]
        for (i, j, _, _), share in zip(arcs, shares):
            alpha[j] += alpha[i] * share
        if min(alpha) < _LEAST:
            ahead = _sums(arcs, n)
            back = _sums([(n - j, n - i, w, k) for i, j, w, k in reversed(arcs)], n)[::-1]
            parts = [math.exp(ahead[i] + w + back[j] - ahead[n]) for i, j, w, _ in arcs]
        else:
            beta, parts = [0.0] * n + [1 / alpha[n]], []
            for (i, j, _, _), share in zip(reversed(arcs), reversed(shares)):
                part = share * beta[j]
                beta[i] += part
                parts.append(alpha[i] * part)
            parts.reverse()
        for (i, _, _, place), part in zip(arcs, parts):
            if place >= 0:
                uses[place] += part
            else:
                for b in text[i].encode():
                    uses[self.bytes[b][1]] += part


def _sums(arcs: list[tuple[int, int, float, int]], n: int) -> list[float]:
    """The forward recursion in log space: to each position the log of the sum over all ways."""
    ending: list[list] = [[] for _ in range(n + 1)]
    for i, j, weight, _ in arcs:
        ending[j].append((i, weight))
    alpha = [0.0]
    for own in ending[1:]:
        terms = [alpha[i] + w for i, w in own]
        top = max(terms)
        alpha.append(top + math.log(sum([math.exp(t - top) for t in terms])))
    return alpha


@lru_cache(maxsize=2)
def _vocabulary(path: str) -> tuple[tuple[str, ...], tuple[float, ...]]:
    """Pieces of a vocabulary file that can stand in a text, and their natural log weights.

    A unigram file scores by natural logs of probabilities, which are taken as they are. In a file
    of merges scores are negative ranks and hold no probabilities; a piece then weighs by its rank,
    as 1 / (rank + 2). Bytes have no scores of their own: they share the weight of the last piece.
    All weights are scaled to add up to 1.
    """
    import sentencepiece

    own = sentencepiece.SentencePieceProcessor(model_file=path)
    names, scores = [], []
    for i in range(own.get_piece_size()):
        if not (own.is_control(i) or own.is_unknown(i) or own.is_unused(i)):
            names.append(own.id_to_piece(i))
            scores.append(None if own.is_byte(i) else own.get_score(i))
    known = [s for s in scores if s is not None]
    ranks = min(known) < -100
    raw = [0.0 if s is None else (1.0 / (2.0 - s) if ranks else math.exp(s)) for s in scores]
    least = min(r for r in raw if r > 0)
    raw = [r or least / 256 for r in raw]
    total = sum(raw)
    return tuple(names), tuple(math.log(r / total) for r in raw)


@lru_cache(maxsize=1)
def vocabulary_lattice(path: str) -> Lattice:
    """The lattice of a vocabulary file, made once by each Python worker."""
    names, weights = _vocabulary(path)
    return Lattice(list(names), list(weights))


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, n): how often each word of the texts occurs in those that are not held out; the empty
    word counts the texts. ``docs``: (text, held_out)."""

    def run(batches):
        held: Counter = Counter()

        def made():
            return pa.RecordBatch.from_arrays(
                [pa.array(list(held), pa.binary()).cast(pa.string()), pa.array(list(held.values()), pa.int64())],
                schema=_COUNTS,
            )

        for batch in batches:
            for text, out in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                own = (text or "").encode().lower().split()
                if out:
                    held.update(dict.fromkeys(own, 0))
                else:
                    held[b""] += 1
                    held.update(own)
                if len(held) >= _HELD:
                    yield made()
                    held.clear()
        if held:
            yield made()

    counted = docs.select("text", "held_out").mapInArrow(run, "word string, n bigint")
    return counted.groupBy("word").agg(F.sum("n").alias("n"))


def learnt_weights(counts: DataFrame, path: str) -> list[float]:
    """Natural log weights of the vocabulary's pieces, learnt from the words with a count.

    Each different word counts once: the lattice is for words that come up for the first time, which
    are like rare words. The driver gets a number per piece.
    """

    def run(batches):
        lattice = vocabulary_lattice(path)
        uses = [0.0] * len(_vocabulary(path)[0])
        for batch in batches:
            for word in batch.column(0).to_pylist():
                lattice.add_uses(word, uses)
        used = [k for k, x in enumerate(uses) if x]
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array([uses[k] for k in used], pa.float64())], schema=_USES)

    words = counts.where("n > 0 AND word <> ''").select("word")
    found = words.mapInArrow(run, "piece bigint, uses double").groupBy("piece").agg(F.sum("uses").alias("uses"))
    uses = {r["piece"]: r["uses"] for r in found.collect()}
    weights = _vocabulary(path)[1]
    raw = [uses.get(k, 0.0) + _PRIOR * len(weights) * math.exp(w) for k, w in enumerate(weights)]
    total = math.fsum(raw)
    return [math.log(x / total) for x in raw]


def valued_words(counts: DataFrame, path: str, weights: list[float] | None = None) -> DataFrame:
    """(word, n, value): ``value`` is the natural log of the word's probability, 0 for the end; with
    the ``weights`` of the vocabulary's file, or these."""
    shared = None if weights is None else counts.sparkSession.sparkContext.broadcast(weights)

    def make():
        if shared is None:
            lattice = vocabulary_lattice(path)
        else:
            lattice = Lattice(list(_vocabulary(path)[0]), shared.value)

        def step(batch):
            values = [lattice.word_log(word) if word else 0.0 for word in batch["word"]]
            return {"word": batch["word"], "n": batch["n"], "value": values}

        return step

    return map_columns(counts, make, _VALUED)


def _drawn(value: float, n: int) -> float:
    """Natural log of drawing a word ``n`` times from the urn, without the sizes of the urn;
    ``value``: log of its share at the start."""
    inside = value + math.log(URN_WORDS)
    if n == 1:
        return inside
    at = math.exp(inside)
    return inside + math.lgamma(at + n) - math.lgamma(at + 1)


def _drawn_column(value, n):
    """The same as a column."""
    inside = value + math.log(URN_WORDS)
    again = F.aggregate(F.sequence(F.lit(1).cast("bigint"), n - 1), F.lit(0.0), lambda sum_, k: sum_ + F.log(F.exp(inside) + k))
    return inside + F.when(n > 1, again).otherwise(0.0)


_SCORED = pa.schema(
    [
        ("row", pa.int64()),
        ("doc_id", pa.int64()),
        ("held_out", pa.bool_()),
        ("n_tokens", pa.int64()),
        ("known", pa.int64()),
        ("logs", pa.float64()),
        ("value", pa.float64()),
        ("rare", pa.list_(pa.struct([("word", pa.string()), ("uses", pa.int64())]))),
    ]
)


def lattice_scores(
    docs: DataFrame, held_out, path: str, id_col: str = "doc_id", text_col: str = "text", learn: bool = False
) -> DataFrame:
    """Scores of all rows; counts are those of the rows for which ``held_out`` is not true.

    A null or empty text is its end alone. A null id stays null and is never held out; repeated
    rows are counted and scored each; whole texts are read, however long; other columns are not
    read; an empty table gives no rows. With no training row every count is 0, and a text ends
    after a word with probability 1/2.

    Without ``learn`` pieces weigh as in the file and only ends are counted. With it the pieces'
    weights and the shares of whole words are learnt as well, from all training rows; ``score`` stays
    the log of a probability that adds up to 1 at most over all texts.

    The most frequent words, a bounded number, go to all workers; the other words, a table that
    grows with the input, are joined to the documents that have them.
    """
    rows = docs.select(
        F.col(id_col).cast("bigint").alias("doc_id"),
        F.col(text_col).cast("string").alias("text"),
        F.coalesce(held_out, F.lit(False)).alias("held_out"),
    )
    counts, weights = word_counts(rows), None
    if learn:
        counts = stage(counts, "counts")
        weights = learnt_weights(counts, path)
    table = stage(valued_words(counts, path, weights), "words")
    sums = table.agg(
        F.coalesce(F.sum(F.when(F.col("word") == "", F.col("n"))), F.lit(0)).alias("ends"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("total"),
        F.count_if(F.col("n") > 0).alias("distinct"),
        F.count_if((F.col("n") > 0) & (F.col("word") != "")).alias("words"),
        F.count_if((F.col("n") == 1) & (F.col("word") != "")).alias("once"),
        F.count_if((F.col("n") == 2) & (F.col("word") != "")).alias("twice"),
    ).first()
    used = sums["total"] - sums["ends"]
    if learn and used:
        # Absolute discounting: what is taken off each different word goes to the lattice.
        off = (sums["once"] + 0.5) / (sums["once"] + 2 * sums["twice"] + 1)
        left = off * sums["words"] / used
        value = F.when(
            F.col("n") > 0, F.log((F.col("n") - off) / used + left * F.exp("value"))
        ).otherwise(F.col("value") + math.log(left))
        table = table.withColumn("value", value)
    short = table.where((F.col("word") != "") & (F.octet_length("word") <= HEAD_BYTES))
    # All words with counts above the one that the word at the head's end has.
    place = max(0.0, 1 - HEAD_WORDS / max(1, short.count()))
    least = short.agg(F.percentile_approx("n", F.lit(place), F.lit(20_000))).first()[0] or 0
    head = {r["word"].encode(): (math.log10(r["n"] + 1), r["value"]) for r in short.where(F.col("n") > least).collect()}
    ends, total, distinct = sums["ends"], sums["total"], sums["distinct"]
    end_share = (ends + 1) / (total + 2)
    goes_on, stops = math.log(1 - end_share), math.log(end_share)
    shared = docs.sparkSession.sparkContext.broadcast(head)

    def run(batches):
        known = shared.value
        end_known, end_log = int(ends > 0), math.log10(ends + 1)
        number = TaskContext.get().partitionId() << 40
        for batch in batches:
            data = batch.to_pydict()
            out = {name: [] for name in _SCORED.names}
            for doc_id, text, held in zip(data["doc_id"], data["text"], data["held_out"]):
                uses = Counter((text or "").encode().lower().split())
                words, seen, base, value, rare = 0, end_known, end_log, 0.0, []
                for word, n in uses.items():
                    words += n
                    own = known.get(word)
                    if own is None:
                        rare.append({"word": word.decode(), "uses": n})
                    else:
                        base += n * own[0]
                        value += _drawn(own[1], n) if learn else n * own[1]
                        seen += n
                if learn:
                    value -= math.lgamma(URN_WORDS + words) - math.lgamma(URN_WORDS)
                row = (number, doc_id, held, words + 1, seen, base, value + words * goes_on + stops, rare)
                for name, x in zip(_SCORED.names, row):
                    out[name].append(x)
                number += 1
            yield pa.RecordBatch.from_pydict(out, schema=_SCORED)
        known = data = out = None
        release_memory()

    scored = stage(
        rows.mapInArrow(
            run,
            "row bigint, doc_id bigint, held_out boolean, n_tokens bigint, known bigint, logs double, "
            "value double, rare array<struct<word:string,uses:bigint>>",
        ),
        "scored",
    )
    tail = table.where((F.col("n") <= least) | (F.octet_length("word") > HEAD_BYTES))
    worth = _drawn_column(F.col("value"), F.col("uses")) if learn else F.col("uses") * F.col("value")
    rest = (
        scored.select("row", F.explode("rare").alias("r"))
        .select("row", F.col("r.word").alias("word"), F.col("r.uses").alias("uses"))
        .join(tail, "word")
        .groupBy("row")
        .agg(
            F.sum(F.when(F.col("n") > 0, F.col("uses"))).alias("uses"),
            F.sum(F.col("uses") * F.log10(F.col("n") + 1)).alias("more"),
            F.sum(worth).alias("worth"),
        )
    )
    room = math.log10(total + distinct + 1)
    return scored.drop("rare").join(rest, "row", "left").select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("known") + F.coalesce("uses", F.lit(0))).alias("n_known"),
        F.lit(total).cast("bigint").alias("train_tokens"),
        (F.col("logs") + F.coalesce("more", F.lit(0.0)) - F.col("n_tokens") * room).alias("base_score"),
        ((F.col("value") + F.coalesce("worth", F.lit(0.0))) / _LOG10).alias("score"),
    )
