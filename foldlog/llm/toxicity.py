"""Toxicity: a support vector machine on a gappy subsequence kernel, with Nyström landmarks.

A string weighs a sequence of ``ORDER`` letters by the sum of decay**span over its occurrences, gaps
included, of a span up to ``SPAN``. The kernel of two strings is the cosine of these weights, so a
string has 1 with itself. An insult with letters put between keeps much of its kernel with the
plain one; marks between letters change nothing, and letters spelt out one by one are one string.

A sentence is a bag of strings, its words between two edges, and the machine's value of a sentence
is that of its strongest string. Sentences of clean documents are clean. A toxic document does not
say which of its sentences is toxic, so the machine is trained in rounds: it names the strongest
sentence of each toxic document, whose string becomes a toxic example, and the strongest strings
of clean sentences become clean ones. Examples are repeated with letters put between.

Landmarks are strings of labelled sentences; the Nyström map (kernel with the landmarks, whitened)
carries a linear machine. Because the kernel is a dot product of sequence weights, the trained
machine folds into one weight per sequence, and scoring takes as long whatever the number of
landmarks.
"""

from __future__ import annotations

import random
import re
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foldlog.llm.common import filter_rows, fold, map_columns
from foldlog.staging import stage

ORDER, SPAN, DECAY = 4, 7, 0.8
#: Letter codes: 1-26, other letters 27-30 by code point, 31 the edge of a word; 0 no letter.
_CODE_BITS = 5
_EDGE = 31
#: Words of more letters are taken in windows of so many, each half in the next.
WINDOW = 24
#: Strings whose value a task remembers, and codes of strings and texts that are worked on at once.
_HELD, _CODES_AT_ONCE, _TEXTS_AT_ONCE = 100_000, 1 << 12, 64
#: Where a sentence ends.
_SENTENCE_END = re.compile(r"(?<=[.!?])\s|\n")

#: Digits and signs that are read as the letter they are written for.
_READ_AS = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s"}


@dataclass(frozen=True)
class ToxicityTraining:
    """Bounds and settings of the fit.

    ``max_labels``: labelled documents of each class, about so many, chosen by a hash of their ids.
    ``max_strings``: different strings of their sentences that reach the driver in each step.
    ``variants``: how often an example is repeated with letters put between.
    """

    max_labels: int = 6_000
    max_strings: int = 3_000
    landmarks: int = 500
    rounds: int = 2
    variants: int = 2
    passes: int = 300
    regularization: float = 3e-4


def _code_table() -> np.ndarray:
    table = np.zeros(0x250, np.uint8)
    for point in range(len(table)):
        c = _READ_AS.get(chr(point), chr(point)).lower()
        if len(c) == 1 and "a" <= c <= "z":
            table[point] = ord(c) - 96
        elif c.isalpha():
            table[point] = 27 + ord(c[0]) % 4
    return table


_TABLE = _code_table()
_WHITE = np.zeros(0x250, bool)
_WHITE[[9, 10, 11, 12, 13, 32]] = True


def strings_of(text: str | None) -> list[bytes]:
    """The letter codes of the words of a text, each between two edges.

    Marks inside a word are left out; single letters in a row, spaced out, are one word. A word of
    more than ``WINDOW`` letters is given in windows of so many, each half in the next.
    """
    points = np.frombuffer((text or "").encode("utf-32-le", "surrogatepass"), "<u4")
    low = points < len(_TABLE)
    at = np.where(low, points, 0)
    code = np.where(low, _TABLE[at], 27 + points % 4).astype(np.uint8)
    white = low & _WHITE[at]
    code[white] = 0
    word = np.cumsum(white)
    keep = code > 0
    code, word = code[keep], word[keep]
    if not len(code):
        return []
    starts = np.flatnonzero(np.concatenate(([True], word[1:] != word[:-1])))
    sizes = np.diff(np.append(starts, len(code)))
    # A word of one letter goes on with the next word if that has one letter as well.
    joined = np.concatenate(([False], (sizes[1:] == 1) & (sizes[:-1] == 1)))
    starts = starts[~joined]
    letters, edge = code.tobytes(), bytes([_EDGE])
    out = []
    for a, b in zip(starts.tolist(), [*starts[1:].tolist(), len(code)]):
        if b - a <= WINDOW:
            out.append(edge + letters[a:b] + edge)
        else:
            step = WINDOW // 2
            out += [edge + letters[k : min(k + WINDOW, b)] + edge for k in range(a, b - step, step)]
    return out


#: For each place of the inner letters of a sequence, the offsets of all its letters.
_SHAPES = [(0, *inner, last) for last in range(ORDER - 1, SPAN) for inner in combinations(range(1, last), ORDER - 2)]
_WEIGHTS = np.array([DECAY ** (shape[-1] + 1) for shape in _SHAPES])
_SHAPE_BITS = len(_SHAPES).bit_length()
_SEQUENCES = 1 << (_CODE_BITS * ORDER)


def sequence_weights(strings: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(string, sequence, weight) of the map of each string, which has length 1.

    A sequence's number is its codes as digits. Occurrences of one sequence in a string are summed
    before its length is taken. A string too short for any sequence has none.
    """
    sizes = np.fromiter(map(len, strings), np.int64, len(strings))
    codes = np.frombuffer(b"".join(strings), np.uint8).astype(np.int64)
    number = np.repeat(np.arange(len(strings)), sizes)
    keys = []
    for k, shape in enumerate(_SHAPES):
        n = len(codes) - shape[-1]
        if n <= 0:
            continue
        digits = np.zeros(n, np.int64)
        for offset in shape:
            digits = digits << _CODE_BITS | codes[offset : offset + n]
        inside = number[:n] == number[shape[-1] :]
        keys.append(((number[:n][inside] << (_CODE_BITS * ORDER) | digits[inside]) << _SHAPE_BITS) | k)
    if not keys:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    key = np.sort(np.concatenate(keys))
    weight = _WEIGHTS[key & ((1 << _SHAPE_BITS) - 1)]
    key >>= _SHAPE_BITS
    first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
    if not len(key):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    weight, key = np.add.reduceat(weight, first), key[first]
    row = key >> (_CODE_BITS * ORDER)
    length = np.sqrt(np.bincount(row, weight**2, minlength=len(strings)))
    return row, key & (_SEQUENCES - 1), weight / length[row]


def kernel_with(strings: list[bytes], landmarks: list[bytes]) -> np.ndarray:
    """The kernel of each string with each landmark."""
    row, col, value = sequence_weights(landmarks)
    out = np.zeros((len(strings), len(landmarks)), np.float32)
    if not len(col):
        return out
    seen, place = np.unique(col, return_inverse=True)
    table = np.zeros((len(seen), len(landmarks)), np.float32)
    table[place, row] = value
    for begin in range(0, len(strings), 200):  # strings at once, to bound memory
        r, c, v = sequence_weights(strings[begin : begin + 200])
        at = np.minimum(np.searchsorted(seen, c), len(seen) - 1)
        shared = np.flatnonzero(seen[at] == c)
        if len(shared):
            r, first = np.unique(r[shared], return_index=True)
            parts = v[shared, None].astype(np.float32) * table[at[shared]]
            out[begin + r] = np.add.reduceat(parts, first, axis=0)
    return out


@dataclass(frozen=True)
class ToxicityModel:
    """One weight per sequence, the machine's shift, and the logistic fit of a document's value."""

    sequences: np.ndarray
    values: np.ndarray
    shift: float
    logistic: tuple[float, float]

    def table(self) -> np.ndarray:
        out = np.zeros(_SEQUENCES, np.float32)
        out[self.sequences] = self.values
        return out


def string_values(strings: list[bytes], table: np.ndarray, shift: float) -> np.ndarray:
    """The machine's value of each string; one without sequences has the shift alone."""
    out = np.full(len(strings), shift)
    begin = 0
    while begin < len(strings):
        end, size = begin, 0
        while end < len(strings) and size < _CODES_AT_ONCE:
            size += len(strings[end])
            end += 1
        row, sequence, weight = sequence_weights(strings[begin:end])
        out[begin:end] += np.bincount(row, weight * table[sequence], minlength=end - begin)
        begin = end
    return out


class Scorer:
    """Values of strings under a model; those of a bounded number of strings are remembered."""

    def __init__(self, model: ToxicityModel):
        self.table, self.shift, self.known = model.table(), model.shift, {}

    def values(self, texts: list[list[bytes]]) -> list[np.ndarray]:
        """The value of each string of each list."""
        if len(self.known) > _HELD:
            self.known.clear()
        new = list({s for own in texts for s in own}.difference(self.known))
        self.known.update(zip(new, string_values(new, self.table, self.shift).tolist()))
        find = self.known.__getitem__
        return [np.fromiter(map(find, own), float, len(own)) for own in texts]


#: Values of documents are kept between this and its opposite; one without letters has it.
_FLOOR = -3.0


def document_values(texts: list[str | None], scorer: Scorer) -> list[tuple[float, bytes | None]]:
    """The value of the strongest string of each text, and that string."""
    out: list[tuple[float, bytes | None]] = []
    for begin in range(0, len(texts), _TEXTS_AT_ONCE):
        bags = [strings_of(text) for text in texts[begin : begin + _TEXTS_AT_ONCE]]
        for own, value in zip(bags, scorer.values(bags)):
            if own:
                at = int(value.argmax())
                out.append((float(np.clip(value[at], _FLOOR, -_FLOOR)), own[at]))
            else:
                out.append((_FLOOR, None))
    return out


def scores_of(texts: list[str | None], model: ToxicityModel, scorer: Scorer | None = None) -> list[float]:
    """Probability that a text is toxic; a text without letters has the lowest value."""
    a, c = model.logistic
    f = np.array([value for value, _ in document_values(texts, scorer or Scorer(model))])
    return (1 / (1 + np.exp(-(a * f + c)))).tolist()


def with_letters_between(string: bytes, rng: random.Random) -> bytes:
    """The string with one to three letters put between its letters, or a letter repeated."""
    out = bytearray(string)
    for _ in range(rng.randint(1, 3)):
        at = rng.randint(2, max(2, len(out) - 2))
        out.insert(at, out[at - 1] if rng.random() < 0.3 else rng.randint(1, 26))
    return bytes(out)


def _spread(own: np.ndarray, most: int) -> np.ndarray:
    """Some of the examples, which come in order of weight: the first ones, and others evenly."""
    first = own[: most // 2]
    rest = own[len(first) :]
    return np.concatenate((first, rest[np.unique(np.linspace(0, max(0, len(rest) - 1), most - len(first)).astype(int))] if len(rest) else rest))


def train_machine(strings: list[bytes], y: np.ndarray, weight: np.ndarray, how: ToxicityTraining) -> tuple:
    """Sequence weights and shift of the support vector machine on labelled strings."""
    half = how.landmarks // 2
    pick = np.concatenate((_spread(np.flatnonzero(y > 0), half), _spread(np.flatnonzero(y < 0), how.landmarks - half)))
    landmarks = [strings[i] for i in pick]
    values, vectors = np.linalg.eigh(kernel_with(landmarks, landmarks))
    good = values > 1e-6 * max(values.max(), 1e-12)
    whiten = vectors[:, good] / np.sqrt(values[good])
    # Single precision, and some rows at a time: this is held by the driver.
    single = whiten.astype(np.float32)
    x1 = np.ones((len(strings), single.shape[1] + 1), np.float32)
    square = np.zeros((x1.shape[1],) * 2)
    for begin in range(0, len(strings), 2_000):
        some = slice(begin, begin + 2_000)
        x1[some, :-1] = kernel_with(strings[some], landmarks) @ single
        square += (x1[some] * weight[some, None].astype(np.float32)).T @ x1[some]
    # Squared hinge loss by accelerated gradient steps, deterministic.
    w = z = np.zeros(x1.shape[1])
    bound = 2 * float(np.linalg.eigvalsh(square)[-1]) + how.regularization
    t = 1.0
    for _ in range(how.passes):
        loss = np.maximum(0, 1 - y * (x1 @ z.astype(np.float32)))
        grad = -2 * ((weight * y * loss).astype(np.float32) @ x1) + how.regularization * z
        nxt = z - grad / bound
        t2 = (1 + np.sqrt(1 + 4 * t * t)) / 2
        z, w, t = nxt + (t - 1) / t2 * (nxt - w), nxt, t2
    row, col, value = sequence_weights(landmarks)
    alpha = whiten @ w[:-1]
    keys, where = np.unique(col, return_inverse=True)
    return keys, np.bincount(where, alpha[row] * value), float(w[-1])


_STRINGS = pa.schema([("string", pa.binary()), ("toxic", pa.int64()), ("clean", pa.int64())])
_VALUES = pa.schema([("value", pa.float64()), ("varied", pa.float64()), ("toxic", pa.int32())])
_STRONGEST = pa.schema([("toxic", pa.int32()), ("string", pa.binary()), ("value", pa.float64())])


def training_rows(
    docs: DataFrame, labels: DataFrame, how: ToxicityTraining, id_col: str, text_col: str
) -> tuple[DataFrame, dict[int, int]]:
    """Texts with labels of the bounded sample, and how many labelled documents each class has.

    Rows of ``labels`` without id or label are no labels; a document with several is toxic if one
    says so; those whose fold (of five) is 0 are never looked at. Copies of a text are one example.
    """
    own = (
        labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
        .where(F.col("toxic").isin(0, 1) & (fold("doc_id", 5) != 0))
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"))
    )
    size = {r.toxic: r["count"] for r in own.groupBy("toxic").count().collect()}
    # A share of the ids by their hashes: no sort, and the same ids whatever the partitions.
    share = [int(min(1.0, how.max_labels / max(size.get(k, 0), 1)) * (1 << 30)) for k in (0, 1)]
    drawn = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30))
    sample = F.broadcast(own.where(drawn < F.when(F.col("toxic") == 1, share[1]).otherwise(share[0])))
    texts = docs.select(
        F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text")
    )
    rows = texts.join(sample, "doc_id").select("text", "toxic")
    rows = rows.withColumn("digest", F.sha2("text", 256)).dropDuplicates(["digest", "toxic"]).drop("digest")
    return stage(rows, "labelled"), size


def _counted(rows: DataFrame) -> DataFrame:
    """Each string of labelled sentences with the numbers of toxic and clean documents that hold it."""

    def count():
        def step(batch):
            held: dict[bytes, list[int]] = {}
            for text, toxic in zip(batch["text"], batch["toxic"]):
                for string in set(strings_of(text)):
                    held.setdefault(string, [0, 0])[toxic] += 1
            return {
                "string": list(held),
                "toxic": [v[1] for v in held.values()],
                "clean": [v[0] for v in held.values()],
            }

        return step

    found = map_columns(rows, count, _STRINGS).where(F.octet_length("string") >= ORDER)
    return stage(found.groupBy("string").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")), "strings")


def _strongest(rows: DataFrame, machine: ToxicityModel, most: int) -> DataFrame:
    """The ``most`` strongest different strings of the strongest sentences of each document: one
    sentence, and so one or more strings, of a toxic document, one string each of clean ones."""

    def make():
        scorer = Scorer(machine)

        def step(batch):
            out = {name: [] for name in _STRONGEST.names}
            for text, toxic in zip(batch["text"], batch["toxic"]):
                bags = [strings_of(s) for s in _SENTENCE_END.split(text or "")]
                found = [(float(v.max()), k) for k, v in enumerate(scorer.values(bags)) if len(v)]
                best: dict[bytes, float] = {}
                for _, k in sorted(found, reverse=True)[:most]:
                    value = scorer.values([bags[k]])[0]
                    at = int(value.argmax())
                    best.setdefault(bags[k][at], float(value[at]))
                out["toxic"] += [toxic] * len(best)
                out["string"] += list(best)
                out["value"] += list(best.values())
            return out

        return step

    return map_columns(rows, make, _STRONGEST)


def _constant(rate: float) -> ToxicityModel:
    """The model without examples of both classes: every text has the rate as its score."""
    logit = float(np.log((rate + 1e-3) / (1 - rate + 1e-3)))
    return ToxicityModel(np.zeros(0, np.int64), np.zeros(0), -1.0, (0.0, logit))


def fit_toxicity(
    docs: DataFrame,
    labels: DataFrame,
    how: ToxicityTraining = ToxicityTraining(),
    id_col: str = "doc_id",
    text_col: str = "text",
) -> ToxicityModel:
    """Fit on sentences of labelled documents outside fold 0 (crc32 of the id modulo 5).

    The first toxic examples are strings that occur in toxic documents far more often than in
    clean ones; then come ``how.rounds`` rounds in which the machine chooses sentences. All counts
    and values are made by Spark; the driver gets strings of bounded number.
    """
    rows, size = training_rows(docs, labels, how, id_col, text_col)
    if not size.get(0) or not size.get(1):
        return _constant(size.get(1, 0) / max(1, sum(size.values())))
    sampled = {r.toxic: r["count"] for r in rows.groupBy("toxic").count().collect()}
    n = {k: sampled.get(k, 0) for k in (0, 1)}
    counted = _counted(rows)
    tells = F.log((F.col("toxic") + 0.5) / (n[1] + 1.0)) - F.log((F.col("clean") + 0.5) / (n[0] + 1.0))
    # How sure the sign is: the log ratio in units of its spread.
    sure = tells / F.sqrt(1 / (F.col("toxic") + 0.5) + 1 / (F.col("clean") + 0.5))
    telling = counted.withColumn("sure", sure).where((F.col("toxic") >= 2) & (F.col("sure") > 2) & (tells > 1.5))
    least = telling.agg(F.percentile_approx("sure", F.lit(max(0.0, 1 - how.max_strings / max(1, telling.count()))), F.lit(10_000))).first()[0]
    positive = {
        bytes(r.string): float(r.toxic)
        for r in telling.where(F.col("sure") >= F.lit(least or 0.0)).orderBy(F.desc("sure"), "string").limit(how.max_strings).collect()
    }
    # Clean examples: a share of the strings of clean documents by their hashes.
    clean = counted.where("clean > 0 AND toxic <= clean")
    share = min(1.0, how.max_strings / max(1, clean.count()))
    negative = {
        bytes(r.string): float(r.clean)
        for r in clean.where(F.pmod(F.xxhash64("string"), F.lit(1 << 30)) < int(share * (1 << 30)))
        .limit(2 * how.max_strings)
        .collect()
    }
    if not positive or not negative:
        return _constant(size[1] / (size[0] + size[1]))
    machine = None
    for again in range(how.rounds + 1):
        machine = _machine(positive, negative, how)
        if again == how.rounds:
            break
        positive, first = {}, positive
        top = _strongest(rows, machine, 3).groupBy("string", "toxic").agg(F.max("value").alias("value"), F.count("*").alias("n"))
        # At most three strings of each document of the sample.
        for r in top.orderBy(F.desc("value"), "string").collect():
            string = bytes(r.string)
            if r.toxic == 0 and string not in first:
                negative[string] = max(negative.get(string, 0.0), 4.0 * r.n)
            elif r.toxic == 1 and r.value > 0 and string not in negative:
                positive[string] = float(r.n)
        positive = positive or first

    def describe():
        scorer, rng = Scorer(machine), random.Random(1)

        def step(batch):
            found = document_values(batch["text"], scorer)
            varied = scorer.values([[with_letters_between(s, rng)] if s else [] for _, s in found])
            return {
                "value": [value for value, _ in found],
                "varied": [float(max(v[0], _FLOOR)) if len(v) else _FLOOR for v in varied],
                "toxic": batch["toxic"],
            }

        return step

    seen = map_columns(rows, describe, _VALUES).collect()  # a row per document of the sample
    shares = {k: size[k] / max(1, n[k]) for k in (0, 1)}
    # A toxic document counts half as it is, and half with letters between those of its string.
    f = [(r.value, r.toxic, shares[r.toxic] / (1 + r.toxic)) for r in seen]
    f += [(min(r.varied, r.value), 1, shares[1] / 2) for r in seen if r.toxic]
    return ToxicityModel(machine.sequences, machine.values, machine.shift, _logistic(*np.array(f, float).T))


def _logistic(x: np.ndarray, toxic: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Slope and shift of the weighted logistic fit of ``toxic`` to ``x``."""
    design, beta = np.stack([x, np.ones(len(x))], axis=1), np.zeros(2)
    for _ in range(60):
        p = 1 / (1 + np.exp(-(design @ beta)))
        h = (design * (weight * p * (1 - p))[:, None]).T @ design + 0.01 * np.eye(2)
        beta += np.clip(np.linalg.solve(h, design.T @ (weight * (toxic - p)) - 0.01 * beta), -1, 1)
    return float(beta[0]), float(beta[1])


def _machine(positive: dict[bytes, float], negative: dict[bytes, float], how: ToxicityTraining) -> ToxicityModel:
    """The machine of these examples and their variants; both classes weigh the same."""
    rng = random.Random(0)
    examples, variants, weights = [], [], []
    for own in (positive, negative):
        strings = sorted(own, key=lambda s: (-own[s], s))
        # A string weighs by the documents that hold it; copies of a template count for less.
        weight = np.sqrt([own[s] for s in strings])
        weights.append(weight / (2 * weight.sum()))
        examples.append(strings)
        variants.append([[with_letters_between(s, rng) for s in strings] for _ in range(how.variants)])
    strings, y, weight = [], [], []
    # Landmarks are chosen from the front: the examples come before their variants.
    for k in range(how.variants + 1):
        for side, own, more, w in zip((1.0, -1.0), examples, variants, weights):
            strings += own if k == 0 else more[k - 1]
            y += [side] * len(own)
            weight += (w if k == 0 else 0.5 * w / how.variants).tolist()
    found = train_machine(strings, np.array(y), np.array(weight) / sum(weight), how)
    return ToxicityModel(*found, (1.0, 0.0))


_SCORES = pa.schema([("doc_id", pa.int64()), ("score", pa.float64())])


def toxicity_scores(
    docs: DataFrame, model: ToxicityModel, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id and score (0 to 1) of each row. Null and empty texts have the score of no strings; a
    null id stays null; repeated rows are scored each; whole texts are read, however long, words of
    more than ``WINDOW`` letters in windows; other columns are not read. An empty table gives no
    rows."""

    def make():
        scorer = Scorer(model)
        return lambda batch: {"doc_id": batch["doc_id"], "score": scores_of(batch["text"], model, scorer)}

    rows = docs.select(
        F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text")
    )
    return map_columns(rows, make, _SCORES)


def drop_toxic(docs: DataFrame, model: ToxicityModel, text_col: str = "text", least: float = 0.5) -> DataFrame:
    """The rows whose score is below ``least``, with all their columns; a null text has the score of
    no strings."""

    def make():
        scorer = Scorer(model)
        return lambda texts: [s < least for s in scores_of(texts, model, scorer)]

    return filter_rows(docs, text_col, make)
