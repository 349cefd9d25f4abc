"""Personal data: proposed spans, judged by boosted trees with calibrated thresholds.

Generators propose overlapping spans with high recall: strict ones (the base) and loose ones, for
e-mail addresses written out, numbers without a plus sign, bracketed dots, and for secrets: long
runs of letters and digits, which may be passwords, tokens or keys, or nothing at all. Boosted trees
judge each loose proposal by its format and by the text around it; a logistic fit on proposals
they did not see turns their margin into a probability, and a threshold for each kind is the
lowest one that holds the wanted precision there. Base spans always stay; accepted spans that
overlap none of them are added.
"""

from __future__ import annotations

import hashlib
import json
import random
import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterable
from dataclasses import dataclass
from functools import lru_cache
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foldlog.llm.common import map_columns, release_memory
from foldlog.staging import stage

#: The kinds in the order in which they are listed, the characters of an address,
#: the strict patterns, and words that speak for a kind when they stand before a span.
BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "secret")
_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
# A run of digits is tried once, from its first digit: inside it no other start can match.
_IP = re.compile(r"[0-9](?<![0-9][0-9])[0-9]*+(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_CUES = {
    "email": ("mail", "contact", "write", "correo", "courriel", "schreib"),
    "ip": ("ip", "host", "server", "addr", "node"),
    "card": ("card", "visa", "credit", "karte", "carte", "tarjeta"),
    "phone": ("phone", "tel", "call", "fax", "mobil", "cell", "anruf", "appel"),
    "secret": ("password", "passwd", "pwd", "secret", "token", "key", "auth", "credential"),
}
#: How keys and tokens of well-known services begin.
_PREFIXES = ("AKIA", "ASIA", "AIza", "ghp_", "gho_", "ghs_", "github_pat_", "glpat-", "sk-", "sk_live_", "xoxb-", "xoxp-")
# What a strict rule takes for a secret: a value that is assigned to such a name, or a known prefix.
_ASSIGNED = re.compile(
    r"(?:password|passwd|pwd|secret|token|api[_ -]?key|access[_ -]?key|credential)s?[\"']?\s{0,2}(?:[=:]|=>|is)\s{0,2}[\"']?\Z",
    re.IGNORECASE,
)
#: The loose patterns. Each begins with the character class that is looked for; what
#: must not stand before it is checked after.
_LOOSE = {
    "ip": re.compile(
        r"[0-9](?<![0-9.][0-9])[0-9]{0,2}(?: ?(?:\.|\[\.\]|\(\.\)) ?[0-9]{1,3}){3}(?![0-9]|\.[0-9])"
    ),
    "card": re.compile(r"[0-9](?<![0-9][0-9])(?:[ ./_-]{0,2}[0-9]){11,18}(?![0-9])"),
    "phone": re.compile(r"[+0-9(](?<![0-9].)(?:(?<=[+(])\(?[0-9]|(?<=[0-9]))(?:[ ()./-]{0,3}[0-9]){6,16}(?![0-9])"),
}
_LOOSE_AT = re.compile(
    r"(?:@|\(at\)|\[at\]|\{at\}| at ) ?"
    r"[A-Za-z0-9-]{1,63}+(?: ?(?:\.|\(dot\)|\[dot\]|\{dot\}| dot ) ?[A-Za-z0-9-]{1,63}+){1,8}"
)
_DIGIT = re.compile("[0-9]")
_LETTER = re.compile("[A-Za-z]")
# A run is tried once, from its first character.
_RUN = re.compile(r"[A-Za-z0-9_+/-](?<![A-Za-z0-9_+/-]{2})[A-Za-z0-9_+/-]{11,}+={0,2}")

#: No span is accepted below this probability, whatever precision the held ones show.
_LEAST = 0.35

Span = tuple[str, int, int]


def luhn(digits: str) -> bool:
    """Whether the check digit at the end of a card number fits."""
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _emails(text: str) -> list[Span]:
    # The leftmost match ends at the first @ that has a local part and a domain; its local part is
    # the whole run before that @, back to the previous match. This is linear in any text.
    out, last, at = [], 0, text.find("@")
    while at >= 0:
        held = text[last:at]
        start = last + len(held.rstrip(_LOCAL))
        found = _DOMAIN.match(text, at) if start < at else None
        if found:
            out.append(("email", start, found.end()))
            last = found.end()
        at = text.find("@", max(at + 1, last))
    return out


def base_spans(text: str) -> list[Span]:
    """The strict spans of each kind, leftmost and not overlapping within a kind."""
    out = _emails(text)
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m.group().split(".")):
            out.append(("ip", *m.span()))
    for m in _CARD.finditer(text):
        digits = _digits(m.group())
        if 12 <= len(digits) <= 19 and luhn(digits):
            out.append(("card", *m.span()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= len(_digits(m.group())) <= 15:
                out.append(("phone", *m.span()))
    return sorted(out, key=_order)


def _order(span: Span) -> tuple[int, int, int]:
    return span[1], KINDS.index(span[0]), span[2]


def loose_spans(text: str) -> list[Span]:
    """Proposals of high recall; they may overlap each other and the strict ones."""
    out = []
    for m in _LOOSE_AT.finditer(text):
        # The local part is the whole run before; runs of different matches have no part in common.
        end = m.start() - (m.start() > 0 and text[m.start() - 1] == " ")
        start = end
        while start and text[start - 1] in _LOCAL:
            start -= 1
        if start < end:
            out.append(("email", start, m.end()))
    if _DIGIT.search(text):
        for kind, pattern in _LOOSE.items():
            out.extend((kind, *m.span()) for m in pattern.finditer(text))
        for m in _RUN.finditer(text):
            if _DIGIT.search(m.group()) and _LETTER.search(m.group()):
                out.append(("secret", *m.span()))
    return out


def strict_secret(text: str, span: Span) -> bool:
    """Whether a run is assigned to a name for secrets, or begins like a key of a known service."""
    before = text[max(0, span[1] - 40) : span[1]]
    return text[span[1] : span[2]].startswith(_PREFIXES) or bool(_ASSIGNED.search(before))


class Intervals:
    """Disjoint intervals that others are looked up in; those that overlap or touch are joined."""

    def __init__(self, spans: Iterable[Span] = ()):
        self.starts: list[int] = []
        self.ends: list[int] = []
        for _, start, end in sorted(spans, key=itemgetter(1, 2)):
            if self.ends and start <= self.ends[-1]:
                self.ends[-1] = max(self.ends[-1], end)
            else:
                self.starts.append(start)
                self.ends.append(end)

    def meets(self, span: Span) -> bool:
        """Whether a span that is not empty has a place in common with one of these."""
        at = bisect_left(self.starts, span[2])
        return at > 0 and self.ends[at - 1] > span[1]

    def covers(self, span: Span) -> bool:
        at = bisect_right(self.starts, span[1])
        return at > 0 and self.ends[at - 1] >= span[2]

    def add(self, span: Span) -> None:
        """Add a span that meets none."""
        at = bisect_left(self.starts, span[1])
        self.starts.insert(at, span[1])
        self.ends.insert(at, span[2])


FEATURES = (
    "kind", "length", "digits", "letters", "separators", "kinds of separator", "plus", "luhn",
    "octets", "groups", "longest group", "last letters", "symbol at", "word at", "cue", "cue of another",
    "letter before", "letter after", "digits before", "digits after", "leading zero", "distinct digits",
    "dots written out", "dots before a space", "known prefix", "assigned", "hexadecimal", "capitals",
    "distinct characters", "changes between letters and digits", "vowels", "words joined",
)


def features(text: str, span: Span, around: int = 32) -> list[float]:
    """Format of a span and what stands around it."""
    kind, start, end = span
    own, before, after = text[start:end], text[max(0, start - around) : start].lower(), text[end : end + around]
    digits = _digits(own)
    groups = [g for g in re.split(r"[^0-9]+", own) if g]
    marks = [c for c in own if not c.isalnum()]
    tail = re.search(r"[A-Za-z]*\Z", own).group()
    cue = {k: any(c in before for c in _CUES[k]) for k in KINDS}
    return [
        KINDS.index(kind), len(own), len(digits), sum(c.isalpha() for c in own), len(marks), len(set(marks)),
        own.startswith(("+", "00")), bool(digits) and luhn(digits),
        len(groups) == 4 and all(len(g) <= 3 and int(g) <= 255 for g in groups),
        len(groups), max(map(len, groups), default=0), len(tail), "@" in own, " at " in own or "at)" in own or "at]" in own,
        cue[kind], any(v for k, v in cue.items() if k != kind),
        before[-1:].isalpha(), after[:1].isalpha(), len(_digits(before)), len(_digits(after)),
        digits.startswith("0"), len(set(digits)),
        len(re.findall(r" dot |[([{](?:dot|\.)[)\]}]", own)), own.count(". ") + own.count(".\n"),
        own.startswith(_PREFIXES), bool(_ASSIGNED.search(before)), not own.strip("0123456789abcdefABCDEF"),
        sum("A" <= c <= "Z" for c in own) / len(own), len(set(own)) / len(own),
        len(re.findall("(?<=[0-9])[A-Za-z]|(?<=[A-Za-z])[0-9]", own)) / len(own),
        sum(c in "aeiouAEIOU" for c in own) / len(own), sum(c in "_+/-" for c in own),
    ]


# --- boosted trees -----------------------------------------------------------------------------


@dataclass(frozen=True)
class Boosting:
    """How the trees are grown and the thresholds chosen.

    ``max_documents`` and ``max_proposals`` bound the sample that is fitted, about so many, chosen
    by hashes. ``max_respelt``: strict spans of one document that are spelt otherwise as examples.
    """

    trees: int = 60
    depth: int = 3
    rate: float = 0.2
    leaf_weight: float = 2.0
    bins: int = 16
    precision: float = 0.95
    max_documents: int = 20_000
    max_proposals: int = 20_000
    max_respelt: int = 8


def _grow(x: np.ndarray, grad: np.ndarray, hess: np.ndarray, cuts: list[np.ndarray], how: Boosting) -> list:
    """A regression tree as nested [feature, cut, left, right], leaves as numbers."""

    def node(rows: np.ndarray, depth: int):
        g, h = grad[rows].sum(), hess[rows].sum()
        value = float(how.rate * g / (h + how.leaf_weight))
        if depth == 0 or len(rows) < 2:
            return value
        best, at = 1e-6, None
        for f, own in enumerate(cuts):
            if not len(own):
                continue
            bins = np.searchsorted(own, x[rows, f], side="left")
            gl = np.cumsum(np.bincount(bins, grad[rows], len(own) + 1))[:-1]
            hl = np.cumsum(np.bincount(bins, hess[rows], len(own) + 1))[:-1]
            gain = (
                gl**2 / (hl + how.leaf_weight)
                + (g - gl) ** 2 / (h - hl + how.leaf_weight)
                - g**2 / (h + how.leaf_weight)
            )
            k = int(gain.argmax())
            if gain[k] > best:
                best, at = float(gain[k]), (f, float(own[k]))
        if at is None:
            return value
        left = x[rows, at[0]] <= at[1]
        return [*at, node(rows[left], depth - 1), node(rows[~left], depth - 1)]

    return node(np.arange(len(x)), how.depth)


def _value(tree, x: np.ndarray) -> np.ndarray:
    if not isinstance(tree, list):
        return np.full(len(x), tree)
    f, cut, left, right = tree
    return np.where(x[:, f] <= cut, _value(left, x), _value(right, x))


@dataclass(frozen=True)
class PiiModel:
    """Trees, the logistic fit of their margin, and a threshold for each kind."""

    trees: tuple
    slope: float
    shift: float
    thresholds: tuple[float, ...]

    def margin(self, x: np.ndarray) -> np.ndarray:
        return sum((_value(t, x) for t in self.trees), np.zeros(len(x)))

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-(self.slope * self.margin(x) + self.shift)))

    def to_json(self) -> str:
        return json.dumps([self.trees, self.slope, self.shift, self.thresholds])


@lru_cache(maxsize=2)
def model_of(text: str) -> PiiModel:
    trees, slope, shift, thresholds = json.loads(text)
    return PiiModel(tuple(trees), slope, shift, tuple(thresholds))


def fit(x: np.ndarray, y: np.ndarray, held: np.ndarray, how: Boosting = Boosting()) -> PiiModel:
    """Boost on the rows not ``held``, calibrate and choose thresholds on those held."""
    xt, yt = x[~held], y[~held]
    cuts = []
    for f in range(x.shape[1]):
        values = np.unique(xt[:, f])
        middle = (values[1:] + values[:-1]) / 2
        if len(middle) > how.bins:
            middle = np.unique(np.quantile(xt[:, f], np.linspace(0, 1, how.bins + 2)[1:-1]))
        cuts.append(middle)
    margin, trees = np.zeros(len(xt)), []
    for _ in range(how.trees):
        p = 1 / (1 + np.exp(-margin))
        tree = _grow(xt, yt - p, p * (1 - p), cuts, how)
        trees.append(tree)
        margin += _value(tree, xt)
    model = PiiModel(tuple(trees), 1.0, 0.0, (0.5,) * len(KINDS))
    m, yh = model.margin(x[held]), y[held]
    slope, shift = 1.0, 0.0
    for _ in range(50):  # Newton steps of a ridged logistic fit
        p = 1 / (1 + np.exp(-(slope * m + shift)))
        w = p * (1 - p)
        g = np.array([((yh - p) * m).sum() - 0.01 * (slope - 1), (yh - p).sum() - 0.01 * shift])
        h = np.array([[(w * m * m).sum() + 0.01, (w * m).sum()], [(w * m).sum(), w.sum() + 0.01]])
        step = np.linalg.solve(h, g)
        slope, shift = slope + float(np.clip(step[0], -1, 1)), shift + float(np.clip(step[1], -1, 1))
    model = PiiModel(tuple(trees), slope, shift, ())
    prob, thresholds = model.probability(x[held]), []
    for k in range(len(KINDS)):
        own = x[held][:, 0] == k
        order = np.argsort(-prob[own], kind="stable")
        right = np.cumsum(yh[own][order]) / np.arange(1, len(order) + 1)
        good = np.flatnonzero(right >= how.precision)
        thresholds.append(max(_LEAST, float(prob[own][order][good[-1]])) if len(good) else 1.01)
    return PiiModel(tuple(trees), slope, shift, tuple(thresholds))


# --- labelled proposals ------------------------------------------------------------------------

#: Examples that are always among the labelled ones, so that a model can be fitted
#: on any table. Numbers from ranges set aside for examples.
SEEDS = {
    "email": (
        "ann.lee@example.com", "info@mail.example.org", "b_99@dept.example.net",
        "a.rather.long.mailbox.name.of.some.department.that.goes.on.and.on.and.on.and.on@example.com",
    ),
    "ip": ("192.0.2.44", "198.51.100.7", "203.0.113.250"),
    "card": ("4111111111111111", "5555 5555 5555 4444", "3782-822463-10005"),
    "phone": ("+1 (202) 555-0143", "+44 20 7946 0958", "+49 30 1234567"),
}




def _random_secrets() -> tuple[str, ...]:
    """Made-up keys and passwords, the same in every run: random characters after known beginnings
    or alone."""
    rng, upper, digits = random.Random(7), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
    forms = [("AKIA", upper + digits, 16)] * 4 + [("ghp_", upper + upper.lower() + digits, 36), ("sk-", upper.lower() + digits, 40)]
    forms += [("", digits + "abcdef", 18), ("", digits + "abcdef", 40), ("", upper + upper.lower() + digits, 24)]
    return tuple(start + "".join(rng.choices(letters, k=size)) for start, letters, size in forms)


SEEDS["secret"] = _random_secrets()

#: The texts in which these examples stand.
_CONTEXTS = ("see {} and so on", "{}", "that one is {}.", "They said:\n{}\nand went on", "1) {}, 2) another")


def variants(kind: str, own: str) -> list[tuple[str, bool]]:
    """Other spellings of a strict span (true), and look-alikes that are none (false)."""
    if kind == "email":
        local, _, domain = own.partition("@")
        return [
            (f"{local} at {domain.replace('.', ' dot ')}", True),
            (f"{local}(at){domain}", True),
            (f"{local} [at] {domain.replace('.', '[dot]')}", True),
            (f"{local[:3] or 'x'} at {domain.split('.')[0]}. {local}", False),
        ]
    if kind == "ip":
        a, b, c, d = own.split(".")
        return [
            (f"{a}[.]{b}[.]{c}[.]{d}", True),
            (f"{a}(.){b}(.){c}(.){d}", True),
            (f"{int(a) + 300}.{b}.{c}.{d}", False),
            (f"{a}. {b}. {c}. {d}", False),
        ]
    if kind == "secret":
        plain = [(f"revision {own}", False), (f"page-{own[:4]}-of-the-long-name-{len(own)}", False), (f"sha {own}", False)]
        named = [(f"{name}{mark}{own}", True) for name in ("password", "api_key", "token") for mark in ("=", ": ", ' = "')]
        if own.startswith(_PREFIXES):
            return [*named, (f"id {own}", True), (own, True), (f"from ({own})", True), (f"x{own[4:]}", False)]
        return named + plain
    digits = _digits(own)
    if kind == "card":
        wrong = digits[:-1] + str((int(digits[-1]) + 3) % 10)
        return [
            (".".join(digits[i : i + 4] for i in range(0, len(digits), 4)), True),
            ("  ".join(digits[i : i + 4] for i in range(0, len(digits), 4)), True),
            (wrong, False),
            (".".join(wrong[i : i + 4] for i in range(0, len(wrong), 4)), False),
        ]
    return [
        ("00" + own[1:], True),
        (f"tel {own[1:]}", True),
        (f"call {own[1:].replace(' ', '/')}", True),
        (f"0049 {digits[2:]}", True),
        (digits, False),
        (f"{digits[:4]}. {digits[4:]}", False),
    ]


def labelled_proposals(text: str, most: int = Boosting.max_respelt) -> list[tuple[list[float], bool]]:
    """Features and labels of the proposals of a text and of its strict spans spelt otherwise.

    A proposal that a strict span of its kind covers is personal data, one that overlaps none is
    not; a run is a secret if the strict rule says so. Up to ``most`` strict spans are then
    replaced in their places by their variants, whose labels are known.
    """
    out: list[tuple[list[float], bool]] = []
    strict = base_spans(text)
    everything = Intervals(strict)
    own_kind = {kind: Intervals(s for s in strict if s[0] == kind) for kind in BASE_KINDS}
    secrets = []
    for span in loose_spans(text):
        if span[0] == "secret":
            if not everything.meets(span):
                found = strict_secret(text, span)
                out.append((features(text, span), found))
                secrets += [span] if found else []
        elif not everything.meets(span):
            out.append((features(text, span), False))
        elif own_kind[span[0]].covers(span):
            out.append((features(text, span), True))
    for kind, start, end in sorted([*strict, *secrets], key=_order)[:most]:
        for own, label in variants(kind, text[start:end]):
            changed = text[max(0, start - 64) : start] + own + text[end : end + 64]
            at = min(start, 64)
            for k, a, b in loose_spans(changed):
                if a < at + len(own) and at < b:
                    out.append((features(changed, (k, a, b)), label and k == kind))
    return out


_LABELLED = pa.schema([("x", pa.list_(pa.float64())), ("y", pa.bool_()), ("held", pa.bool_()), ("drawn", pa.int64())])


def fit_pii_model(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", how: Boosting = Boosting()) -> PiiModel:
    """Fit on proposals from a bounded sample of documents, and on the seeds.

    The sample is a share of the documents by a hash of their ids, which no property of a text
    decides; of their proposals a share by a hash reaches the driver.
    """
    rows = docs.select(
        F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text")
    ).where("doc_id IS NOT NULL")
    share = min(1.0, how.max_documents / max(1, rows.count()))
    rows = rows.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < int(share * (1 << 30)))

    def make():
        def step(batch):
            out = {name: [] for name in _LABELLED.names}
            for doc_id, text in zip(batch["doc_id"], batch["text"]):
                for k, (x, y) in enumerate(labelled_proposals(text or "", how.max_respelt)):
                    digest = hashlib.blake2b(f"{doc_id}:{k}".encode(), digest_size=8).digest()
                    out["x"].append([float(v) for v in x])
                    out["y"].append(y)
                    out["held"].append(digest[0] % 4 == 0)
                    out["drawn"].append(int.from_bytes(digest[1:5], "little"))
            return out

        return step

    proposals = stage(map_columns(rows, make, _LABELLED), "proposals")
    share = min(1.0, how.max_proposals / max(1, proposals.count()))
    found = proposals.where(F.col("drawn") < int(share * (1 << 32))).select("x", "y", "held").collect()
    found.sort(key=lambda r: r.x)
    x = [r.x for r in found]
    y = [r.y for r in found]
    held = [r.held for r in found]
    for kind in KINDS:
        for own in SEEDS[kind]:
            named = f"password={own}" if kind == "secret" and not own.startswith(_PREFIXES) else own
            for context in _CONTEXTS:
                for k, (fx, fy) in enumerate(labelled_proposals(context.format(named))):
                    x.append([float(v) for v in fx])
                    y.append(fy)
                    held.append(k % 4 == 1)
    return fit(np.array(x), np.array(y, float), np.array(held), how)


def judged_spans(text: str, model: PiiModel) -> tuple[list[Span], list[Span]]:
    """(base spans, all spans): accepted proposals that overlap no base span and no better one."""
    base = base_spans(text)
    taken = Intervals(base)
    loose = [s for s in loose_spans(text) if not taken.meets(s)]
    if not loose:
        return base, base
    p = np.concatenate(
        [
            model.probability(np.array([features(text, s) for s in loose[k : k + 4096]], float))
            for k in range(0, len(loose), 4096)
        ]
    )
    added = []
    for i in sorted(range(len(loose)), key=lambda i: (-p[i], _order(loose[i]))):
        if p[i] >= model.thresholds[KINDS.index(loose[i][0])] and not taken.meets(loose[i]):
            taken.add(loose[i])
            added.append(loose[i])
    return base, sorted(base + added, key=_order)


def listed(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in spans)


_SPANS = pa.schema(
    [
        ("doc_id", pa.int64()),
        *((f"n_{kind}", pa.int64()) for kind in BASE_KINDS),
        ("base_sha256", pa.string()),
        ("spans", pa.string()),
        ("n_spans", pa.int64()),
    ]
)


def pii_spans(docs: DataFrame, model: PiiModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: counts of base spans by kind, the digest of their list, all spans and their number.

    A null text counts as empty (no spans), a null id stays null, repeated rows are searched each;
    whole texts are searched, in time that grows with length and spans. Other columns are not read;
    an empty table gives no rows. Spans are in code points, the end excluded.
    """
    packed = model.to_json()

    def make():
        own = model_of(packed)

        def step(batch):
            out = {name: [] for name in _SPANS.names}
            for doc_id, text in zip(batch["doc_id"], batch["text"]):
                base, spans = judged_spans(text or "", own)
                out["doc_id"].append(doc_id)
                for kind in BASE_KINDS:
                    out[f"n_{kind}"].append(sum(s[0] == kind for s in base))
                out["n_spans"].append(len(spans))
                out["base_sha256"].append(hashlib.sha256(listed(base).encode()).hexdigest())
                out["spans"].append(listed(spans))
            return out

        return step

    rows = docs.select(
        F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text")
    )
    return map_columns(rows, make, _SPANS)


def redact(text: str | None, model: PiiModel) -> str | None:
    """The text with every span replaced by its kind in brackets; null stays null."""
    if text is None:
        return None
    out, last = [], 0
    for kind, start, end in judged_spans(text, model)[1]:
        if start < last:  # base spans of two kinds may overlap; the text is removed once
            last = max(last, end)
            continue
        out += [text[last:start], f"[{kind.upper()}]"]
        last = end
    return "".join([*out, text[last:]])


def redacted(docs: DataFrame, model: PiiModel, text_col: str = "text") -> DataFrame:
    """All rows and columns, the text redacted."""
    packed = model.to_json()

    def run(batches):
        own = model_of(packed)
        for batch in batches:
            k = batch.schema.get_field_index(text_col)
            texts = [redact(t, own) for t in batch.column(k).to_pylist()]
            yield batch.set_column(k, batch.schema.field(k), pa.array(texts, batch.schema.field(k).type))
        batch = texts = None
        release_memory()

    return docs.mapInArrow(run, docs.schema)
