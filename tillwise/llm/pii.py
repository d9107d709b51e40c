"""Personal data: fixed patterns, and more spans proposed widely and chosen by boosted trees.

Generators with high recall propose overlapping spans for each kind.  Trees see a span's format and
what stands beside it.  They learn from a bounded sample: what the fixed patterns accept is personal,
also written in other usual notations; what looks alike but fails them (and made-up dates, version
numbers, amounts and serial numbers in the same surroundings) is not.  For each kind a threshold is calibrated on
rows kept from the fit so that at least ``PRECISION`` of what it admits is right.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import boosting

KINDS = ("email", "ip", "card", "phone")
SAMPLE_DOCS = 3_000
SAMPLE_SPANS = 20_000
PRECISION = 0.995
SIDE = 24

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
# wide nets
_AT = re.compile(r"[A-Za-z0-9._%+-]{1,64}(?:@|\x20?[\[({<]\x20?at\x20?[\])}>]\x20?|\x20at\x20)[A-Za-z0-9-]{1,63}(?:(?:\.|\x20?[\[({<]\x20?dot\x20?[\])}>]\x20?|\x20dot\x20)[A-Za-z0-9-]{1,63}){1,5}", re.I)
_NUMBER = re.compile(r"(?<![0-9])[+(]?[0-9](?:[\x20().\-/]{0,2}[0-9])++")

Span = tuple[int, int]


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) << (i & 1)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def emails(text: str) -> list[Span]:
    """Local part, @ and a domain with a dot; each @ looks back no further than the last match, so time is linear."""
    out, last, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > last and text[start - 1] in _LOCAL:
            start -= 1
        found = _DOMAIN.match(text, at + 1) if start < at else None
        if found:
            out.append((start, found.end()))
            last = found.end()
        at = text.find("@", found.end() if found else at + 1)
    return out


def _small(part: str) -> bool:
    return len(part := part.lstrip("0") or "0") <= 3 and int(part) <= 255


def ips(text: str) -> list[Span]:
    return [m.span() for m in _IP.finditer(text) if all(map(_small, m.group().split(".")))]


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def cards(text: str) -> list[Span]:
    return [m.span() for m in _CARD.finditer(text) if 13 <= len(d := _digits(m.group())) <= 19 and luhn(d)]


def phones(text: str) -> list[Span]:
    return [m.span() for m in _PHONE.finditer(text) if 9 <= len(_digits(m.group())) <= 15]


def base_spans(text: str) -> list[list[Span]]:
    """Accepted spans of each kind, in the order of ``KINDS``."""
    numbers = _DIGIT.search(text) is not None
    return [emails(text) if "@" in text else [], ips(text) if numbers else [], cards(text) if numbers else [], phones(text) if "+" in text else []]


def propose(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of everything that might be personal; spans of different kinds overlap."""
    out = []
    low = text.lower()
    if "@" in text or " at " in low or "at)" in low or "at]" in low or "at}" in low or "at>" in low:
        out += [(0, *m.span()) for m in _AT.finditer(text)]
    if _DIGIT.search(text):
        for m in _NUMBER.finditer(text):
            n = len(_digits(m.group()))
            if n >= 4 and m.group().count(".") >= 3:
                out.append((1, *m.span()))
            if 12 <= n <= 20:
                out.append((2, *m.span()))
            if 7 <= n <= 16:
                out.append((3, *m.span()))
    return out


_WORDS = (
    ("mail", "e-mail", "contact", "write", "correo", "courriel"),
    ("ip", "host", "server", "addr", "address"),
    ("card", "visa", "credit", "carte", "karte", "tarjeta"),
    ("phone", "tel", "call", "fax", "mobile", "telefon"),
    ("version", "license", "v", "release", "chapter", "section"),
    ("token", "password", "id", "no", "nr", "isbn", "order"),
)


def _side(c: str) -> int:
    return 0 if not c else 1 if c.isspace() else 2 if c.isdigit() else 3 if c.isalpha() else 4


def features(kind: int, span: str, before: str, after: str) -> list[float]:
    """Format of the span and what stands beside it."""
    d = _digits(span)
    groups = [len(g) for g in re.findall(r"[0-9]+", span)] or [0]
    parts = span.split(".")
    near = set(re.findall(r"[a-z-]+", before.lower()[-SIDE:])) | set(re.findall(r"[a-z-]+", after.lower()[:SIDE]))
    domain = re.split(r"@|[\[({< ]at[\])}> ]", span.lower())[-1]
    return [
        *(float(kind == k) for k in range(len(KINDS))),
        len(span),
        len(d),
        len(groups),
        max(groups),
        min(groups),
        groups[0],
        groups[-1],
        span.count("."),
        span.count("-"),
        span.count(" "),
        span.count("/"),
        float("(" in span),
        float(span[:1] == "+"),
        float("@" in span),
        float(bool(d) and luhn(d)),
        float(len(parts) == 4 and all(p.isdigit() and _small(p) for p in parts)),
        len(domain.rsplit(".", 1)[-1]) if kind == 0 else 0,
        sum(c.isalpha() for c in span) / max(1, len(span)),
        len(set(d)),
        int(d[0]) if d else -1,
        _side(before[-1:]),
        _side(after[:1]),
        *(float(not near.isdisjoint(w)) for w in _WORDS),
    ]


@dataclass(frozen=True)
class Model:
    trees: boosting.Trees
    thresholds: tuple[float, ...]


def _notations(kind: int, span: str) -> list[str]:
    """The same item as people also write it."""
    d = _digits(span)
    if kind == 0:
        name, _, host = span.partition("@")
        return [f"{name} (at) {host}", f"{name}[at]{host.replace('.', '[dot]')}", f"{name} at {host.replace('.', ' dot ')}"]
    if kind == 2:
        return [" ".join(d[i : i + 4] for i in range(0, len(d), 4)), "-".join(d[i : i + 4] for i in range(0, len(d), 4))]
    if kind == 3:
        t = d[-10:]
        return [f"({t[:3]}) {t[3:6]}-{t[6:]}", f"{t[:3]}-{t[3:6]}-{t[6:]}", f"{t[:3]}.{t[3:6]}.{t[6:]}"]
    return []


def _lookalikes(kind: int, rng: np.random.Generator) -> str:
    """What a generator of this kind also catches and is not personal."""
    r = lambda a, b: int(rng.integers(a, b))
    if kind == 0:
        return [f"room at level {r(1, 99)}", f"look@{r(1, 9)}.{r(0, 9)}"][r(0, 2)]
    if kind == 1:
        return [f"{r(1, 9)}.{r(0, 20)}.{r(0, 20)}.{r(256, 9999)}", f"{r(1, 9)}.{r(0, 9)}.{r(0, 9)}.{r(0, 9)}.{r(0, 9)}", f"{r(1, 31)}.{r(1, 13)}.{r(1900, 2030)}.{r(1, 9)}"][r(0, 3)]
    if kind == 2:
        while luhn(s := "".join(str(r(0, 10)) for _ in range(r(12, 20)))):
            pass
        return s
    return [f"{r(1900, 2030)}-{r(10, 13)}-{r(10, 29)}", f"{r(10, 29)}/{r(10, 13)}/{r(1900, 2030)}", f"{r(1900, 2030)}-{r(1900, 2030)}", str(r(10**7, 10**12)), f"{r(1, 999)}.{r(10**6, 10**8)}"][r(0, 5)]


def learn(rows: list[tuple[int, str, str, str, bool]], precision: float = PRECISION, seed: int = 5) -> Model:
    """From (kind, span, before, after, accepted) of a sample."""
    rng = np.random.default_rng(seed)
    data, marks = [], []
    for kind, span, before, after, accepted in rows:
        data.append(features(kind, span, before, after))
        marks.append(accepted)
        if accepted:
            for other in _notations(kind, span):
                data.append(features(kind, other, before, after))
                marks.append(True)
            for _ in range(3):
                data.append(features(kind, _lookalikes(kind, rng), before, after))
                marks.append(False)
    if len(set(marks)) < 2:  # nothing to tell apart: no span is added
        return Model(boosting.Trees([], -50.0), tuple(2.0 for _ in KINDS))
    x, y = np.array(data, float), np.array(marks, float)
    held = rng.random(len(y)) < 0.3
    trees = boosting.fit(x[~held], y[~held])
    p = trees.probability(x[held])
    cuts = []
    for k in range(len(KINDS)):
        of = x[held][:, k] == 1
        order = np.argsort(-p[of], kind="stable")
        good, scores = y[held][of][order], p[of][order]
        share = np.cumsum(good) / np.arange(1, len(good) + 1)
        ends = np.append(np.diff(scores) != 0, True) if len(scores) else np.zeros(0, bool)
        ok = np.flatnonzero((share >= precision) & ends & (np.arange(1, len(good) + 1) >= 30))
        if len(ok):  # half-way to the next lower score
            below = float(scores[ok[-1] + 1]) if ok[-1] + 1 < len(scores) else 0.0
            cuts.append(max(0.5, (float(scores[ok[-1]]) + below) / 2))
        else:
            cuts.append(2.0)
    return Model(trees, tuple(cuts))


def _context(text: str, s: int, e: int) -> tuple[str, str, str]:
    return text[s:e], text[max(0, s - SIDE) : s], text[e : e + SIDE]


def sample_spans(docs: DataFrame, sample_docs: int, sample_spans_: int) -> list[tuple[int, str, str, str, bool]]:
    """Proposed and accepted spans of at most ``sample_docs`` documents with a digit or @, chosen by a hash of the id."""
    ids = docs.where(F.col("doc_id").isNotNull() & F.col("text").rlike("[0-9@]")).select("doc_id").distinct()
    ids = ids.orderBy(F.md5(F.col("doc_id").cast("string")), "doc_id").limit(sample_docs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for text in b.column("text").to_pylist():
                accepted = {(k, *s) for k, spans in enumerate(base_spans(text)) for s in spans}
                for k, s, e in sorted(accepted | set(propose(text))):
                    out.append((k, *_context(text, s, e), (k, s, e) in accepted))
            if out:
                cols = list(zip(*out, strict=True))
                yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int32()), *(pa.array(c, pa.string()) for c in cols[1:4]), pa.array(cols[4])], ["kind", "span", "before", "after", "accepted"])

    picked = docs.join(F.broadcast(ids), "doc_id").select("text")  # a bounded list of ids
    spans = picked.mapInArrow(run, "kind int, span string, before string, after string, accepted boolean")
    order = F.xxhash64("kind", "span", "before", "after")
    got = spans.orderBy(order, "kind", "span", "before", "after").limit(sample_spans_).collect()
    return [tuple(r) for r in got]


def _text_of(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for k, s, e in sorted(spans))


class _Cover:
    """The stretches of a text that spans cover, disjoint and in order, so that an overlap is found by bisection."""

    def __init__(self, spans: list[Span]):
        self.starts: list[int] = []
        self.ends: list[int] = []
        for s, e in sorted(spans):
            if self.ends and s < self.ends[-1]:
                self.ends[-1] = max(self.ends[-1], e)
            else:
                self.starts.append(s)
                self.ends.append(e)

    def meets(self, s: int, e: int) -> bool:
        at = bisect_left(self.starts, e)
        return at > 0 and self.ends[at - 1] > s

    def add(self, s: int, e: int) -> None:
        """A span that meets none."""
        at = bisect_left(self.starts, s)
        self.starts.insert(at, s)
        self.ends.insert(at, e)


def find_in(texts: list[str], model: Model) -> list[tuple[list[list[Span]], list[tuple[int, int, int]]]]:
    """For each text the base spans by kind, and all spans (kind, start, end): added ones overlap no other span."""
    out, covers, rows, where = [], [], [], []
    for i, text in enumerate(texts):
        base = base_spans(text)
        cover = _Cover([s for spans in base for s in spans])
        out.append((base, [(k, s, e) for k, spans in enumerate(base) for s, e in spans]))
        covers.append(cover)
        for k, s, e in propose(text):
            if model.thresholds[k] <= 1 and not cover.meets(s, e):
                rows.append(features(k, *_context(text, s, e)))
                where.append((i, k, s, e))
    if rows:
        p = model.trees.probability(np.array(rows, float))
        for j in np.argsort(-p, kind="stable"):
            i, k, s, e = where[j]
            if p[j] >= model.thresholds[k] and not covers[i].meets(s, e):
                covers[i].add(s, e)
                out[i][1].append((k, s, e))
    return out


def train(docs: DataFrame, sample_docs: int = SAMPLE_DOCS, sample_spans_count: int = SAMPLE_SPANS) -> Model:
    return learn(sample_spans(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")), sample_docs, sample_spans_count))


def find(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone (by the fixed patterns), base_sha256, spans, redacted for every row.

    Offsets are code points, ends exclusive.  Null texts are empty; rows without spans have the hash of the empty
    text; null and repeated ids are rows like others.  A very long text costs time in proportion to its items; of equally
    likely spans that overlap, the one proposed first stays.  In ``redacted`` every span is replaced by its kind in brackets.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by the number of trees

    def redact(text: str, spans: list[tuple[int, int, int]]) -> str:
        at, parts = 0, []
        for k, s, e in sorted(spans, key=lambda x: x[1:]):
            if e > at:
                parts += [text[at : max(at, s)], f"[{KINDS[k]}]"]
                at = e
        return "".join([*parts, text[at:]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [t or "" for t in b.column("text").to_pylist()]
            found = find_in(texts, shared.value)
            counts = np.array([[len(s) for s in base] for base, _ in found], np.int64).reshape(-1, len(KINDS))
            digests = [hashlib.sha256(_text_of([(k, *s) for k, spans in enumerate(base) for s in spans]).encode()).hexdigest() for base, _ in found]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), *map(pa.array, counts.T), pa.array(digests, pa.string()), pa.array([_text_of(s) for _, s in found], pa.string()), pa.array([redact(t, s) for t, (_, s) in zip(texts, found, strict=True)], pa.string())],
                ["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans", "redacted"],
            )

    picked = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return picked.mapInArrow(run, "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, redacted string")
