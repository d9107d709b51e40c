"""Quality classifier: n-gram indicators scaled by class log-count ratios, then a linear hinge-loss model.

Features of a text are the words and word pairs it has, and the shapes of its words (letter
case, digits, punctuation before and after, same word as before) singly and in pairs, each
hashed to a slot.  A slot's indicator is scaled by the log ratio of its smoothed class
frequencies; rows get length one; dual coordinate descent fits the weights.

Both steps use a bounded sample of labelled rows (``SAMPLE_PER_CLASS`` of each class), since
the fit is sequential; scoring covers every row in one pass and shuffles nothing.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import memory
from .text import encoded, id_remainder

SLOTS = 1 << 18
SAMPLE_PER_CLASS = 3_000
EPOCHS = 12
COST = 1.0
_MASK = np.uint64(SLOTS - 1)
_ONE = np.uint64(0x9E3779B97F4A7C15)
_TWO = np.uint64(0xC2B2AE3D27D4EB4F)


class _Shapes(dict):
    """word -> (hash of the word in lower case, hash of its shape); forgets all when it gets large."""

    def __missing__(self, word: bytes) -> tuple[int, int]:
        if len(self) > 120_000:
            self.clear()
        text = word.decode("utf-8", "surrogatepass")
        core = text.strip("!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~")
        at = text.find(core) if core else len(text)
        case = "" if not core else "A" if core.isupper() and len(core) > 1 else "a" if core.islower() else "Aa" if core[0].isupper() and core[1:].islower() else "x"
        shape = f"{text[:at][:3]}|{case}{'9' if any(c.isdigit() for c in core) else ''}|{text[at + len(core):][:3]}"
        out = self[word] = (xxhash.xxh64_intdigest(word.lower()), xxhash.xxh64_intdigest(shape.encode("utf-8", "surrogatepass"), 1))
        return out


def slots(text: str | None) -> np.ndarray:
    """Distinct feature slots of a text; none for a null or empty one."""
    words = encoded(text).split()
    if not words:
        return np.zeros(0, np.int64)
    both = np.array(list(map(memory.keep("shapes", _Shapes).__getitem__, words)), np.uint64)
    word, shape = both[:, 0], both[:, 1].copy()
    shape[1:][word[1:] == word[:-1]] += np.uint64(1)
    with np.errstate(over="ignore"):
        grams = np.concatenate([word, shape * _TWO, (word[:-1] * _ONE) ^ (word[1:] >> np.uint64(1)), (shape[:-1] * _TWO) ^ (shape[1:] * _ONE) >> np.uint64(2)])
        grams ^= grams >> np.uint64(29)
        grams *= _TWO
    seen = np.zeros(SLOTS, bool)
    seen[((grams >> np.uint64(32)) & _MASK).astype(np.int64)] = True
    return np.flatnonzero(seen)


@dataclass(frozen=True)
class Model:
    ratio: np.ndarray
    weight: np.ndarray
    bias: float
    slope: float
    shift: float

    def margin(self, at: np.ndarray) -> float:
        r = self.ratio[at]
        length = math.sqrt(float(r @ r)) or 1.0
        return float(self.weight[at] @ r) / length + self.bias

    def score(self, text: str | None) -> float:
        z = self.slope * self.margin(slots(text)) + self.shift
        return 1.0 / (1.0 + math.exp(-max(-700.0, min(700.0, z))))


def log_count_ratios(rows: list[np.ndarray], y: np.ndarray, alpha: float = 1.0) -> np.ndarray:
    p, q = np.full(SLOTS, alpha), np.full(SLOTS, alpha)
    for at, label in zip(rows, y, strict=True):
        (p if label > 0 else q)[at] += 1
    return (np.log(p / p.sum()) - np.log(q / q.sum())).astype(np.float32)


def dual_coordinate_descent(rows: list[np.ndarray], y: np.ndarray, ratio: np.ndarray, cost=COST, epochs=EPOCHS, seed=3):
    """Weights and bias of min |w|^2 / 2 + cost * sum of hinge losses, one dual variable at a time.

    Rows have length one and a bias feature of one, so each step divides by two.
    """
    w, b, a = np.zeros(SLOTS, np.float32), 0.0, np.zeros(len(rows))
    values = []
    for at in rows:
        r = ratio[at]
        values.append(r / (math.sqrt(float(r @ r)) or 1.0))
    order, rng = np.arange(len(rows)), np.random.default_rng(seed)
    for _ in range(epochs):
        rng.shuffle(order)
        worst = 0.0
        for i in order:
            at, v = rows[i], values[i]
            gradient = y[i] * (float(w[at] @ v) + b) - 1.0
            new = min(max(a[i] - gradient / (float(v @ v) + 1.0), 0.0), cost)
            step = (new - a[i]) * y[i]
            if step:
                w[at] += np.float32(step) * v
                b += step
                a[i] = new
                worst = max(worst, abs(step))
        if worst < 1e-3:
            break
    return w, b


def _calibrate(m: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and shift of a logistic curve from margins to labels, by Newton steps with smoothed targets."""
    pos, neg = (y > 0).sum(), (y < 0).sum()
    t = np.where(y > 0, (pos + 1) / (pos + 2), 1 / (neg + 2))
    a, b = 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * m + b, -500, 500)))
        s = np.maximum(p * (1 - p), 1e-9)
        g = np.array([((p - t) * m).sum() + 1e-3 * a, (p - t).sum()])
        h = np.array([[(s * m * m).sum() + 1e-3, (s * m).sum()], [(s * m).sum(), s.sum() + 1e-6]])
        da, db = np.linalg.solve(h, g)
        a, b = a - da, b - db
        if abs(da) + abs(db) < 1e-8:
            break
    return float(a), float(b)


def fit(rows: list[np.ndarray], y: np.ndarray) -> Model:
    """From feature slots and labels of -1 and 1.  With fewer than two classes every score is one half."""
    if len(set(y.tolist())) < 2:
        return Model(np.zeros(SLOTS, np.float32), np.zeros(SLOTS, np.float32), 0.0, 0.0, 0.0)
    held = np.arange(len(y)) % 5 == 4
    if min((held & (y > 0)).sum(), (held & (y < 0)).sum()) < 5:
        held[:] = True
    first = np.flatnonzero(~held) if not held.all() else np.arange(len(y))
    part = [rows[i] for i in first]
    ratio = log_count_ratios(part, y[first])
    weight, bias = dual_coordinate_descent(part, y[first], ratio)
    rough = Model(ratio, weight, bias, 1.0, 0.0)
    slope, shift = _calibrate(np.array([rough.margin(rows[i]) for i in np.flatnonzero(held)]), y[held])
    return Model(ratio, weight, bias, slope, shift)


def labelled_sample(docs: DataFrame, labels: DataFrame, per_class: int = SAMPLE_PER_CLASS, held_out: int = 2) -> DataFrame:
    """(doc_id, quality, slots) of at most ``per_class`` ids of each class, chosen by a hash of the id; one row per id.

    The bounded list of ids is broadcast, so documents are read once and not shuffled.  Of rows that repeat an id the one
    with the least features counts, folded per task first.
    """
    marks = (
        labels.where("doc_id IS NOT NULL AND quality IN (0, 1)")
        .where(id_remainder(F.col("doc_id"), 4) != held_out)
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg(F.min("quality").alias("quality"))
    )
    key = [F.md5(F.col("doc_id").cast("string")), F.col("doc_id")]
    picked = marks.where("quality = 0").orderBy(*key).limit(per_class).union(marks.where("quality = 1").orderBy(*key).limit(per_class))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text")).join(F.broadcast(picked), "doc_id")
    featured = texts.select("doc_id", "quality", "text").mapInArrow(_featurize, "doc_id long, quality int, slots binary")
    return featured.groupBy("doc_id").agg(F.min("quality").alias("quality"), F.min("slots").alias("slots"))


def _featurize(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        packed = [slots(t).astype(np.int32).tobytes() for t in b.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("quality").cast(pa.int32()), pa.array(packed, pa.binary())], ["doc_id", "quality", "slots"])


def train(docs: DataFrame, labels: DataFrame, per_class: int = SAMPLE_PER_CLASS, held_out: int = 2) -> Model:
    got = labelled_sample(docs, labels, per_class, held_out).toArrow().to_pylist()
    got.sort(key=lambda r: (xxhash.xxh64_intdigest(str(r["doc_id"])), r["doc_id"], r["slots"]))
    rows = [np.frombuffer(r["slots"], np.int32) for r in got]
    return fit(rows, np.array([1.0 if r["quality"] else -1.0 for r in got]))


def score(docs: DataFrame, model: Model, threshold: float = 0.7) -> DataFrame:
    """doc_id, score (0 to 1) and predicted (1 at ``threshold`` or above) of every row.

    Null and empty texts have no features and get the score of the bias.  Null ids and rows
    that repeat an id are scored like others; other columns are ignored.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # two arrays of SLOTS numbers, whatever the data

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for b in batches:
            s = np.array([m.score(t) for t in b.column("text").to_pylist()], np.float64)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(s), pa.array((s >= threshold).astype(np.int32))], ["doc_id", "score", "predicted"])

    picked = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return picked.mapInArrow(run, "doc_id long, score double, predicted int")


def classify(docs: DataFrame, labels: DataFrame, threshold: float = 0.7, per_class: int = SAMPLE_PER_CLASS, held_out: int = 2) -> DataFrame:
    """Train on the labels that are not held out and score every row."""
    scored = score(docs, train(docs, labels, per_class, held_out), threshold)
    return scored.select("doc_id", (id_remainder(F.col("doc_id"), 4) == held_out).alias("held_out"), "score", "predicted")


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = 0.7, per_class: int = SAMPLE_PER_CLASS, held_out: int = 2) -> DataFrame:
    """The rows of ``docs``, all columns, whose text scores ``threshold`` or more: scored and filtered in one pass, without a join."""
    shared = docs.sparkSession.sparkContext.broadcast(train(docs, labels, per_class, held_out))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for b in batches:
            yield b.filter(pa.array([m.score(t) >= threshold for t in b.column("text").to_pylist()], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
