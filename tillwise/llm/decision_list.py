"""Quality rules learned as an ordered decision list.

Each document becomes a row of counts.  From a bounded sample of labelled rows, sequential
covering grows a conjunction of thresholds that picks out low-quality documents, prunes it on
rows it was not grown on, keeps it if it is precise enough there, takes away what it covers
and starts again.  The rules come out as one Spark conditional expression over the counts.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .scratch import materialize
from .text import SPACE, encoded, id_remainder

SAMPLE_ROWS = 20_000
MIN_PRECISION = 0.95
MAX_RULES = 12
MAX_LITERALS = 4
WINDOW = 5
SYMBOLS = b"#*$%&|<>"
_UPPER = bytes(range(65, 91))

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_distinct", "n_same")
#: What rules may test: ratios of counts, none of which depends on the language.
FEATURES: dict[str, str] = {
    "words": "double(n_words)",
    "word_length": "word_chars / nullif(n_words, 0)",
    "symbol_share": "n_symbols / nullif(word_chars, 0)",
    "dup_line_share": "n_dup_lines / nullif(n_lines, 0)",
    "repeat_share": "n_repeat_words / nullif(n_words, 0)",
    "upper_share": "n_upper / nullif(word_chars, 0)",
    "distinct_share": "n_distinct / nullif(n_words, 0)",
    "same_share": "n_same / nullif(n_words, 0)",
    "words_per_line": "n_words / nullif(n_lines, 0)",
}


def repeated(ids: np.ndarray, window: int = WINDOW) -> int:
    """Positions inside windows of ``window`` ids that occur twice or more in ``ids``.

    Windows are named exactly: each step names pairs of a prefix and one further id."""
    n = len(ids) - window + 1
    if n < 2:
        return 0
    width = int(ids.max()) + 1
    names = ids[:n]
    for k in range(1, window):
        names = np.unique(names.astype(np.int64) * width + ids[k : k + n], return_inverse=True)[1]
        if k < window - 1 and names.max() + 1 == n:
            return 0  # all prefixes differ already
    many = np.bincount(names)[names] > 1
    edges = np.zeros(len(ids) + 1, np.int64)
    at = np.flatnonzero(many)
    np.add.at(edges, at, 1)
    np.add.at(edges, at + window, -1)
    return int((np.cumsum(edges[:-1]) > 0).sum())


def count(text: str | None) -> tuple[int, ...]:
    """The counts of one text, in the order of ``COUNTS``; a null text has none of anything."""
    raw = encoded(text)
    if not raw:
        return (0,) * len(COUNTS)
    words = raw.split()
    order: dict[bytes, int] = {}
    ids = np.fromiter((order.setdefault(w, len(order)) for w in words), np.int64, len(words))
    solid = raw.translate(None, SPACE)
    lines = Counter(x for x in raw.split(b"\n") if x.strip(SPACE))
    return (
        len(words),
        len(text) - (len(raw) - len(solid)),
        len(raw) - len(raw.translate(None, SYMBOLS)),
        sum(lines.values()) - len(lines),
        repeated(ids),
        sum(lines.values()),
        len(raw) - len(raw.translate(None, _UPPER)),
        len(order),
        int((ids[1:] == ids[:-1]).sum()),
    )


def _count_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        table = np.array([count(t) for t in b.column("text").to_pylist()], np.int64).reshape(-1, len(COUNTS))
        yield pa.RecordBatch.from_arrays([b.column("doc_id"), *map(pa.array, table.T)], ["doc_id", *COUNTS])


def statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and the counts of every row; rows that repeat an id are counted each."""
    picked = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return picked.mapInArrow(_count_batches, "doc_id long, " + ", ".join(f"{c} long" for c in COUNTS))


@dataclass(frozen=True)
class Literal:
    feature: str
    at_least: bool
    threshold: float

    def column(self) -> Column:
        x = F.expr(FEATURES[self.feature])
        return F.coalesce(x >= self.threshold if self.at_least else x <= self.threshold, F.lit(False))

    def mask(self, x: np.ndarray) -> np.ndarray:
        v = x[:, list(FEATURES).index(self.feature)]
        return v >= self.threshold if self.at_least else v <= self.threshold


Rule = tuple[Literal, ...]


def _covers(rule: Rule, x: np.ndarray) -> np.ndarray:
    out = np.ones(len(x), bool)
    for literal in rule:
        out &= literal.mask(x)
    return out


def _grow(x: np.ndarray, bad: np.ndarray, max_literals: int, banned: frozenset = frozenset()) -> Rule:
    """Adds the literal with the largest information gain until no good row is covered.

    The first one may not be of a ``banned`` (feature, side)."""
    rule: list[Literal] = []
    inside = np.ones(len(x), bool)
    while len(rule) < max_literals and (inside & ~bad).any() and (inside & bad).any():
        p, n = (inside & bad).sum(), (inside & ~bad).sum()
        best, gain = None, 1e-9
        for j, name in enumerate(FEATURES):
            v = x[inside, j]
            values = np.unique(v[np.isfinite(v)])
            if len(values) < 2:
                continue
            cuts = (values[1:] + values[:-1]) / 2
            cuts = np.unique(cuts[np.linspace(0, len(cuts) - 1, min(200, len(cuts))).astype(int)])
            for at_least in (True, False):
                if not rule and (name, at_least) in banned:
                    continue
                side = np.sort(v[bad[inside] & np.isfinite(v)]), np.sort(v[~bad[inside] & np.isfinite(v)])
                q = [len(s) - np.searchsorted(s, cuts, "left") if at_least else np.searchsorted(s, cuts, "right") for s in side]
                with np.errstate(divide="ignore", invalid="ignore"):
                    gains = np.where(q[0] > 0, q[0] * (np.log2(q[0] / (q[0] + q[1])) - np.log2(p / (p + n))), -1)
                k = int(np.argmax(gains))
                if gains[k] > gain:
                    best, gain = Literal(name, at_least, float(cuts[k])), float(gains[k])
        if best is None:
            break
        rule.append(best)
        inside &= best.mask(x)
    return tuple(rule)


def _prune(rule: Rule, x: np.ndarray, bad: np.ndarray) -> Rule:
    """The shortest prefix of the rule with the best balance of bad over good rows."""

    def worth(r: Rule) -> float:
        c = _covers(r, x)
        p, n = (c & bad).sum(), (c & ~bad).sum()
        return (p - n) / (p + n) if p + n else -1.0

    return max((rule[:k] for k in range(1, len(rule) + 1)), key=worth)


def learn(x: np.ndarray, bad: np.ndarray, min_precision=MIN_PRECISION, max_rules=MAX_RULES, max_literals=MAX_LITERALS, seed=7) -> list[Rule]:
    """An ordered list of conjunctions that pick out bad rows; rows that none covers are good."""
    part = np.random.default_rng(seed).random(len(x)) < 2 / 3
    left = np.ones(len(x), bool)
    rules: list[Rule] = []
    banned: frozenset = frozenset()
    while len(rules) < max_rules and (left & part & bad).any():
        rule = _grow(x[left & part], bad[left & part], max_literals, banned)
        if not rule:
            break
        held = left & ~part
        rule = _prune(rule, x[held], bad[held])
        c = _covers(rule, x)
        p, n = (c & held & bad).sum(), (c & held & ~bad).sum()
        if p == 0 or p / (p + n) < min_precision:
            banned |= {(rule[0].feature, rule[0].at_least)}  # too vague: start from another feature
            continue
        rules.append(rule)
        left &= ~c
        banned = frozenset()
    return rules


def verdict(rules: list[Rule]) -> Column:
    """True (keep) or false, by the first rule that holds."""
    out = None
    for rule in rules:
        test = rule[0].column()
        for literal in rule[1:]:
            test = test & literal.column()
        out = F.when(test, False) if out is None else out.when(test, False)
    return F.lit(True) if out is None else out.otherwise(True)


def fit(stats: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> list[Rule]:
    """Rules from at most ``sample_rows`` labelled rows, picked by a hash of the id.

    A label counts if its id and quality are not null; of several for one id the lowest counts.  Of rows
    that repeat an id the one with the least features, taken in order, counts.
    """
    marks = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    picked = marks.orderBy(F.md5(F.col("doc_id").cast("string")), "doc_id").limit(sample_rows)
    measured = F.struct(*[F.coalesce(F.expr(e), F.lit(float("nan"))).cast("double").alias(n) for n, e in FEATURES.items()])
    rows = stats.join(picked, "doc_id").groupBy("doc_id").agg(F.min("quality").alias("quality"), F.min(measured).alias("f"))
    sample = rows.select("quality", "f.*").toPandas()  # at most sample_rows
    if sample.empty:
        return []
    sample = sample.sort_values(list(sample.columns), kind="stable")
    return learn(sample[list(FEATURES)].to_numpy(np.float64), (sample["quality"] == 0).to_numpy())


def judge(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS, held_out: int | None = 2) -> DataFrame:
    """doc_id, the counts, base_failed and kept for every row of ``docs``.

    Base rule: fewer than 10 words, or more than 20 % of the words in repeated windows.  Labels
    whose id leaves ``held_out`` (crc32 modulo 4) are not learned from.  Without labels the base
    rule decides alone.  Null and empty texts have no words and fail; a null id is judged too.
    """
    stats = materialize(statistics(docs), "counts")
    usable = labels.select("doc_id", "quality")
    if held_out is not None:
        usable = usable.where(id_remainder(F.col("doc_id"), 4) != held_out)
    rules = fit(stats, usable, sample_rows)
    base = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    return stats.withColumn("base_failed", base).withColumn("kept", ~F.col("base_failed") & verdict(rules))
