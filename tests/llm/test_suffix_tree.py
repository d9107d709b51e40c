from __future__ import annotations

import math
import zlib
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import pyarrow.parquet as pq
import pytest

from tillwise.llm import suffix_tree as st

DATA = "/root/testdata/sf0.01"


def split(rows):
    """(id, words with the end, whether learned from)"""
    return [(i, [*(t or "").encode().lower().split(), None], zlib.crc32(str("" if i is None else i).encode()) % 10 != 0) for i, t in rows]


def base(rows):
    """n_tokens, n_known, train_tokens and base score by plain counting."""
    docs = split(rows)
    counts = Counter(w for _, ws, t in docs if t for w in ws)
    n, v = sum(counts.values()), len(counts)
    p = lambda w: math.log10((counts[w] + 0.1) / (n + 0.1 * (v + 1)))
    return [(i, not t, len(ws), sum(w in counts for w in ws), n, sum(map(p, ws))) for i, ws, t in docs]


class Plain:
    """The same tree in dictionaries: contexts as tuples, counted, tested and mixed one by one."""

    def __init__(self, rows, depth=3, least=2, discount=0.5):
        self.docs, self.depth, self.discount = split(rows), depth, discount
        train = [ws for _, ws, t in self.docs if t]
        self.counts = Counter(w for ws in train for w in ws)
        self.total = sum(self.counts.values())
        self.nexts, self.left = defaultdict(Counter), {}
        for ws in train:
            for k in range(1, depth + 1):
                for i in range(k, len(ws)):
                    self.nexts[tuple(ws[i - k : i])][ws[i]] += 1
        for s in sorted(self.nexts, key=len):
            self.nexts[s], n = {y: m for y, m in self.nexts[s].items() if m >= least}, sum(self.nexts[s].values())
            told = self.nexts[s]
            if n < least or not told:
                continue
            below = {y: 2 ** (round(1024 * math.log2(self.p(s[1:], y))) / 1024) for y in told}  # as the test is defined: steps of 1 / 1024 bit
            rest = n - sum(told.values())
            saved = sum(m * math.log(m / n / below[y]) for y, m in told.items())
            saved += rest * math.log(rest / n / max(1e-9, 1 - sum(below.values()))) if rest else 0
            if saved > 0.5 * len(told) * math.log(max(2, self.total)):
                self.left[s] = (n, 1 - sum(m - discount for m in told.values()) / n)

    def p(self, past, y):
        past = past[max(0, len(past) - self.depth) :]
        if not past:
            return (self.counts[y] + 0.1) / (self.total + 0.1 * (len(self.counts) + 1))
        below = self.p(past[1:], y)
        if past not in self.left:
            return below
        n, left = self.left[past]
        return max(0, self.nexts[past].get(y, 0) - self.discount) / n + left * below

    def scores(self):
        return [(i, len(ws), sum(math.log10(self.p(tuple(ws[max(0, j - self.depth) : j]), w)) for j, w in enumerate(ws))) for i, ws, _ in self.docs]


def same(got, want):
    key = lambda r: (r[0] is None, r[0] or 0, r[2], r[5])
    assert len(got) == len(want)
    for a, b in zip(sorted((tuple(r)[:6] for r in got), key=key), sorted(want, key=key), strict=True):
        assert a[:5] == b[:5] and a[5] == pytest.approx(b[5], rel=1e-9, abs=1e-6)


def close(got, plain):
    key = lambda r: (r[0] is None, r[0] or 0, r[1], r[2])
    for a, b in zip(sorted(((r["doc_id"], r["n_tokens"], r["score"]) for r in got), key=key), sorted(plain.scores(), key=key), strict=True):
        assert a[:2] == b[:2] and a[2] == pytest.approx(b[2], rel=1e-4, abs=1e-4)


def texts():
    rng = np.random.default_rng(4)
    words = ["a", "b", "c", "d", *(f"w{i}" for i in range(60))]
    p = 1 / np.arange(1, len(words) + 1)
    out = [" ".join(rng.choice(words, int(rng.integers(0, 60)), p=p / p.sum())) + " a b c d W1 w2 a b c d" * int(rng.integers(0, 2)) for _ in range(150)]
    return list(enumerate(out + out[:20] + ["the " * 500, "of the " * 400]))


@pytest.mark.parametrize("depth,hot,bucket", [(3, 1e-3, st.BUCKET), (3, 1e-9, 500), (1, 1e-9, 2000), (5, 0.5, 300)])
def test_scores_equal_a_tree_in_dictionaries(spark, monkeypatch, depth, hot, bucket):
    """Also with hot contexts spread over buckets, many buckets, and sequences deeper than the default."""
    rows = texts()
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    plain = Plain(rows, depth)
    got = st.score(docs, depth=depth, hot=hot, bucket=bucket).collect()
    same(got, base(rows))
    close(got, plain)
    assert {len(s) for s in plain.left} >= set(range(1, min(depth, 3) + 1))
    for past in [(), (b"a",), (b"a", b"b"), (b"zz", b"b", b"c"), (b"of", b"the")]:
        assert sum(plain.p(past, y) for y in [*plain.counts, b"never seen"]) == pytest.approx(1)


def test_given_texts_and_better_scores_on_held_out_ones(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    got = st.score(docs).collect()
    same(got, base(rows))
    close(got, Plain(rows))
    held = [r for r in got if r["held_out"]]
    assert sum(r["score"] for r in held) > 0.9 * sum(r["base_score"] for r in held)


def test_the_tree_grows_with_the_text(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    kept = []
    for part in (docs.where("doc_id % 4 = 0"), docs):
        rows, model = st.prepared(part, 0, 10, 3, 2, st.HOT, "doc_id", "text")
        kept.append(st.contexts_kept(rows, st.grow(rows, model), model))
    assert all(b > 2 * a > 0 for a, b in zip(*kept, strict=True))


def test_chunks_are_sent_in_parts_and_never_to_ask(spark, monkeypatch):
    """What bounds the disk: to ask, a depth shuffles pairs alone; a chunk goes through a shuffle once a depth, a part of them at a time; nothing but the scores stays."""
    written, write = [], st.materialize

    def spy(df, label):
        plan = df._jdf.queryExecution().executedPlan().toString()
        out = write(df, label)
        written.append((label, plan, Path(out._scratch_path.removeprefix("file:"))))
        return out

    monkeypatch.setattr(st, "materialize", spy)
    rows = texts()
    got = st.score(spark.createDataFrame(rows, "doc_id long, text string").repartition(24)).collect()
    same(got, base(rows))
    close(got, Plain(rows))
    asking = [plan for label, plan, _ in written if label.startswith("depth")]
    assert len(asking) == st.DEPTH + 1 and not any("hashpartitioning(chunk" in plan for plan in asking)
    assert [sum(label == f"chunks{k}" for label, _, _ in written) for k in range(st.DEPTH + 1)] == [st.PARTS] * (st.DEPTH + 1)
    assert [label for label, _, path in written if path.exists()] == ["scores"]


def test_a_task_never_holds_all_chunks_in_one_row_group(spark, monkeypatch):
    """What bounds the memory: chunks are rows of some MB, and each table that holds them closes a page after a row and a row group at 4 MB."""
    groups, write = {}, st.materialize

    def spy(df, label):
        out = write(df, label)
        if label.startswith("chunks"):
            files = [pq.ParquetFile(f).metadata for f in Path(out._scratch_path.removeprefix("file:")).glob("*.parquet")]
            groups.setdefault(label, []).extend((m.row_group(i).num_rows, m.row_group(i).total_byte_size) for m in files for i in range(m.num_row_groups))
        return out

    monkeypatch.setattr(st, "materialize", spy)
    monkeypatch.setattr(st, "PARTS", 1)
    rng = np.random.default_rng(5)
    rows = [(i, " ".join(np.char.mod("%x", rng.integers(0, 1 << 18, st.CHUNK)))) for i in range(8)]  # each a chunk
    rows, model = st.prepared(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1), 0, 10, 0, 2, st.HOT, "doc_id", "text", 1 << 30)
    monkeypatch.setattr(type(spark.sparkContext), "defaultParallelism", 1)  # one bucket, and few tasks take its answers
    st.grow(rows, model)
    assert set(groups) == {"chunks", "chunks0"}
    for got in groups.values():
        assert sum(n for n, _ in got) == 8 and sum(size for _, size in got) > 8 << 20
        assert all(n == 1 or size <= (4 << 20) + size / n for n, size in got)


def test_whole_numbers_in_order():
    for key in (np.zeros(0, np.int64), np.array([5, 0, 5, 2]), np.random.default_rng(2).integers(0, 1 << 40, 1000), np.array([1 << 61, 7, 1 << 61, 0])):
        ordered, order = st.in_order(key)
        assert np.array_equal(order, np.argsort(key, kind="stable")) and np.array_equal(ordered, key[order])


def test_numbers_pack_and_unpack():
    a = (np.zeros(0, np.uint64), np.arange(1000, dtype=np.uint32), np.random.default_rng(1).random(99).astype(np.float32))
    assert all(np.array_equal(x, y) for x, y in zip(st.unpack(st.pack(*a), *(x.dtype.type for x in a)), a, strict=True))
    p = 10.0 ** -np.linspace(0, 18, 500)
    assert st.decoded(st.coded(p)) == pytest.approx(p, rel=1e-3)


def test_edges(spark, nasty, empty):
    rows = [(r["doc_id"], r["text"]) for r in nasty.collect()]
    got = st.score(nasty).collect()
    same(got, base(rows))
    close(got, Plain(rows))
    assert all(math.isfinite(r["score"]) for r in got)
    assert st.score(empty).count() == 0
    only_held = nasty.where("crc32(coalesce(string(doc_id), '')) % 10 = 0")
    assert all(r["train_tokens"] == 0 and r["n_known"] == 0 for r in st.score(only_held).collect())
