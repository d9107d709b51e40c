from __future__ import annotations

import hashlib

import numpy as np
import pytest

from tillwise.llm import recompression as rc


def plain(rows, window):
    first = {}
    docs = [(i, (t or "").encode().split()) for i, t in rows]
    for i, w in docs:
        if i is not None:
            for p in range(len(w) - window + 1):
                g = tuple(w[p : p + window])
                first[g] = min(first.get(g, i), i)
    out = []
    for i, w in docs:
        gone = set()
        if i is not None:
            for p in range(len(w) - window + 1):
                if first[tuple(w[p : p + window])] < i:
                    gone |= set(range(p, p + window))
        kept = b" ".join(x for k, x in enumerate(w) if k not in gone)
        out.append((i, len(w), len(gone), hashlib.sha256(kept).hexdigest()))
    return out


def order(rows):
    return sorted((tuple(r) for r in rows), key=lambda r: (r[0] is None, r[0] or 0, *r[1:]))


@pytest.mark.parametrize("letters,window,seed", [(2, 5, 0), (2, 13, 1), (3, 13, 2), (30, 13, 3), (1, 13, 4)])
def test_repeats_in_texts_of_few_words(spark, letters, window, seed):
    """Few different words make runs, periods and overlapping repeats of all lengths."""
    rng = np.random.default_rng(seed)
    pool = [" ".join(f"w{x}" for x in rng.integers(0, letters, int(rng.integers(5, 120)))) for _ in range(12)]
    rows = []
    for i in rng.permutation(80):
        parts = [pool[k] for k in rng.integers(0, len(pool), int(rng.integers(0, 4)))]
        own = [f"w{x}" for x in rng.integers(0, letters, int(rng.integers(0, 40)))]
        rows.append((int(i), " ".join([*own, *parts, f"u{i}"])))
    rows += [(7, rows[3][1]), (None, rows[3][1])]
    got = rc.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string").repartition(5), window)
    assert order(got.drop("kept").collect()) == order(plain(rows, window))


def test_equal_windows_choose_equal_anchors():
    rng = np.random.default_rng(9)
    passage = [b"p%d" % x for x in rng.integers(0, 6, 13)]
    anchors = set()
    for _ in range(50):
        left, right = ([b"p%d" % x for x in rng.integers(0, 6, int(rng.integers(0, 30)))] for _ in range(2))
        p = rc.parse([left + passage + right])
        anchors.add(int(p.anchor[len(left)]))
    assert len(anchors) == 1


def test_symbols_stand_for_the_same_words():
    rng = np.random.default_rng(8)
    docs = [[b"x%d" % x for x in rng.integers(0, 2, 400)] for _ in range(20)]
    p = rc.parse(docs)
    seen: dict[int, tuple] = {}
    for name, d, s, e in zip(p.long_name.tolist(), p.long_doc.tolist(), p.long_start.tolist(), p.long_end.tolist(), strict=True):
        words = tuple(docs[d][s - int(p.begins[d]) : e - int(p.begins[d])])
        assert seen.setdefault(name, words) == words
    assert sum(int(e - s) == 400 for s, e in zip(p.long_start, p.long_end, strict=True)) >= 20  # each whole document is a symbol


def test_edges(nasty, empty):
    rows = [(r["doc_id"], r["text"]) for r in nasty.collect()]
    assert order(rc.remove_repeats(nasty).drop("kept").collect()) == order(plain(rows, 13))
    assert rc.remove_repeats(empty).count() == 0
