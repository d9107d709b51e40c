from __future__ import annotations

import math
import random
import re
from collections import Counter

import pytest

from tillwise.llm import shared_search as s

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return [re.sub("[A-Z]", lambda m: m.group().lower(), t) for t in TERM.findall(text or "")]


def brute(docs, items, k=10):
    docs = [(i, Counter(terms(t))) for i, t in docs]
    docs = [(i, c, sum(c.values())) for i, c in docs if c]
    n_docs, length = len(docs), sum(n for *_, n in docs)
    df = Counter(t for _, c, _ in docs for t in c)
    weight = {t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * f + 1))) for t, f in df.items()}
    out = []
    for item, text in items:
        asked, scored = Counter(terms(text)), []
        for i, c, n in docs:
            m = 100 - 75 + (75 * n * n_docs) // length
            score = sum(q * weight[t] * ((10**9 * c[t]) // (1000 * c[t] + 8 * m)) for t, q in asked.items() if t in c)
            if score > 0:
                scored.append((-score, i is None, i or 0))
        for rank, (score, none, i) in enumerate(sorted(scored)[:k], 1):
            out.append((item, rank, None if none else i, -score))
    return sorted(out, key=repr)


def got(df):
    assert df.columns == ["item_id", "rank", "doc_id", "score"]
    return sorted((tuple(r) for r in df.collect()), key=repr)


def corpus(seed, n=150, vocabulary=60):
    rnd = random.Random(seed)
    words = [f"W{i}" if i % 3 else f"é{i}" for i in range(vocabulary)]
    text = lambda most: " ".join(rnd.choices(words, [1 / (1 + i) for i in range(vocabulary)], k=rnd.randrange(most)))
    docs = [(i, text(80)) for i in range(n)] + [(n + i, docs) for i, docs in enumerate(["same w1 w2"] * 15 + ["", None, "..."])]
    return docs, [(i, text(25) + " same" * (i % 3)) for i in range(30)] + [(3, "W1 unknown"), (None, "w2"), (77, None), (78, "nowhere")]


@pytest.mark.parametrize("limits", [{}, {"PASS_TERMS": 7, "BLOCK_PAIRS": 40, "CELLS": 64}])
def test_equals_brute_force(spark, monkeypatch, limits):
    for name, value in limits.items():
        monkeypatch.setattr(s, name, value)
    docs, items = corpus(1)
    found = s.search(spark.createDataFrame(docs, "doc_id long, text string").repartition(4), spark.createDataFrame(items, "item_id long, text string"))
    assert got(found) == brute(docs, items)


def test_edges(spark, nasty, stored, empty):
    items = [(1, "the same words, in the same order"), (2, "w1x1 w2x2 ONE"), (2, "don't"), (None, "漢字"), (4, "")]
    asked = spark.createDataFrame([(i, t, 0, "x") for i, t in items], "item_id long, text string, score long, query string")
    docs = [(r["doc_id"], r["text"]) for r in nasty.select("doc_id", "text").collect()]
    assert got(s.search(nasty, asked)) == brute(docs, items)
    assert got(s.search(stored, asked, k=1)) == brute(docs, items, 1)
    assert s.search(empty, asked).count() == 0
    assert s.search(nasty, asked.where("false")).count() == 0
    assert s.search(nasty, asked.where("item_id = 4")).count() == 0


def test_shared_sets_are_added_once():
    lists = [[0, 1, 2, 3, 4], [0, 1, 2, 5], [0, 1, 2, 3, 6], [7], [7, 8]]
    nodes, left = s.share([list(x) for x in lists], 9)
    assert len(nodes) + sum(len(x) - 1 for x in left) < sum(len(x) - 1 for x in lists)

    def spelled(n):
        return [n] if n < 9 else [x for m in nodes[n - 9] for x in spelled(m)]

    assert [[y for n in x for y in spelled(n)] for x in left] == lists
    pairs = [p for x in left for p in zip(x, x[1:])]
    assert len(pairs) == len(set(pairs))


def test_terms_are_those_of_the_contract():
    for text in ("A-b_C9@d[é]{ß}\x1c\x7f~`İK", " x", "", None, "a" * 9):
        assert [t.decode() for t in s.terms(text)] == terms(text)
