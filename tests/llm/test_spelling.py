from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import pyarrow as pa
import pytest

from tillwise.llm import spelling as s


def distance_one(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute(rows):
    counts = Counter()
    for i, text in rows:
        for w in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            w = re.sub("[A-Z]", lambda m: m.group().lower(), w)
            h = zlib.crc32(f"{'' if i is None else i}:{w}".encode())
            if h % 31 == 0:
                w = w[: h % len(w)] + w[h % len(w) + 1 :]
            if len(w) >= 7:
                counts[w] += 1
    counts = {w: n for w, n in counts.items() if n >= 2}
    near = {w: [x for x in counts if distance_one(w, x)] for w in counts}
    form = {}
    for w in counts:
        best = min(near[w], key=lambda x: (-counts[x], x), default=None)
        form[w] = best if best and counts[best] >= 10 * counts[w] else None

    def root(w):
        while form[w]:
            w = form[w]
        return w

    return sorted((w, form[w] or "", root(w), counts[w], len(near[w]), counts[form[w]] if form[w] else 0) for w in counts)


def got(df):
    assert df.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    return sorted((r["word"], r["form"] or "", r["root"], r["n"], r["n_near"], r["form_n"] or 0) for r in df.collect())


def noisy(seed, n=200):
    rnd = random.Random(seed)
    base = ["letters", "spelling", "variants", "grouping", "éclaireur", "aaaaaaa", "abababab", "ßtraßen", "ÀbcdefÿÞ"]

    def edit(w):
        i, c = rnd.randrange(len(w)), rnd.choice("abelté")
        return rnd.choice([w[:i] + w[i + 1 :], w[:i] + c + w[i:], w[:i] + c + w[i + 1 :], w.upper(), w])

    words = [w for b in base for w in [b] * 30 + [edit(b) for _ in range(25)] + [edit(edit(b)) for _ in range(25)]]
    return [(i, " ".join(rnd.choices(words, k=rnd.randrange(40))) + rnd.choice(["", " 1x×y", "İstanbulx"])) for i in range(n)]


@pytest.mark.parametrize("limits", [{}, {"SUBTREE": 3, "HELD_WORDS": 5, "PAIRS": 2}, {"SUBTREE": 40}])
def test_equals_brute_force(spark, monkeypatch, limits):
    rows = noisy(len(limits))
    for name, value in limits.items():
        monkeypatch.setattr(s, name, value)
    found = s.variants(spark.createDataFrame(rows, "doc_id long, text string").repartition(3))
    want = brute(rows)
    assert got(found) == want
    assert any(f for _, f, *_ in want)


def test_chains_of_forms_end_at_their_last(spark):
    words = {"abcdefg": 2, "abcdefgh": 20, "abcdefghi": 200, "abcdefghij": 2000, "zzzzzzz": 5}
    rows = [(None, " ".join([w.upper()] * n)) for w, n in words.items()]
    want = brute(rows)
    assert got(s.variants(spark.createDataFrame(rows, "doc_id long, text string"))) == want


def test_edges(spark, nasty, stored, empty):
    rows = [(r["doc_id"], r["text"]) for r in nasty.select("doc_id", "text").collect()]
    assert got(s.variants(nasty)) == brute(rows)
    assert got(s.variants(stored)) == brute(rows)
    assert s.variants(empty).count() == 0
    long = "ab" * 70_000
    rows = [(1, f"{long} {long} {long}a {long}a"), (2, f"{long} " * 30), (3, "short"), (4, None)]
    assert got(s.variants(spark.createDataFrame(rows, "doc_id long, text string"))) == brute(rows)


def test_near_is_one_edit():
    rnd = random.Random(4)
    for _ in range(20_000):
        a, b = ("".join(rnd.choices("abé", k=rnd.randrange(1, 7))) for _ in range(2))
        assert s.near(a.encode("latin-1"), b.encode("latin-1")) == distance_one(a, b)


@pytest.mark.parametrize("depth", [1, 4, s.GROUPS])
def test_counts_cut_to_a_top_lose_no_pair_and_repeat_none(monkeypatch, depth):
    monkeypatch.setattr(s, "_TOP", 2)
    rnd = random.Random(depth)
    words = sorted({"".join(rnd.choices("aab", k=rnd.randrange(5, 8))) for _ in range(150)})
    group = [i % s.GROUPS for i in range(256)]
    table = pa.table({"word": words, "n": list(range(len(words)))})
    sent = pa.Table.from_batches(list(s._sent(group, depth)(iter(table.to_batches())))).sort_by("kind")
    found = [p for b in s._pairs(group)(iter(sent.to_batches(max_chunksize=97))) for p in zip(b["a"].to_pylist(), b["b"].to_pylist())]
    want = [(a, b) for i, a in enumerate(words) for b in words[i + 1 :] if distance_one(a, b)]
    assert sorted(tuple(sorted(p)) for p in found) == sorted(want)
