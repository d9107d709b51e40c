from __future__ import annotations

import hashlib
import re
import time

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as some

from tillwise.llm import boosting, pii

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def plain(text):
    digits = lambda m: re.sub("[^0-9]", "", m.group())
    return [
        [m.span() for m in EMAIL.finditer(text)],
        [m.span() for m in IP.finditer(text) if all(int(p) <= 255 for p in m.group().split("."))],
        [m.span() for m in CARD.finditer(text) if 13 <= len(digits(m)) <= 19 and pii.luhn(digits(m))],
        [m.span() for m in PHONE.finditer(text) if 9 <= len(digits(m)) <= 15],
    ]


@settings(max_examples=600, deadline=None)
@given(some.lists(some.sampled_from(["a", "@", ".", "-", "1", "4", "255", "0", "256", " ", "+", "(", ")", "@b.c", "4111111111111111", "\n", "é", "10.0.0.1", "+1 202 555"]), max_size=24))
def test_fixed_patterns_equal_their_regular_expressions(parts):
    text = "".join(parts)
    assert pii.base_spans(text) == plain(text)


def test_long_runs_take_linear_time():
    for text in ("1" * 200_000, "a" * 200_000 + "@", "1." * 100_000, "+1" + " " * 200_000, "a@" * 100_000, "1 " * 100_000):
        pii.base_spans(text)
        pii.propose(text)


def test_luhn():
    assert pii.luhn("4111111111111111") and not pii.luhn("4111111111111112")


def test_boosted_trees_learn_an_interaction():
    rng = np.random.default_rng(2)
    x = rng.random((3000, 5))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    model = boosting.fit(x[:2000], y[:2000])
    assert (((model.probability(x[2000:]) > 0.5) == (y[2000:] > 0.5)).mean()) > 0.95


def test_other_notations_are_added_and_plain_numbers_are_not(spark):
    rng = np.random.default_rng(3)
    texts = []
    for i in range(300):
        n = rng.integers(100, 999, 6)
        texts.append(f"call +1 ({n[0]}) {n[1]}-{n[2]}4 or write to user{i}@mail{i % 7}.example.com from 10.{n[3] % 256}.{n[4] % 256}.{n[5] % 256} on 2021-03-0{i % 9 + 1}, release {i}.0.1")
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    model = pii.train(docs)
    got = pii.find_in(["reach me at (415) 555-2671 please", "as of 2019-11-25 version 3.0.1 has 1234567 lines", "mail jo.doe (at) site.example.com now"], model)
    assert [[k for k, _, _ in every] for _, every in got] == [[3], [], [0]]


def test_edges(spark, nasty, empty):
    model = pii.train(nasty)
    got = pii.find(nasty, model).collect()
    assert len(got) == nasty.count()
    assert {r["base_sha256"] for r in got if r["doc_id"] in (1, 2, 3)} == {hashlib.sha256(b"").hexdigest()}
    assert pii.find(empty, pii.train(empty)).count() == 0
    data = spark.createDataFrame([(1, "x a@b.co 10.0.0.1, +1 202 555 0101, 4111111111111111\n")], "doc_id long, text string")
    row = pii.find(data, model).first()
    assert (row["n_email"], row["n_ip"], row["n_card"], row["n_phone"]) == (1, 1, 1, 1)
    want = "email:2:8,ip:9:17,card:36:52,phone:19:34"
    assert row["spans"] == want and row["base_sha256"] == hashlib.sha256(want.encode()).hexdigest()
    assert row["redacted"] == "x [email] [ip], [phone], [card]\n"


class _AnyTrees:
    """A stand-in for trained trees: a probability from the features, some of them equal."""

    def probability(self, x):
        return (x.sum(axis=1).astype(int) % 7 + 1) / 8


_ANY = pii.Model(_AnyTrees(), (0.2, 0.3, 0.4, 0.5))


def _every_pair(text, model):
    """Added spans by comparing each with all others."""
    every = [(k, s, e) for k, spans in enumerate(pii.base_spans(text)) for s, e in spans]
    free = [c for c in pii.propose(text) if not any(c[1] < b and a < c[2] for _, a, b in every)]
    p = model.trees.probability(np.array([pii.features(k, *pii._context(text, s, e)) for k, s, e in free], float)) if free else []
    for j in sorted(range(len(free)), key=lambda j: (-p[j], j)):
        k, s, e = free[j]
        if p[j] >= model.thresholds[k] and not any(s < b and a < e for _, a, b in every):
            every.append((k, s, e))
    return every


@settings(max_examples=150, deadline=None)
@given(some.lists(some.sampled_from(["a@b.co", "jo at site", "+1 415 555 2671", "4111 1111 1111 1111", "1.2.3.4", "1.2.3.999", "2019-11-25", "4155552671", "555-26", " ", ", ", "x", "(", "@", "."]), max_size=40))
def test_added_spans_equal_those_of_comparing_all_pairs(parts):
    text = "".join(parts)
    assert pii.find_in([text], _ANY)[0][1] == _every_pair(text, _ANY)


def test_a_text_with_many_items_takes_time_in_proportion():
    def seconds(n):
        text = " ".join(f"u{i}@site{i % 97}.org (415) 555-{i % 9000 + 1000}; +1 212 555 {i % 9000 + 1000} mail jo{i} (at) there" for i in range(n))
        begin = time.perf_counter()
        found = pii.find_in([text], _ANY)[0][1]
        assert len(found) >= 2 * n
        return time.perf_counter() - begin

    seconds(100)
    small, large = seconds(2_500), seconds(25_000)
    assert large < 30 * small and large < 60
