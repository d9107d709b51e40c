from __future__ import annotations

import numpy as np
import pytest

from tests.llm.conftest import LONG
from tillwise.llm import simhash
from tillwise.llm.components import components


def union(n, pairs):
    parent = list(range(n))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in pairs:
        parent[max(find(a), find(b))] = min(find(a), find(b))
    return [find(i) for i in range(n)]


def groups(labels):
    out = {}
    for i, x in enumerate(labels):
        out.setdefault(x, set()).add(i)
    return sorted(map(sorted, out.values()))


@pytest.mark.parametrize("crowd", [1, 4, 64])
@pytest.mark.parametrize("radius", [0, 1, 2])
def test_links_give_the_components_of_all_pairs(spark, crowd, radius):
    rng = np.random.default_rng(crowd)
    prints = {0, (1 << 64) - 1}
    for _ in range(12):
        center = int(rng.integers(0, 1 << 63)) << 1
        for _ in range(25):
            x = center
            for b in rng.choice(64, int(rng.integers(0, 5)), replace=False):
                x ^= 1 << int(b)
            prints.add(x)
    prints |= {1 << b for b in range(0, 64, 3)}
    prints = sorted(prints)
    near = [(i, j) for i in range(len(prints)) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= radius]
    table = spark.createDataFrame([(simhash._signed(p),) for p in prints], "print long")
    number = {simhash._signed(p): i for i, p in enumerate(prints)}
    links = [(number[r["u"]], number[r["v"]]) for r in simhash.link(table, radius, crowd).collect()]
    assert groups(union(len(prints), links)) == groups(union(len(prints), near))


def test_components(spark):
    chain = [(i, i + 1) for i in range(40)] + [(100, 99), (99, 100), (7, 7), (200, 201), (200, 202), (200, 203)]
    got = dict(components(spark.createDataFrame(chain, "u long, v long")).collect())
    assert {got[i] for i in range(41)} == {0} and got[100] == 99 and got[203] == 200 and got[99] == 99
    assert components(spark.createDataFrame([], "u long, v long")).collect() == []


def test_thresholds_meet_the_pigeonhole_sum():
    rng = np.random.default_rng(0)
    for n in (0, 1, 1000, 10**6, 10**10):
        bits = (rng.random((4000, 64)) < np.linspace(0.02, 0.6, 64)).astype(float)
        both = bits.T @ bits * (n / 4000)
        chosen = simhash.allocate(n, both)
        used = [b for part, _ in chosen for b in part]
        assert len(used) == len(set(used))
        assert any(sum(t for _, t in chosen) - (m - len(chosen)) == 2 - m + 1 for m in (1, 2, 3))


def test_fingerprint_of_few_and_many_words():
    assert simhash.fingerprint(None) == simhash.fingerprint(" \n") == 0
    import xxhash

    assert simhash.fingerprint("A b") == xxhash.xxh64_intdigest(b"a b", 42)
    assert simhash.fingerprint("x y z") == xxhash.xxh64_intdigest(b"x y z", 42)
    words = LONG.encode().split()
    hashes = [xxhash.xxh64_intdigest(b" ".join(words[i : i + 3]), 42) for i in range(len(words) - 2)]
    assert simhash.fingerprint(LONG) == sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_edges(spark, nasty, stored, empty):
    got = {(r["doc_id"], r["component_id"]) for r in simhash.near_duplicates(nasty).collect()}
    assert {c for d, c in got if d in (1, 2, 3)} == {1}
    assert (None, -3) in got and (-3, -3) in got and (None, 1) in got
    assert simhash.near_duplicates(empty).count() == 0
    kept = simhash.keep_one(stored)
    assert kept.columns == stored.columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert ids.count(5) == 1 and 1 in ids and 2 not in ids and None not in ids and -3 in ids and 4 in ids
    assert simhash.keep_one(empty).count() == 0


def test_one_of_each_group_stays_when_later_scans_are_cut_otherwise(spark, tmp_path):
    rows = [(i, " ".join(f"w{i % 40}x{j}" for j in range(30)), i) for i in range(80)]
    spark.createDataFrame(rows, "doc_id long, text string, n int").repartition(9).write.parquet(f"{tmp_path}/docs")
    kept = simhash.keep_one(spark.read.parquet(f"{tmp_path}/docs"))
    spark.conf.set("spark.sql.files.minPartitionNum", "1")  # as if executors had come or gone since
    try:
        assert sorted(r["doc_id"] for r in kept.collect()) == list(range(40))
    finally:
        spark.conf.unset("spark.sql.files.minPartitionNum")
