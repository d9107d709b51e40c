from __future__ import annotations

import hashlib
import random
import re

import pytest

from tillwise.llm import content_sort as c


def brute(rows):
    """(doc_id, keep_id, group_size, kept, sha) of rows; of rows that share an id and a text it is not said which one stays."""
    groups = {}
    for i, t in rows:
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", t or ""), []).append(i)
    out = []
    for text, ids in groups.items():
        order = sorted(ids, key=lambda i: (i is None, i or 0))
        sha = hashlib.sha256(text.encode()).hexdigest()
        out += [(i, order[0], len(ids), n == 0, sha) for n, i in enumerate(order)]
    return sorted(out, key=repr)


def got(df):
    assert df.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    return sorted((tuple(r) for r in df.collect()), key=repr)


def pairs(df):
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]


@pytest.mark.parametrize("parts", [1, 7])
@pytest.mark.parametrize("chunk", [2, c.CHUNK])
def test_equals_brute_force_when_groups_span_ranges(spark, monkeypatch, parts, chunk):
    monkeypatch.setattr(c, "CHUNK", chunk)
    rnd = random.Random(parts)
    rows = [(i, "the hot text\tof all") for i in range(300)] + [(1000 + i, rnd.choice(["a b", "a  b", "a\n\x0bb", "", " ", None, " ", "a b "])) for i in range(200)]
    rows += [(2000 + i, "shared leading bytes longer than a splitter holds " + str(i % 40)) for i in range(90)] + [(None, "the hot text of all"), (5, "the hot text of all")]
    rnd.shuffle(rows)
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = c.duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(3))
        assert got(found) == brute(rows)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_edges(nasty, stored, empty):
    assert got(c.duplicates(nasty)) == brute(pairs(nasty))
    assert got(c.duplicates(stored)) == brute(pairs(nasty))
    assert c.duplicates(empty).count() == 0


def test_batches_of_any_size_give_the_same_runs(spark):
    rows = [(i, t) for i, t in enumerate(["x"] * 5 + ["y"] + ["z"] * 3 + ["zz", "zzz"])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    for size in ("1", "2", "3", "10000"):
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)
        assert got(c.duplicates(docs)) == brute(rows)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)


def test_splitters_do_not_hold_texts(stored):
    plan = c._sorted(stored, "doc_id", "text")._jdf.queryExecution().optimizedPlan().toString()
    ranged = re.search(r"RepartitionByExpression \[(.*?)\]", plan).group(1)
    assert "lead" in ranged and not re.search(r"\btext#", ranged)
