from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from tillwise.llm import mixing


def level(sizes):
    """Targets by handing on the excess until none is above its limit."""
    weights = dict(zip(sizes, [(3, 1, 2)[i % 3] for i in range(len(sizes))], strict=True))
    total, fixed = 1.5 * sum(sizes.values()), {}
    while True:
        free = [s for s in sizes if s not in fixed]
        rest, w = total - sum(fixed.values()), sum(weights[s] for s in free)
        over = [s for s in free if rest * weights[s] / w > 2 * sizes[s]]
        if not over:
            return {**fixed, **{s: rest * weights[s] / w for s in free}}
        fixed |= {s: 2.0 * sizes[s] for s in over}


@pytest.mark.parametrize("seed", range(4))
def test_targets_and_sample(spark, seed):
    rng = np.random.default_rng(seed)
    rows = [(int(i), None if s == 0 else f"s{s}", int(n)) for i, (s, n) in enumerate(zip(rng.geometric(0.3, 3000) % 9, rng.integers(0, 400, 3000), strict=True))]
    table = spark.createDataFrame(rows, "doc_id long, source string, size long")
    got = mixing.systematic(table).collect()
    assert sorted(r["doc_id"] for r in got) == list(range(3000))
    names = sorted({s for _, s, _ in rows if s}) + [None]
    sizes = {s: sum(n for _, t, n in rows if t == s) for s in names if any(t == s for _, t, _ in rows)}
    targets = level(sizes)
    for s in sizes:
        mine = [r for r in got if r["source"] == s]
        assert mine[0]["source_size"] == sizes[s] and abs(mine[0]["target"] - targets[s]) < 1e-6 * targets[s] + 1e-9
        assert all(0 <= r["copies"] <= 2 for r in mine)
        assert abs(sum(r["copies"] * r["size"] for r in mine) - targets[s]) <= 3 * 400
    again = mixing.systematic(table.repartition(7)).collect()
    assert {(r["doc_id"], r["copies"]) for r in got} == {(r["doc_id"], r["copies"]) for r in again}


def test_one_source_holds_nearly_all(spark):
    table = spark.range(20_000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 100 == 0, "b").otherwise("a").alias("source"), F.lit(7).cast("long").alias("size"))
    got = {r["source"]: r for r in mixing.systematic(table).groupBy("source").agg(F.sum(F.col("copies") * 7).alias("taken"), F.first("target").alias("target")).collect()}
    assert got["b"]["taken"] == got["b"]["target"] == 2 * 7 * 200
    assert abs(got["a"]["taken"] - got["a"]["target"]) <= 7


def test_edges(nasty, stored, empty):
    got = mixing.mix(nasty)
    assert got.count() == nasty.count() and got.where("taken > 2 * size OR taken IS NULL OR target IS NULL").count() == 0
    assert mixing.mix(empty).count() == 0 and mixing.take(empty).count() == 0
    taken = mixing.take(stored)
    assert taken.columns == stored.columns
    assert mixing.mix(nasty.select("doc_id", F.lit("").alias("text"), "source")).where("target <> 0 OR taken <> 0").count() == 0


def test_the_drawn_rows_are_taken_when_later_scans_are_cut_otherwise(spark, tmp_path):
    rows = [(i, f"word{i} " * (1 + i % 50), "ab"[i % 2]) for i in range(300)]
    spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(9).write.parquet(f"{tmp_path}/docs")
    docs = spark.read.parquet(f"{tmp_path}/docs")
    want = {r["doc_id"]: r["copies"] for r in mixing.mix(docs).collect() if r["copies"]}
    taken = mixing.take(docs)
    spark.conf.set("spark.sql.files.minPartitionNum", "1")  # as if executors had come or gone since
    try:
        got = [r["doc_id"] for r in taken.collect()]
    finally:
        spark.conf.unset("spark.sql.files.minPartitionNum")
    assert {i: got.count(i) for i in set(got)} == want


def test_one_id_holds_a_third_of_the_rows(spark):
    rows = [(None if i % 3 == 0 else 7 if i % 3 == 1 else i, "ab"[i % 2], 5 + i % 4, i) for i in range(6000)]
    table = spark.createDataFrame(rows, "doc_id long, source string, size long, row long")
    dealt = mixing.systematic(table, row_col="row")
    got = dealt.collect()
    assert sorted(r["row"] for r in got) == list(range(6000))
    # rows equal in id and size may change places: what they take together may not
    together = lambda rs: sorted(((r["source"], r["size"], r["doc_id"] or -1, r["copies"]) for r in rs))
    assert together(got) == together(mixing.systematic(table).collect())
    for s in "ab":
        mine = [r for r in got if r["source"] == s]
        assert abs(sum(r["copies"] * r["size"] for r in mine) - mine[0]["target"]) <= 3 * 8
    again = mixing.systematic(table.repartition(5), row_col="row").collect()
    assert {(r["row"], r["copies"]) for r in got} == {(r["row"], r["copies"]) for r in again}
