from __future__ import annotations

import zlib

import numpy as np
from pyspark.sql import functions as F

from tillwise.llm import naive_bayes_svm as nb

DATA = "/root/testdata/sf0.01"


def test_held_out_labels_are_predicted(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    rows = nb.classify(docs, labels).join(labels, "doc_id").where("held_out").collect()
    assert len(rows) > 900
    right = [r["predicted"] == r["quality"] for r in rows]
    good = [r["predicted"] for r in rows if r["quality"] == 1]
    assert np.mean(right) > 0.95 and np.mean(good) > 0.99


def test_kept_rows_are_those_predicted_good(spark):
    docs, labels = spark.read.parquet(f"{DATA}/documents.parquet"), spark.read.parquet(f"{DATA}/labels.parquet")
    kept = nb.keep_good(docs, labels)
    assert kept.columns == docs.columns
    assert kept.count() == nb.classify(docs, labels).where("predicted = 1").count()


def test_the_dual_solution_is_the_best():
    """No small step from the weights found lowers the primal objective, and the duality gap is small."""
    rng = np.random.default_rng(0)
    rows = [np.unique(rng.integers(0, 300, 20)) for _ in range(200)]
    y = np.array([1.0 if (r < 150).sum() + rng.normal(0, 2) > 10 else -1.0 for r in rows])
    ratio = np.ones(nb.SLOTS, np.float32)
    w, b = nb.dual_coordinate_descent(rows, y, ratio, epochs=300)
    x = [np.full(len(r), 1 / np.sqrt(len(r))) for r in rows]

    def primal(w, b):
        loss = sum(max(0.0, 1 - t * (w[r] @ v + b)) for r, v, t in zip(rows, x, y, strict=True))
        return 0.5 * (w.astype(float) @ w + b * b) + loss

    base = primal(w, b)
    for _ in range(50):
        step = np.zeros(nb.SLOTS)
        step[:300] = rng.normal(0, 0.05, 300)
        assert primal(w + step, b + rng.normal(0, 0.05)) > base - 1e-2 * base


def test_edges(spark, nasty, empty):
    labels = spark.createDataFrame([(4, 1, None), (5, 0, 1), (5, 1, 0), (None, 1, 0), (6, None, 0), (99, 0, 0), (8, 1, 0)], "doc_id long, quality int, toxic int")
    got = nb.classify(nasty, labels)
    assert got.columns == ["doc_id", "held_out", "score", "predicted"] and got.count() == nasty.count()
    assert got.where("score IS NULL OR score < 0 OR score > 1 OR predicted <> int(score >= 0.7)").count() == 0
    for r in got.select("doc_id", "held_out").distinct().collect():
        assert r["held_out"] == (zlib.crc32(str("" if r["doc_id"] is None else r["doc_id"]).encode()) % 4 == 2)
    assert [r["score"] for r in nb.classify(nasty, labels.where("false")).select("score").distinct().collect()] == [0.5]
    assert nb.classify(empty, labels).count() == 0


def test_held_out_labels_are_not_read(spark):
    docs, labels = spark.read.parquet(f"{DATA}/documents.parquet"), spark.read.parquet(f"{DATA}/labels.parquet")
    turned = labels.withColumn("quality", F.when(nb.id_remainder(F.col("doc_id"), 4) == 2, 1 - F.col("quality")).otherwise(F.col("quality")))
    assert set(nb.classify(docs, labels).collect()) == set(nb.classify(docs, turned).collect())


def test_a_sampled_id_that_many_rows_share_is_learned_from_once(spark):
    rows = [(i if i % 3 else 3, f"word{i % 11} and more of text {i}") for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = docs.select("doc_id").distinct().select("doc_id", (F.col("doc_id") % 2).cast("int").alias("quality"))
    sample = nb.labelled_sample(docs, labels, per_class=200).collect()
    ids = [r["doc_id"] for r in sample]
    assert len(ids) == len(set(ids)) <= 400
    again = nb.labelled_sample(docs.repartition(7), labels, per_class=200).collect()
    assert sorted(map(tuple, sample)) == sorted(map(tuple, again))
