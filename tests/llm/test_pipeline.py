from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import __spark_entry__ as entry
import corpus_pipeline
from tests.conftest import SMALL
from tests.llm.test_recompression import order
from tests.llm.test_simhash import groups, union
from tillwise.llm import decontaminate, mixing, naive_bayes_svm, scratch, simhash


@pytest.fixture(scope="module")
def steps(spark):
    """Input and result of each stage, written and read again as the pipeline does."""
    docs, out = spark.read.parquet(f"{SMALL}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        result = scratch.materialize(stage(spark, docs, SMALL), name)
        out[name] = (docs, result)
        docs = result
    return out


def test_names_and_columns(steps):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "near_dedup", "decontamination", "source_mix", "token_files"]
    for name, (docs, result) in list(steps.items())[:-1]:
        assert result.columns == docs.columns, name
    assert {f"op{n}" for n in range(1, 14)} == {k.split("_")[0] for k in entry.queries() if k.startswith("op")} and "pipeline" in entry.queries()


def test_quality(spark, steps):
    docs, kept = steps["quality"]
    scores = naive_bayes_svm.classify(docs, spark.read.parquet(f"{SMALL}/labels.parquet")).where("predicted = 1")
    assert {r[0] for r in scores.select("doc_id").collect()} == {r[0] for r in kept.select("doc_id").collect()}


def test_near_dedup_keeps_one_of_each_group(steps):
    docs, kept = steps["near_dedup"]
    rows = sorted((r["doc_id"], simhash.fingerprint(r["text"])) for r in docs.collect())
    pairs = [(i, j) for i in range(len(rows)) for j in range(i) if (rows[i][1] ^ rows[j][1]).bit_count() <= 2]
    want = {rows[g[0]][0] for g in groups(union(len(rows), pairs))}
    assert {r["doc_id"] for r in kept.collect()} == want and kept.count() == len(want)


def test_decontamination(spark, steps):
    docs, kept = steps["decontamination"]
    found = decontaminate.find(docs, spark.read.parquet(f"{SMALL}/benchmark.parquet")).where("NOT contaminated")
    assert order(kept.select("doc_id").collect()) == order(found.select("doc_id").collect())
    assert kept.count() < docs.count()


def test_mix(steps):
    docs, mixed = steps["source_mix"]
    want = {r["doc_id"]: r["copies"] for r in mixing.mix(docs).collect() if r["copies"]}
    assert Counter(r["doc_id"] for r in mixed.collect()) == want


def test_token_files(steps):
    import public_tokenizers

    words = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    docs, result = steps["token_files"]
    start, want = 0, []
    for r in docs.orderBy("doc_id").collect():
        ids = [*words.encode(r["text"], add_special_tokens=False).ids, 2]
        want.append((r["doc_id"], start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert order(result.collect()) == want


def test_run_gives_the_last_stage(spark, steps):
    _, result = steps["token_files"]
    got = corpus_pipeline.run(spark, SMALL)
    assert order(got.collect()) == order(result.collect())


def test_stages_on_empty_and_nasty_tables(spark, stored, empty):
    for docs in (stored, empty):
        for name, stage in corpus_pipeline.STAGES:
            docs = scratch.materialize(stage(spark, docs, SMALL), name)
        assert docs.where(F.col("n_tokens") < 1).count() == 0
