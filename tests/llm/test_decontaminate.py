from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from tillwise.llm import decontaminate as d

ITEM = "Alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu"
BENCH = [(1, ITEM), (10, "short item"), (2, "Short, ITEM!"), (3, None), (4, " ... "), (None, "nameless words"), (5, ITEM), (5, ITEM)]


@pytest.fixture
def bench(spark):
    return spark.createDataFrame([(i, t, 0) for i, t in BENCH], "item_id long, text string, hash long")


def brute(text):
    ws = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    hit, items = set(), set()
    for item, t in BENCH:
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m.group().lower(), t or ""))
        k = min(10, len(w))
        grams = {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if w else set()
        for i in range(len(ws) - k + 1):
            if tuple(ws[i : i + k]) in grams:
                hit |= set(range(i, i + k))
                items |= {str(item)} if item is not None else set()
    return len(ws), len(hit), sorted(items)


TEXTS = [
    "before " + ITEM.upper() + " after",
    "alpha beta gamma delta epsilon zeta eta theta iota nothing",
    "a short item, short item short ITEM",
    "kappa " + " ".join(ITEM.split()[:10]) + " x " + " ".join(ITEM.split()[1:11]),
    "nameless-words here",
    "",
    None,
    "9 é ß",
]


@pytest.mark.parametrize("limit", [0, d.BROADCAST_WINDOWS])
def test_hits_with_and_without_broadcast(spark, bench, monkeypatch, limit):
    monkeypatch.setattr(d, "BROADCAST_WINDOWS", limit)
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "doc_id long, text string")
    got = {r["doc_id"]: (r["n_words"], r["n_hit"], r["items"]) for r in d.find(docs, bench).collect()}
    assert got == {i: brute(t) for i, t in enumerate(TEXTS)}


def test_edges(spark, nasty, stored, empty, bench):
    assert d.find(nasty, bench).count() == nasty.count()
    assert d.find(empty, bench).count() == 0
    assert d.find(nasty, bench.where("false")).where("contaminated").count() == 0
    left = d.drop_documents(stored, spark.createDataFrame([(1, "text under the same number")], "item_id long, text string"))
    assert left.columns == stored.columns and left.where("doc_id = 5").count() == 0 and left.count() == stored.count() - 3


def test_spans_are_cut_out_of_the_text(spark, bench):
    docs = spark.createDataFrame([(1, "See: (Short ITEM)! Next"), (2, "Nothing here"), (3, None)], "doc_id long, text string")
    assert dict(d.remove_spans(docs, bench).collect()) == {1: "See: ( )! Next", 2: "Nothing here", 3: None}


def test_the_main_path_has_no_python(spark, nasty, bench):
    plan = d.find(nasty, bench)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_rows_of_an_id_are_dropped_one_by_one(spark, nasty, bench):
    rows = [(None, ITEM), (None, "clean"), (None, None), (7, "clean too"), (7, "see " + ITEM), (7, ITEM), (8, ""), (9, ITEM), (9, "clean")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = [r for r in rows if not brute(r[1])[1]]
    assert sorted(map(str, map(tuple, d.drop_rows(docs, bench).collect()))) == sorted(map(str, want))
    assert d.drop_rows(nasty, bench).columns == nasty.columns
    left = d.drop_rows(nasty, spark.createDataFrame([(1, "text under the same number")], "item_id long, text string"))
    assert left.where("doc_id = 5").count() == 2 and left.count() == nasty.count() - 1


def test_the_stage_keeps_clean_rows_of_a_contaminated_id(spark, bench, tmp_path):
    import corpus_pipeline

    bench.write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = spark.createDataFrame([(None, ITEM), (None, "clean"), (7, "clean too"), (7, ITEM)], "doc_id long, text string")
    got = corpus_pipeline.decontamination(spark, docs, str(tmp_path)).collect()
    assert sorted(r["text"] for r in got) == ["clean", "clean too"]


@pytest.mark.parametrize("chunk", [1, 2, 9, 10, 32])
def test_windows_across_chunks_are_found_once(spark, bench, monkeypatch, chunk):
    monkeypatch.setattr(d, "CHUNK", chunk)
    texts = [*TEXTS, "x " * 21 + ITEM + " y" * 11 + " short item " + ITEM, ITEM + " " + ITEM, " ".join(["alpha"] * 65)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: (r["n_words"], r["n_hit"], r["items"]) for r in d.find(docs, bench).collect()}
    assert got == {i: brute(t) for i, t in enumerate(texts)}


def test_a_window_of_another_text_under_the_same_hash_is_no_hit(spark, bench, monkeypatch):
    docs = spark.createDataFrame([(1, "before " + ITEM), (2, "short item")], "doc_id long, text string")
    other = d.benchmark_windows(bench).withColumn("phrase", F.concat("phrase", F.lit("!")))
    monkeypatch.setattr(d, "benchmark_windows", lambda *a, **k: other)
    assert sorted((r["doc_id"], r["n_words"], r["n_hit"]) for r in d.find(docs, bench).collect()) == [(1, 13, 0), (2, 2, 0)]


def test_a_text_of_a_million_words_ends(spark, bench):
    docs = spark.createDataFrame([(1, "w " * 1_000_000 + ITEM)], "doc_id long, text string")
    r = d.find(docs, bench).first()
    assert (r["n_words"], r["n_hit"]) == (1_000_012, 12)


def test_shuffled_windows_do_not_carry_their_document(spark, bench, monkeypatch):
    monkeypatch.setattr(d, "BROADCAST_WINDOWS", 0)
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = d.find(docs, bench)
        plan = spark._jvm.PythonSQLUtils.explainString(found._jdf.queryExecution(), "formatted")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    shuffled = re.findall(r"\) Exchange\nInput \[\d+\]: \[(.*)\]", plan)
    assert any("said#" in x for x in shuffled) and not any(re.search(r"\b(w|part)#", x) for x in shuffled)
