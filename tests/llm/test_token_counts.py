from __future__ import annotations

import re

import numpy as np
import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tests.llm.test_huffman import STRANGE
from tillwise.llm import token_counts as tc

BYTES = Tokenizer.from_file(public_tokenizers.path(tc.TOKENIZER))
BYTES.encode_special_tokens = True


def plain(text, sections):
    out = [[0, 0] for _ in sections]
    for a, b in BYTES.encode(text, add_special_tokens=False).offsets:
        held = [max(0, min(b, e) - max(a, s)) for s, e in sections]
        if held and max(held):
            k = held.index(max(held))
            out[k][0] += 1
            out[k][1] += max(held) < b - a
    return [tuple(x) for x in out]


def test_spans_equal_those_of_the_whole_text():
    for t in [*STRANGE, "a  b   c\n\n\n d  ", "  lead", "tail  ", "　x　 y", "x\x85y \x0c\x0b z"]:
        assert tc.offsets(tc.TOKENIZER).spans(t).tolist() == [list(o) for o in BYTES.encode(t, add_special_tokens=False).offsets], t


def test_lines_of_given_documents(spark, nasty):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").union(nasty.where("doc_id <> 4 AND doc_id <> 5").selectExpr("doc_id + 1000000", "text"))
    got = {(r["doc_id"], r["section"]): (r["start"], r["end"], r["n_tokens"], r["n_crossing"]) for r in tc.count_sections(docs).collect()}
    want = {}
    for doc, text in docs.collect():
        at, sections = 0, []
        for line in re.findall("[^\n]*\n|[^\n]+", text or ""):
            sections.append((at, at + len(line)))
            at += len(line)
        for k, (s, n) in enumerate(zip(sections, plain(text, sections) if text else [], strict=True)):
            want[doc, k] = (*s, *n)
    assert got == want


def test_random_sections():
    rng = np.random.default_rng(5)
    text = "Some words, and   more words; 漢字かな and \U0001f600\U0001f600 emoji!" * 3
    spans = tc.offsets(tc.TOKENIZER).spans(text)
    for _ in range(200):
        cuts = np.sort(rng.choice(len(text) + 1, 2 * int(rng.integers(1, 12)), replace=False)).reshape(-1, 2)
        got = list(zip(*(x.tolist() for x in tc.attribute(spans, cuts)), strict=True))
        assert got == plain(text, cuts.tolist())


def test_fields_and_edges(spark, nasty, empty):
    rows = spark.createDataFrame([(1, "Title here", "body text", None), (2, "", None, "z")], "id long, a string, b string, c string")
    got = {(r["doc_id"], r["field"]): (r["n_tokens"], r["n_crossing"]) for r in tc.count_fields(rows, "id", ["a", "b", "c"], " ").collect()}
    # " body" reaches over the separator, which belongs to the title
    assert got[1, "a"] == (2, 0) and got[1, "b"][1] == 1 and got[1, "c"] == (0, 0) and got[2, "c"][0] >= 0
    assert tc.count_sections(empty).count() == 0
    ids = [r["doc_id"] for r in tc.count_sections(nasty).select("doc_id").collect()]
    assert 1 not in ids and 2 not in ids and ids.count(5) == 3 and None in ids
    given = F.array(F.struct(F.lit(0).alias("start"), F.lit(3).alias("end")))
    assert tc.count_sections(nasty.where("doc_id = 7"), given).collect()[0]["n_tokens"] == 1
    assert tc.count_sections(nasty, F.lit(None)).count() == 0
