from __future__ import annotations

import itertools
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from tillwise.llm import huffman as h
from tillwise.llm import scratch

WORDS = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
STRANGE = [
    "don't we'll THE'S 'tis",
    "<|ENDOFTEXT|> x<|endoftext|>y <|startoftext|>",
    "é!≠ a̸ é…! İ! İx ß ﬁ K",
    "日本語テキスト。ok 12３４ ½x",
    "",
    "a b　c  d\x1ce",
    "A.B-C##$$ x1y22 __ ``'' ’s it’s",
    "ǅ Σας ΟΔΟΣ!",
    "\x00\x01 \x7f~",
    "각 각!",
]


def cost(lengths, counts):
    return int((lengths.astype(int) * counts).sum())


@pytest.mark.parametrize("limit", [3, 4, 6])
def test_code_lengths_are_the_best_within_the_limit(limit):
    rng = np.random.default_rng(limit)
    for n in (1, 2, 3, 5, 6):
        counts = rng.integers(1, 200, n)
        got = h.code_lengths(counts, limit)
        if n > 1:
            best = min(
                sum(a * b for a, b in zip(ls, counts, strict=True)) for ls in itertools.product(range(1, limit + 1), repeat=n) if sum(2.0**-x for x in ls) <= 1
            )
            assert cost(got, counts) == best
        assert got.max() <= limit and sum(2.0 ** -int(x) for x in got) <= 1


@pytest.mark.parametrize("ids", [[], [3], [3] * 700, list(range(300)) * 3, [0, 1, 0, 0, 1]])
def test_pack_and_unpack(ids):
    ids = np.array(ids, np.int64)
    lengths = h.code_lengths(np.bincount(ids, minlength=1))
    payload, offsets = h.pack(ids, h.canonical(lengths), lengths)
    assert (h.unpack(payload, offsets[:: h.STEP], len(ids), h.decode_table(lengths)) == ids).all()


def test_decoding_may_start_at_any_checkpoint():
    ids = np.random.default_rng(1).integers(0, 5000, 4000)
    lengths = h.code_lengths(np.bincount(ids))
    payload, offsets = h.pack(ids, h.canonical(lengths), lengths)
    at = offsets[:: h.STEP]
    assert (h.unpack(payload, at[5:7], 2 * h.STEP, h.decode_table(lengths)) == ids[5 * h.STEP : 7 * h.STEP]).all()


@pytest.mark.parametrize("limit", [8, 700_000])
def test_remembered_pieces_equal_whole_texts(limit):
    memo = h.WordMemo(WORDS, limit)
    for t in STRANGE * 2:
        got = np.frombuffer(memo.ids([t.encode()])[0], memo.type).tolist()
        assert got == WORDS.encode(t, add_special_tokens=False).ids, t


class Counted:
    """A tokenizer that counts what it is asked; ``normalizer`` and ``model`` are itself."""

    def __init__(self):
        self.asked = []
        self.normalizer = self.model = self

    def get_vocab(self):
        return WORDS.get_vocab()

    def encode(self, *args, **more):
        self.asked.append("encode")
        return WORDS.encode(*args, **more)

    def normalize_str(self, text):
        self.asked.append("normalize")
        return WORDS.normalizer.normalize_str(text)

    def tokenize(self, text):
        self.asked.append(text)
        return WORDS.model.tokenize(text)


def test_texts_of_a_batch_are_normalised_together_and_each_piece_is_encoded_once():
    memo = h.WordMemo(counted := Counted())
    counted.asked.clear()
    words = [f"é{chr(97 + i)}{chr(97 + k)}" for i in range(26) for k in range(26)]
    texts = [f"{w.upper()}, the {v} 7" for w in words for v in words[:5]]
    got = memo.ids([t.encode() for t in texts])
    assert counted.asked.count("normalize") <= 2 and "encode" not in counted.asked
    pieces = [x for x in counted.asked if x != "normalize"]
    assert len(pieces) <= 2 * len(words) + 3  # in capitals and not, and three more
    for i in range(0, len(texts), 97):
        assert np.frombuffer(got[i], memo.type).tolist() == WORDS.encode(texts[i], add_special_tokens=False).ids


@pytest.mark.parametrize("limit", [8, 700_000])
def test_plain_and_strange_texts_in_one_batch(limit):
    spaced = ["a\xa0", "\xa0", "zzé", "cé\xa0dé", "é", "\u2003 é", " \t\n", "", "7\u0301 a\u0301", "ÉÉ ÀB", "<|x|> <x| y", "\x1c\x85 é"]
    texts = [f"{a} {b}" for a in (*STRANGE, *spaced, "plain wörds, 42!") for b in ("", "plain", *spaced)] + [None, "", None, "x"]
    whole = [WORDS.encode(t or "", add_special_tokens=False).ids for t in texts]
    memo = h.WordMemo(WORDS, limit)
    for kind in (pa.string(), pa.large_string()):
        rows = pa.array(["left out", *texts, "too"], kind).slice(1, len(texts))
        for part in (rows, rows.slice(5), rows.slice(7, 20), rows.slice(0, 0)):
            got = [np.frombuffer(x, memo.type).tolist() for x in memo.packed(part).to_pylist()]
            assert got == whole[part.offset - 1 :][: len(part)]


def test_slices_hold_all_rows_in_order(monkeypatch):
    monkeypatch.setattr(h, "SLICE_BYTES", 100)
    texts = ["x" * n for n in (0, 30, 30, 30, 30, 1000, 0, 1, 1)] + [None] * 3 + ["y" * 250, ""]
    for rows in (texts, [], [None], ["z" * 500]):
        parts = list(h._slices(pa.RecordBatch.from_arrays([pa.array(rows, pa.string())], ["text"])))
        assert [t for p in parts for t in p.column("text").to_pylist()] == rows
        assert all(sum(len(t or "") for t in p.column("text").to_pylist()[:-1]) < 100 for p in parts)


DECOMPOSED = [chr(c) for c in range(0x80, 0x110000) if chr(c).isalpha() and not WORDS.normalizer.normalize_str(chr(c)).isalpha()]


def test_letters_that_normalise_to_a_letter_and_a_mark():
    assert {"\u0958", "\u09dc", "\u0a33", "\ufb1d", "\ufb2a"} <= set(DECOMPOSED)
    memo = h.WordMemo(WORDS)
    for c in DECOMPOSED:
        for t in (c, f"{c}\u092e", f"{c}\u05dc", f"a{c}! {c}7 x"):
            got = np.frombuffer(memo.ids([t.encode()])[0], memo.type).tolist()
            assert got == WORDS.encode(t, add_special_tokens=False).ids, t


def expected(rows):
    """By the library's own encoding of each whole text, in order of id."""
    out, start = [], 0
    for doc, text in sorted(rows, key=lambda r: (r[0] is not None, r[0])):
        ids = [*WORDS.encode(text or "", add_special_tokens=False).ids, h.END]
        out.append((doc, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_round_trip(spark, nasty):
    rows = [(r["doc_id"], r["text"]) for r in nasty.collect()]
    got = h.round_trip(nasty).collect()
    assert sorted((tuple(r)[0], *tuple(r)[2:]) for r in got if r["doc_id"] is not None) == sorted((a, c, d) for a, b, c, d in expected(rows) if a is not None)
    by_start = sorted(got, key=lambda r: r["start"])
    assert [r["start"] for r in by_start] == list(itertools.accumulate([0, *(r["n_tokens"] for r in by_start[:-1])]))
    assert [r["doc_id"] for r in by_start] == [r[0] for r in expected(rows)]


def test_round_trip_of_given_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").repartition(5)
    assert sorted(map(tuple, h.round_trip(docs).collect())) == expected([(r["doc_id"], r["text"]) for r in docs.collect()])


def test_blocks_decode_alone_and_empty_tables_write_none(spark, empty):
    tokens = spark.createDataFrame([(i, 300, np.full(300, i, "<u2").tobytes()) for i in range(40)], "doc_id long, n long, ids binary")
    path = scratch.fresh_path(spark, "blocks")
    h.write(tokens, path, block_tokens=1000)
    assert h.read_blocks(spark, path).count() > 8
    got = {r["doc_id"]: (r["start"], np.frombuffer(r["ids"], "<u4").tolist()) for r in h.read(spark, path).collect()}
    assert got == {i: (300 * i, [i] * 300) for i in range(40)}
    assert h.round_trip(empty).collect() == []


def test_rows_of_one_id_are_dealt_to_several_tasks(spark, tmp_path):
    rows = [(None if i % 3 == 0 else 5 if i % 3 == 1 else i, f"text {i} of many") for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    tokens = scratch.materialize(h.tokenize(docs), "tokens")
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # it would join tasks as small as these
    try:
        h.write(tokens, f"{tmp_path}/file", block_tokens=500)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    parts = {r["part"]: r["null"] for r in spark.read.parquet(f"{tmp_path}/file/blocks").groupBy("part").sum("nulls").withColumnRenamed("sum(nulls)", "null").collect()}
    assert sum(parts.values()) == 1000 and max(parts.values()) < 900
    got = sorted(h.read(spark, f"{tmp_path}/file").select("start", "doc_id", "n").collect())
    ids = [-1 if r["doc_id"] is None else r["doc_id"] for r in got]
    assert ids == sorted(ids) and len(ids) == 3000
    assert all(a["start"] + a["n"] == b["start"] for a, b in zip(got, got[1:]))
