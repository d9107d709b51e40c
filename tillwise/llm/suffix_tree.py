"""Language-model scores from a probabilistic suffix tree over words.

Symbols are all words, by 64-bit hash, and the end of a text.  A node of the tree is a context, the last 1 to
``DEPTH`` words.  It is a candidate if training texts hold it ``LEAST`` times or more, and states the next symbols it
was followed by ``LEAST`` times or more.  A candidate is retained if these diverge from what its longest retained suffix
expects: the code length they save, the count times the Kullback-Leibler divergence, must exceed half a logarithm of
the training size per stated symbol.  The test takes the suffix's probabilities in steps of 1 / 1024 bit.  All bounds are fixed counts, so the tree grows with the text.

A retained context of count N gives a stated symbol of count n the probability (n - D) / N plus the mass that is
left times what the suffix gives; other symbols get the second part alone.  These add up to one at every
context.  A context that is not retained passes its suffix's probabilities on; the root has additively smoothed word counts.

The tree is never in one place.  Tokens are kept in chunks of some documents.  At depth k every chunk sends its distinct
(context, next symbol) pairs with their counts to the bucket of the context; there the pairs are counted over the corpus and the
context is tested; the answer goes back to the chunk, whose tokens then know their probability at depth k and
whether they can be the end of a longer context.  Chunks keep what they heard beside their tokens, in ``PARTS`` tables that
are written again one after the other at each depth, so that little lies on disk twice; the answers to the words
themselves are their numbers, which take the place of the hashes.  A context with more than ``HOT`` of all tokens (at most 1 / HOT of a depth)
is spread over several buckets by its next symbol, and its sums meet afterwards.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from math import ceil

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scratch import discard, large_rows, materialize, release
from .text import encoded, id_remainder

DEPTH = 3
LEAST = 2
DISCOUNT = 0.5
HOT = 1e-3
CHUNK = 1 << 19  # tokens of a chunk; one longer text is a chunk of its own
BUCKET = 1 << 21  # tokens of the corpus for each bucket
PARTS = 4  # tables that hold the chunks
SPREAD = np.uint64(64)
END = np.uint64(0x656E64206F662061)

#: words: the hashes of the chunk's words, until they have numbers, and the place of each token's word among them;
#: heard: per depth, counts of the pairs that were asked for, and numbers of the words or mass that the contexts leave
ROWS = "chunk long, doc_ids array<long>, train array<boolean>, sizes array<long>, words binary, heard array<binary>"
ASKED = "bucket long, chunk long, pairs binary"
#: contexts, their counts, if they are hot, how many of the pairs each has; symbols, what the suffix gives them, counts
PAIRS = (np.uint64, np.uint32, np.uint8, np.uint32, np.uint64, np.uint16, np.uint32)
ANSWERS = "chunk long, bucket long, counts binary, context long, times long, stated long, n_log_n double, n_log_p double, stated_n long, below double"
SCORES = "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double"


def word_hashes(text: str | None) -> np.ndarray:
    """64-bit hashes of the words of a text, A-Z in lower case."""
    words = encoded(text).lower().split()
    return np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))


_ZSTD = pa.Codec("zstd", 1)


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays as bytes: of each all first bytes, all second ones, and so on, compressed together."""
    raw = b"".join(np.ascontiguousarray(a).view(np.uint8).reshape(len(a), a.dtype.itemsize).T.tobytes() for a in arrays)
    return np.array([len(a) for a in arrays], "<u4").tobytes() + (_ZSTD.compress(raw, asbytes=True) if raw else b"")


def unpack(blob: bytes, *kinds: type) -> list[np.ndarray]:
    sizes = np.frombuffer(blob, "<u4", len(kinds)).tolist()
    widths = [np.dtype(k).itemsize for k in kinds]
    total = sum(n * w for n, w in zip(sizes, widths, strict=True))
    raw = np.frombuffer(_ZSTD.decompress(blob[4 * len(kinds) :], total, asbytes=True) if total else b"", np.uint8)
    out, at = [], 0
    for n, w, k in zip(sizes, widths, kinds, strict=True):
        out.append(np.ascontiguousarray(raw[at : at + n * w].reshape(w, n).T).view(k).ravel() if n else np.zeros(0, k))
        at += n * w
    return out


def coded(p: np.ndarray) -> np.ndarray:
    """Probabilities in two bytes, in steps of a thousandth of a bit: what the divergence test compares with."""
    return np.minimum(np.round(-1024 * np.log2(np.maximum(p, 1e-19))), 65535).astype(np.uint16)


def decoded(code: np.ndarray) -> np.ndarray:
    return np.exp2(code / -1024.0)


def mixed(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """A 64-bit hash of pairs."""
    x = a * np.uint64(0x9E3779B97F4A7C15) + (b ^ (b >> np.uint64(31))) * np.uint64(0xC2B2AE3D27D4EB4F) + np.uint64(1)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def in_order(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whole numbers from 0 in order, and where each stood: one plain sort where 64 bits hold both."""
    bits = len(key).bit_length()
    if len(key) and int(key.max()) >> (63 - bits):
        order = np.argsort(key, kind="stable")
        return key[order], order
    both = np.sort((key << bits) | np.arange(len(key)))
    return both >> bits, both & ((1 << bits) - 1)


def _table(schema: str, rows: list[tuple]) -> pa.Table:
    kinds = {"long": pa.int64(), "double": pa.float64(), "boolean": pa.bool_(), "binary": pa.binary(), "array<long>": pa.list_(pa.int64()), "array<boolean>": pa.list_(pa.bool_()), "array<binary>": pa.list_(pa.binary())}
    fields = [f.split() for f in schema.split(", ")]
    columns = list(zip(*rows, strict=True)) if rows else [()] * len(fields)
    return pa.table([pa.array(c, kinds[k]) for c, (_, k) in zip(columns, fields, strict=True)], [name for name, _ in fields])


def chunks(texts: DataFrame) -> DataFrame:
    """Documents in chunks: their ids, sizes and words, the words as places in the chunk's own list."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = TaskContext.get().partitionId() << 32
        held: list[tuple] = []
        size = 0

        def out() -> Iterator[pa.RecordBatch]:
            words, places, n = np.unique(np.concatenate([h[2] for h in held]), return_inverse=True, return_counts=True)
            order = np.argsort(-n, kind="stable")  # frequent words first: small numbers pack well
            rank = np.empty(len(order), np.uint32)
            rank[order] = np.arange(len(order), dtype=np.uint32)
            row = (at, [h[0] for h in held], [h[1] for h in held], [len(h[2]) for h in held], pack(words[order], rank[places]), [])
            yield from _table(ROWS, [row]).to_batches()

        for b in batches:
            for i, train, text in zip(*(b.column(c).to_pylist() for c in ("doc_id", "train", "text")), strict=True):
                held.append((i, train, np.append(word_hashes(text), END)))
                size += len(held[-1][2])
                if size >= CHUNK:
                    yield from out()
                    held, size, at = [], 0, at + 1
        if held:
            yield from out()

    return texts.select("doc_id", "train", "text").mapInArrow(run, ROWS)


class Model:
    """What every task knows of the corpus: totals and, per depth, the hot contexts with the mass that each leaves over."""

    def __init__(self, tokens: int, total: int, buckets: int, depth: int = DEPTH, least: int = LEAST, hot: float = HOT):
        self.tokens, self.total, self.buckets, self.depth, self.least = tokens, total, buckets, depth, least
        self.hot_n = max(64, ceil(hot * total))
        self.vocabulary = 0
        self.hot: dict[int, tuple[np.ndarray, np.ndarray]] = {}  # depth: sorted contexts, mass left (NaN: not retained)

    def left(self, n: np.ndarray, stated: np.ndarray, stated_n: np.ndarray, n_log_n: np.ndarray, n_log_p: np.ndarray, below: np.ndarray) -> np.ndarray:
        """Mass that contexts leave to their suffixes; NaN for those that do not diverge from them."""
        n = np.maximum(n, 1).astype(float)
        rest = n - stated_n
        with np.errstate(divide="ignore", invalid="ignore"):
            saved = n_log_n - stated_n * np.log(n) - n_log_p
            saved += np.where(rest > 0, rest * (np.log(np.maximum(rest, 1) / n) - np.log(np.maximum(1 - below, 1e-9))), 0)
        keep = (stated > 0) & (saved > 0.5 * stated * np.log(max(2, self.total)))
        return np.where(keep, 1 - (stated_n - DISCOUNT * stated) / n, np.nan)


class Chunk:
    """The tokens of a chunk, and the distinct (context, next symbol) pairs of the depth reached so far.

    Per token: ``p`` its probability, ``pair`` its pair at this depth (-1: none).  Per pair, in the order of buckets:
    context, symbol, hash of the whole sequence and its count in the corpus.
    """

    def __init__(self, row: dict, model: Model):
        self.model, self.row = model, row
        self.sizes = np.array(row["sizes"], np.int64)
        self.words, places = unpack(row["words"], np.uint64, np.uint32)
        self.places = places.astype(np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.pos = np.arange(len(self.places)) - np.repeat(self.starts, self.sizes)
        self.train = np.repeat(np.array(row["train"], np.int64), self.sizes)
        self.p = np.ones(len(self.places))
        for k, told in enumerate(row["heard"]):
            self.hear(k, told)

    def sort(self, k: int) -> None:
        """Finds the distinct pairs of depth ``k``.  At the root the words themselves are counted."""
        if k == 0:
            order = np.argsort(self.words)
            rank = np.empty(len(order), np.int64)
            rank[order] = np.arange(len(order))
            self.here, self.at = slice(None), None
            self.pair = rank[self.places]
            self.context, self.symbol = self.words[order], np.zeros(len(order), np.uint64)
            self.size, self.hot = np.zeros(len(order), np.int64), np.zeros(len(order), bool)
            self.run, route = np.arange(len(order)), self.context
        else:
            before = self.pair[:-1]
            frequent = np.append(self.n >= self.model.least, False)  # -1: none
            self.here = here = np.flatnonzero((self.pos[1:] >= k) & frequent[before]) + 1
            ctx, place = self.pair[here - 1], self.places[here]
            grams, hot = np.flatnonzero(frequent), np.flatnonzero(frequent[:-1] & (self.n >= self.model.hot_n))
            parts = mixed(np.repeat(self.gram[hot], int(SPREAD)), np.tile(np.arange(SPREAD, dtype=np.uint64), len(hot)))
            routes, of = np.concatenate([self.gram[grams], parts]), np.concatenate([grams, np.repeat(hot, int(SPREAD))])
            nth = np.full(len(self.gram), -1, np.int64)
            nth[grams] = np.arange(len(grams))
            way = nth[ctx]
            if len(hot):
                nth[:] = -1
                nth[hot] = np.arange(len(hot))
                part = (mixed(self.symbols, self.symbols)[place] % SPREAD).astype(np.int64)
                way = np.where(nth[ctx] >= 0, len(grams) + nth[ctx] * int(SPREAD) + part, way)
            by_route = np.argsort(routes)
            rank = np.empty(len(routes), np.int64)
            rank[by_route] = np.arange(len(routes))
            key, order = in_order(rank[way] * len(self.symbols) + place)
            new = np.ones(len(key), bool)
            new[1:] = key[1:] != key[:-1]
            self.pair_here = np.empty(len(key), np.int64)
            self.pair_here[order] = np.cumsum(new) - 1
            key = key[new]
            way = by_route[key // len(self.symbols)]
            self.at = here[order[new]]  # a token of each pair
            self.told = self.n[self.pair[self.at]] >= self.model.least  # a sequence is at most as frequent as what it ends in
            self.context, self.symbol = self.gram[of[way]], self.symbols[key % len(self.symbols)]
            self.size, self.hot = self.n[of[way]], way >= len(grams)
            self.run, route = np.cumsum(np.diff(key // len(self.symbols), prepend=-1) != 0) - 1, routes[way]
            self.pair = np.full(len(self.places), -1, np.int64)
            self.pair[here] = self.pair_here
        self.bucket = (((route >> np.uint64(32)) * np.uint64(self.model.buckets)) >> np.uint64(32)).astype(np.int64)

    def ask(self) -> list[tuple]:
        """For each bucket its contexts, and those pairs that can be frequent with their counts and what the suffix gives the symbol."""
        n = len(self.context)
        if not n:
            return []
        if self.at is None:
            times, below, told = np.bincount(self.pair, self.train, n), np.ones(n), np.ones(n, bool)
        else:
            times, below, told = np.bincount(self.pair_here, self.train[self.here], n), self.p[self.at], self.told
        times, below = times.astype(np.uint32), coded(below)
        edges = np.flatnonzero(np.diff(self.bucket, prepend=-1, append=-1))
        rows = []
        for a, b in zip(edges[:-1], edges[1:], strict=True):
            lead, t = a + np.flatnonzero(np.diff(self.run[a:b], prepend=-1)), told[a:b]
            lengths = np.add.reduceat(t, lead - a, dtype=np.uint32)
            pairs = pack(self.context[lead], self.size[lead].astype(np.uint32), self.hot[lead].astype(np.uint8), lengths, self.symbol[a:b][t], below[a:b][t], times[a:b][t])
            rows.append((int(self.bucket[a]), self.row["chunk"], pairs))
        return rows

    def hear(self, k: int, told: bytes) -> None:
        """Takes the answers to the pairs of depth ``k``."""
        n, told = unpack(told, np.uint32, np.float32 if k else np.uint64)
        if k == 0:
            self.n, self.pair, self.symbols = n.astype(np.int64), self.places, told
            p = (self.n + 0.1) / (self.model.total + 0.1 * (self.model.vocabulary + 1))
            self.p, self.base, self.known = p[self.pair], np.log10(p)[self.pair], (self.n > 0)[self.pair]
            self.gram = mixed(self.symbols, END)  # no two numbers share one
            return
        self.sort(k)
        self.n = np.zeros(len(self.context), np.int64)
        self.n[self.told] = n
        self.gram = mixed(self.context, self.symbol)
        left = told.astype(float)[self.run]
        if self.hot.any():
            contexts, masses = self.model.hot[k]
            left[self.hot] = masses[np.searchsorted(contexts, self.context[self.hot])]
        self.retained = ~np.isnan(left)
        own = np.where(self.n >= self.model.least, (self.n - DISCOUNT) / np.maximum(self.size, 1), 0)
        p = self.p[self.at]
        self.p[self.here] = np.where(self.retained, own + left * p, p)[self.pair_here]

    def scores(self) -> list[tuple]:
        add = lambda x: np.add.reduceat(x, self.starts)
        held = [not t for t in self.row["train"]]
        columns = (self.row["doc_ids"], held, self.sizes.tolist(), add(self.known.astype(np.int64)).tolist(), add(self.base).tolist(), add(np.log10(self.p)).tolist())
        return list(zip(*columns, strict=True))


def _answer(table: pa.Table, k: int, model: Model) -> pa.Table:
    """Counts the pairs of a bucket, tests its contexts, and answers each chunk in the order it asked."""
    chunk, bucket = table.column("chunk").to_pylist(), table.column("bucket")[0].as_py()
    parts = [unpack(x, *PAIRS) for x in table.column("pairs").to_pylist()]
    context, size, hot, lengths, symbol, below, times = (np.concatenate(x) for x in zip(*parts, strict=True))
    known, at, number = np.unique(context, return_index=True, return_inverse=True)
    width = int(symbol.max(initial=0)) + 1
    key = np.repeat(number, lengths) * width + symbol.astype(np.int64)
    key, order = in_order(key)
    new = np.ones(len(key), bool)
    new[1:] = key[1:] != key[:-1]
    first = np.flatnonzero(new)
    n = np.add.reduceat(times[order].astype(np.int64), first) if len(first) else np.zeros(0, np.int64)
    n_of = np.empty(len(key), np.uint32)
    n_of[order] = n[np.cumsum(new) - 1]
    extra: list[tuple] = []
    if k == 0:
        # words by frequency within their bucket: numbers that no two words share, small for frequent ones
        rank = np.empty(len(n), np.int64)
        rank[np.argsort(-n, kind="stable")] = np.arange(len(n))
        told = (rank * model.buckets + bucket).astype(np.uint64)[number]
        extra.append((None, None, None, None, int((n > 0).sum()), None, None, None, None, None))
    else:
        of = key[first] // width
        stated = n >= model.least
        m, q = np.where(stated, n, 0), decoded(below[order[first]])
        add = lambda x: np.bincount(of, x, len(known))
        sums = size[at].astype(float), add(stated), add(m), add(m * np.log(np.maximum(m, 1))), add(m * np.log(q)), add(np.where(stated, q, 0))
        told = model.left(*sums).astype(np.float32)[number]
        for j in np.flatnonzero(hot[at]):
            total, some, stated_n, n_log_n, n_log_p, mass = (float(x[j]) for x in sums)
            extra.append((None, None, None, int(known[j].view(np.int64)), int(total), int(some), n_log_n, n_log_p, int(stated_n), mass))
    ends, heads = np.cumsum([len(x[4]) for x in parts]), np.cumsum([len(x[0]) for x in parts])
    out = [(c, bucket, pack(n_of[b - len(x[4]) : b], told[h - len(x[0]) : h]), *[None] * 7) for c, x, b, h in zip(chunk, parts, ends, heads, strict=True)]
    return _table(ANSWERS, out + extra)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for b in batches:
        for i in range(b.num_rows):
            yield b.slice(i, 1).to_pylist()[0]


def _asker(shared: Broadcast, k: int):
    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            chunk = Chunk(row, shared.value)
            chunk.sort(k)
            yield from _table(ASKED, chunk.ask()).to_batches()

    return ask


def _answerer(shared: Broadcast, k: int):
    def answer(table: pa.Table) -> pa.Table:
        return _answer(table, k, shared.value)

    return answer


def _taker(k: int):
    def take(left: pa.Table, right: pa.Table) -> pa.Table:
        """Chunks with the answers of all buckets to depth ``k``, which come in the order of buckets, in one piece."""
        kinds = np.uint32, np.float32 if k else np.uint64
        told = [unpack(x, *kinds) for x in right.sort_by("bucket").column("counts").to_pylist()]
        n, other = (np.concatenate(x) for x in zip(*told, strict=True)) if told else (np.zeros(0, kind) for kind in kinds)
        out = []
        for row in left.to_pylist():
            if k == 0:  # from the order of hashes to the chunk's own, which needs no hashes
                words, places = unpack(row["words"], np.uint64, np.uint32)
                rank = np.empty(len(words), np.int64)
                rank[np.argsort(words)] = np.arange(len(words))
                n, other, row["words"] = n[rank], other[rank], pack(words[:0], places)
            row["heard"].append(pack(n, other))
            out.append(tuple(row.values()))
        return _table(ROWS, out)

    return take


def _taken(held: list[DataFrame], found: DataFrame, k: int, tasks: int) -> list[DataFrame]:
    """The chunks with the answers to depth ``k``; each table goes when its successor is written."""
    part, tasks = F.pmod(F.xxhash64("chunk"), F.lit(PARTS)), ceil(tasks / PARTS)
    answers = found.where("chunk IS NOT NULL").select("chunk", "bucket", "counts")
    out = []
    for i in range(PARTS):
        own = held[i] if k else held[0].where(part == i)
        pairs = (x.repartition(tasks, "chunk").groupBy("chunk") for x in (own, answers.where(part == i)))
        out.append(materialize(large_rows(next(pairs).cogroup(next(pairs)).applyInArrow(_taker(k), ROWS)), f"chunks{k}"))
        if k:
            discard(own)
    discard(found, *([] if k else held))
    return out


def grow(rows: DataFrame, model: Model) -> list[DataFrame]:
    """The chunks with the answers of each depth, what they need to know of the tree, in ``PARTS`` tables; ``rows`` goes."""
    spark = rows.sparkSession
    tasks = max(3 * spark.sparkContext.defaultParallelism, model.buckets)
    held = [rows]
    for k in range(model.depth + 1):
        shared = spark.sparkContext.broadcast(model)  # totals and at most depth / HOT hot contexts
        asked = reduce(DataFrame.unionAll, held).mapInArrow(_asker(shared, k), ASKED)
        found = materialize(asked.repartition(tasks, "bucket").groupBy("bucket").applyInArrow(_answerer(shared, k), ANSWERS), f"depth{k}")
        release(spark)
        if k == 0:
            model.vocabulary = int(found.where("chunk IS NULL").agg(F.coalesce(F.sum("times"), F.lit(0))).first()[0])
        else:
            model.hot[k] = _hot(found, model)
        held = _taken(held, found, k, tasks)
        release(spark)
    return held


def _hot(found: DataFrame, model: Model) -> tuple[np.ndarray, np.ndarray]:
    """Hot contexts of a depth, of which there are at most 1 / HOT, from the sums of their buckets."""
    names = ["times", "stated", "stated_n", "n_log_n", "n_log_p", "below"]
    # every part of a hot context knows its whole count
    got = found.where("context IS NOT NULL").groupBy("context").agg(F.max("times").alias("times"), *(F.sum(x).alias(x) for x in names[1:])).toArrow()
    contexts = got.column("context").to_numpy().astype(np.int64).view(np.uint64)
    left = model.left(*(got.column(x).to_numpy() for x in names))
    order = np.argsort(contexts)
    return contexts[order], left[order]


def contexts_kept(rows: DataFrame, held: list[DataFrame], model: Model) -> list[int]:
    """Retained contexts per depth, counted by the hashes that chunks hold: for reports on how the tree grows."""
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            told, out = row["heard"], []
            chunk = Chunk(row | {"heard": told[:1]}, shared.value)
            for k in range(1, len(told)):
                chunk.hear(k, told[k])
                if len(chunk.context):
                    out += [(k, int(x)) for x in np.unique(chunk.context[chunk.retained]).view(np.int64)]
            yield from _table("depth long, context long", out).to_batches()

    got = {r["depth"]: r["n"] for r in reduce(DataFrame.unionAll, held).mapInArrow(run, "depth long, context long").distinct().groupBy("depth").agg(F.count("*").alias("n")).collect()}
    return [got.get(k, 0) for k in range(1, model.depth + 1)]


def prepared(docs: DataFrame, held_out: int, modulus: int, depth: int, least: int, hot: float, id_col: str, text_col: str, bucket: int = BUCKET) -> tuple[DataFrame, Model]:
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    rows = materialize(large_rows(chunks(texts.withColumn("train", id_remainder(F.col("doc_id"), modulus) != held_out))), "chunks")
    each = F.explode(F.arrays_zip("sizes", "train")).alias("d")
    sums = rows.select(each).agg(F.sum("d.sizes").alias("all"), F.sum(F.when(F.col("d.train"), F.col("d.sizes"))).alias("train")).first()
    tokens = int(sums["all"] or 0)
    return rows, Model(tokens, int(sums["train"] or 0), max(1, ceil(tokens / bucket)), depth, least, hot)


def score(
    docs: DataFrame, held_out: int = 0, modulus: int = 10, depth: int = DEPTH, least: int = LEAST, hot: float = HOT, id_col: str = "doc_id", text_col: str = "text", bucket: int = BUCKET
) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score for every row of ``docs``.

    Rows whose id leaves ``held_out`` (crc32 modulo ``modulus``) are scored but not learned from.  A null text is
    empty and consists of its end; a null id counts as the empty text in the remainder; rows that repeat an id
    are rows of their own; other columns, whatever their names, are not read.  A text of any length is
    read whole.  With no training rows nothing is known and every word has the same probability.
    """
    rows, model = prepared(docs, held_out, modulus, depth, least, hot, id_col, text_col, bucket)
    if not model.tokens:
        discard(rows)
        return docs.sparkSession.createDataFrame([], "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")
    held = grow(rows, model)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            yield from _table(SCORES, Chunk(row, shared.value).scores()).to_batches()

    scored = materialize(reduce(DataFrame.unionAll, held).mapInArrow(run, SCORES), "scores")
    discard(*held)
    return scored.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(model.total).cast("long").alias("train_tokens"), "base_score", "score")
