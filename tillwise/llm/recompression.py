"""Exact repeats of word windows across documents, by recompression.

A document is a string of word names.  Each round replaces runs of one symbol by one symbol, splits the
alphabet in two by a bit of the names and replaces neighbours (left, right) by one symbol.  A new
symbol's name is a hash of what it replaces, so a name stands for the same words wherever it occurs.
How a stretch is cut depends on its own words and few beside it, so equal stretches get equal symbols inside.

Every window chooses an *anchor*: of the symbols whose cut the window's words alone decide, one of the
highest early round, then the longest, then by hash.  It is named with all the words that decide its cut.
Equal windows choose equal anchors, and neighbouring windows mostly share one, so anchors are few.
Only windows whose anchor occurs in another document are named and compared.  Symbols of later rounds that span many words, up to the whole document, are
themselves verified repeats: windows inside them need no comparison.

Names and window keys are 64-bit hashes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scratch import discard, materialize, release
from .text import encoded

WINDOW = 13
ANCHOR_ROUNDS = 2
#: A symbol that spans this many words, and each that spans four times the last, counts as a long repeat.
LONG = 52
MAX_ROUNDS = 200
_A, _B, _C = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_ONE, _S1, _S2 = np.uint64(1), np.uint64(31), np.uint64(29)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _S1)) * _B
    x ^= x >> _S2
    x *= _C
    x ^= x >> _S1
    return x


def word_names(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))


@dataclass
class Level:
    """Symbols of some documents after a round: name, words [start, end), and the words [low, high) that decide the cut."""

    name: np.ndarray
    doc: np.ndarray
    start: np.ndarray
    end: np.ndarray
    low: np.ndarray
    high: np.ndarray


def first_level(names: np.ndarray, doc: np.ndarray) -> Level:
    at = np.arange(len(names), dtype=np.int64)
    return Level(names, doc, at, at + 1, at, at + 1)


def _neighbours(x: Level, decide: bool):
    """Is the next symbol of the same document; where the one before starts to be decided, and the one after ends."""
    same = np.zeros(len(x.name), bool)
    same[:-1] = x.doc[1:] == x.doc[:-1]
    if not decide:
        return same, None, None
    before = x.start - 1  # at a document's edge: a word that no window has
    after = x.end + 1
    before[1:] = np.where(same[:-1], x.low[:-1], before[1:])
    after[:-1] = np.where(same[:-1], x.high[1:], after[:-1])
    return same, before, after


def next_level(x: Level, number: int, decide: bool) -> Level:
    """One round: runs, then pairs.  With ``decide`` false, low and high are not kept up."""
    same, before, after = _neighbours(x, decide)
    joins = same[:-1] & (x.name[1:] == x.name[:-1])
    first = np.flatnonzero(np.concatenate([[True], ~joins]))
    last = np.append(first[1:], len(x.name)) - 1
    count = (last - first + 1).astype(np.uint64)
    name = x.name[first]
    many = count > _ONE
    if many.any():
        name = np.where(many, _mix(name * _A + count), name)
    y = Level(name, x.doc[first], x.start[first], x.end[last], x.low[first], x.high[first])
    if decide:
        y.low, y.high = np.minimum(x.low[first], before[first]), np.maximum(x.high[last], after[last])
    # pairs: a bit of the name, another one each round, says left or right
    salt = np.uint64((number * int(_A)) & (2**64 - 1))
    same, before, after = _neighbours(y, decide)
    left = (_mix(y.name + salt) & _ONE) == 0
    pair = np.zeros(len(y.name), bool)
    pair[:-1] = same[:-1] & left[:-1] & ~left[1:]
    second = np.zeros(len(y.name), bool)
    second[1:] = pair[:-1]
    at = np.flatnonzero(~second)
    is_pair = pair[at]
    other = np.minimum(at + 1, len(y.name) - 1)
    name = np.where(is_pair, _mix(y.name[at] * _A + _mix(y.name[other] ^ _C)), y.name[at])
    z = Level(name, y.doc[at], y.start[at], np.where(is_pair, y.end[other], y.end[at]), y.low[at], y.high[at])
    if decide:
        low = np.where(left, y.low, np.minimum(y.low, before))
        high = np.where(left, np.maximum(y.high, after), y.high)
        z.low = np.where(is_pair, np.minimum(y.low[at], y.low[other]), low[at])
        z.high = np.where(is_pair, np.maximum(y.high[at], y.high[other]), high[at])
    return z


_INVERSE = np.uint64(pow(int(_A), -1, 1 << 64))


def stretches(names: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """A hash of the words [low, high) that does not depend on where they stand."""
    powers = np.cumprod(np.full(len(names), _A))
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_mix(names) * powers)])
    back = np.cumprod(np.full(len(names), _INVERSE))
    return _mix((sums[high] - sums[low]) * back[low] + (high - low).astype(np.uint64))


def choose_anchors(levels: list[Level], names: np.ndarray, starts: np.ndarray, window: int) -> np.ndarray:
    """The anchor's name for each window that begins at ``starts``; levels go from words upwards."""
    n_words = len(names)
    low, high = np.zeros(len(starts), np.int64), np.zeros(len(starts), np.int64)
    left = np.arange(len(starts))
    for x in reversed(levels):
        p = starts[left]
        # symbols decided inside [p, p + window) are a stretch of the level
        f = np.cumsum(np.bincount(x.low + 1, minlength=n_words + 3))[p]
        g = np.cumsum(np.bincount(x.high, minlength=n_words + 3))[p + window] - 1
        has = np.flatnonzero(g >= f)
        rank = ((np.minimum(x.end - x.start, 255).astype(np.uint64)) << np.uint64(56)) | (_mix(x.name) >> np.uint64(8))
        f, g = f[has], g[has]
        best, best_rank = f.copy(), rank[f]
        more, k = np.flatnonzero(g > f), 1
        while len(more):
            c = f[more] + k
            r = rank[c]
            win = r > best_rank[more]
            best[more[win]], best_rank[more[win]] = c[win], r[win]
            k += 1
            more = more[f[more] + k <= g[more]]
        low[left[has]], high[left[has]] = x.low[best], x.high[best]
        left = np.delete(left, has)
        if not len(left):
            break
    return stretches(names, low, high)


@dataclass
class Parsed:
    """What a batch of documents offers for comparison.  Anchor names are even, names of long symbols odd."""

    names: np.ndarray
    sizes: np.ndarray
    begins: np.ndarray
    window_start: np.ndarray
    window_doc: np.ndarray
    anchor: np.ndarray
    long_name: np.ndarray
    long_doc: np.ndarray
    long_start: np.ndarray
    long_end: np.ndarray


def parse(docs: list[list[bytes]], window: int = WINDOW) -> Parsed:
    """Anchors of all windows and all long symbols of some documents; shorter documents have neither."""
    docs = [w if len(w) >= window else [] for w in docs]
    sizes = np.array([len(w) for w in docs], np.int64)
    begins = np.cumsum(sizes) - sizes
    n = int(sizes.sum())
    none = np.zeros(0, np.int64)
    if not n:
        return Parsed(np.zeros(0, np.uint64), sizes, begins, none, none, none, none, none, none, none)
    names = np.concatenate([word_names(w) for w in docs])
    doc = np.repeat(np.arange(len(docs)), sizes)
    at = np.arange(n)
    starts = at[at + window <= (begins + sizes)[doc]]
    x = first_level(names, doc)
    levels = [x]
    found: list[tuple] = []
    top = LONG
    tier = np.full(n, 0)  # per first word of a symbol: how many long spans were passed already
    for k in range(MAX_ROUNDS):
        x = next_level(x, k, k < ANCHOR_ROUNDS)
        if k < ANCHOR_ROUNDS:
            levels.append(x)
        span = x.end - x.start
        whole = span == sizes[x.doc]
        reach = np.where(span >= top, np.floor(np.log(np.maximum(span, top) / top) / np.log(4) + 1e-9).astype(np.int64) + 1, 0)
        new = (reach > tier[x.start]) | (whole & (tier[x.start] < 99))
        if new.any():
            found.append((x.name[new], x.doc[new], x.start[new], x.end[new]))
            tier[x.start[new]] = np.where(whole[new], 99, reach[new])
        if whole.all():
            break
        if k >= ANCHOR_ROUNDS and whole.any():
            keep = ~whole
            x = Level(x.name[keep], x.doc[keep], x.start[keep], x.end[keep], x.low[keep], x.high[keep])
    anchors = choose_anchors(levels, names, starts, window)
    even, odd = np.uint64(2**64 - 2), _ONE
    name, d, s, e = (np.concatenate(c) for c in zip(*found, strict=True)) if found else (np.zeros(0, np.uint64), none, none, none)
    return Parsed(names, sizes, begins, starts, doc[starts], (anchors & even).view(np.int64), (name | odd).view(np.int64), d, s, e)


def window_keys(names: np.ndarray, starts: np.ndarray, window: int = WINDOW) -> np.ndarray:
    key = np.zeros(len(starts), np.uint64)
    for k in range(window):
        key = key * _A + _mix(names[starts + k])
    return _mix(key).view(np.int64)


def _texts(column: pa.Array) -> list[list[bytes]]:
    return [encoded(t).split() for t in column.to_pylist()]


def _binary(parts: list[np.ndarray], dtype: str) -> pa.Array:
    return pa.array([p.astype(dtype).tobytes() for p in parts], pa.binary())


def _split(values: np.ndarray, doc: np.ndarray, n: int) -> list[np.ndarray]:
    """Values by document, for values in order of their documents."""
    return np.split(values, np.searchsorted(doc, np.arange(1, n))) if n else []


SLICE = 256


def name_symbols(rows: DataFrame, window: int) -> DataFrame:
    """(d, names): the distinct anchors and long symbols of each document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, SLICE):
                part = b.slice(at, SLICE)
                p = parse(_texts(part.column("text")), window)
                name, doc = np.concatenate([p.anchor, p.long_name]), np.concatenate([p.window_doc, p.long_doc])
                order = np.lexsort((name, doc))
                name, doc = name[order], doc[order]
                new = np.ones(len(name), bool)
                new[1:] = (name[1:] != name[:-1]) | (doc[1:] != doc[:-1])
                names = _split(name[new], doc[new], part.num_rows)
                yield pa.RecordBatch.from_arrays([part.column("d"), _binary(names, "<i8")], ["d", "names"])

    return rows.mapInArrow(run, "d long, names binary")


def _unfold(table: DataFrame, columns: dict[str, str], schema: str, keys: list[str]) -> DataFrame:
    """One row per number in the packed columns, beside the keys."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 1024):
                part = b.slice(at, 1024)
                packed = {c: [np.frombuffer(x.as_buffer(), t) for x in part.column(c)] for c, t in columns.items()}
                n = [len(x) for x in next(iter(packed.values()))]
                if sum(n):
                    own = [pa.array(np.repeat(part.column(k).to_numpy(zero_copy_only=False), n)) for k in keys]
                    yield pa.RecordBatch.from_arrays([*own, *(pa.array(np.concatenate(v)) for v in packed.values())], [*keys, *columns])

    return table.select(*keys, *columns).mapInArrow(run, schema)


def _earlier(pairs: DataFrame, key: str) -> DataFrame:
    """(key, least): keys that documents of different ids have.  Folded per task first, so a common key costs a task one row."""
    return pairs.groupBy(key).agg(F.min("d").alias("least"), F.max("d").alias("most")).where("least < most").drop("most")


def candidates(rows: DataFrame, hits: DataFrame, window: int) -> DataFrame:
    """(d, k, covered, keys, places): stretches inside long repeats, and windows that have to be compared."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        none = np.zeros(0, np.int64)
        for b in batches:
            for at in range(0, b.num_rows, SLICE):
                part = b.slice(at, SLICE)
                p = parse(_texts(part.column("text")), window)
                shared = [np.asarray(x, np.int64) for x in part.column("shared").to_pylist()]
                later = [np.asarray(x, np.int64) for x in part.column("later").to_pylist()]
                repeated = np.zeros(len(p.long_name), bool)
                order = np.argsort(p.long_doc, kind="stable")
                for i, at_doc in enumerate(_split(order, p.long_doc[order], part.num_rows)):
                    if len(later[i]) and len(at_doc):
                        repeated[at_doc] = np.isin(p.long_name[at_doc], later[i])
                s, e, d = p.long_start[repeated], p.long_end[repeated], p.long_doc[repeated]
                # windows inside a repeated long symbol are repeats already
                inside = np.zeros(len(p.names) + 1, np.int64)
                np.add.at(inside, s, 1)
                np.add.at(inside, e - window + 1, -1)
                inside = np.cumsum(inside)[p.window_start] > 0
                every = np.concatenate(shared) if shared else none
                compare = np.flatnonzero(~inside & np.isin(p.anchor, every))
                w = p.window_start[compare]
                keys = _split(window_keys(p.names, w, window), p.window_doc[compare], part.num_rows)
                places = _split(w - p.begins[p.window_doc[compare]], p.window_doc[compare], part.num_rows)
                order = np.argsort(d, kind="stable")
                pairs = np.stack([s - p.begins[d], e - p.begins[d]], 1)[order]
                covered = [x.ravel() for x in np.split(pairs, np.searchsorted(d[order], np.arange(1, part.num_rows)))]
                yield pa.RecordBatch.from_arrays(
                    [part.column("d"), part.column("k"), _binary(covered, "<i4"), _binary(keys, "<i8"), _binary(places, "<i4")], ["d", "k", "covered", "keys", "places"]
                )

    both = rows.join(hits, "d").select("d", "k", "text", "shared", "later")
    return both.mapInArrow(run, "d long, k long, covered binary, keys binary, places binary")


def _cut(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out: list[tuple] = []
            columns = (b.column(c) for c in ("text", "covered", "places"))
            for text, covered, places in zip(*columns, strict=True):
                words = encoded(text.as_py()).split()
                edge = np.zeros(len(words) + 1, np.int64)
                if covered.is_valid:
                    pairs = np.frombuffer(covered.as_buffer(), "<i4").reshape(-1, 2)
                    np.add.at(edge, pairs[:, 0], 1)
                    np.add.at(edge, pairs[:, 1], -1)
                if places.is_valid:
                    at = np.asarray(places.as_py(), np.int64)
                    np.add.at(edge, at, 1)
                    np.add.at(edge, at + window, -1)
                gone = np.cumsum(edge)[: len(words)] > 0
                kept = b" ".join(w for w, g in zip(words, gone.tolist(), strict=True) if not g) if gone.any() else b" ".join(words)
                out.append((len(words), int(gone.sum()), hashlib.sha256(kept).hexdigest(), kept.decode("utf-8", "surrogatepass")))
            n, removed, digest, kept = zip(*out, strict=True) if out else ((), (), (), ())
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(n, pa.int64()), pa.array(removed, pa.int64()), pa.array(digest, pa.string()), pa.array(kept, pa.string())],
                ["doc_id", "n_words", "n_removed", "kept_sha256", "kept"],
            )

    return run


def remove_repeats(docs: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256, kept (the words left, single-spaced) for every row of ``docs``.

    A word goes if a window of ``window`` words that covers it also starts in a document with a smaller id;
    windows are judged on the texts as given.  Null texts have no words.  Rows with a null id have no order:
    nothing is removed from them or because of them.  Rows that repeat an id do not count against one another.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    every = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"))
    rows = every.where("doc_id IS NOT NULL").select(F.col("doc_id").alias("d"), F.crc32(F.col("text").cast("binary")).alias("k"), "text")
    symbols = materialize(name_symbols(rows.select("d", "text"), window), "symbols")
    pairs = _unfold(symbols, {"names": "<i8"}, "d long, names long", ["d"])
    shared = pairs.join(_earlier(pairs, "names"), "names").where("names % 2 = 0 OR d > least")
    even = F.col("names") % 2 == 0
    hits = materialize(
        shared.groupBy("d").agg(F.collect_set(F.when(even, F.col("names"))).alias("shared"), F.collect_set(F.when(~even, F.col("names"))).alias("later")), "hits"
    )
    discard(symbols)
    release(spark)
    wanted = materialize(candidates(rows, hits, window), "windows")
    discard(hits)
    release(spark)
    named = _unfold(wanted, {"keys": "<i8", "places": "<i4"}, "d long, k long, keys long, places int", ["d", "k"])
    repeats = named.join(_earlier(named, "keys"), "keys").where("d > least").groupBy("d", "k").agg(F.collect_set("places").alias("places"))
    found = materialize(wanted.select("d", "k", "covered").join(repeats, ["d", "k"], "left").where("length(covered) > 0 OR places IS NOT NULL").dropDuplicates(["d", "k"]), "repeats")
    discard(wanted)
    release(spark)
    keyed = every.withColumn("k", F.crc32(F.col("text").cast("binary")))
    cut = keyed.join(found, (keyed["doc_id"] == found["d"]) & (keyed["k"] == found["k"]), "left")
    return cut.select("doc_id", "text", "covered", "places").mapInArrow(_cut(window), "doc_id long, n_words long, n_removed long, kept_sha256 string, kept string")
