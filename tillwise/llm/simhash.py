"""SimHash near-duplicates by the generalised pigeonhole principle.

If 64 bits are cut into m parts with thresholds t_1 + ... + t_m = r - m + 1, then two fingerprints that
differ in at most r bits differ in at most t_i bits of some part i.  Parts hold correlated
bits, thresholds may differ (-1 leaves a part out), and dynamic programming picks the number of
parts and their thresholds by the estimated cost: probes sent plus candidates met.

Links are found among distinct fingerprints, so exact copies cost one row.  A part's value that more
than ``CROWD`` fingerprints share would make the square of that many candidates; there a
second, exact way serves: two fingerprints differ in at most two bits just if one flip or none
of each gives the same 64 bits, so each sends its flips, and equal flips are linked in a star.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import memory
from .components import components
from .scratch import discard, materialize
from .text import encoded, unused

RADIUS = 2
SHINGLE = 3
BITS = 64
CROWD = 64
SEED = 42


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """64 bits, each 1 if set in over half the hashes of the text's shingles; 0 for a text without words.

    Words are runs of non-white-space with A-Z in lower case; fewer than ``shingle`` words make one
    shingle; repeats count."""
    words = encoded(text).lower().split()
    if not words:
        return 0
    k = min(shingle, len(words))
    line = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = [0, *(ends[:-1] + 1).tolist()]
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(line[a:b], SEED) for a, b in zip(starts, ends[k - 1 :].tolist(), strict=False)], np.uint64)
    ones = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        part = hashes[at : at + (1 << 16)]
        ones += np.unpackbits(part.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return sum(1 << int(b) for b in np.flatnonzero(2 * ones > len(hashes)))


def _batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    memory.drop()
    for b in batches:
        prints = np.array([fingerprint(t) for t in b.column("text").to_pylist()], np.uint64).view(np.int64)
        yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(prints)], ["doc_id", "print"])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and print (the fingerprint as a signed long) of every row."""
    picked = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return picked.mapInArrow(_batches, "doc_id long, print long")


def bit_table(prints: DataFrame) -> tuple[int, np.ndarray]:
    """Number of fingerprints, and for bits a and b how many have both: 64 x 64 numbers, summed per task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, both = 0, np.zeros((BITS, BITS))
        for b in batches:
            x = b.column("print").to_numpy().astype("<i8").view(np.uint8).reshape(-1, 8)
            bits = np.unpackbits(x, axis=1, bitorder="little").astype(np.float32)
            n += len(bits)
            both += bits.T @ bits
        yield pa.RecordBatch.from_pydict({"cell": pa.array([-1, *range(BITS * BITS)], pa.int32()), "n": pa.array([n, *both.ravel().astype(np.int64)], pa.int64())})

    rows = prints.mapInArrow(run, "cell int, n long").groupBy("cell").agg(F.sum("n").alias("n")).collect()  # 4,097 rows
    got = {r["cell"]: r["n"] for r in rows}
    return got.get(-1, 0), np.array([got.get(i, 0) for i in range(BITS * BITS)], float).reshape(BITS, BITS)


def group_bits(n: int, both: np.ndarray, parts: int) -> list[list[int]]:
    """Parts of nearly equal width; each starts with the freest bit and takes those most correlated with it."""
    p = np.diag(both) / max(n, 1)
    spread = np.sqrt(np.maximum(p * (1 - p), 1e-12))
    corr = np.abs((both / max(n, 1) - np.outer(p, p)) / np.outer(spread, spread))
    free, out = set(range(BITS)), []
    for k in range(parts):
        width = len(free) // (parts - k)
        part = [max(free, key=lambda b: (spread[b], -b))]
        free.remove(part[0])
        while len(part) < width:
            nxt = max(free, key=lambda b: (corr[b, part].sum(), -b))
            part.append(nxt)
            free.remove(nxt)
        out.append(sorted(part))
    return out


def _near(p: np.ndarray, part: list[int], t: int) -> float:
    """Estimated share of pairs that differ in at most t bits of a part, from the bits' frequencies."""
    share = np.zeros(t + 2)
    share[0] = 1.0
    for b in part:
        d = 2 * p[b] * (1 - p[b])
        share[1:] = share[1:] * (1 - d) + share[:-1] * d
        share[0] *= 1 - d
        share[-1] = 0
    return float(share[: t + 1].sum())


def allocate(n: int, both: np.ndarray, radius: int = RADIUS) -> list[tuple[list[int], int]]:
    """The cheapest parts and thresholds: [(bits, threshold)], parts with threshold -1 left out."""
    p = np.diag(both) / max(n, 1)
    best: tuple[float, list] = (float("inf"), [])
    for m in range(1, radius + 2):
        parts = group_bits(n, both, m)
        total = radius - m + 1

        @lru_cache(None)
        def cost(i: int, t: int, parts=parts) -> float:
            if t < 0:
                return 0.0
            probes = sum(comb(len(parts[i]), k) for k in range(t + 1))
            return n * (1 + probes) + n * max(n - 1, 0) / 2 * _near(p, parts[i], t)

        @lru_cache(None)
        def solve(i: int, left: int, m=m, cost=cost) -> tuple[float, tuple]:
            if i == m:
                return (0.0, ()) if left == 0 else (float("inf"), ())
            options = []
            for t in range(-1, radius + 1):
                c, rest = solve(i + 1, left - t)
                options.append((cost(i, t) + c, (t, *rest)))
            return min(options)

        c, thresholds = solve(0, total)
        if c < best[0]:
            best = (c, [(part, t) for part, t in zip(parts, thresholds, strict=True) if t >= 0])
    return best[1]


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def _mask(bits) -> int:
    return _signed(sum(1 << b for b in bits))


def _star(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Links of all rows of a key to the key's smallest print: a star in place of all pairs.

    Grouping folds per task first, so a key that everyone has costs a task one row."""
    least = rows.groupBy(*keys).agg(F.min("print").alias("u"), F.max("print").alias("top")).where("u <> top").drop("top")
    return rows.join(least, keys).where("print <> u").select("u", F.col("print").alias("v"))


def link(prints: DataFrame, radius: int = RADIUS, crowd: int = CROWD) -> DataFrame:
    """Links (u, v) among distinct fingerprints that join all of those within ``radius`` (2 at most) bits.

    Every pair within the radius is connected through links, and every link is within it.  ``prints`` is a
    table of distinct values in column print.
    """
    if radius > 2:
        raise ValueError("the way for crowded values covers two bits")
    n, both = bit_table(prints)
    out: DataFrame | None = None
    inside: DataFrame | None = None
    for bits, t in allocate(n, both, radius):
        mask = _mask(bits)
        keyed = prints.select("print", F.col("print").bitwiseAND(F.lit(mask)).alias("key"))
        flips = [_mask(c) for k in range(t + 1) for c in combinations(bits, k)]
        probe = keyed.select("print", F.explode(F.transform(F.array(*[F.lit(f) for f in flips]), lambda f: f.bitwiseXOR(F.col("key")))).alias("key"))
        sizes = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("size"))
        cold = keyed.join(sizes.where(F.col("size") <= crowd), "key").select("key", F.col("print").alias("u"))
        close = F.bit_count(F.col("u").bitwiseXOR(F.col("v"))) <= radius
        near = cold.join(probe.select("key", F.col("print").alias("v")), "key").where(close & (F.col("u") != F.col("v"))).select("u", "v")
        out = near if out is None else out.union(near)
        crowded = probe.join(sizes.where(F.col("size") > crowd).select("key"), "key").select("print")
        inside = crowded if inside is None else inside.union(crowded)
    # prints that probe a crowded value in any part meet at the prints one flip (or none) away, each once
    if radius == 2:
        reach = F.array(*[F.lit(f) for f in (0, *(_mask([b]) for b in range(BITS)))])
        hubs = inside.distinct().select("print", F.explode(F.transform(reach, lambda f: f.bitwiseXOR(F.col("print")))).alias("hub"))
        out = out.union(_star(hubs, ["hub"]))
    elif radius == 1:  # one bit apart: equal once that bit is cleared
        cleared = F.array(*[F.struct(F.lit(b).alias("b"), F.col("print").bitwiseAND(F.lit(~_mask([b]))).alias("hub")) for b in range(BITS)])
        hubs = inside.distinct().select("print", F.explode(cleared).alias("x")).select("print", "x.b", "x.hub")
        out = out.union(_star(hubs, ["b", "hub"]))
    return out


def _components_of(rows: DataFrame, radius: int) -> DataFrame:
    """(print, component_id) of all fingerprints with a copy or a link; ``rows`` is a table of doc_id and print."""
    classes = materialize(rows.groupBy("print").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("n")), "classes")
    roots = materialize(components(link(classes.select("print"), radius)), "roots")
    linked = classes.join(roots, classes["print"] == roots["node"]).select("print", "first", "root")
    least = linked.groupBy("root").agg(F.min("first").alias("component_id"))
    named = linked.join(least, "root").select("print", "root", "component_id")
    # a fingerprint without links and copies names itself: only the others are looked up
    alone = classes.where("n > 1").join(roots, classes["print"] == roots["node"], "left_anti").select("print", F.col("print").alias("root"), F.col("first").alias("component_id"))
    named = materialize(named.union(alone), "named")
    discard(classes, roots)
    return named


def near_duplicates(docs: DataFrame, radius: int = RADIUS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, print, component_id of every row: the smallest id reachable over links of at most ``radius`` bits.

    Null and empty texts have fingerprint 0 and link like any other.  A null id has a component of the ids
    it is linked to and never names one, unless all are null.  Rows that repeat an id get a row each.
    """
    rows = materialize(fingerprints(docs, id_col, text_col), "prints")
    named = _components_of(rows, radius).select("print", "component_id")
    return rows.join(named, "print", "left").select("doc_id", "print", F.coalesce("component_id", "doc_id").alias("component_id"))


def keep_one(docs: DataFrame, radius: int = RADIUS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, without near duplicates: of each component the row of the smallest id stays.

    Null ids come last, and among equal ids one row stays.  Row numbers are written with the rows once, since
    numbers made in two scans agree only while both are cut alike.
    """
    row, gone = unused("_row", docs.columns), unused("_gone", docs.columns)
    table = materialize(docs.withColumn(row, F.monotonically_increasing_id()), "numbered")
    numbered = table.select(F.col(row).alias("doc_id"), F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            prints = next(_batches(iter([b])))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("id"), prints.column("print")], ["row", "doc_id", "print"])

    rows = materialize(numbered.mapInArrow(run, "row long, doc_id long, print long"), "prints")
    grouped = rows.join(_components_of(rows, radius), "print").select("row", "doc_id", "root")
    order = F.struct(F.col("doc_id").isNull().alias("a"), "doc_id", "row")
    stays = grouped.groupBy("root").agg(F.min(order)["row"].alias("stays"))
    copies = materialize(grouped.join(stays, "root").where("row <> stays").select(F.col("row").alias(gone)), "copies")
    return table.join(copies, F.col(row) == F.col(gone), "left_anti").drop(row)


def hexadecimal(fingerprint_col: Column) -> Column:
    return F.lower(F.lpad(F.hex(fingerprint_col), 16, "0"))
