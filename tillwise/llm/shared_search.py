"""Ranked lexical search of many items at once, sharing what they have in common.

Items are written as term lists in one order, the terms of most items first.  Pairs of neighbours that
several lists hold become a node, and so on with the nodes, until no pair repeats: the nodes are the term sets that items
share, and the lists that remain say how to add an item's score from them.  Each document's weights of the items' terms are found
once, each node's partial score is added once per document, and items add nodes.

Terms of a document are counted in one pass, which keeps only the items' terms; the statistics that weights need come from what that pass
wrote.  Items are dealt to blocks of bounded size, so what a task holds does not grow with the number of items, and a task returns
the best ``k`` documents of each item, not all scores.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .scratch import materialize
from .text import encoded

#: Distinct (item, term) pairs that a block of items has on average at most; it is what mining holds at a time.
BLOCK_PAIRS = 50_000
#: Distinct terms of all items that a worker may hold while it counts; more are counted in as many passes as it takes.
PASS_TERMS = 400_000
#: Cells of the matrix of partial scores that a task fills at a time.
CELLS = 2**21

_SEPARATORS = bytes([*range(0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)])
_UPPER = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_TABLE = bytes.maketrans(_SEPARATORS + _UPPER, b" " * len(_SEPARATORS) + _UPPER.lower())


def terms(text: str | None) -> list[bytes]:
    """The terms of a text in order: letters and digits of ASCII and all above ASCII, with A-Z in lower case."""
    return encoded(text).translate(_TABLE).split()


def share(lists: list[list[int]], leaves: int) -> tuple[list[tuple[int, int]], list[list[int]]]:
    """Nodes (left, right), numbered from ``leaves``, and what is left of each list once shared pairs are nodes.

    Lists hold distinct leaf numbers.  A round counts neighbouring pairs and makes a node of each that two lists or more
    still hold when its turn comes, the most frequent first.
    """
    nodes: list[tuple[int, int]] = []
    while True:
        counts = Counter(p for x in lists for p in zip(x, x[1:]))
        good = {p: c for p, c in counts.items() if c > 1}
        if not good:
            return nodes, lists
        rank = {p: i for i, p in enumerate(sorted(good, key=lambda p: (-good[p], p)))}
        picked: list[list[int]] = []  # per list, positions whose pair is replaced
        for x in lists:
            free, mine = [True] * len(x), []
            for _, i in sorted((rank[p], i) for i, p in enumerate(zip(x, x[1:])) if p in rank):
                if free[i] and free[i + 1]:
                    free[i] = free[i + 1] = False
                    mine.append(i)
            picked.append(mine)
        held = Counter((x[i], x[i + 1]) for x, mine in zip(lists, picked) for i in mine)
        named: dict[tuple[int, int], int] = {}
        after = []
        for x, mine in zip(lists, picked):
            at, y, i = set(mine), [], 0
            while i < len(x):
                pair = (x[i], x[i + 1]) if i in at else None
                if pair and held[pair] > 1:
                    if pair not in named:
                        named[pair] = leaves + len(nodes)
                        nodes.append(pair)
                    y.append(named[pair])
                    i += 2
                else:
                    y.append(x[i])
                    i += 1
            after.append(y)
        if not named:  # pairs repeat only where each list prefers another one: the most frequent alone is shared
            best = min(rank, key=rank.get)
            node = leaves + len(nodes)
            nodes.append(best)
            after = []
            for x in lists:
                i = next((i for i in range(len(x) - 1) if (x[i], x[i + 1]) == best), None)
                after.append(x if i is None else [*x[:i], node, *x[i + 2 :]])
        lists = after


class Plan:
    """How the scores of a block of items are added: leaves, nodes by level, lists of items."""

    def __init__(self, pairs: list[tuple[int, int, int]], weight: dict[int, int]):
        """``pairs`` are (item, term, occurrences in the item)."""
        by_item: dict[int, list[tuple[int, int]]] = {}
        shared = Counter((t, q) for _, t, q in pairs)
        for i, t, q in pairs:
            by_item.setdefault(i, []).append((t, q))
        self.items = sorted(by_item)
        owners: dict[tuple[int, int], list[int]] = {}
        for i in self.items:
            for leaf in by_item[i]:
                owners.setdefault(leaf, []).append(i)
        # terms of the same items are neighbours in all of them
        order = sorted(shared, key=lambda leaf: (-shared[leaf], owners[leaf], leaf))
        number = {leaf: n for n, leaf in enumerate(order)}
        self.term = np.array([t for t, _ in order], np.int64)
        self.factor = np.array([q * weight[t] for t, q in order], np.int64)
        nodes, lists = share([sorted(number[leaf] for leaf in by_item[i]) for i in self.items], len(order))
        self.size = len(order) + len(nodes)
        depth = [0] * self.size
        levels: dict[int, list[tuple[int, int, int]]] = {}
        for n, (a, b) in enumerate(nodes, len(order)):
            depth[n] = 1 + max(depth[a], depth[b])
            levels.setdefault(depth[n], []).append((n, a, b))
        self.levels = [tuple(np.array(levels[d], np.int64).T) for d in sorted(levels)]
        self.parts = np.array([n for x in lists for n in x], np.int64)
        self.starts = np.cumsum([0, *map(len, lists[:-1])]).astype(np.int64)
        self.terms = np.unique(self.term)
        self.leaf_term = np.searchsorted(self.terms, self.term)

    def scores(self, doc: np.ndarray, term: np.ndarray, part: np.ndarray, docs: int) -> np.ndarray:
        """Scores, items by documents; ``part`` is a document's share of a term before the term's weight."""
        at = np.searchsorted(self.terms, term)
        at[at == len(self.terms)] = 0
        mine = self.terms[at] == term
        share_of = np.zeros((len(self.terms), docs), np.int64)
        share_of[at[mine], doc[mine]] = part[mine]
        sums = np.empty((self.size, docs), np.int64)
        np.multiply(share_of[self.leaf_term], self.factor[:, None], out=sums[: len(self.term)])
        for n, a, b in self.levels:
            sums[n] = sums[a] + sums[b]
        return np.add.reduceat(sums[self.parts], self.starts, axis=0)


def _counter(vocabulary) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = vocabulary.value
        known = number.keys()
        for b in batches:
            lengths, ids, counts = [], [], []
            for text in b.column("text"):
                words = terms(text.as_py())
                seen = Counter(words)
                mine = sorted(number[w] for w in known & seen.keys())
                back = {number[w]: seen[w] for w in known & seen.keys()}
                lengths.append(len(words))
                ids.append(mine)
                counts.append([back[i] for i in mine])
            yield pa.RecordBatch.from_arrays(
                [b.column("row"), b.column("doc_id"), pa.array(lengths, pa.int64()), pa.array(ids, pa.list_(pa.int64())), pa.array(counts, pa.list_(pa.int64()))],
                ["row", "doc_id", "n", "term", "tf"],
            )

    return run


def _best(score: np.ndarray, doc: np.ndarray, null: np.ndarray, row: np.ndarray, k: int) -> np.ndarray:
    return np.lexsort((row, doc, null, -score))[:k]


def _searcher(plan, documents: int, length: int, k: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p: Plan = plan.value
        step = max(8, CELLS // (p.size + len(p.parts)))
        none = np.zeros(0, np.int64)
        best = [(none, none, none, none)] * len(p.items)
        floor = np.zeros(len(p.items), np.int64)
        for whole in batches:
            for start in range(0, whole.num_rows, step):
                b = whole.slice(start, step)
                ids = b.column("doc_id")
                null = np.asarray(ids.is_null()).astype(np.int64)
                doc, row = ids.fill_null(0).to_numpy(zero_copy_only=False), b.column("row").to_numpy()
                n = b.column("n").to_numpy()
                m = 100 - 75 + (75 * n * documents) // length
                sizes = np.asarray(b.column("term").value_lengths())
                at = np.repeat(np.arange(b.num_rows), sizes)
                tf = b.column("tf").flatten().to_numpy()
                part = (1_000_000_000 * tf) // (1000 * tf + 8 * m[at])
                scores = p.scores(at, b.column("term").flatten().to_numpy(), part, b.num_rows)
                for i in np.flatnonzero(scores.max(axis=1) >= np.maximum(floor, 1)):
                    new = np.flatnonzero(scores[i] >= max(floor[i], 1))
                    s, d, u, r = (np.concatenate(x) for x in zip(best[i], (scores[i][new], doc[new], null[new], row[new])))
                    top = _best(s, d, u, r, k)
                    best[i] = s[top], d[top], u[top], r[top]
                    floor[i] = s[top[-1]] if len(top) == k else 0
        for i, item in enumerate(p.items):
            s, d, u, r = best[i]
            if len(s):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(s), item, np.int64)), pa.array(d, mask=u.astype(bool)), pa.array(s), pa.array(r)],
                    ["query", "doc_id", "score", "row"],
                )

    return run


def _item_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        query, words, counts = [], [], []
        for q, text in zip(b.column("query").to_pylist(), b.column("text")):
            for w, c in Counter(terms(text.as_py())).items():
                query.append(q)
                words.append(w)
                counts.append(c)
        yield pa.RecordBatch.from_arrays([pa.array(query, pa.int64()), pa.array(words, pa.binary()), pa.array(counts, pa.int64())], ["query", "word", "qtf"])


def search(docs: DataFrame, items: DataFrame, k: int = 10, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """item_id, rank, doc_id, score: the ``k`` best documents of each row of ``items`` whose score is above 0.

    The score is the sum, over an item's terms with repeats, of the term's weight floor(1000 ln((2N+2)/(2df+1))) times a saturating
    share of its occurrences, all in whole numbers.  Equal scores come by ascending id, null ids last, then in row order.  Each row
    is a document or an item of its own, ids repeated or null included.  Null and empty texts have no
    terms: such documents count nowhere and such items have no rows.  Very long texts are counted whole.  Without documents or items the result is empty.
    """
    spark = docs.sparkSession
    context = spark.sparkContext
    asked = materialize(items.select(F.monotonically_increasing_id().alias("query"), F.col(item_col).alias("item_id"), F.col(item_text_col).cast("string").alias("text")), "items")
    wanted = materialize(asked.select("query", "text").mapInArrow(_item_terms, "query long, word binary, qtf long"), "item_terms")
    pairs = wanted.count()
    words = wanted.groupBy("word").agg(F.count(F.lit(1)).alias("items"))
    shape = "item_id " + asked.schema["item_id"].dataType.simpleString() + ", rank int, doc_id long, score long"
    if not pairs:
        return spark.createDataFrame([], shape)
    # numbers of terms: a term's pass and its place there
    passes = -(-words.count() // PASS_TERMS)
    numbered = materialize(words.select("word", F.pmod(F.xxhash64("word"), F.lit(passes)).alias("pass"), F.monotonically_increasing_id().alias("term")), "terms")
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    if passes > 1:  # the passes have to agree on row numbers
        rows = materialize(rows, "rows")
    counted = []
    for i in range(passes):
        own = {bytes(r["word"]): r["term"] for r in numbered.where(F.col("pass") == i).select("word", "term").toLocalIterator()}
        held = context.broadcast(own)
        counted.append(materialize(rows.mapInArrow(_counter(held), "row long, doc_id long, n long, term array<long>, tf array<long>"), "counts").where("n > 0"))
        held.unpersist()
    totals = counted[0].agg(F.count(F.lit(1)).alias("documents"), F.sum("n").alias("length")).first()
    if not totals["documents"]:
        return spark.createDataFrame([], shape)
    if passes == 1:
        table = counted[0]
    else:  # a row's lists of all passes, one after the other
        every = reduce(DataFrame.union, counted)
        table = materialize(every.groupBy("row").agg(F.first("doc_id").alias("doc_id"), F.first("n").alias("n"), F.collect_list("term").alias("term"), F.collect_list("tf").alias("tf")).select("row", "doc_id", "n", F.flatten("term").alias("term"), F.flatten("tf").alias("tf")), "counts")
    seen = reduce(DataFrame.union, [c.select(F.explode("term").alias("term")) for c in counted]).groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    n = F.lit(2 * totals["documents"] + 2).cast("double")
    weights = seen.select("term", F.floor(F.lit(1000.0) * F.log(n / (2 * F.col("df") + 1).cast("double"))).alias("weight"))
    blocks = -(-pairs // BLOCK_PAIRS)
    block = F.pmod(F.xxhash64("query"), F.lit(blocks))
    leaves = materialize(wanted.join(numbered, "word").join(weights, "term").select(block.alias("block"), "query", "term", "qtf", "weight"), "leaves")
    found = None
    for i in range(blocks):
        mine = leaves.where(F.col("block") == i).select("query", "term", "qtf", "weight").collect()
        if not mine:
            continue
        plan = context.broadcast(Plan([(r["query"], r["term"], r["qtf"]) for r in mine], {r["term"]: r["weight"] for r in mine}))
        part = table.mapInArrow(_searcher(plan, totals["documents"], totals["length"], k), "query long, doc_id long, score long, row long")
        found = part if found is None else found.union(part)
    if found is None:
        return spark.createDataFrame([], shape)
    best = Window.partitionBy("query").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last(), "row")
    top = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return top.join(asked.select("query", "item_id"), "query").select("item_id", "rank", "doc_id", "score")
