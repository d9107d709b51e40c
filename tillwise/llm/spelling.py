"""Spelling variants: words one inserted, deleted or replaced letter apart, by a trie of letter-group counts.

A word is arranged by how often it has each group of letters, group after group.  One edit changes these counts by a surplus of one
at most, a deficit of one at most, or both, so a depth-first search that may spend one of each reaches every word one edit away; the words at
the leaves it reaches are verified.

The first groups deal the trie to tasks: Spark sends a word to its own subtree, and as a question to the subtrees that the
budget reaches through those groups.  As many groups take part as keep every subtree below ``SUBTREE`` words.  Of two words only one asks: the
shorter one, or the one with the smaller counts, so its first difference is a surplus.  In a task a batch of questions goes down the levels together.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scratch import discard, materialize

MIN_LENGTH = 7
MIN_COUNT = 2
#: A form is this many times as frequent as its variant, or more.
RATIO = 10
#: Words that a subtree holds at most, as long as there are groups left to divide it by.
SUBTREE = 20_000
#: Letter groups: the most widespread letters are groups of their own, the others share the rest.
GROUPS = 12
#: Distinct words that a task counts before it passes them on.
HELD_WORDS = 200_000
#: Candidate pairs compared at a time.
PAIRS = 1_000_000

#: Counts above this are cut to it, which brings no two of them further apart.
_TOP = 60_000

_LETTER = [0x41 <= c <= 0x5A or 0x61 <= c <= 0x7A or c >= 0xC0 for c in range(256)]
_TABLE = bytes((c + 32 if c <= 0x5A else c) if _LETTER[c] else 0x20 for c in range(256))


def runs(text: str | None) -> list[bytes]:
    """Maximal runs of A-Z, a-z and U+00C0 to U+00FF, in Latin-1, with A-Z in lower case."""
    return [] if text is None else text.encode("latin-1", "replace").translate(_TABLE).split()


def _written(doc_id: int | None, run: bytes) -> bytes:
    """The run as this document is taken to write it: of some runs one letter is missing."""
    name = run if run.isascii() else run.decode("latin-1").encode()
    h = zlib.crc32(b"%s:%s" % (b"" if doc_id is None else str(doc_id).encode(), name))
    if h % 31:
        return run
    cut = h % len(run)
    return run[:cut] + run[cut + 1 :]


def _counts(least: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def flush(held: Counter) -> pa.RecordBatch:
        words = [w.decode("latin-1") for w in held]
        return pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array(list(held.values()), pa.int64())], ["word", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()
        for b in batches:
            for i, text in zip(b.column("doc_id").to_pylist(), b.column("text")):
                for w, c in Counter(runs(text.as_py())).items():
                    if len(w) >= least:
                        w = _written(i, w)
                        if len(w) >= least:
                            held[w] += c
                if len(held) > HELD_WORDS:
                    yield flush(held)
                    held = Counter()
        if held:
            yield flush(held)

    return run


def word_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = MIN_LENGTH) -> DataFrame:
    """(word, n): occurrences of each run of ``least`` letters or more.  Null texts have none; a null id counts as an empty one."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(_counts(least), "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def letter_groups(words: DataFrame) -> list[int]:
    """The group of each Latin-1 code, by the number of words that hold the letter: a count for each of at most 256 letters."""
    held = words.select(F.explode(F.array_distinct(F.split("word", ""))).alias("letter")).where("letter <> ''").groupBy("letter").agg(F.count(F.lit(1)).alias("n"))
    order = [ord(r["letter"]) for r in sorted(held.collect(), key=lambda r: (-r["n"], r["letter"]))]
    group = [0] * 256
    for i, c in enumerate(order):
        group[c] = i if i < GROUPS - 2 else GROUPS - 2 + i % 2
    return group


def _vectors(words: list[bytes], group: np.ndarray) -> np.ndarray:
    """Counts of each group, a row per word."""
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    letters = group[np.frombuffer(b"".join(words), np.uint8)]
    at = np.repeat(np.arange(len(words)), lengths) * GROUPS + letters
    return np.minimum(np.bincount(at, minlength=len(words) * GROUPS).reshape(-1, GROUPS), _TOP)


#: A subtree's key is the sum of its counts times these, modulo 2**64, so a step of one in a group adds a fixed number.  Two
#: subtrees that share a key only share a task.
_STEP = (np.arange(1, GROUPS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) ** np.uint64(3) | np.uint64(1)


def _keys(vectors: np.ndarray, depth: int) -> np.ndarray:
    return (vectors[:, :depth].astype(np.uint64) * _STEP[:depth]).sum(axis=1, dtype=np.uint64)


def _prefixes(group: list[int]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Each word's subtree at every depth, for counting."""
    groups = np.array(group, np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            v = _vectors([w.encode("latin-1") for w in b.column("word").to_pylist()], groups)
            for depth in range(1, GROUPS + 1):
                keys, n = np.unique(_keys(v, depth), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(keys), depth, np.int32)), pa.array(keys.view(np.int64)), pa.array(n)], ["depth", "key", "n"])

    return run


def _depth(words: DataFrame, group: list[int]) -> int:
    """The least number of groups that leaves no subtree above ``SUBTREE`` words."""
    sizes = words.select("word").mapInArrow(_prefixes(group), "depth int, key long, n long").groupBy("depth", "key").agg(F.sum("n").alias("n"))
    top = {r["depth"]: r["n"] for r in sizes.groupBy("depth").agg(F.max("n").alias("n")).collect()}  # a row per depth
    return next((d for d in sorted(top) if top[d] <= SUBTREE), GROUPS)


def _sent(group: list[int], depth: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Each word once as a member of its subtree (kind 0), and as a question (kind 1) to every subtree within the budget."""
    groups = np.array(group, np.int64)
    steps = [(None, None), *((i, None) for i in range(depth)), *((i, j) for i in range(depth) for j in range(i + 1, depth))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            v = _vectors([w.encode("latin-1") for w in b.column("word").to_pylist()], groups)
            own = _keys(v, depth)
            at, keys = [], []
            for up, down in steps:
                able = np.arange(len(v)) if down is None else np.flatnonzero(v[:, down] > 0)
                key = own[able] + (_STEP[up] if up is not None else np.uint64(0)) - (_STEP[down] if down is not None else np.uint64(0))
                at.append(able)
                keys.append(key)
            at, keys = np.concatenate(at), np.concatenate(keys)
            order = np.lexsort((keys, at))
            at, keys = at[order], keys[order]
            once = np.append(True, (at[1:] != at[:-1]) | (keys[1:] != keys[:-1]))[: len(at)]
            at, keys = at[once], keys[once]  # a subtree is asked once
            for kind, rows, key in ((0, np.arange(len(v)), own), (1, at, keys)):
                taken = pa.array(rows)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key.view(np.int64)), pa.array(np.full(len(rows), kind, np.int32)), b.column("word").take(taken), b.column("n").take(taken)],
                    ["key", "kind", "word", "n"],
                )

    return run


class Trie:
    """Words by subtree key, then by the count of each group: per level the sorted codes (parent node, count) of its nodes."""

    def __init__(self, words: list[bytes], n: np.ndarray, keys: np.ndarray, group: np.ndarray):
        v = _vectors(words, group)
        order = np.lexsort((*(v[:, g] for g in reversed(range(GROUPS))), keys))
        self.words, self.n = [words[i] for i in order], n[order]
        v, keys = v[order], keys[order]
        new = np.ones(len(order), bool)
        new[1:] = keys[1:] != keys[:-1]
        self.keys, node = keys[new], np.cumsum(new) - 1
        self.levels = []
        for g in range(GROUPS):
            code = (node << 16) | v[:, g]
            new[1:] = code[1:] != code[:-1]
            self.levels.append(code[new])
            node = np.cumsum(new) - 1
        self.first = np.flatnonzero(new)
        self.last = np.append(self.first[1:], len(order))

    def leaves(self, v: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(question, leaf, spent) within a surplus and then a deficit of one."""
        if not len(self.keys):
            return (np.zeros(0, np.int64),) * 3
        node = np.searchsorted(self.keys, keys)
        node[node == len(self.keys)] = 0
        ask = np.flatnonzero(self.keys[node] == keys)
        node, spent = node[ask], np.zeros(len(ask), np.int64)  # 0 nothing, 1 the surplus, 2 both
        for g, codes in enumerate(self.levels):
            found = []
            for step, allowed, becomes in ((0, None, 0), (1, 0, 1), (-1, 1, 1)):
                able = np.arange(len(ask)) if allowed is None else np.flatnonzero(spent == allowed)
                count = v[ask[able], g] + step
                able, count = able[count >= 0], count[count >= 0]
                code = (node[able] << 16) | count
                at = np.searchsorted(codes, code)
                at[at == len(codes)] = 0
                hit = codes[at] == code
                found.append((ask[able[hit]], at[hit], spent[able[hit]] + becomes))
            ask, node, spent = (np.concatenate(x) for x in zip(*found))
        return ask, node, spent


def near(a: bytes, b: bytes) -> bool:
    """Whether exactly one letter is inserted, deleted or replaced between the two."""
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    if len(a) == len(b):
        x = int.from_bytes(a, "little") ^ int.from_bytes(b, "little")
        return not x >> (8 * (((x & -x).bit_length() - 1) // 8 + 1))
    x = int.from_bytes(a, "little") ^ int.from_bytes(b[: len(a)], "little")
    i = ((x & -x).bit_length() - 1) // 8 if x else len(a)
    return a[i:] == b[i + 1 :]


def _halves(words: list[bytes], shorter: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of both halves of each word, as a word of ``shorter`` letters fewer would have them.

    Of two words one edit apart the halves before or those behind the edit are equal.
    """
    first = np.fromiter((hash(w[: (len(w) - shorter) // 2]) for w in words), np.int64, len(words))
    last = np.fromiter((hash(w[(len(w) - shorter) // 2 + shorter :]) for w in words), np.int64, len(words))
    return first, last


def _pairs(group: list[int]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    groups = np.array(group, np.int64)

    def answer(trie: Trie, members: tuple, words: list[bytes], n: np.ndarray, keys: np.ndarray) -> Iterator[pa.RecordBatch]:
        ask, leaf, spent = trie.leaves(_vectors(words, groups), keys)
        sizes = trie.last[leaf] - trie.first[leaf]
        ends = np.cumsum(sizes)
        first, last = _halves(words)
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        start = 0
        while start < len(ask):  # leaves of any size are compared in blocks
            done = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, done + PAIRS, "right")))
            here = slice(start, stop)
            which = np.repeat(np.arange(start, stop), sizes[here])
            member = np.arange(len(which)) - np.repeat(ends[here] - sizes[here] - done, sizes[here]) + np.repeat(trie.first[leaf[here]], sizes[here])
            a = ask[which]
            longer = members[0][member] - lengths[a]
            close = np.zeros(len(a), bool)
            for more, half in ((0, members[1]), (1, members[2])):
                at = np.flatnonzero(longer == more)
                close[at] = (first[a[at]] == half[0][member[at]]) | (last[a[at]] == half[1][member[at]])
            close = np.flatnonzero(close)
            out: tuple[list, list, list, list] = ([], [], [], [])
            for i, j, k in zip(a[close].tolist(), member[close].tolist(), spent[which[close]].tolist()):
                word, other = words[i], trie.words[j]
                # words of equal counts ask each other, and one of them is heard
                if near(word, other) and (k or len(word) < len(other) or word < other):
                    for x, y in zip(out, (word, n[i], other, trie.n[j])):
                        x.append(y)
            start = stop
            text = lambda x: pa.array([w.decode("latin-1") for w in x], pa.string())
            yield pa.RecordBatch.from_arrays([text(out[0]), pa.array(out[1], pa.int64()), text(out[2]), pa.array(out[3], pa.int64())], ["a", "a_n", "b", "b_n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        members: list[pa.RecordBatch] = []
        trie, known = None, ()

        def columns(b):
            return [w.encode("latin-1") for w in b.column("word").to_pylist()], b.column("n").to_numpy(), b.column("key").to_numpy().view(np.uint64)

        for b in batches:
            kind = b.column("kind").to_numpy()
            cut = int(np.searchsorted(kind, 1))
            if cut:
                members.append(b.slice(0, cut))
            if cut < b.num_rows:
                if trie is None:
                    held = pa.Table.from_batches(members).combine_chunks().to_batches() if members else []
                    trie = Trie(*columns(held[0]), groups) if held else Trie([], np.zeros(0, np.int64), np.zeros(0, np.uint64), groups)
                    known = (np.fromiter(map(len, trie.words), np.int64, len(trie.words)), _halves(trie.words), _halves(trie.words, 1))
                yield from answer(trie, known, *columns(b.slice(cut)))

    return run


def near_pairs(words: DataFrame) -> DataFrame:
    """(a, a_n, b, b_n): every pair of ``words`` (word, n; distinct) one edit apart, once."""
    words = words.select("word", "n")
    group = letter_groups(words)
    sent = words.mapInArrow(_sent(group, _depth(words, group)), "key long, kind int, word string, n long")
    return sent.repartition("key").sortWithinPartitions("kind").mapInArrow(_pairs(group), "a string, a_n long, b string, b_n long")


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root): where following forms ends.  A form is ``RATIO`` times as frequent, so chains are short; each round doubles the step."""
    now = materialize(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        there = now.select(F.col("word").alias("root"), F.col("root").alias("further"))
        then = materialize(now.join(there, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "roots")
        moved = then.where("moved").limit(1).count()
        discard(now)
        now = then
        if not moved:
            return now.select("word", "root")


def variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = MIN_LENGTH, often: int = MIN_COUNT, ratio: int = RATIO) -> DataFrame:
    """word, form, root, n, n_near, form_n of every word of ``least`` letters or more that occurs ``often`` or more.

    Two words are near if one letter is inserted, deleted or replaced between them.  A word's form is its near word of largest n, ties going
    to the smallest in code-point order, if that is ``ratio`` times the word's n or more; else null.  ``root`` follows forms to the last one.  Null and
    empty texts have no words, very long texts and words are taken whole, rows that repeat count each time, rows of a null id count as of an empty
    one, and an empty table gives an empty result.
    """
    words = materialize(word_counts(docs, id_col, text_col, least).where(F.col("n") >= often), "words")
    pairs = materialize(near_pairs(words), "pairs")
    both = pairs.select(F.col("a").alias("word"), F.col("b").alias("other"), F.col("b_n").alias("other_n"))
    both = both.union(pairs.select("b", "a", "a_n"))
    best = both.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("m"), "other")).alias("best"))
    told = words.join(best, "word", "left").select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.col("best.other").alias("other"), (-F.col("best.m")).alias("other_n"))
    high = F.col("other_n") >= ratio * F.col("n")
    told = materialize(told.select("word", "n", "n_near", F.when(high, F.col("other")).alias("form"), F.when(high, F.col("other_n")).alias("form_n")), "told")
    roots = _roots(told.where("form IS NOT NULL"))
    return told.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
