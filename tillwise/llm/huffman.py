"""Token ids in Huffman-coded blocks.

Counts of all ids give one canonical code with bounded code lengths.  Documents in order of id
are cut into blocks that decode on their own: a block row holds the packed bits, the number of
the first token in the whole file, and a checkpoint (bit offset) every ``STEP`` tokens, at which decoding may
start.  A reader looks codes up in one table and decodes all checkpoints of a block side by side.

A written set is two Parquet folders, ``codes`` (id, bits) and ``blocks``; Spark's writer commits
whole tasks, so a lost executor leaves no half block, and any store that Spark reaches will do.
"""

from __future__ import annotations

import itertools
import os
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import memory
from .scratch import discard, fresh_path, materialize
from .text import SPACE

MIN_WIDTH = 16
BLOCK_TOKENS = 1 << 19
STEP = 256
END = 2
MEMO = 1_200_000
SLICE_BYTES = 4 * 2**20


# ---------------------------------------------------------------- code


def code_lengths(counts: np.ndarray, max_bits: int = 20) -> np.ndarray:
    """Optimal code lengths of at most ``max_bits`` by package-merge; 0 for ids that do not occur."""
    used = np.flatnonzero(counts > 0)
    lengths = np.zeros(len(counts), np.uint8)
    if len(used) == 0:
        return lengths
    if len(used) == 1:
        lengths[used] = 1
        return lengths
    if max_bits > 25 or len(used) > 1 << max_bits:
        raise ValueError("code lengths go up to 25 bits and must be enough for all ids")
    order = used[np.argsort(counts[used], kind="stable")]
    leaves = counts[order].astype(np.float64)
    # A level's list merges the leaves with the pairs of the level below.  Of each list only a prefix is
    # used, and of the leaves in it again a prefix, so counting leaves per level is enough.
    levels = [np.ones(len(leaves), bool)]
    weights = leaves
    for _ in range(max_bits - 1):
        pairs = weights[: len(weights) // 2 * 2].reshape(-1, 2).sum(axis=1)
        both = np.concatenate([leaves, pairs])
        rank = np.argsort(both, kind="stable")
        weights = both[rank]
        levels.append(rank < len(leaves))
    take = 2 * len(leaves) - 2
    bits = np.zeros(len(leaves), np.int64)
    for is_leaf in reversed(levels):
        n = int(is_leaf[:take].sum())
        bits[:n] += 1
        take = 2 * (take - n)
    lengths[order] = bits
    return lengths


def canonical(lengths: np.ndarray) -> np.ndarray:
    """Codes by (length, id); only the lengths need to be kept."""
    codes = np.zeros(len(lengths), np.uint64)
    used = np.flatnonzero(lengths)
    code, last = 0, 0
    for i in used[np.lexsort((used, lengths[used]))]:
        code <<= int(lengths[i]) - last
        last = int(lengths[i])
        codes[i] = code
        code += 1
    return codes


def decode_table(lengths: np.ndarray) -> tuple[np.ndarray, int]:
    """For each value of the next ``width`` bits an id and, in the low five bits, the length of its code."""
    width = max(1, int(lengths.max(initial=1)))
    table = np.ones(1 << width, np.int64)
    used = np.flatnonzero(lengths)
    order = used[np.lexsort((used, lengths[used]))]  # canonical codes in rising order fill the table from its start
    spans = (1 << (width - lengths[order].astype(np.int64))).astype(np.int64)
    n = int(spans.sum())
    table[:n] = np.repeat(order << 5 | lengths[order], spans)
    return table, width


def pack(ids: np.ndarray, codes: np.ndarray, lengths: np.ndarray) -> tuple[bytes, np.ndarray]:
    """Bits of ``ids``, most significant first, and the bit offset of every token."""
    size = lengths[ids].astype(np.int64)
    ends = np.cumsum(size)
    offsets = ends - size
    total = int(ends[-1]) if len(ids) else 0
    words = np.zeros(total // 64 + 3, np.uint64)
    if len(ids):
        left = codes[ids] << (64 - size).astype(np.uint64)
        at, shift = offsets >> 6, (offsets & 63).astype(np.uint64)
        first = left >> shift
        second = np.where(shift > 0, left << (np.uint64(64) - np.maximum(shift, np.uint64(1))), np.uint64(0))
        starts = np.flatnonzero(np.diff(at, prepend=-1))
        words[at[starts]] = np.bitwise_or.reduceat(first, starts)
        words[at[starts] + 1] |= np.bitwise_or.reduceat(second, starts)
    return words.astype(">u8").tobytes(), offsets


def unpack(payload: bytes, checkpoints: np.ndarray, n: int, table: tuple[np.ndarray, int], step: int = STEP) -> np.ndarray:
    """The ``n`` ids of a block: all checkpoints advance together, one table lookup a token."""
    entries, width = table
    lanes = len(checkpoints)
    if n == 0:
        return np.zeros(0, np.int32)
    window = np.ndarray(shape=(len(payload) - 7,), dtype=">u4", buffer=payload, strides=(1,))
    out = np.zeros((step, lanes), np.int64)
    at = checkpoints.astype(np.int64)
    down, mask = 32 - width, (1 << width) - 1  # up to 7 bits of the first byte are read already, so width is 25 at most
    bound = 8 * (len(window) - 1)
    for k in range(step):
        np.minimum(at, bound, out=at)  # the last lane may end early
        found = entries[(window[at >> 3].astype(np.int64) >> (down - (at & 7))) & mask]
        out[k] = found
        at += found & 31
    out >>= 5
    return out.T.reshape(-1)[:n]


# ---------------------------------------------------------------- tokens


class _Known:
    """What was encoded lately, in two generations: when the younger is full it becomes the older, and what is met again moves back."""

    def __init__(self, encode: Callable[[list[bytes]], list[bytes | None]], limit: int):
        self.encode, self.limit, self.young, self.old = encode, limit // 2, {}, {}

    def of(self, keys: list[bytes]) -> list[bytes | None]:
        """What belongs to each of the different ``keys``; the new ones are encoded together."""
        if len(self.young) > self.limit:
            self.old, self.young = self.young, {}
        found = list(map(self.young.get, keys))
        missing = [k for k, x in zip(keys, found) if x is None and k not in self.young]
        if not missing:
            return found
        new = [k for k in missing if k not in self.old]
        self.young.update((k, self.old[k]) for k in missing if k in self.old)
        for i in range(0, len(new), 1 << 15):
            part = new[i : i + (1 << 15)]
            self.young.update(zip(part, self.encode(part), strict=True))
        return [self.young[k] if x is None else x for k, x in zip(keys, found)]


def _byte_alphabet() -> list[str]:
    """The character that byte-level tokenizers put for each byte: itself if it prints, else the next one from 256 on."""
    prints = [33 <= b <= 126 or 161 <= b <= 172 or b >= 174 for b in range(256)]
    return [chr(b) if p else chr(256 + b - sum(prints[:b])) for b, p in enumerate(prints)]


#: For texts decoded as Latin-1, that is byte by byte; pieces hold no line end, which stands between them.
_BYTES = {b: c for b, c in enumerate(_byte_alphabet()) if b != 10}

_SPACE, _SINGLE = 0, 1


def _kinds(kind: Callable[[int], int]) -> bytes:
    return bytes(_SPACE if b in SPACE else kind(b) for b in range(256))


#: Kinds of bytes: a piece is a run of one kind, a digit is a piece by itself, a word is all between white space.
_PIECE_KINDS = _kinds(lambda b: _SINGLE if chr(b) in "0123456789" else 2 if b >= 128 or chr(b).isalpha() else 3)
_WORD_KINDS = _kinds(lambda b: 2)
_LOWER = bytes(range(256)).lower()


def _values(array: pa.Array) -> list[bytes]:
    """``to_pylist`` of large binaries without nulls, without a scalar for each."""
    _, offsets, raw = array.buffers()
    at = np.frombuffer(offsets, np.int64, len(array) + 1, 8 * array.offset).tolist()
    raw = raw.to_pybytes() if raw else b""
    return [raw[a:b] for a, b in zip(at, at[1:])]


class WordMemo:
    """Encodes texts from remembered pieces; equal to encoding each whole text.

    A piece is a letter run, a digit or a run of ASCII punctuation: what the tokenizer itself encodes one by one.
    That holds while all characters above ASCII are letters, also once normalised, and there is no apostrophe (contractions) and no
    special token; a text with anything else is the sum of its words, since white space always separates.

    Texts are cut all at once, and each different piece among them is looked up once.
    """

    def __init__(self, tokenizer, limit: int = MEMO):
        self.tokenizer = tokenizer
        self.type = "<u2" if max(tokenizer.get_vocab().values(), default=0) < 1 << 16 else "<u4"
        self.pieces, self.words = _Known(self._pieces, limit), _Known(self._words, limit // 8)
        tried = ["the".encode(), "ungéheuerß".encode(), b"7", "Éa".encode(), b"#~\x01"]
        self.direct = True
        self.direct = self._pieces(tried) == self._words(tried)

    def _pack(self, ids: list[list[int]]) -> list[bytes]:
        flat = np.fromiter(itertools.chain.from_iterable(ids), self.type).tobytes()
        ends = (np.cumsum([len(x) for x in ids], dtype=np.int64) * np.dtype(self.type).itemsize).tolist()
        return [flat[a:b] for a, b in zip([0, *ends], ends)]

    def _words(self, words: list[bytes]) -> list[bytes]:
        return self._pack([self.tokenizer.encode(w.decode("utf-8", "surrogatepass"), add_special_tokens=False).ids for w in words])

    def _direct(self, pieces: list[bytes]) -> list[bytes]:
        """Of normalised pieces, by the tokenizer's model alone: its byte alphabet is applied here."""
        texts = b"\n".join(pieces).decode("latin-1").translate(_BYTES).split("\n") if pieces else []
        tokenize = self.tokenizer.model.tokenize
        return self._pack([[t.id for t in tokenize(x)] for x in texts])

    def _letters(self, pieces: list[bytes]) -> dict[bytes, bytes]:
        """Normalised, those of letters only: no white space is in them, so all are one text for the normalizer."""
        texts = {p: t for p in pieces if (t := p.decode("utf-8", "surrogatepass")).lower().isalpha()}
        normalize = self.tokenizer.normalizer.normalize_str
        found = normalize(" ".join(texts.values())).split(" ") if texts else []
        if len(found) != len(texts):
            found = [normalize(t) for t in texts.values()]
        # some letters are a letter and a mark once normalised, and a mark is cut off
        return {p: n.encode("utf-8", "surrogatepass") for p, n in zip(texts, found, strict=True) if n.isalpha()}

    def _pieces(self, pieces: list[bytes]) -> list[bytes | None]:
        """None for a piece whose limits depend on what stands beside it."""
        letters = self._letters([p for p in pieces if not p.isascii()])
        normal = [letters.get(p) if not p.isascii() else None if b"'" in p or b"<|" in p else p for p in pieces]
        fit = [p for p, n in zip(pieces, normal) if n is not None]
        found = iter(self._direct([n for n in normal if n is not None]) if self.direct else self._words(fit))
        return [None if n is None else next(found) for n in normal]

    def _sums(self, texts: pa.Array, known: _Known, kinds: bytes, fold: bytes | None) -> tuple[pa.Array, np.ndarray]:
        """Packed ids of each text by what is known of its pieces, and the numbers of the texts with a piece of which nothing is."""
        _, offsets, raw = texts.buffers()
        at = np.frombuffer(offsets, np.int64, len(texts) + 1, 8 * texts.offset)
        data = raw[at[0] : at[-1]].to_pybytes() if raw else b""
        at = at - at[0]
        kind = np.frombuffer(data.translate(kinds), np.uint8)
        new = kind == _SINGLE
        new[1:] |= kind[1:] != kind[:-1]
        new[at[at < len(data)]] = True
        runs = np.flatnonzero(new)
        solid = kind[runs] != _SPACE
        cuts = np.concatenate([[0], np.cumsum(np.diff(runs, append=len(data))[solid])])
        first = np.concatenate([[0], np.cumsum(solid)])[np.searchsorted(runs, at)]
        del kind, new, runs, solid
        body = pa.py_buffer(data.translate(fold, SPACE))
        coded = pa.Array.from_buffers(pa.large_binary(), len(cuts) - 1, [None, pa.py_buffer(cuts), body]).dictionary_encode()
        ids = pa.array(known.of(_values(coded.dictionary)), pa.large_binary()).take(coded.indices)
        ends = np.frombuffer(ids.buffers()[1], np.int64, len(ids) + 1, 8 * ids.offset)[first]
        odd = np.flatnonzero(ids.is_null().to_numpy(zero_copy_only=False)) if ids.null_count else np.zeros(0, np.int64)
        rows = pa.Array.from_buffers(pa.large_binary(), len(texts), [None, pa.py_buffer(ends), ids.buffers()[2]])
        return rows, np.unique(np.searchsorted(first, odd, "right") - 1)

    def packed(self, texts: pa.Array) -> pa.Array:
        """Packed ids (of ``type``) of each text; a null text is empty."""
        texts = texts.cast(pa.large_binary()).fill_null(b"")
        if not len(texts):
            return texts
        out, odd = self._sums(texts, self.pieces, _PIECE_KINDS, _LOWER)
        if len(odd):
            whole, _ = self._sums(texts.take(pa.array(odd)), self.words, _WORD_KINDS, None)
            order = np.arange(len(texts))
            order[odd] = len(texts) + np.arange(len(odd))
            out = pa.concat_arrays([out, whole]).take(pa.array(order))
        return out

    def ids(self, texts: list[bytes]) -> list[bytes]:
        return _values(self.packed(pa.array(texts, pa.large_binary())))


def word_tokenizer(name: str) -> WordMemo:
    """A worker's memo over a public tokenizer that drops white space and ASCII case; ``name`` is a file of the tokenizer package or a path."""

    def make() -> WordMemo:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import public_tokenizers
        from tokenizers import Tokenizer

        return WordMemo(Tokenizer.from_file(name if os.path.isabs(name) else public_tokenizers.path(name)))

    return memory.keep(("words", name), make)


def _slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """A batch in parts of ``SLICE_BYTES`` of text or so, of one row at least."""
    sizes = pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    part = (np.cumsum(sizes) - sizes) // SLICE_BYTES
    cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
    for a, b in zip(cuts, cuts[1:]):
        yield batch.slice(a, b - a)


def tokenize(docs: DataFrame, tokenizer: str = "word_bpe_49k.json", end: int | None = END, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n and ids of every row; a null text is empty, ``end`` closes each document.

    Ids are little-endian, of 2 bytes each where the vocabulary allows it and else of 4: len(ids) / n tells.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = word_tokenizer(tokenizer)
        tail = pa.scalar(b"" if end is None else np.array([end], memo.type).tobytes(), pa.large_binary())
        width = np.dtype(memo.type).itemsize
        for b in batches:
            for part in _slices(b):
                packed = pc.binary_join_element_wise(memo.packed(part.column("text")), tail, pa.scalar(b"", pa.large_binary())).cast(pa.binary())
                n = pc.divide(pc.binary_length(packed).cast(pa.int64()), width)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), n, packed], ["doc_id", "n", "ids"])

    picked = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return picked.mapInArrow(run, "doc_id long, n long, ids binary")


def _unpacked(n: int, ids: pa.Scalar) -> np.ndarray:
    raw = ids.as_buffer()
    return np.frombuffer(raw, "<u2" if len(raw) == 2 * n else "<u4") if n else np.zeros(0, np.uint16)


def count_ids(tokens: DataFrame) -> DataFrame:
    """(id, n) of all tokens: a count array per task, then one row per id and task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1, np.int64)
        for b in batches:
            parts = [_unpacked(n, x) for n, x in zip(b.column("n").to_pylist(), b.column("ids"), strict=True)]
            got = np.bincount(np.concatenate(parts)) if parts else total[:0]
            if len(got) > len(total):
                total = np.pad(total, (0, len(got) - len(total)))
            total[: len(got)] += got
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(total[at])], ["id", "n"])

    return tokens.select("n", "ids").mapInArrow(run, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))


# ---------------------------------------------------------------- files

BLOCK = "first_doc long, part int, block int, start long, n_tokens long, payload binary, checkpoints binary, docs binary, sizes binary, nulls long"


def write(tokens: DataFrame, path: str, max_bits: int | None = None, block_tokens: int = BLOCK_TOKENS, step: int = STEP) -> None:
    """Writes ``tokens`` (doc_id, n, ids) as codes and blocks in ascending order of doc_id, nulls first.

    Without ``max_bits`` codes may be one bit longer than equal codes would be, and 16 bits at least: short
    enough for a table that stays in a processor's cache, for next to no loss in size.
    """
    spark = tokens.sparkSession
    rows = count_ids(tokens).collect()  # at most one row per id of the vocabulary
    counts = np.zeros(max((r["id"] for r in rows), default=0) + 1, np.int64)
    for r in rows:
        counts[r["id"]] = r["n"]
    lengths = code_lengths(counts, max_bits or max(MIN_WIDTH, int(np.count_nonzero(counts)).bit_length() + 1))
    spark.createDataFrame([(int(i), int(lengths[i])) for i in np.flatnonzero(lengths)], "id long, bits int").coalesce(1).write.parquet(f"{path}/codes")
    shared = spark.sparkContext.broadcast((canonical(lengths), lengths))  # the vocabulary's size, not the data's

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, bits = shared.value
        from pyspark import TaskContext

        memory.drop()
        part, block, start = TaskContext.get().partitionId(), 0, 0
        docs: list = []
        held: list[np.ndarray] = []
        size = 0

        def flush() -> pa.RecordBatch:
            nonlocal block, start, size
            ids = np.concatenate(held)
            payload, offsets = pack(ids, codes, bits)
            known = np.array([0 if d is None else d for d in docs], "<i8")
            row = [docs[0], part, block, start, len(ids), payload, offsets[::step].astype("<i8").tobytes(), known.tobytes(), np.array([len(h) for h in held], "<i8").tobytes(), sum(d is None for d in docs)]
            block, start, size = block + 1, start + len(ids), 0
            docs.clear()
            held.clear()
            names = ["first_doc", "part", "block", "start", "n_tokens", "payload", "checkpoints", "docs", "sizes", "nulls"]
            types = [pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), *[pa.binary()] * 4, pa.int64()]
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, types, strict=True)], names)

        for b in batches:
            for d, n, x in zip(b.column("doc_id").to_pylist(), b.column("n").to_pylist(), b.column("ids"), strict=True):
                docs.append(d)
                held.append(_unpacked(n, x).astype(np.int64))
                size += len(held[-1])
                if size >= block_tokens:
                    yield flush()
        if docs:
            yield flush()

    # a row number as second key: an id that many rows share, or the null id, does not go to one task
    numbered = tokens.select("doc_id", "n", "ids", F.monotonically_increasing_id().alias("nth"))
    ranged = numbered.repartitionByRange(F.col("doc_id").asc_nulls_first(), "nth").sortWithinPartitions(F.col("doc_id").asc_nulls_first())
    ranged.select("doc_id", "n", "ids").mapInArrow(run, BLOCK).write.option("compression", "none").parquet(f"{path}/blocks")


def read_blocks(spark: SparkSession, path: str) -> DataFrame:
    """Blocks with ``start`` counted over the whole file: range partitions are in order, so their totals add up."""
    blocks = spark.read.schema(BLOCK).parquet(f"{path}/blocks")
    totals = sorted(blocks.groupBy("part").agg(F.sum("n_tokens").alias("n")).collect())  # one row per written file
    begins, so_far = [], 0
    for part, n in totals:
        begins.append((part, so_far))
        so_far += n
    offsets = F.broadcast(spark.createDataFrame(begins, "part int, before long"))
    return blocks.join(offsets, "part").withColumn("start", F.col("start") + F.col("before")).drop("before")


def read(spark: SparkSession, path: str, step: int = STEP) -> DataFrame:
    """doc_id, start, n, ids of every document, decoded block by block."""
    lengths = np.zeros(1, np.uint8)
    rows = spark.read.parquet(f"{path}/codes").collect()  # one row per id of the vocabulary
    if rows:
        lengths = np.zeros(max(r["id"] for r in rows) + 1, np.uint8)
        for r in rows:
            lengths[r["id"]] = r["bits"]
    shared = spark.sparkContext.broadcast(lengths)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory.drop()
        table = decode_table(shared.value)
        for b in batches:
            for row in b.to_pylist():
                ids = unpack(row["payload"], np.frombuffer(row["checkpoints"], "<i8"), row["n_tokens"], table, step)
                sizes = np.frombuffer(row["sizes"], "<i8")
                ends = np.cumsum(sizes)
                docs = np.frombuffer(row["docs"], "<i8")
                raw = ids.astype("<u4").tobytes()
                parts = [raw[4 * (e - s) : 4 * e] for e, s in zip(ends.tolist(), sizes.tolist(), strict=True)]
                null = np.arange(len(docs)) < row["nulls"]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(docs, mask=null), pa.array(row["start"] + ends - sizes), pa.array(sizes), pa.array(parts, pa.binary())], ["doc_id", "start", "n", "ids"]
                )

    return read_blocks(spark, path).select("start", "n_tokens", "payload", "checkpoints", "docs", "sizes", "nulls").mapInArrow(run, "doc_id long, start long, n long, ids binary")


def checksums(decoded: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of decoded documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            crc = pa.array([zlib.crc32(x.as_buffer()) for x in b.column("ids")], pa.int64())
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("start"), b.column("n"), crc], ["doc_id", "start", "n_tokens", "ids_crc32"])

    return decoded.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def round_trip(docs: DataFrame, tokenizer: str = "word_bpe_49k.json", end: int = END) -> DataFrame:
    """Tokenize, write, read back: doc_id, start, n_tokens, ids_crc32 of every row.

    Empty and null texts hold the end id alone.  Null ids come first; rows that repeat an id follow one
    another in any order.  An empty table writes no block.
    """
    spark = docs.sparkSession
    tokens = materialize(tokenize(docs, tokenizer, end), "tokens")
    path = fresh_path(spark, "huffman")
    write(tokens, path)
    discard(tokens)
    return checksums(read(spark, path))
