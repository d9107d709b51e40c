"""Token counts of fields or sections, from one encoding of the whole document.

A document is encoded once and every token keeps its span of characters.  Sections are disjoint spans of
the same text; each token goes to the section that holds most of its characters, to the earlier one if two hold
as many, and to none if no section touches it.  A token that reaches past its section is counted there as crossing.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import memory

TOKENIZER = "byte_bpe_50k.json"
MEMO = 400_000
#: Byte-level pre-tokenizers always cut where white space (Unicode's) begins after something else.
_SPACE = "\t-\r \x85\xa0  -     　"
_UNIT = re.compile(f"[{_SPACE}]*[^{_SPACE}]+|[{_SPACE}]+")


class Offsets(dict):
    """unit -> packed (start, end) of its tokens, in code points from the unit's start."""

    def __init__(self, tokenizer):
        super().__init__()
        self.tokenizer = tokenizer

    def load(self, units: list[str]) -> None:
        new = list({u for u in units if u not in self})
        if len(self) + len(new) > MEMO:
            self.clear()
            new = list(set(units))
        for at in range(0, len(new), 4096):
            part = new[at : at + 4096]
            for u, e in zip(part, self.tokenizer.encode_batch(part, add_special_tokens=False), strict=True):
                self[u] = np.array(e.offsets, "<i4").tobytes()

    def spans(self, text: str) -> np.ndarray:
        """(start, end) of every token of the text."""
        units = _UNIT.findall(text)
        if not units:
            return np.zeros((0, 2), np.int64)
        self.load(units)
        packed = [self[u] for u in units]
        sizes = np.fromiter(map(len, units), np.int64, len(units))
        starts = np.cumsum(sizes) - sizes
        n = np.fromiter((len(p) >> 3 for p in packed), np.int64, len(packed))
        return np.frombuffer(b"".join(packed), "<i4").reshape(-1, 2) + np.repeat(starts, n)[:, None]


def offsets(name: str) -> Offsets:
    """A worker's tokenizer; ``name`` is a file of the tokenizer package or a path.  Special tokens' strings are ordinary text."""

    def make() -> Offsets:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import public_tokenizers
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(name if os.path.isabs(name) else public_tokenizers.path(name))
        tokenizer.encode_special_tokens = True
        return Offsets(tokenizer)

    return memory.keep(("offsets", name), make)


def attribute(tokens: np.ndarray, sections: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each section the tokens given to it and those of them that reach beyond it.

    ``tokens`` are (start, end) in order of start; ``sections`` are disjoint (start, end) in order.
    """
    counts = np.zeros((2, len(sections)), np.int64)
    if not len(tokens) or not len(sections):
        return counts[0], counts[1]
    first = np.searchsorted(sections[:, 1], tokens[:, 0], "right")  # the first section that ends after the token starts
    last = np.searchsorted(sections[:, 0], tokens[:, 1], "left") - 1  # the last that starts before it ends
    touched = np.flatnonzero((first <= last) & (tokens[:, 1] > tokens[:, 0]))
    first, last, span = first[touched], last[touched], tokens[touched]
    best = first.copy()
    held = np.minimum(span[:, 1], sections[first, 1]) - np.maximum(span[:, 0], sections[first, 0])
    more, k = np.flatnonzero(last > first), 1
    while len(more):
        c = first[more] + k
        part = np.minimum(span[more, 1], sections[c, 1]) - np.maximum(span[more, 0], sections[c, 0])
        win = part > held[more]
        best[more[win]], held[more[win]] = c[win], part[win]
        k += 1
        more = more[first[more] + k <= last[more]]
    crossing = held < span[:, 1] - span[:, 0]
    return np.bincount(best, minlength=len(sections)), np.bincount(best[crossing], minlength=len(sections))


def lines(text: str) -> np.ndarray:
    """Lines with the line feed that ends them: they tile the text."""
    ends = [m.end() for m in re.finditer("\n", text)]
    if len(text) > (ends[-1] if ends else 0):
        ends.append(len(text))
    return np.array([[0, *ends[:-1]], ends], np.int64).T.reshape(-1, 2) if ends else np.zeros((0, 2), np.int64)


def count_sections(docs: DataFrame, sections: Column | None = None, tokenizer: str = TOKENIZER, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, section, start, end, n_tokens, n_crossing: one row per section of each row of ``docs``.

    ``sections`` is an array of struct(start, end) in code points, disjoint and in order; without it the sections are
    lines.  Sections are numbered from 0.  Null and empty texts, and null or empty arrays, have no section and no row.
    A null id is kept; rows that repeat an id give their rows each.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    given = (sections if sections is not None else F.lit(None)).cast("array<struct<start:long,end:long>>")
    picked = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"), given.alias("sections"))
    by_line = sections is None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = offsets(tokenizer)
        for b in batches:
            for at in range(0, b.num_rows, 128):
                part = b.slice(at, 128)
                out, ids, n = [], [], []
                for doc, t, s in zip(part.column("doc_id").to_pylist(), part.column("text").to_pylist(), part.column("sections"), strict=True):
                    spans = lines(t) if by_line else np.array([(x["start"], x["end"]) for x in s.as_py() or ()], np.int64).reshape(-1, 2)
                    if len(spans):
                        got, crossing = attribute(memo.spans(t), spans)
                        out.append(np.column_stack([np.arange(len(spans)), spans, got, crossing]))
                        ids.append(doc)
                        n.append(len(spans))
                if out:
                    table = np.concatenate(out)
                    id_column = pa.array([d for d, k in zip(ids, n, strict=True) for _ in range(k)], pa.int64())
                    yield pa.RecordBatch.from_arrays([id_column, *map(pa.array, table.T)], ["doc_id", "section", "start", "end", "n_tokens", "n_crossing"])

    return picked.mapInArrow(run, "doc_id long, section long, start long, end long, n_tokens long, n_crossing long")


def count_fields(rows: DataFrame, id_col: str, fields: list[str], separator: str = "\n", tokenizer: str = TOKENIZER) -> DataFrame:
    """doc_id, field, n_tokens, n_crossing of text columns that are encoded together, with ``separator`` between them.

    The separator belongs to the field before it, a null field is empty, and an empty field has no token.
    """
    parts = [F.coalesce(F.col(f"`{f}`").cast("string"), F.lit("")) for f in fields]
    parts = [F.concat(p, F.lit(separator)) if i + 1 < len(parts) else p for i, p in enumerate(parts)]
    ends = [sum((F.length(p) for p in parts[:i]), F.lit(0)) for i in range(len(parts) + 1)]
    spans = F.array(*[F.struct(a.cast("long").alias("start"), b.cast("long").alias("end")) for a, b in zip(ends, ends[1:], strict=False)])
    whole = rows.select(F.col(f"`{id_col}`").alias("doc_id"), F.concat(*parts).alias("text"), spans.alias("spans"))
    counted = count_sections(whole, F.col("spans"), tokenizer)
    name = F.element_at(F.array(*[F.lit(f) for f in fields]), (F.col("section") + 1).cast("int"))
    return counted.select("doc_id", name.alias("field"), "n_tokens", "n_crossing")
