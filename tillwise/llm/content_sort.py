"""Exact duplicates by sorting contents.

Texts are normalised and dealt to sorted ranges: Spark samples splitters, which are the leading
bytes, the SHA-256, the id and the row number, so they stay short whatever the texts and a group of equal texts, however large,
spreads over several ranges.  Spark's external sort puts equal texts next to each other, each text is compared in full with
the one before it, and equal neighbours form a run.  Runs that go on in the next range are found by comparing
the texts at the ends of the ranges.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .scratch import materialize

#: Leading bytes of a text that take part in a splitter.
LEAD = 24
#: Rows of one run that look up its size under one key.
CHUNK = 4096

_GAP = r"[\x20\x09-\x0D]+"
_RUNS = "part int, run long, chunk long, alone boolean, row long, doc_id long, sha string, head binary, tail binary"


def normalised(text: Column) -> Column:
    """Each run of the six ASCII white-space characters as one space; null is empty."""
    return F.regexp_replace(F.coalesce(text.cast("string"), F.lit("")), _GAP, " ")


def _sorted(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("doc_id"), normalised(F.col(text_col)).cast("binary").alias("text"))
    keyed = rows.select("row", "doc_id", "text", F.substring("text", 1, LEAD).alias("lead"), F.sha2("text", 256).alias("sha"))
    last = F.col("doc_id").asc_nulls_last()
    return keyed.repartitionByRange("lead", "sha", last, "row").sortWithinPartitions("lead", "sha", "text", last, "row")


def _runs(chunk: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows of a sorted range with the number of their run; a row is alone if it differs from both its neighbours.

    One row is held back until the next batch is there.  The first and the last row of the range carry their texts: whether
    they are alone is not known here.
    """

    def run_numbers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        run, place, first = -1, 0, True
        held: pa.RecordBatch | None = None  # the last row seen
        held_new = True  # whether it began a run

        def out(b: pa.RecordBatch, runs, places, alone, head=False, tail=False) -> pa.RecordBatch:
            n = b.num_rows
            texts = b.column("text")
            edge = lambda on, i: pa.array([texts[i].as_py() if on and j == i else None for j in range(n)] if on else [None] * n, pa.binary())
            return pa.RecordBatch.from_arrays(
                [pa.array(np.full(n, part, np.int32)), pa.array(runs), pa.array(places // chunk), pa.array(alone), b.column("row"), b.column("doc_id"), b.column("sha"), edge(head, 0), edge(tail, n - 1)],
                ["part", "run", "chunk", "alone", "row", "doc_id", "sha", "head", "tail"],
            )

        for b in batches:
            if not b.num_rows:
                continue
            texts = b.column("text")
            new = np.ones(b.num_rows, bool)
            new[1:] = ~np.asarray(pc.equal(texts.slice(1), texts.slice(0, b.num_rows - 1)))
            if held is not None:
                new[0] = held.column("text")[0].as_py() != texts[0].as_py()
                yield out(held, np.array([run]), np.array([place]), np.array([held_new and new[0] and not first]), head=first)
                first = False
            starts = np.maximum.accumulate(np.where(new, np.arange(b.num_rows), -1))
            places = np.arange(b.num_rows) - starts + np.where(starts < 0, place, 0)
            runs = run + np.cumsum(new)
            if b.num_rows > 1:
                alone = new[:-1] & new[1:]
                alone[0] &= not first
                yield out(b.slice(0, b.num_rows - 1), runs[:-1], places[:-1], alone, head=first)
                first = False
            held, held_new, run, place = b.slice(b.num_rows - 1), bool(new[-1]), int(runs[-1]), int(places[-1])
        if held is not None:
            yield out(held, np.array([run]), np.array([place]), np.array([False]), head=first, tail=True)

    return run_numbers


def _homes(rows: DataFrame) -> DataFrame:
    """(part, run, home_part, home_run) of the runs that continue one of an earlier range: at most one a range."""
    ends = rows.where("head IS NOT NULL OR tail IS NOT NULL").groupBy("part").agg(F.max("head").alias("head"), F.max("tail").alias("tail"), F.max("run").alias("last_run"))
    ends = materialize(ends, "ends")
    order = Window.orderBy("part")  # a row per range
    before = ends.select("part", F.lag("part").over(order).alias("before"))
    tails = ends.select(F.col("part").alias("before"), "tail")
    same = ends.select("part", "head", "last_run").join(before, "part").join(tails, "before", "left")
    same = same.select("part", "last_run", F.coalesce(F.col("head") == F.col("tail"), F.lit(False)).alias("goes_on"))
    begun = F.when(~F.col("goes_on") | (F.col("last_run") > 0), F.struct("part", "last_run"))
    home = F.max(begun).over(order.rowsBetween(Window.unboundedPreceding, -1))
    found = same.select("part", "goes_on", home.alias("home")).where("goes_on")
    return found.select("part", F.lit(0).cast("long").alias("run"), F.col("home.part").alias("home_part"), F.col("home.last_run").alias("home_run"))


def duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 of every row of ``docs``.

    Texts are equal if they are identical once each run of white space is one space; null is empty, and
    empty texts are equal to each other.  Of equal texts the row of the smallest id stays; ids that are null come last, and among rows
    of one id one stays.  ``keep_id`` is null only if all ids of the group are.  Texts of any length are compared whole.
    An empty table gives an empty result; other columns of ``docs`` are not looked at.
    """
    rows = materialize(_sorted(docs, id_col, text_col).mapInArrow(_runs(CHUNK), _RUNS), "runs")
    met = rows.where("NOT alone").groupBy("part", "run").agg(F.count(F.lit(1)).alias("size"), F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")).alias("least"), F.max("chunk").alias("chunks"))
    homes = _homes(rows).withColumnsRenamed({"part": "p", "run": "r"})
    met = met.join(homes, (F.col("part") == F.col("p")) & (F.col("run") == F.col("r")), "left")
    met = materialize(met.select("part", "run", "size", "least", "chunks", F.coalesce("home_part", "part").alias("home_part"), F.coalesce("home_run", "run").alias("home_run")), "met")
    groups = met.groupBy("home_part", "home_run").agg(F.sum("size").alias("group_size"), F.min("least").alias("stays"))
    # a run's rows ask in chunks, so that one text with a third of all rows is no hot key
    keys = met.join(groups, ["home_part", "home_run"]).select("part", "run", F.explode(F.sequence(F.lit(0).cast("long"), "chunks")).alias("chunk"), "group_size", "stays")
    asked = rows.where("NOT alone").join(keys, ["part", "run", "chunk"])
    some = asked.select("doc_id", F.col("stays.doc_id").alias("keep_id"), "group_size", (F.col("row") == F.col("stays.row")).alias("kept"), F.col("sha").alias("text_sha256"))
    one = rows.where("alone").select("doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), F.col("sha").alias("text_sha256"))
    return one.union(some)
