"""Mixing sources to target weights by systematic sampling.

The documents of a source are laid on a line, each as long as its expected number of copies.
One random offset per source shifts a grid of integers over the line, and a document is
emitted once for each integer it covers.  Documents lie in order of size class, so that what
the sample takes of a source in words stays within about one large document of its target.

No task sees a whole source: a document's place is the number of documents in smaller size
classes, plus those of its class in earlier hash buckets of ids, plus those before its id in its
bucket, plus, among rows of one id and size, those in earlier hash buckets of row numbers and its rank in
its own.  All but the last come from counts, and with about sqrt(n) buckets of either sort a window
sees about sqrt(n) rows, whatever one source, one id or the null id holds.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .scratch import materialize
from .text import WORD, unused

WEIGHTS = (3, 1, 2)
SHARE_PERCENT = 150
LIMIT = 2
SEED = "mix-1"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def _hash(text: Column) -> Column:
    """A whole number below 2**32 from the first eight hex digits of md5."""
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long")


def source_targets(totals: DataFrame, weights=WEIGHTS, share_percent=SHARE_PERCENT, limit=LIMIT, seed=SEED) -> DataFrame:
    """Targets of all sources from (src, src_null, source_size): one row per source.

    Sources in code-point order, null last, take ``weights`` in turn.  A target is its weight's
    part of ``share_percent`` of all sizes, cut at ``limit`` times the source's size; the excess
    goes to the others by weight.  With sources ordered by limit / weight, those at their
    limit are a prefix, so one pass over the sources finds the level of the rest.
    """
    order = [F.col("src_null"), F.col("src")]
    every = Window.partitionBy()
    place = F.row_number().over(Window.orderBy(*order)) - 1
    weight = F.element_at(F.array(*[F.lit(int(w)) for w in weights]), (place % len(weights) + 1).cast("int"))
    s = totals.withColumn("weight", weight.cast("long")).withColumn("cap", F.col("source_size") * limit)
    up = Window.orderBy(F.col("cap") / F.col("weight"), *order)
    s = (
        s.withColumn("wanted", F.sum("source_size").over(every) * share_percent / F.lit(100))
        .withColumn("cap_before", F.coalesce(F.sum("cap").over(up.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
        .withColumn("weight_left", F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(up.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
        .withColumn("level", (F.col("wanted") - F.col("cap_before")) / F.col("weight_left"))
        .withColumn("free", F.col("cap") / F.col("weight") >= F.col("level"))
        .withColumn("level", F.min(F.when(F.col("free"), F.struct(F.row_number().over(up).alias("n"), "level"))).over(every)["level"])
    )
    target = F.least(F.col("cap").cast("double"), F.coalesce(F.col("level") * F.col("weight"), F.col("cap").cast("double")))
    return s.select(
        "src",
        "src_null",
        "source_size",
        target.alias("target"),
        (_hash(F.concat(F.lit(seed + ":"), F.when(F.col("src_null"), "n").otherwise("s"), F.col("src"))) / F.lit(2.0**32)).alias("offset"),
    )


def systematic(sized: DataFrame, id_col: str = "doc_id", source_col: str = "source", size_col: str = "size", row_col: str | None = None, **how) -> DataFrame:
    """Adds ``source_size``, ``target`` and ``copies`` to rows that have an id, a source and a size.

    The rows are read several times: give a table, not a long plan.  ``row_col`` names a number written with each row,
    by which rows that share an id and a size are dealt to tasks; without it they meet in one.  A null source is a source
    of its own, a null size counts as 0 and a row of size 0 may be taken like any other.  Rows
    that repeat an id are rows of their own.  An empty table gives an empty result.  Reruns
    give the same copies for the same rows (among rows equal in id and size any may be the one).
    """
    n = max(1, sized.count())
    buckets = max(1, math.isqrt(n))
    ids = F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit(""))
    size = F.coalesce(F.col(f"`{size_col}`"), F.lit(0)).cast("long")
    low_bits = F.greatest(F.length(F.bin(size)) - 4, F.lit(0))
    rows = sized.select(
        *[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(sized.columns)],
        F.coalesce(F.col(f"`{source_col}`").cast("string"), F.lit("")).alias("src"),
        F.col(f"`{source_col}`").isNull().alias("src_null"),
        size.alias("size"),
        F.call_function("shiftleft", F.call_function("shiftright", size, low_bits), low_bits).alias("klass"),
        (_hash(ids) % buckets).alias("bucket"),
        ids.alias("id_text"),
        (F.pmod(F.xxhash64(F.col(f"`{row_col}`")), F.lit(buckets)) if row_col else F.lit(0)).cast("long").alias("part"),
        (F.col(f"`{row_col}`") if row_col else F.lit(0)).cast("long").alias("nth"),
    )
    source = ["src", "src_null"]
    block = [*source, "klass", "bucket"]
    same = [*block, "id_text", "size"]
    parts = rows.groupBy(*same, "part").agg(F.count(F.lit(1)).alias("n"))
    groups = parts.groupBy(*same).agg(F.sum("n").alias("n"))
    blocks = groups.groupBy(*block).agg(F.sum("n").alias("n"), F.sum(F.col("n") * F.col("size")).alias("words"))
    classes = blocks.groupBy(*source, "klass").agg(F.sum("n").alias("n"), F.sum("words").alias("words"))
    totals = classes.groupBy(*source).agg(F.sum("words").alias("source_size"))
    before = lambda w: F.coalesce(F.sum("n").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    classes = classes.select(*source, "klass", before(Window.partitionBy(*source).orderBy("klass")).alias("class_before"))
    blocks = blocks.select(*block, before(Window.partitionBy(*source, "klass").orderBy("bucket")).alias("bucket_before"))
    groups = groups.select(*same, before(Window.partitionBy(*block).orderBy(F.md5("id_text"), "id_text", "size")).alias("group_before"))
    parts = parts.select(*same, "part", before(Window.partitionBy(*same).orderBy("part")).alias("part_before"))
    places = parts.join(groups, same).join(blocks.join(classes, [*source, "klass"]).join(source_targets(totals, **how), source), block)
    rank = F.row_number().over(Window.partitionBy(*same, "part").orderBy("nth"))
    place = F.col("class_before") + F.col("bucket_before") + F.col("group_before") + F.col("part_before") + rank
    rate = F.coalesce(F.col("target") / F.when(F.col("source_size") > 0, F.col("source_size")), F.lit(0.0))
    copies = F.floor(F.col("offset") + rate * place) - F.floor(F.col("offset") + rate * (place - 1))
    return (
        rows.join(places, [*same, "part"])
        .withColumn("copies", copies.cast("long"))
        .select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(sized.columns) if c not in ("source_size", "target", "copies")], "source_size", "target", "copies")
    )


def mix(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", source_col: str = "source", **how) -> DataFrame:
    """doc_id, size, source_size, target, copies, taken for every row of ``docs``; sizes are words, null has none."""
    sized = materialize(
        docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), word_count(F.col(text_col)).alias("size")), "sizes"
    )
    return systematic(sized, row_col="row", **how).select(
        "doc_id", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken")
    )


def take(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", source_col: str = "source", **how) -> DataFrame:
    """The mixed rows, with the columns of ``docs``: each row as often as the sample takes it.

    Row numbers are written with the rows once, since numbers made in two scans agree only while both are cut alike.
    """
    row, taken, times, nth = (unused(n, docs.columns) for n in ("_row", "_taken", "_times", "_nth"))
    numbered = materialize(docs.withColumn(row, F.monotonically_increasing_id()), "numbered")
    sized = materialize(
        numbered.select(F.col(row).alias("row"), F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), word_count(F.col(text_col)).alias("size")), "sizes"
    )
    copies = systematic(sized, row_col="row", **how).where("copies > 0").select(F.col("row").alias(taken), F.col("copies").cast("int").alias(times))
    # a row per document: never a side to broadcast, however small it is today
    drawn = numbered.join(materialize(copies, "copies").hint("merge"), F.col(row) == F.col(taken))
    return drawn.withColumn(nth, F.explode(F.sequence(F.lit(1), F.col(times)))).drop(row, taken, times, nth)
