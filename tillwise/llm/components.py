"""Connected components of an edge table, by alternating star operations.

Each round points every node at the smallest node next to it, first from larger to
smaller neighbours and then among those, until nothing changes.  The number of rounds follows the
logarithm of the longest chain.  Rounds end in a written table, so lineage stays short.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scratch import discard, materialize


def _large_star(edges: DataFrame) -> DataFrame:
    """Neighbours above a node are linked to the smallest of the node and its neighbours."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are linked to the smallest of those."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, root): every node with an edge and the smallest node it is linked to.

    ``edges`` has long columns u and v; loops, repeats and both directions are harmless, nulls
    are dropped.  Nodes without an edge do not appear.
    """
    now = materialize(edges.where("u <> v").select("u", "v").distinct(), "edges")
    for _ in range(max_rounds):
        then = materialize(_small_star(_large_star(now)), "edges")
        a = now.agg(F.count(F.lit(1)), F.coalesce(F.bit_xor(F.xxhash64("u", "v")), F.lit(0))).first()
        b = then.agg(F.count(F.lit(1)), F.coalesce(F.bit_xor(F.xxhash64("u", "v")), F.lit(0))).first()
        discard(now)
        now = then
        if a == b:
            break
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).union(now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
