"""Recursion over tables: rounds from a frontier until nothing new is found.

``WITH RECURSIVE`` keeps its rounds inside one query and stops at a configured depth.  Here each round is written to the shared
folder, so lineage stays short, a lost executor costs one round, and the depth is that of the data.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources import layout


def _written(df: DataFrame, label: str) -> DataFrame:
    path = layout.scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def closure(seed: DataFrame, step: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """All rows that ``seed`` leads to: distinct rows of the seed, and of ``step`` over the rows each round has found new.

    The same rows as ``WITH RECURSIVE t AS (seed UNION SELECT ... FROM t)``, NULLs included.  ``step`` must return the seed's columns;
    it sees only new rows, so no row is expanded twice.  It has to be able to run dry: a step that counts up never ends.
    """
    columns = seed.columns
    frontier = _written(seed.distinct(), "frontier")
    found = frontier
    while frontier.limit(1).count():
        new = step(frontier).select(*columns).distinct().alias("n")
        old = found.alias("o")
        same = None
        for c in columns:
            one = F.col(f"n.{c}").eqNullSafe(F.col(f"o.{c}"))
            same = one if same is None else same & one
        frontier = _written(new.join(old, same, "left_anti"), "frontier")
        found = found.union(frontier)
    return found


def follow(links: DataFrame, node: str, onward: str) -> DataFrame:
    """(node, end): where each node's chain of links ends.  A node without a link, or linked to itself, is an end.

    Each round replaces a link by the link of its target, which doubles the stretch: the rounds follow the logarithm of the longest
    chain.  Nodes are distinct; a circle of links would never end and is an error.
    """
    now = _written(links.select(F.col(node).alias("node"), F.coalesce(onward, node).alias("end")), "links")
    rounds, most = 0, now.count().bit_length() + 1
    while True:
        ahead = now.select(F.col("node").alias("end"), F.col("end").alias("further"))
        then = _written(now.join(ahead, "end", "left").select("node", F.coalesce("further", "end").alias("end"), (F.col("further") != F.col("end")).alias("moved")), "links")
        if not then.where("moved").limit(1).count():
            return then.select("node", "end")
        now, rounds = then.select("node", "end"), rounds + 1
        if rounds > most:
            raise ValueError("the links run in a circle")
