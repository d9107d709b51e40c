"""Text that is equal whatever its case or accents.

``collated`` gives columns a collation: comparisons, ``isin``, prefixes and joins then follow it.  Grouping by such a
column makes Spark sort every row before it folds them, so keys that are grouped by are better rewritten once, at load:
``one_spelling`` gives all equal spellings the same text and leaves a plain column, which hashes.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .joins import null_safe_join

#: Neither case nor accents count.  ``UTF8_LCASE``, which also serves LIKE, ignores case only.
ANY_CASE_AND_ACCENT = "UNICODE_CI_AI"
ANY_CASE = "UTF8_LCASE"
PLAIN = "UTF8_BINARY"


def collated(df: DataFrame, columns: Sequence[str], collation: str = ANY_CASE_AND_ACCENT) -> DataFrame:
    """``df`` with the named columns under a collation."""
    return df.withColumns({c: F.collate(c, collation) for c in columns})


def spellings(df: DataFrame, column: str, collation: str = ANY_CASE_AND_ACCENT, known: Sequence[str] = ()) -> DataFrame:
    """(spelling, chosen): one row per spelling that occurs, and the one that stands for its class.

    That is a ``known`` spelling if one is equal, else the most frequent, ties going to the smallest.  Rows are folded to
    spellings by hash first, so only distinct spellings are compared under the collation.
    """
    counts = df.where(F.col(column).isNotNull()).groupBy(F.collate(column, PLAIN).alias("spelling")).agg(F.count(F.lit(1)).alias("n"))
    # the class is compared once per spelling; its key is the sort of the window, so a class is not collected
    same = Window.partitionBy(F.collate("spelling", collation)).orderBy(F.desc("n"), "spelling").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    chosen: Column = F.first("spelling").over(same)
    for k in reversed(known):
        chosen = F.when(F.collate("spelling", collation) == F.lit(k), F.lit(k)).otherwise(chosen)
    return counts.select("spelling", chosen.alias("chosen"))


def one_spelling(df: DataFrame, columns: Sequence[str], collation: str = ANY_CASE_AND_ACCENT, known: Mapping[str, Sequence[str]] | None = None) -> DataFrame:
    """``df`` with one spelling for all that are equal under the collation, in each of the columns; NULL stays NULL.

    Costs a fold of the table to its spellings and a join with them per column.  The result is plain text: later grouping and joining by
    these columns hashes as usual and agrees on the keys.
    """
    out = df
    for c in columns:
        told = spellings(df, c, collation, (known or {}).get(c, ())).select(F.col("spelling").alias(c), F.col("chosen").alias("__chosen"))
        out = null_safe_join(out.withColumn(c, F.collate(c, PLAIN)), told, [c], "left")
        out = out.withColumn(c, F.col("__chosen")).select(*df.columns)
    return out
