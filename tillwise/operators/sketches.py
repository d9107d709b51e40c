"""Mergeable summaries: made once per day or month, kept as a table, and added up to longer periods without reading rows again.

Exact forms stay the default elsewhere; these are for totals over periods that are asked for often.  Each function
states its bound.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# --- distinct counts ---------------------------------------------------------

#: 2**12 registers: one sketch takes some kilobytes at most.
REGISTERS_LOG2 = 12


def distinct_bound(registers_log2: int = REGISTERS_LOG2, deviations: float = 4) -> float:
    """Relative error of a distinct count that is passed by fewer than one count in ten thousand, with four deviations."""
    return deviations * 1.04 / math.sqrt(2**registers_log2)


def distinct_sketches(rows: DataFrame, by: Sequence[Column | str], key: str, registers_log2: int = REGISTERS_LOG2) -> DataFrame:
    """(by, sketch): a distinct-count sketch of ``key`` per group.  It folds per task first, so a hot group reaches its task as one sketch each."""
    return rows.groupBy(*by).agg(F.hll_sketch_agg(key, registers_log2).alias("sketch"))


def distinct_rollup(sketches: DataFrame, by: Sequence[Column | str]) -> DataFrame:
    """(by, estimate): distinct keys of longer periods from the sketches of shorter ones."""
    return sketches.groupBy(*by).agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("estimate"))


# --- quantiles ---------------------------------------------------------------

#: Size of a quantile sketch: some kilobytes, whatever it has seen.
QUANTILE_SIZE = 400


def rank_bound(size: int = QUANTILE_SIZE) -> float:
    """Rank error of a quantile, as a share of the rows: twice the 99 % figure 2.296 / size**0.9021 of this kind of sketch."""
    return 2 * 2.296 / size**0.9021


def quantile_sketches(rows: DataFrame, by: Sequence[Column | str], whole: Column, size: int = QUANTILE_SIZE) -> DataFrame:
    """(by, sketch): a sketch per group of a whole-number value, e.g. cents; NULLs are not counted."""
    return rows.groupBy(*by).agg(F.call_function("kll_sketch_agg_bigint", whole.cast("bigint"), F.lit(size)).alias("sketch"))


def quantile_rollup(sketches: DataFrame, by: Sequence[Column | str], probs: Mapping[str, str]) -> DataFrame:
    """(by, n, one column per probability): quantiles of merged sketches."""
    merged = sketches.groupBy(*by).agg(F.call_function("kll_merge_agg_bigint", "sketch").alias("sketch"))
    keys = merged.columns[:-1]
    at = [F.call_function("kll_sketch_get_quantile_bigint", "sketch", F.lit(float(p))).alias(name) for name, p in probs.items()]
    return merged.select(*keys, F.call_function("kll_sketch_get_n_bigint", "sketch").alias("n"), *at)


def fences(quartiles: DataFrame, reach: str = "1.5") -> DataFrame:
    """Adds fences ``reach`` quartile ranges outside q1 and q3, in the values' units."""
    spread = (F.col("q3") - F.col("q1")).cast("decimal(20,0)") * F.lit(Decimal(reach))
    return quartiles.withColumn("low_fence", F.col("q1") - spread).withColumn("high_fence", F.col("q3") + spread)


# --- heavy hitters -----------------------------------------------------------

#: Items a sketch keeps track of: it needs room for these in a task, not for all that occur.
TRACKED = 20_000


def _counted(rows: DataFrame, items: Sequence[str]) -> DataFrame:
    return rows.groupBy(*items).agg(F.count(F.lit(1)).alias("n"))


def proposals(rows: DataFrame, items: Sequence[str], tracked: int = TRACKED) -> DataFrame:
    """(items, estimate): combinations that a frequent-items sketch has kept, with an upper bound of their counts."""
    kinds = {f.name: f.dataType for f in rows.select(*items).schema}
    told = rows.select(F.to_json(F.struct(*items), {"ignoreNullFields": "false"}).alias("item"))
    found = told.agg(F.call_function("approx_top_k", "item", F.lit(tracked // 2), F.lit(tracked)).alias("top"))
    shape = ", ".join(f"`{c}` {t.simpleString()}" for c, t in kinds.items())
    each = found.select(F.inline("top"))
    return each.select(F.from_json("item", shape).alias("i"), F.col("count").alias("estimate")).select("i.*", "estimate")


def heavy_hitters(rows: DataFrame, items: Sequence[str], k: int, tracked: int = TRACKED) -> tuple[DataFrame, str]:
    """The ``k`` most frequent combinations of ``items`` as (items, n), exact, and the way that gave them.

    A sketch proposes combinations and only those are counted, so a combination that is not proposed is never shuffled.
    Whatever is not proposed occurs ``bound`` times at most: the least estimate, or the sketch's error of 3.5 rows in ``tracked``.  The result
    stands (``proposed``) if the k-th count is above the bound, or if the proposals account for every row.  Otherwise all
    combinations are counted (``counted``).  Ties go to the smallest items.
    """
    order = [F.desc("n"), *[F.asc_nulls_first(c) for c in items]]
    wanted = proposals(rows, items, tracked)
    same = None
    for c in items:
        one = F.col(f"r.{c}").eqNullSafe(F.col(f"p.{c}"))
        same = one if same is None else same & one
    counts = rows.select(*items).alias("r").join(wanted.select(*items).alias("p"), same, "left_semi")
    counts = _counted(counts, items)
    kth = F.try_element_at(F.sort_array(F.collect_list("n"), asc=False), F.lit(k))  # at most ``tracked`` / 2 numbers
    known = counts.agg(kth.alias("least"), F.sum("n").alias("covered")).first()
    told = wanted.agg(F.min("estimate").alias("estimate"), F.count(F.lit(1)).alias("proposed")).first()
    total = rows.count()
    bound = max(math.ceil(3.5 * total / tracked), told["estimate"] if told["proposed"] >= tracked // 2 else 0)
    if (known["covered"] or 0) == total or (known["least"] or 0) > bound:
        return counts.orderBy(*order).limit(k), "proposed"
    return _counted(rows, items).orderBy(*order).limit(k), "counted"
