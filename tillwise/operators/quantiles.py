"""Exact quantiles per group that no single task has to hold.

``percentile`` keeps every distinct value of a group in one buffer and
``percentile_approx`` is not exact.  Here values are folded to (group, value, count) and cut
into buckets of values that agree in their first three digits: wide where values are large, so a
group has at most some thousands of buckets however long its tail is.  A running count over a group's buckets
finds the few buckets that hold the wanted ranks, and only their values are ordered: a window
covers one bucket, or the list of buckets, never a group.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import exact
from ..functions.joins import null_safe_join

DIGITS = 3


def fold(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """(keys, value, n): rows per distinct value.  NULL is a value of its own, which no quantile counts."""
    return df.groupBy(*keys, value).agg(exact.rows().alias("n"))


def _bucket(value: Column, scale: int) -> Column:
    """The value in its smallest units, cut to its first digits: rises with the value, and zero has its own."""
    units = (value * F.lit(Decimal(10) ** scale)).cast("decimal(38,0)")
    cut = F.greatest(F.length(F.abs(units).cast("string")) - DIGITS, F.lit(0))
    step = F.element_at(F.array(*[F.lit(Decimal(10) ** k) for k in range(38 - DIGITS + 1)]), cut + 1).cast("decimal(38,0)")
    return F.sign(units).cast("int") * F.call_function("div", F.abs(units), step) * step


def from_fold(counts: DataFrame, keys: Sequence[str], value: str, probs: Mapping[str, str], carry: Sequence[str] = ()) -> DataFrame:
    """Per group, for each probability p, the smallest value with at least p of the rows at or below it.

    ``probs`` maps an output column to a probability written as a decimal, e.g. {"median": "0.5"}.
    ``value`` is a decimal column.  Beside the quantiles stand ``rows`` (all rows of the group), ``valued`` (those
    with a value) and ``total`` (the sum of values), from the same fold; a group without values has NULL quantiles.
    ``carry`` names further sums of the fold, which come out added up per group.
    """
    kind = counts.schema[value].dataType
    counts = counts.select(*keys, value, "n", *carry).withColumn("bucket", _bucket(F.col(value), kind.scale))
    group = Window.partitionBy(*keys)
    earlier = group.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    has = F.col("bucket").isNotNull()
    placed = (
        counts.groupBy(*keys, "bucket")
        .agg(F.sum("n").alias("bucket_n"), F.sum((F.col(value) * F.col("n")).cast(f"decimal(38,{kind.scale})")).alias("bucket_total"), *[F.sum(c).alias(f"bucket_{c}") for c in carry])
        .withColumn("rows_before", F.coalesce(F.sum(F.when(has, F.col("bucket_n"))).over(earlier), F.lit(0)))
        .withColumn("rows", F.sum("bucket_n").over(group))
        .withColumn("valued", F.coalesce(F.sum(F.when(has, F.col("bucket_n"))).over(group), F.lit(0)))
        .withColumn("total", F.sum("bucket_total").over(group))
        .withColumns({c: F.sum(f"bucket_{c}").over(group) for c in carry})
    )

    def needed(p: str) -> Column:
        return F.ceil(F.lit(Decimal(p)) * F.col("valued").cast("decimal(20,0)"))

    hit = F.col("valued") == 0
    for p in probs.values():
        hit = hit | (has & needed(p).between(F.col("rows_before") + 1, F.col("rows_before") + F.col("bucket_n")))
    wanted = placed.where(hit).select(*keys, "bucket", "rows_before", "rows", "valued", "total", *carry)
    so_far = (
        Window.partitionBy(*keys, "bucket").orderBy(value).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    ranked = null_safe_join(counts.drop(*carry), wanted, [*keys, "bucket"]).withColumn(
        "at_or_below", F.col("rows_before") + F.sum("n").over(so_far)
    )

    def pick(p: str) -> Column:
        return F.min(F.when(F.col("at_or_below") >= needed(p), F.col(value)))

    once = [F.max(c).alias(c) for c in ("rows", "valued", "total", *carry)]
    return ranked.groupBy(*keys).agg(*[pick(p).alias(name) for name, p in probs.items()], *once)


def quantiles(df: DataFrame, keys: Sequence[str], value: str, probs: Mapping[str, str]) -> DataFrame:
    """``from_fold`` over raw rows; groups without any value are left out."""
    counts = fold(df.where(F.col(value).isNotNull()), keys, value)
    return from_fold(counts, keys, value, probs).drop("rows", "valued", "total")


def with_fences(quartiles: DataFrame, reach: str = "1.5") -> DataFrame:
    """Adds the fences ``reach`` interquartile ranges outside q1 and q3."""
    spread = (F.col("q3") - F.col("q1")) * F.lit(Decimal(reach))
    return quartiles.withColumn("low_fence", F.col("q1") - spread).withColumn("high_fence", F.col("q3") + spread)


def iqr_fences(df: DataFrame, keys: Sequence[str], value: str, reach: str = "1.5") -> DataFrame:
    """Quartiles and fences per group."""
    return with_fences(quantiles(df, keys, value, {"q1": "0.25", "q3": "0.75"}), reach)


def outlier_summary(df: DataFrame, keys: Sequence[str], value: str, reach: str = "1.5") -> DataFrame:
    """Per group: rows with a value, outliers, fences, and sums of all, clipped and kept values.

    All of it comes from one fold of the rows to distinct values: no raw row is shuffled.
    """
    counts = fold(df, keys, value)
    fences = with_fences(from_fold(counts, keys, value, {"q1": "0.25", "q3": "0.75"}), reach)
    v = F.col(value)
    n = F.when(v.isNotNull(), F.col("n"))  # a filter here would make a second fold, over a scan of its own
    joined = null_safe_join(counts, fences.select(*keys, "low_fence", "high_fence"), keys)
    outside = (v < F.col("low_fence")) | (v > F.col("high_fence"))
    clipped = F.greatest(F.least(v, F.col("high_fence")), F.col("low_fence"))
    weighed = lambda c: F.sum((c * n).cast("decimal(38,4)"))
    summary = joined.groupBy(*keys).agg(
        F.sum(n).alias("n"),
        F.coalesce(F.sum(F.when(outside, n)), F.lit(0)).alias("outliers"),
        F.max("low_fence").alias("low_fence"),
        F.max("high_fence").alias("high_fence"),
        weighed(v).alias("total"),
        weighed(clipped).alias("clipped_total"),
        weighed(F.when(~outside, v)).alias("kept_total"),
        F.coalesce(F.sum(F.when(~outside, n)), F.lit(0)).alias("kept"),
    )
    return summary.where(F.col("n").isNotNull())


def mark_outliers(df: DataFrame, fences: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Add ``is_outlier`` and the value clipped to its group's fences.

    The fences have one row per group; Spark broadcasts them when they measure small and
    otherwise joins on the group, splitting a skewed one.
    """
    joined = null_safe_join(df, fences.select(*keys, "low_fence", "high_fence"), keys, "left")
    v = F.col(value)
    outside = (v < F.col("low_fence")) | (v > F.col("high_fence"))
    clipped = F.greatest(F.least(v, F.col("high_fence")), F.col("low_fence"))
    return joined.withColumn("is_outlier", outside.cast("int")).withColumn("clipped", clipped)
