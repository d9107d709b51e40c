"""Decompositions that separate mix from performance.

Inputs are small aggregates (one row per period, segment or stratum), so each operator
is one further aggregation.  Rates stay unrounded until the last step.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import exact


def _converted(table: DataFrame) -> str:
    """The column that counts converting sessions; a table of one order per session may only have ``orders``."""
    return "converted" if "converted" in table.columns else "orders"


def growth_decomposition(periods: DataFrame, period: str = "year_") -> DataFrame:
    """Growth of revenue per session from the first period to the last, as the product of growth in
    conversion, in orders per converting session and in order value.

    The middle factor is left out where the table does not tell orders from converting sessions.
    """
    converted = _converted(periods)

    def ends(c: str) -> list[Column]:
        return [F.min_by(c, period).alias(f"{c}0"), F.max_by(c, period).alias(f"{c}1")]

    t = periods.agg(
        F.min(period).alias("first_period"),
        F.max(period).alias("last_period"),
        *ends("sessions"),
        *ends("orders"),
        *([] if converted == "orders" else ends("converted")),
        *ends("revenue"),
    )
    s0, s1 = (F.col(c).cast("decimal(14,0)") for c in ("sessions0", "sessions1"))
    o0, o1 = (F.col(c).cast("decimal(14,0)") for c in ("orders0", "orders1"))
    c0, c1 = (F.col(f"{converted}{i}").cast("decimal(14,0)") for i in (0, 1))
    per_converted = [] if converted == "orders" else [exact.ratio(o1 * c0, o0 * c1, 2).alias("orders_per_converted_growth")]
    r0, r1 = (exact.cents(F.col(c)).cast("decimal(19,0)") for c in ("revenue0", "revenue1"))
    return t.select(
        "first_period",
        "last_period",
        exact.ratio(r1 * s0, r0 * s1, 2).alias("revenue_per_session_growth"),
        exact.ratio(c1 * s0, c0 * s1, 2).alias("conversion_growth"),
        *per_converted,
        exact.ratio(r1 * o0, r0 * o1, 2).alias("order_value_growth"),
    )


def relative_improvement(table: DataFrame, segment: str, period: str) -> DataFrame:
    """Conversion in the last period over conversion in the first, per segment."""
    converted = _converted(table)
    t = table.groupBy(segment).agg(
        F.min_by("sessions", period).cast("decimal(16,0)").alias("s0"),
        F.max_by("sessions", period).cast("decimal(16,0)").alias("s1"),
        F.min_by(converted, period).cast("decimal(16,0)").alias("c0"),
        F.max_by(converted, period).cast("decimal(16,0)").alias("c1"),
    )
    s0, s1, c0, c1 = (F.col(c) for c in ("s0", "s1", "c0", "c1"))
    return t.select(
        segment,
        exact.percent(c0, s0, 2).alias("first_conv_pct"),
        exact.percent(c1, s1, 2).alias("last_conv_pct"),
        exact.ratio(c1 * s0, c0 * s1, 2).alias("improvement"),
    )


def opportunity_cost(segments: DataFrame, segment: str, reference: str) -> DataFrame:
    """Orders each segment would add at the reference segment's conversion, at its own order value."""
    everything = Window.partitionBy()
    is_ref = F.col(segment) == reference
    rs = F.max(F.when(is_ref, F.col("sessions").cast("decimal(16,0)"))).over(everything)
    ro = F.max(F.when(is_ref, F.col("orders").cast("decimal(16,0)"))).over(everything)
    t = segments.withColumn("rs", rs).withColumn("ro", ro)
    s, o = F.col("sessions").cast("decimal(16,0)"), F.col("orders").cast("decimal(16,0)")
    missing = s * F.col("ro") - o * F.col("rs")
    value = exact.half_up(missing, F.col("rs"), 4) * exact.rate(F.col("revenue"), F.col("orders"))
    return t.where(~is_ref).select(
        segment,
        "orders",
        exact.half_up(s * F.col("ro"), F.col("rs"), 0).cast("bigint").alias("expected_orders"),
        exact.half_up(missing, F.col("rs"), 0).cast("bigint").alias("missing_orders"),
        exact.rounded(value, 0).alias("missing_value"),
    )


def mix_shift(table: DataFrame, segment: str, period: str, base: Column, other: Column) -> DataFrame:
    """Change of revenue per session between two periods, split into mix and rate.

    mix  = sum over segments of (share_other - share_base) * rate_base
    rate = sum over segments of share_other * (rate_other - rate_base)
    """

    def at(which: Column, c: str, kind: str) -> Column:
        return F.coalesce(F.sum(F.when(F.col(period) == which, F.col(c))), F.lit(0)).cast(kind)

    t = table.groupBy(segment).agg(
        at(base, "sessions", "decimal(20,0)").alias("s0"),
        at(other, "sessions", "decimal(20,0)").alias("s1"),
        at(base, "revenue", "decimal(28,2)").alias("r0"),
        at(other, "revenue", "decimal(28,2)").alias("r1"),
    )
    everything = Window.partitionBy()
    shares = t.select(
        exact.rate(F.col("s0"), F.sum("s0").over(everything)).alias("h0"),
        exact.rate(F.col("s1"), F.sum("s1").over(everything)).alias("h1"),
        F.coalesce(exact.rate(F.col("r0"), F.col("s0")), F.lit(0)).cast("decimal(24,12)").alias("v0"),
        F.coalesce(exact.rate(F.col("r1"), F.col("s1")), F.lit(0)).cast("decimal(24,12)").alias("v1"),
    )
    h0, h1, v0, v1 = (F.col(c) for c in ("h0", "h1", "v0", "v1"))
    return shares.agg(
        exact.rounded(F.sum((h1 * v1 - h0 * v0).cast("decimal(28,10)")), 2).alias("total_change"),
        exact.rounded(F.sum(((h1 - h0) * v0).cast("decimal(28,10)")), 2).alias("mix_effect"),
        exact.rounded(F.sum((h1 * (v1 - v0)).cast("decimal(28,10)")), 2).alias("rate_effect"),
    )


def composition_vs_performance(
    table: DataFrame, segment: str, stratum: str, high: str, low: str, within: int | str
) -> DataFrame:
    """How much of one segment's conversion lead over another survives inside a single stratum.

    headline gap = composition + gap within the stratum, all in percentage points.
    """

    converted = _converted(table)

    def conv(name: str, keep: Column) -> Column:
        hit = (F.col(segment) == name) & keep
        n = F.sum(F.when(hit, F.col(converted))) * 100
        return exact.rate(n, F.sum(F.when(hit, F.col("sessions"))))

    inside = F.col(stratum) == within
    t = table.agg(
        (conv(high, F.lit(True)) - conv(low, F.lit(True))).alias("headline"),
        (conv(high, inside) - conv(low, inside)).alias("inside"),
    )
    composition = F.col("headline") - F.col("inside")
    explained = F.try_divide(composition.cast("decimal(18,8)") * 100, F.col("headline").cast("decimal(18,8)"))
    return t.select(
        exact.rounded(F.col("headline"), 2).alias("headline_gap"),
        exact.rounded(F.col("inside"), 2).alias("gap_within"),
        exact.rounded(composition, 2).alias("composition"),
        exact.rounded(explained, 0).alias("composition_pct"),
    )


def short_lived(ranges: DataFrame, max_days: int) -> DataFrame:
    """Segments that ran for at most ``max_days``: experiments rather than ongoing spend."""
    return ranges.where(F.col("days_active") <= max_days)
