"""Time-series operators over an *aggregated* series: one row per period (and key).

Windows here see periods, not raw rows, so each partition is as long as the calendar.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import exact


def _ordered(keys: Sequence[str], order: Sequence[str]):
    return Window.partitionBy(*keys).orderBy(*order)


def period_over_period(series: DataFrame, keys: Sequence[str], order: Sequence[str], metric: str) -> DataFrame:
    """Previous and next period's value, the change, and the change in percent."""
    w = _ordered(keys, order)
    change = F.col(metric) - F.col("previous")
    return (
        series.withColumn("previous", F.lag(metric).over(w))
        .withColumn("next", F.lead(metric).over(w))
        .withColumn("change", change)
        .withColumn("change_pct", exact.percent(F.col("change"), F.col("previous"), 1))
    )


def same_month_last_year(series: DataFrame, keys: Sequence[str], metric: str) -> DataFrame:
    """The value twelve months earlier and the ratio to it.

    The frame is the range "one year before", not the row before, so a missing year gives
    NULL; and the series is computed once, where a self-join would compute it twice.
    """
    year_before = Window.partitionBy(*keys, "month_").orderBy("year_").rangeBetween(-1, -1)
    return series.withColumn("last_year", F.max(metric).over(year_before)).withColumn(
        "yoy_ratio", exact.ratio(F.col(metric), F.col("last_year"), 2)
    )


def running_total(series: DataFrame, keys: Sequence[str], order: Sequence[str], metric: str) -> DataFrame:
    w = _ordered(keys, order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return series.withColumn("running_total", F.sum(metric).over(w))


def moving_average(
    series: DataFrame, keys: Sequence[str], order: Sequence[str], metric: str, periods: int
) -> DataFrame:
    """Mean of the current and the previous ``periods`` - 1 values (fewer at the start)."""
    w = _ordered(keys, order).rowsBetween(-(periods - 1), Window.currentRow)
    mean = exact.ratio(F.sum(metric).over(w), F.count(metric).over(w), 2)
    return series.withColumn("moving_average", mean)


def zero_filled(series: DataFrame, periods: DataFrame, period: str, metrics: Sequence[str]) -> DataFrame:
    """Every period of ``periods``, with 0 where the series has no row."""
    filled = [F.coalesce(F.col(m), F.lit(0)).alias(m) for m in metrics]
    return periods.join(series, period, "left").select(period, *filled)


def seasonality_index(series: DataFrame, keys: Sequence[str], month: str, metric: str) -> DataFrame:
    """Average value of a calendar month over the average month, times 100.

    ``series`` has one row per key and month of each year.
    """
    by_month = series.groupBy(*keys, month).agg(
        F.sum(metric).alias("month_total"), exact.rows().alias("months")
    )
    everything = Window.partitionBy(*keys)
    total = F.sum("month_total").over(everything).cast("decimal(16,0)")
    months = F.sum("months").over(everything).cast("decimal(8,0)")
    num = F.col("month_total").cast("decimal(16,0)") * months
    den = F.col("months").cast("decimal(8,0)") * total
    return by_month.select(
        *keys,
        month,
        exact.ratio(F.col("month_total"), F.col("months"), 1).alias("average"),
        exact.percent(num, den, 1).alias("seasonal_index"),
    )


def regime_break(series: DataFrame, period: str, metric: str, breaks_on: Column) -> DataFrame:
    """The series' average before and from a known disruption, so a trend does not span it unsaid."""
    after = F.col(period) >= breaks_on

    def total(keep: Column) -> Column:
        return F.sum(F.when(keep, F.col(metric))).cast("decimal(17,0)")

    t = series.agg(
        total(~after).alias("t0"),
        F.count_if(~after).alias("periods_before"),
        total(after).alias("t1"),
        F.count_if(after).alias("periods_after"),
    )
    n0, n1 = (F.col(c).cast("decimal(8,0)") for c in ("periods_before", "periods_after"))
    t0, t1 = F.col("t0"), F.col("t1")
    return t.select(
        "periods_before",
        exact.ratio(t0, n0, 1).alias("average_before"),
        "periods_after",
        exact.ratio(t1, n1, 1).alias("average_after"),
        exact.percent((t1 * n0 - t0 * n1).cast("decimal(28,0)"), t0 * n1, 1).alias("change_pct"),
    )


def top_in_group(
    table: DataFrame, group: Sequence[str], by: Sequence[Column], tiebreak: Sequence[str], k: int
) -> DataFrame:
    """Row number and rank within a group, for the first ``k`` rows.

    The bound on ``row_number`` lets Spark cut every group to ``k`` rows before the shuffle.
    """
    numbered = Window.partitionBy(*group).orderBy(*by, *tiebreak)
    ranked = Window.partitionBy(*group).orderBy(*by)
    top = table.withColumn("row_number", F.row_number().over(numbered)).where(F.col("row_number") <= k)
    return top.withColumn("rank", F.rank().over(ranked))
