"""Ever-reached funnels and what a lost step is worth.

Two aggregations: one row of 0/1 flags per session, then a sum of flags.  A page seen
twice counts once; the order of pages does not matter.  Only sessions with at least one
pageview are counted.  The per-session fold combines map-side, so one session with a
huge number of pageviews does not weigh on one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import exact
from ..functions.rules import CHECKOUT_STEPS, Step


def funnel(
    pageviews: DataFrame,
    key: str = "website_session_id",
    url: str = "pageview_url",
    steps: Sequence[Step] = CHECKOUT_STEPS,
    fold_case: bool = False,
) -> DataFrame:
    """One row: sessions, and sessions that ever reached each step.

    ``fold_case`` compares URLs case-insensitively, as a case-insensitive collation would.
    """
    page = F.lower(url) if fold_case else F.col(url)
    flags = pageviews.groupBy(key).agg(
        *[F.max(s.matches(page).cast("int")).alias(s.name) for s in steps]
    )
    return flags.agg(exact.rows().alias("sessions"), *[F.sum(s.name).alias(s.name) for s in steps])


def _stacked(wide: DataFrame, rows: Sequence[list[tuple[str, Column]]]) -> DataFrame:
    structs = [F.struct(*[c.alias(n) for n, c in cells]) for cells in rows]
    return wide.select(F.inline(F.array(*structs)))


def funnel_steps(wide: DataFrame, steps: Sequence[Step] = CHECKOUT_STEPS) -> DataFrame:
    """The wide row as one row per step, with step conversion and sessions lost.

    The previous step is known when the plan is built, so no window is needed.
    """
    names = ["sessions", *[s.name for s in steps]]
    cells = []
    for i, name in enumerate(names):
        previous = F.col(names[i - 1]) if i else F.lit(None).cast("bigint")
        cells.append(
            [
                ("step_no", F.lit(i)),
                ("step", F.lit(name)),
                ("reached", F.col(name)),
                ("step_conversion_pct", exact.percent(F.col(name), previous, 1)),
                ("lost", previous - F.col(name)),
            ]
        )
    return _stacked(wide, cells)


def abandoned_value(steps: DataFrame, orders: DataFrame, value: str = "price_usd") -> DataFrame:
    """Sessions lost at each step times the average order value (rounded to cents)."""
    aov = (
        orders.agg(exact.from_cents(exact.sum_cents(value)).alias("revenue"), exact.rows().alias("orders"))
        .select(exact.per_unit(F.col("revenue"), F.col("orders")))
        .scalar()
    )
    return (
        steps.where(F.col("lost").isNotNull())
        .select("step_no", "step", "lost", aov.alias("avg_order_value"))
        .withColumn("abandoned_value", (F.col("lost") * F.col("avg_order_value")).cast("decimal(24,2)"))
    )


def sensitivity(wide: DataFrame, steps: Sequence[Step] = CHECKOUT_STEPS) -> DataFrame:
    """Orders gained by one more percentage point of conversion at each step.

    A point at a step is one percent of the sessions that reached the step before it.
    Each converts onward at the step's own rate to the last step, stated to a tenth of
    a percent.
    """
    names = ["sessions", *[s.name for s in steps]]
    last = F.col(names[-1])
    cells = []
    for i in range(1, len(names)):
        onward = exact.percent(last, F.col(names[i]), 1)
        gained = exact.half_up(
            F.col(names[i - 1]).cast("decimal(19,0)") * (onward * 10).cast("decimal(6,0)"), F.lit(100000), 0
        )
        cells.append(
            [
                ("step_no", F.lit(i)),
                ("step", F.lit(names[i])),
                ("onward_conversion_pct", onward),
                ("extra_orders_per_point", gained.cast("bigint")),
            ]
        )
    return _stacked(wide, cells)
