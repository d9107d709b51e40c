"""Refund rates by product, role, order month and refund month.

Refunds are folded to one row per item before they meet the items, so an item refunded
twice still counts once as sold and its price once as revenue.  Where the fold shrinks them,
items are folded by product id before product names are joined, so a best-seller costs that
join one row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import calendar, exact

ITEM_KEY = ("order_item_id",)


def with_refunds(items: DataFrame, refunds: DataFrame, item_key: Sequence[str] = ITEM_KEY) -> DataFrame:
    per_item = refunds.groupBy(*item_key).agg(
        F.lit(1).alias("refunded"), F.sum("refund_amount_usd").alias("refund_amount_usd")
    )
    return items.join(per_item, list(item_key), "left")


def with_order_time(facts: DataFrame, orders: DataFrame) -> DataFrame:
    """Inner join to the order for its time.  An order's row is unique, so a skewed order
    on the item side is split by the adaptive skew join."""
    return facts.join(orders.select("order_id", F.col("created_at").alias("ordered_at")), "order_id")


def _counts() -> list[Column]:
    return [
        exact.rows().alias("n"),
        F.count("refunded").alias("r"),
        exact.sum_cents("price_usd").alias("v"),
        exact.sum_cents("refund_amount_usd").alias("rv"),
    ]


def _named(counts: DataFrame) -> DataFrame:
    keys = [c for c in counts.columns if c not in ("n", "r", "v", "rv")]
    return counts.select(
        *keys,
        F.col("n").alias("items_sold"),
        F.col("r").alias("items_refunded"),
        exact.from_cents(F.col("v")).alias("revenue"),
        exact.from_cents(F.col("rv")).alias("refunded_value"),
    )


def refund_counts(facts: DataFrame, products: DataFrame, *by: str) -> DataFrame:
    """Items sold, items refunded, gross revenue and refunded value per product name (and ``by``).

    An item whose product is unknown stays, under a NULL name.
    """
    names = products.select("product_id", "product_name")
    by_id = facts.groupBy("product_id", *by).agg(*_counts())
    sums = [F.sum(c).alias(c) for c in ("n", "r", "v", "rv")]
    return _named(by_id.join(names, "product_id", "left").groupBy("product_name", *by).agg(*sums))


def monthly_refund_counts(facts: DataFrame, orders: DataFrame, products: DataFrame) -> DataFrame:
    """``refund_counts`` by order month.

    Product ids times months can be as many as the items, so a fold by id would not shrink
    them: here names are joined first, and the fold by name and month does all the work.
    """
    month = calendar.month_start(F.col("ordered_at")).alias("month")
    named = with_order_time(facts, orders).join(
        products.select("product_id", "product_name"), "product_id", "left"
    )
    t = _named(named.groupBy("product_name", month).agg(*_counts()))
    return t.withColumn("order_month", calendar.month_label(F.col("month"))).drop("month")


def _rate(scale: int = 2) -> Column:
    return exact.percent(F.col("items_refunded"), F.col("items_sold"), scale).alias("refund_rate_pct")


def refund_rate_by_product(facts: DataFrame, products: DataFrame) -> DataFrame:
    t = refund_counts(facts, products)
    return t.select(
        "product_name", "items_sold", "items_refunded", _rate(), "revenue", "refunded_value"
    ).orderBy(F.desc("refund_rate_pct"), "product_name")


def monthly_refund_rate(
    facts: DataFrame, orders: DataFrame, products: DataFrame, min_items: int = 100
) -> DataFrame:
    """By *order* month, leaving out product-months with too little volume for a rate."""
    t = monthly_refund_counts(facts, orders, products)
    return (
        t.where(F.col("items_sold") >= min_items)
        .select("product_name", "order_month", "items_sold", "items_refunded", _rate())
        .orderBy("product_name", "order_month")
    )


def refund_by_item_role(facts: DataFrame, products: DataFrame) -> DataFrame:
    t = refund_counts(facts, products, "is_primary_item")
    return t.select(
        "product_name", "is_primary_item", "items_sold", "items_refunded", _rate()
    ).orderBy("product_name", "is_primary_item")


def refund_by_item_role_since(
    facts: DataFrame, orders: DataFrame, products: DataFrame, since: Column
) -> DataFrame:
    timed = with_order_time(facts, orders.where(F.col("created_at") >= since))
    return refund_by_item_role(timed, products)


def refunds_by_refund_date(
    refunds: DataFrame,
    items: DataFrame,
    orders: DataFrame,
    products: DataFrame,
    product_name: str,
    item_key: Sequence[str] = ITEM_KEY,
) -> DataFrame:
    """One product's refunds by the month they were issued, with the average lag in days.

    ``dated_before_order`` counts refunds dated before their order: they stay in the average and make it suspect.
    """
    wanted = products.where(F.col("product_name") == product_name).select("product_id")
    sold = items.join(wanted, "product_id").select(*dict.fromkeys([*item_key, "order_id"]))
    issued = refunds.select(*item_key, F.col("created_at").alias("refunded_at"))
    lagged = with_order_time(issued.join(sold, list(item_key)), orders)
    t = lagged.groupBy(calendar.month_start(F.col("refunded_at")).alias("month")).agg(
        exact.rows().alias("refunds_issued"),
        F.sum(F.datediff("refunded_at", "ordered_at")).alias("days"),
        F.count_if(F.datediff("refunded_at", "ordered_at") < 0).alias("dated_before_order"),
    )
    return t.select(
        calendar.month_label(F.col("month")).alias("refund_month"),
        "refunds_issued",
        exact.ratio(F.col("days"), F.col("refunds_issued"), 1).alias("avg_days_to_refund"),
        "dated_before_order",
    ).orderBy("refund_month")


# --- derived from the tables above -------------------------------------------


def refund_month_pairs(refunds: DataFrame, orders: DataFrame) -> DataFrame:
    """Refunds per (order month, refund month): at most the square of the months in the data."""
    issued = refunds.select("order_id", F.col("created_at").alias("refunded_at"))
    t = (
        with_order_time(issued, orders)
        .groupBy(
            calendar.month_start(F.col("ordered_at")).alias("ordered"),
            calendar.month_start(F.col("refunded_at")).alias("refunded"),
        )
        .agg(exact.rows().alias("n"))
    )
    return t.select(
        calendar.month_label(F.col("ordered")).alias("order_month"),
        calendar.month_label(F.col("refunded")).alias("refund_month"),
        "n",
    )


def event_vs_record_date(by_event: DataFrame, by_record: DataFrame) -> DataFrame:
    """The same refunds per month by order date and by refund date, side by side.

    Both sides are (month, n) tables; a month that appears on one side only shows 0 on the other.
    """
    left = by_event.select("month", F.col("n").alias("by_order_date"))
    right = by_record.select("month", F.col("n").alias("by_refund_date"))
    return left.join(right, "month", "full").select(
        "month",
        F.coalesce("by_order_date", F.lit(0)).alias("by_order_date"),
        F.coalesce("by_refund_date", F.lit(0)).alias("by_refund_date"),
    )


def _baseline_counts(monthly: DataFrame, flagged: Column, *more: Column) -> DataFrame:
    """Items sold and refunded outside (bs, br) and inside (fs, fr) the flagged periods, per product."""

    def total(c: str, keep: Column) -> Column:
        return F.coalesce(F.sum(F.when(keep, F.col(c))), F.lit(0)).cast("decimal(17,0)")

    return monthly.groupBy("product_name").agg(
        total("items_sold", ~flagged).alias("bs"),
        total("items_refunded", ~flagged).alias("br"),
        total("items_sold", flagged).alias("fs"),
        total("items_refunded", flagged).alias("fr"),
        *more,
    )


def excess_vs_baseline(monthly: DataFrame, flagged: Column, unit_value: Column | None = None) -> DataFrame:
    """Refunds beyond what the baseline rate predicts for the flagged periods, per product.

    ``monthly`` has product_name, items_sold, items_refunded (and ``unit_value``'s columns).
    The baseline is every period that is not flagged.
    """
    value = F.max(unit_value) if unit_value is not None else F.lit(None)
    t = _baseline_counts(monthly, flagged, value.cast("decimal(18,2)").alias("unit_value"))
    bs, br, fs, fr = (F.col(c) for c in ("bs", "br", "fs", "fr"))
    excess = (fr * bs - br * fs).cast("decimal(34,0)")
    out = t.select(
        "product_name",
        exact.percent(br, bs, 2).alias("baseline_rate_pct"),
        fr.cast("bigint").alias("observed"),
        exact.half_up((br * fs).cast("decimal(34,0)"), bs, 1).alias("expected"),
        exact.half_up(excess, bs, 1).alias("excess"),
        (exact.half_up(excess, bs, 4) * F.col("unit_value")).alias("value"),
    )
    if unit_value is None:
        return out.drop("value")
    return out.withColumn("value", exact.rounded(F.col("value"), 0)).withColumnRenamed("value", "excess_value")


def peer_check(monthly: DataFrame, flagged: Column, moved_at: float = 2.0) -> DataFrame:
    """Did other products move in the flagged periods too?  Rate there over each product's own baseline."""
    t = _baseline_counts(monthly, flagged)
    bs, br, fs, fr = (F.col(c) for c in ("bs", "br", "fs", "fr"))
    times = exact.ratio((fr * bs).cast("decimal(34,0)"), br * fs, 2)
    return t.select(
        "product_name",
        exact.percent(br, bs, 2).alias("baseline_rate_pct"),
        exact.percent(fr, fs, 2).alias("flagged_rate_pct"),
        times.alias("times_baseline"),
        (times >= F.lit(moved_at)).cast("int").alias("moved"),
    )


def gap_by_role(by_role: DataFrame) -> DataFrame:
    """Primary rate, add-on rate and their difference in points, from the role table."""

    def of(c: str, role: int) -> Column:
        return F.sum(F.when(F.col("is_primary_item") == role, F.col(c))).cast("decimal(16,0)")

    t = by_role.groupBy("product_name").agg(
        of("items_sold", 1).alias("ps"),
        of("items_refunded", 1).alias("pr"),
        of("items_sold", 0).alias("xs"),
        of("items_refunded", 0).alias("xr"),
    )
    ps, pr, xs, xr = (F.col(c) for c in ("ps", "pr", "xs", "xr"))
    return t.select(
        "product_name",
        exact.percent(xr, xs, 2).alias("addon_rate_pct"),
        exact.percent(pr, ps, 2).alias("primary_rate_pct"),
        exact.percent((pr * xs - xr * ps).cast("decimal(33,0)"), ps * xs, 2).alias("gap_points"),
    )


def net_revenue(items: DataFrame, refunds: DataFrame) -> DataFrame:
    """Gross, refunded and net money.  Everywhere else revenue is gross."""
    refunded = refunds.agg(exact.from_cents(exact.sum_cents("refund_amount_usd"))).scalar()
    gross = items.agg(exact.from_cents(exact.sum_cents("price_usd")).alias("gross_revenue"))
    return gross.select("gross_revenue", F.coalesce(refunded, F.lit(0)).alias("refunded_value")).withColumn(
        "net_revenue", F.col("gross_revenue") - F.col("refunded_value")
    ).withColumn(
        "refunded_pct", exact.money_percent(F.col("refunded_value"), F.col("gross_revenue"), 1)
    )


def refund_cost_share(facts: DataFrame, refunds: DataFrame, products: DataFrame) -> DataFrame:
    """Each product's share of the money refunded, the total being taken from the refund table."""
    all_refunds = refunds.agg(exact.from_cents(exact.sum_cents("refund_amount_usd"))).scalar()
    t = refund_counts(facts, products)
    return t.select(
        "product_name",
        "refunded_value",
        exact.money_percent(F.col("refunded_value"), all_refunds, 1).alias("pct_of_refunded"),
    ).orderBy(F.desc("pct_of_refunded"), "product_name")
