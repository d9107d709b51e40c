"""Session-to-order metrics: conversion, channels, devices, campaigns, repeat visits.

Sessions without an order stay in every denominator.  Orders are first folded to one
row per session, so the left join is one-to-one: nothing fans out when a session
has several orders, and the shuffle carries one row per converting session.

``orders`` is the number of orders; ``converted`` the sessions with at least one.  A conversion
rate is converted sessions over sessions, so it never exceeds 100; order value and revenue count orders.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import exact, rules

KEY = "website_session_id"


def join_orders(sessions: DataFrame, orders: DataFrame, key: str = KEY, value: str = "price_usd") -> DataFrame:
    per_session = orders.groupBy(key).agg(
        exact.rows().alias("session_orders"), exact.sum_cents(value).alias("session_cents")
    )
    return sessions.join(per_session, key, "left")


def totals(joined: DataFrame, *by: Column | str) -> DataFrame:
    """Sessions, orders, converted sessions and revenue per group (NULL is a group)."""
    return joined.groupBy(*by).agg(
        exact.rows().alias("sessions"),
        F.coalesce(F.sum("session_orders"), F.lit(0)).alias("orders"),
        F.count("session_orders").alias("converted"),
        exact.from_cents(F.sum("session_cents")).alias("revenue"),
    )


def _conversion(scale: int = 2) -> Column:
    return exact.percent(F.col("converted"), F.col("sessions"), scale).alias("conversion_rate_pct")


def _per_session() -> Column:
    return exact.per_unit(F.col("revenue"), F.col("sessions")).alias("revenue_per_session")


def _per_order(name: str) -> Column:
    return exact.per_unit(F.col("revenue"), F.col("orders")).alias(name)


# --- traffic -----------------------------------------------------------------


def observation_window(events: DataFrame, ts: str = "created_at") -> DataFrame:
    return events.agg(F.min(ts).alias("first_session"), F.max(ts).alias("last_session"))


def session_counts(sessions: DataFrame, period: Sequence[Column]) -> DataFrame:
    return sessions.groupBy(*period).agg(exact.rows().alias("sessions"))


def sessions_by_year_pivot(
    sessions: DataFrame, years: Sequence[int], blank_years: Sequence[int] = (), ts: str = "created_at"
) -> DataFrame:
    """Month rows, one column per year, and ``sessions_other_years`` so that a row adds up to its month.

    A year in ``blank_years`` shows NULL for a month it has no sessions in (it had not
    begun yet); every other year shows 0.
    """
    year = F.year(ts)
    columns = []
    for y in years:
        hit = F.when(year == y, 1)
        columns.append(F.sum(hit if y in blank_years else hit.otherwise(0)).alias(f"sessions_{y}"))
    other = F.count_if(~F.coalesce(year.isin(*years), F.lit(False)))
    return sessions.groupBy(F.month(ts).alias("month_")).agg(*columns, other.alias("sessions_other_years"))


def sessions_by_every_year_pivot(sessions: DataFrame, ts: str = "created_at", most: int = 200) -> DataFrame:
    """Month rows and a column for each year that occurs: the years are looked up first, and more than ``most`` of them are an error.

    Sessions without a time have no month and no year; they are left out.
    """
    timed = sessions.where(F.col(ts).isNotNull())
    found = timed.select(F.year(ts).alias("y")).distinct().limit(most + 1).collect()  # bounded by ``most``
    if len(found) > most:
        raise ValueError(f"more than {most} years in {ts}: columns for these would be no table")
    years = sorted(r["y"] for r in found)
    return sessions_by_year_pivot(timed, years, ts=ts).drop("sessions_other_years")


# --- conversion and revenue --------------------------------------------------


def conversion(sessions: DataFrame, orders: DataFrame, period: Sequence[Column] = (), scale: int = 5) -> DataFrame:
    t = totals(join_orders(sessions, orders), *period)
    keys = t.columns[: len(period)]
    return t.select(*keys, "sessions", "orders", "converted", _conversion(scale))


def channel_performance(sessions: DataFrame, orders: DataFrame) -> DataFrame:
    t = totals(join_orders(sessions, orders), rules.channel().alias("channel"))
    return t.select(
        "channel", "sessions", "orders", _conversion(), "revenue", _per_session()
    ).orderBy(F.desc("sessions"), "channel")


def revenue_metrics(sessions: DataFrame, orders: DataFrame, period: Sequence[Column]) -> DataFrame:
    """Keyed on the *session's* time; filter ``sessions`` first for a like-for-like window."""
    t = totals(join_orders(sessions, orders), *period)
    keys = t.columns[: len(period)]
    return t.select(*keys, "sessions", "orders", _per_order("revenue_per_order"), _per_session())


# --- devices -----------------------------------------------------------------


def device_overall(sessions: DataFrame, orders: DataFrame) -> DataFrame:
    t = totals(join_orders(sessions, orders), "device_type")
    all_sessions = F.sum("sessions").over(Window.partitionBy())
    return t.select(
        "device_type",
        "sessions",
        exact.percent(F.col("sessions"), all_sessions, 1).alias("pct_of_traffic"),
        "orders",
        _conversion(),
        _per_order("avg_order_value"),
        _per_session(),
    ).orderBy(F.desc("sessions"), "device_type")


def device_gap(
    sessions: DataFrame, orders: DataFrame, period: Column, high: str = "desktop", low: str = "mobile"
) -> DataFrame:
    """Conversion of two devices per period, their gap in points and as a ratio.

    The gap is formed from the unrounded rates (as one exact fraction), then rounded.
    """

    def only(device: str, what: Column) -> Column:
        return F.sum(F.when(F.col("device_type") == device, what)).cast("decimal(18,0)")

    wide = join_orders(sessions, orders).groupBy(period).agg(
        only(high, F.lit(1)).alias("hs"),
        only(low, F.lit(1)).alias("ls"),
        only(high, F.col("session_orders").isNotNull().cast("int")).alias("hc"),
        only(low, F.col("session_orders").isNotNull().cast("int")).alias("lc"),
    )
    hs, ls, hc, lc = (F.col(c) for c in ("hs", "ls", "hc", "lc"))
    return wide.select(
        wide.columns[0],
        exact.percent(hc, hs, 2).alias(f"{high}_conv_pct"),
        exact.percent(lc, ls, 2).alias(f"{low}_conv_pct"),
        exact.percent((hc * ls - lc * hs).cast("decimal(33,0)"), hs * ls, 2).alias("gap_points"),
        exact.ratio((hc * ls).cast("decimal(35,0)"), hs * lc, 2).alias("gap_ratio"),
    )


def device_mix(sessions: DataFrame, period: Column, device: str = "mobile", other: str = "desktop") -> DataFrame:
    n, d = F.col("total_sessions"), F.col(f"{device}_sessions")
    mix = sessions.groupBy(period).agg(
        exact.rows().alias("total_sessions"),
        F.count_if(F.col("device_type") == other).alias(f"{other}_sessions"),
        F.count_if(F.col("device_type") == device).alias(f"{device}_sessions"),
    )
    return mix.withColumn(f"{device}_pct_of_traffic", exact.percent(d, n, 1))


# --- campaigns ---------------------------------------------------------------


def campaign_volume(sessions: DataFrame) -> DataFrame:
    return session_counts(sessions, [F.col("utm_campaign")]).orderBy(F.desc("sessions"), "utm_campaign")


def campaign_performance(sessions: DataFrame, orders: DataFrame) -> DataFrame:
    t = totals(join_orders(sessions, orders), "utm_campaign")
    return t.select(
        "utm_campaign", "sessions", "orders", _conversion(), "revenue", _per_session()
    ).orderBy(F.desc("sessions"), "utm_campaign")


def repeat_share(sessions: DataFrame) -> DataFrame:
    by_campaign = sessions.groupBy("utm_campaign").agg(
        exact.rows().alias("total_sessions"), F.sum("is_repeat_session").alias("repeated_sessions")
    )
    share = exact.percent(F.col("repeated_sessions"), F.col("total_sessions"), 2)
    return by_campaign.withColumn("repeat_session_pct", share).orderBy(
        F.desc("repeat_session_pct"), "utm_campaign"
    )


def conversion_by_campaign_repeat(sessions: DataFrame, orders: DataFrame) -> DataFrame:
    t = totals(join_orders(sessions, orders), "utm_campaign", "is_repeat_session")
    return t.select("utm_campaign", "is_repeat_session", "sessions", "orders", _conversion()).orderBy(
        "utm_campaign", "is_repeat_session"
    )


def campaign_date_ranges(sessions: DataFrame) -> DataFrame:
    return (
        sessions.groupBy("utm_campaign")
        .agg(
            exact.rows().alias("sessions"),
            F.min("created_at").alias("first_session"),
            F.max("created_at").alias("last_session"),
        )
        .withColumn("days_active", F.datediff(F.col("last_session"), F.col("first_session")))
        .orderBy("first_session", "utm_campaign")
    )


# --- repeat visits -----------------------------------------------------------


def repeat_vs_first_time(sessions: DataFrame, orders: DataFrame) -> DataFrame:
    """The join keeps every session once, so the two groups add up to all sessions; revenue
    is set against the order table itself, whatever sessions its orders belong to."""
    t = totals(join_orders(sessions, orders), "is_repeat_session")
    all_sessions = F.sum("sessions").over(Window.partitionBy())
    all_revenue = orders.agg(exact.from_cents(exact.sum_cents("price_usd"))).scalar()
    return t.select(
        "is_repeat_session",
        "sessions",
        exact.percent(F.col("sessions"), all_sessions, 1).alias("pct_of_sessions"),
        "orders",
        _conversion(),
        "revenue",
        exact.money_percent(F.col("revenue"), all_revenue, 1).alias("pct_of_revenue"),
        _per_session(),
    ).orderBy("is_repeat_session")


# --- derived from the channel table ------------------------------------------


def channel_share(channels: DataFrame, baseline: str = "Paid") -> DataFrame:
    """Share of sessions, and revenue per session relative to a baseline channel.

    ``channels`` is already one row per channel, so the window sees a handful of rows.
    """
    everything = Window.partitionBy()
    base = F.col("channel") == baseline
    s, r = F.col("sessions").cast("decimal(14,0)"), F.col("revenue")
    base_s = F.max(F.when(base, s)).over(everything)
    base_r = F.max(F.when(base, r)).over(everything)
    return channels.select(
        "channel",
        "sessions",
        exact.percent(F.col("sessions"), F.sum("sessions").over(everything), 1).alias("pct_of_sessions"),
        exact.half_up(
            exact.cents(r).cast("decimal(19,0)") * base_s, exact.cents(base_r).cast("decimal(19,0)") * s, 2
        ).alias("relative_value"),
    )
