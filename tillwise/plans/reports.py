"""The shop's thirty standard reports, over tables of the declared schema.

    tables = load.open_shop(spark, folder)
    reports.REPORTS["channel_performance"](tables, reports.Settings())
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import calendar
from ..operators import funnel, products, returns, sessions, users
from ..sources import csv

Tables = Mapping[str, DataFrame]


@dataclass(frozen=True)
class Settings:
    """Literals of the reports.  ``same_until``: month and day up to which every year is covered."""

    # Those of the published reports.
    pivot_years: tuple[int, ...] = (2012, 2013, 2014)
    blank_years: tuple[int, ...] = (2012,)
    same_until: tuple[int, int] = (3, 19)
    launch_days: int = 90
    min_items: int = 100
    cross_sell_since: datetime = datetime(2013, 9, 1)
    refund_product: str | None = None


def _month():
    return calendar.year_month(F.col("created_at"))


def _year():
    return F.year("created_at").alias("year_")


def _same(t: Tables, s: Settings) -> DataFrame:
    sessions_ = t["website_sessions"]
    if "month_" in sessions_.columns:  # laid out by month: later months are not read
        return sessions_.where(calendar.until_day_in_months(F.col("month_"), F.col("created_at"), *s.same_until))
    return sessions_.where(calendar.until_day_of_year(F.col("created_at"), *s.same_until))


def _later_launches(t: Tables) -> DataFrame:
    """Launches after the shop's own opening, which has nothing before it."""
    launched = products.launches(t["products"])
    opening = t["products"].agg(F.min("created_at").cast("date")).scalar()
    return launched.where(F.col("launch_day") > opening)


def _facts(t: Tables) -> DataFrame:
    return returns.with_refunds(t["order_items"], t["order_item_refunds"])


def _refund_months(t: Tables, s: Settings) -> DataFrame:
    if s.refund_product is None:
        raise ValueError("settings.refund_product names the product of this report")
    return returns.refunds_by_refund_date(
        t["order_item_refunds"], t["order_items"], t["orders"], t["products"], s.refund_product
    )


def _on_both(report: Callable[[DataFrame, DataFrame], DataFrame]) -> Callable[[Tables, Settings], DataFrame]:
    return lambda t, s: report(t["website_sessions"], t["orders"])


def _on_sessions(report: Callable[[DataFrame], DataFrame]) -> Callable[[Tables, Settings], DataFrame]:
    return lambda t, s: report(t["website_sessions"])


REPORTS: dict[str, Callable[[Tables, Settings], DataFrame]] = {
    "data_range": _on_sessions(sessions.observation_window),
    "monthly_sessions": _on_sessions(lambda ws: sessions.session_counts(ws, _month()).orderBy("year_", "month_")),
    "monthly_sessions_by_year_pivot": lambda t, s: sessions.sessions_by_year_pivot(
        t["website_sessions"], s.pivot_years, s.blank_years
    ).orderBy("month_"),
    "overall_conversion": _on_both(lambda ws, o: sessions.conversion(ws, o, scale=6)),
    "monthly_conversion": _on_both(lambda ws, o: sessions.conversion(ws, o, _month()).orderBy("year_", "month_")),
    "channel_performance": _on_both(sessions.channel_performance),
    "monthly_revenue_metrics": _on_both(
        lambda ws, o: sessions.revenue_metrics(ws, o, _month()).orderBy("year_", "month_")
    ),
    "annual_revenue_metrics": _on_both(lambda ws, o: sessions.revenue_metrics(ws, o, [_year()]).orderBy("year_")),
    "annual_revenue_like_for_like": lambda t, s: sessions.revenue_metrics(
        _same(t, s), t["orders"], [_year()]
    ).orderBy("year_"),
    "conversion_funnel": lambda t, s: funnel.funnel(t["website_pageviews"]),
    "monthly_items_per_order": lambda t, s: products.items_per_order(t["orders"], _month()).orderBy("year_", "month_"),
    "product_mix": lambda t, s: products.product_mix(t["order_items"], t["products"]),
    "launch_windows": lambda t, s: products.launch_windows(t["orders"], _later_launches(t), s.launch_days),
    "device_overall": _on_both(sessions.device_overall),
    "device_gap_by_year": _on_both(lambda ws, o: sessions.device_gap(ws, o, _year()).orderBy("year_")),
    "device_mix_by_year": _on_sessions(lambda ws: sessions.device_mix(ws, _year()).orderBy("year_")),
    "device_mix_like_for_like": lambda t, s: sessions.device_mix(_same(t, s), _year())
    .drop("desktop_sessions")
    .orderBy("year_"),
    "campaign_volume": _on_sessions(sessions.campaign_volume),
    "campaign_performance": _on_both(sessions.campaign_performance),
    "repeat_share_by_campaign": _on_sessions(sessions.repeat_share),
    "conversion_by_campaign_repeat": _on_both(sessions.conversion_by_campaign_repeat),
    "campaign_date_ranges": _on_sessions(sessions.campaign_date_ranges),
    "repeat_vs_first_time": _on_both(sessions.repeat_vs_first_time),
    "sessions_per_user": _on_sessions(users.sessions_per_user),
    "orders_per_customer": lambda t, s: users.orders_per_customer(t["orders"]),
    "refund_rate_by_product": lambda t, s: returns.refund_rate_by_product(_facts(t), t["products"]),
    "monthly_refund_rate": lambda t, s: returns.monthly_refund_rate(_facts(t), t["orders"], t["products"], s.min_items),
    "refunds_by_refund_date": _refund_months,
    "refund_by_item_role": lambda t, s: returns.refund_by_item_role(_facts(t), t["products"]),
    "refund_by_item_role_since": lambda t, s: returns.refund_by_item_role_since(
        _facts(t), t["orders"], t["products"], F.lit(s.cross_sell_since).cast("timestamp_ntz")
    ),
}


def export(tables: Tables, settings: Settings, folder: str) -> None:
    """Write every report as CSV under ``<folder>/<report>``."""
    for name, report in REPORTS.items():
        csv.write_result(report(tables, settings), f"{folder}/{name}")
