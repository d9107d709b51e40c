"""Traffic, conversion, funnel, campaign and repeat-visit questions."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import calendar
from ..operators import funnel, sessions, users
from . import load
from .oracle import CHANNEL, CONVERTED, ORDERS, REVENUE, SESSIONS, big, dollars, label, month, per_unit, percent, sql, text, year
from .registry import query

PIVOT_YEARS = range(1995, 2002)


def _year():
    return F.year("created_at").alias("year_")


def _day():
    return F.col("created_at").cast("date").alias("day")


def _months():
    return calendar.year_month(F.col("created_at"))


CONV = percent(CONVERTED, SESSIONS, 2)
PER_SESSION = per_unit(REVENUE, SESSIONS)
PER_ORDER = per_unit(REVENUE, ORDERS)
YM = f"{year('created_at')} AS year_, {month('created_at')} AS month_"


@query(
    "data_range",
    sql(f"SELECT {text('min(created_at)')} AS first_session, {text('max(created_at)')} AS last_session FROM sessions", "sessions"),
)
def _(r):
    return sessions.observation_window(r.web_sessions)


@query("monthly_sessions", sql(f"SELECT {YM}, count(*) AS sessions FROM visits GROUP BY 1, 2", "visits"))
def _(r):
    return sessions.session_counts(r.visits, _months()).orderBy("year_", "month_")


@query(
    "daily_sessions",
    sql("SELECT strftime(created_at, '%Y-%m-%d') AS day, count(*) AS sessions FROM sessions GROUP BY 1", "sessions"),
)
def _(r):
    return sessions.session_counts(r.web_sessions, [_day()]).orderBy("day")


_PIVOT = ", ".join(
    f"CAST(sum(CASE WHEN year(created_at) = {y} THEN 1 {'' if y == 2001 else 'ELSE 0 '}END) AS BIGINT) AS sessions_{y}"
    for y in PIVOT_YEARS
) + f", count(*) FILTER (WHERE year(created_at) NOT BETWEEN {min(PIVOT_YEARS)} AND {max(PIVOT_YEARS)}) AS sessions_other_years"


@query(
    "monthly_sessions_by_year_pivot",
    sql(f"SELECT {month('created_at')} AS month_, {_PIVOT} FROM visits GROUP BY 1", "visits"),
)
def _(r):
    return sessions.sessions_by_year_pivot(r.visits, list(PIVOT_YEARS), blank_years=[2001]).orderBy("month_")


@query(
    "overall_conversion",
    sql(
        f"SELECT {SESSIONS} AS sessions, {ORDERS} AS orders, {CONVERTED} AS converted, "
        f"{percent(CONVERTED, SESSIONS, 6)} AS conversion_rate_pct FROM joined",
        "joined",
    ),
)
def _(r):
    return sessions.conversion(r.web_sessions, r.web_orders, scale=6)


@query(
    "monthly_conversion",
    sql(
        f"SELECT {YM}, {SESSIONS} AS sessions, {ORDERS} AS orders, {CONVERTED} AS converted, "
        f"{percent(CONVERTED, SESSIONS, 5)} AS conversion_rate_pct FROM vjoined GROUP BY 1, 2",
        "vjoined",
    ),
)
def _(r):
    return sessions.conversion(r.visits, r.visit_orders, _months()).orderBy("year_", "month_")


@query(
    "daily_conversion",
    sql(
        f"SELECT strftime(created_at, '%Y-%m-%d') AS day, {SESSIONS} AS sessions, {ORDERS} AS orders, "
        f"{CONVERTED} AS converted, {percent(CONVERTED, SESSIONS, 5)} AS conversion_rate_pct FROM joined GROUP BY 1",
        "joined",
    ),
)
def _(r):
    return sessions.conversion(r.web_sessions, r.web_orders, [_day()]).orderBy("day")


@query(
    "channel_performance",
    sql(
        f"SELECT {CHANNEL} AS channel, {SESSIONS} AS sessions, {ORDERS} AS orders, {CONV} AS conversion_rate_pct, "
        f"{dollars(REVENUE)} AS revenue, {PER_SESSION} AS revenue_per_session FROM joined GROUP BY 1",
        "joined",
    ),
)
def channel_performance(r):
    return sessions.channel_performance(r.web_sessions, r.web_orders)


_REVENUE = (
    f"{SESSIONS} AS sessions, {ORDERS} AS orders, {PER_ORDER} AS revenue_per_order, {PER_SESSION} AS revenue_per_session"
)


@query("monthly_revenue_metrics", sql(f"SELECT {YM}, {_REVENUE} FROM vjoined GROUP BY 1, 2", "vjoined"))
def _(r):
    return sessions.revenue_metrics(r.visits, r.visit_orders, _months()).orderBy("year_", "month_")


@query(
    "annual_revenue_metrics",
    sql(f"SELECT {year('created_at')} AS year_, {_REVENUE} FROM vjoined GROUP BY 1", "vjoined"),
)
def _(r):
    return sessions.revenue_metrics(r.visits, r.visit_orders, [_year()]).orderBy("year_")


@query(
    "annual_revenue_like_for_like",
    sql(
        f"SELECT {year('created_at')} AS year_, {_REVENUE} FROM vjoined "
        "WHERE strftime(created_at, '%m-%d') <= '03-19' GROUP BY 1",
        "vjoined",
    ),
)
def _(r):
    window = r.visits.where(calendar.until_day_of_year(F.col("created_at"), 3, 19))
    return sessions.revenue_metrics(window, r.visit_orders, [_year()]).orderBy("year_")


@query(
    "like_for_like_pushed_down",
    sql(
        f"SELECT {year('created_at')} AS year_, count(*) AS sessions FROM visits "
        "WHERE strftime(created_at, '%m-%d') <= '07-31' GROUP BY 1",
        "visits",
    ),
)
def _(r):
    """Over visits laid out by month: months past the window are not read."""
    laid_out = load.by_month(r.visits, "created_at", ("created_at", "website_session_id"))
    window = laid_out.where(calendar.until_day_in_months(F.col("month_"), F.col("created_at"), 7, 31))
    return sessions.session_counts(window, [F.col("year_")]).orderBy("year_")


@query(
    "bucketed_session_join",
    sql(
        f"SELECT {year('created_at')} AS year_, {_REVENUE} FROM vjoined GROUP BY 1",
        "vjoined",
    ),
)
def _(r):
    """Visits and their purchases laid out in buckets of the session: their join shuffles neither."""
    visits, purchases = load.by_bucket([r.visits, r.visit_orders], "website_session_id", 16)
    return sessions.revenue_metrics(visits, purchases, [_year()])


# --- funnel --------------------------------------------------------------------

# The pages of the checkout.
_REACHED = {
    "reached_products": "pageview_url = '/products'",
    "reached_product_detail": "pageview_url LIKE '/the-%'",
    "reached_cart": "pageview_url = '/cart'",
    "reached_shipping": "pageview_url = '/shipping'",
    "reached_billing": "pageview_url IN ('/billing', '/billing-2')",
    "reached_thankyou": "pageview_url = '/thank-you-for-your-order'",
}
_FUNNEL = (
    "SELECT count(DISTINCT website_session_id) AS sessions, "
    + ", ".join(f"count(DISTINCT CASE WHEN {c} THEN website_session_id END) AS {n}" for n, c in _REACHED.items())
    + " FROM pageviews"
)
_NAMES = ["sessions", *_REACHED]
_LONG = "\nUNION ALL ".join(
    f"SELECT {i} AS step_no, '{n}' AS step, {n} AS reached, "
    f"{'CAST(NULL AS BIGINT)' if i == 0 else _NAMES[i - 1]} AS prev FROM wide"
    for i, n in enumerate(_NAMES)
)


@query("conversion_funnel", sql(_FUNNEL, "pageviews"))
def conversion_funnel(r):
    return funnel.funnel(r.web_pageviews)


@query(
    "funnel_steps",
    sql(
        f"SELECT step_no, step, reached, {percent('reached', 'prev', 1)} AS step_conversion_pct, prev - reached AS lost FROM long",
        "pageviews",
        wide=_FUNNEL,
        long=_LONG,
    ),
)
def _(r):
    return funnel.funnel_steps(funnel.funnel(r.web_pageviews))


@query(
    "funnel_abandoned_value",
    sql(
        f"SELECT step_no, step, prev - reached AS lost, {dollars('c')} AS avg_order_value, "
        f"{dollars('(prev - reached) * c')} AS abandoned_value FROM long, aov WHERE step_no > 0",
        "pageviews",
        "web_orders",
        wide=_FUNNEL,
        long=_LONG,
        aov="SELECT CAST((2 * sum(price) + count(*)) // (2 * count(*)) AS BIGINT) AS c FROM web_orders",
    ),
)
def _(r):
    return funnel.abandoned_value(funnel.funnel_steps(funnel.funnel(r.web_pageviews)), r.web_orders)


@query(
    "funnel_sensitivity",
    sql(
        "SELECT step_no, step, CAST(tenths AS DOUBLE) / 10 AS onward_conversion_pct, "
        "CAST((2 * prev * tenths + 100000) // 200000 AS BIGINT) AS extra_orders_per_point FROM onward WHERE step_no > 0",
        "pageviews",
        wide=_FUNNEL,
        long=_LONG,
        onward="SELECT l.*, CAST((2000 * w.reached_thankyou + l.reached) // (2 * l.reached) AS BIGINT) AS tenths FROM long l, wide w",
    ),
)
def _(r):
    return funnel.sensitivity(funnel.funnel(r.web_pageviews))


# --- devices -------------------------------------------------------------------


@query(
    "device_overall",
    sql(
        f"SELECT device_type, {SESSIONS} AS sessions, "
        f"{percent(SESSIONS, '(SELECT count(*) FROM sessions)', 1)} AS pct_of_traffic, {ORDERS} AS orders, "
        f"{CONV} AS conversion_rate_pct, {PER_ORDER} AS avg_order_value, {PER_SESSION} AS revenue_per_session "
        "FROM joined GROUP BY 1",
        "joined",
    ),
)
def _(r):
    return sessions.device_overall(r.web_sessions, r.web_orders)


_DEVICE_PIVOT = (
    "SELECT k, max(CASE WHEN device_type = 'desktop' THEN s END) AS hs, max(CASE WHEN device_type = 'mobile' THEN s END) AS ls, "
    "max(CASE WHEN device_type = 'desktop' THEN c END) AS hc, max(CASE WHEN device_type = 'mobile' THEN c END) AS lc "
    "FROM by_device GROUP BY 1"
)


def _device_gap(key: str) -> str:
    h = "CAST({} AS HUGEINT) * {}"
    return (
        f"SELECT k AS {key}, {percent('hc', 'hs', 2)} AS desktop_conv_pct, {percent('lc', 'ls', 2)} AS mobile_conv_pct, "
        f"{percent(h.format('hc', 'ls') + ' - ' + h.format('lc', 'hs'), h.format('hs', 'ls'), 2)} AS gap_points, "
        f"{percent(h.format('hc', 'ls'), '100 * ' + h.format('hs', 'lc'), 2)} AS gap_ratio FROM wide"
    )


@query(
    "device_gap_by_year",
    sql(
        _device_gap("year_"),
        "vjoined",
        by_device=f"SELECT {year('created_at')} AS k, device_type, {SESSIONS} AS s, {CONVERTED} AS c FROM vjoined GROUP BY 1, 2",
        wide=_DEVICE_PIVOT,
    ),
)
def _(r):
    return sessions.device_gap(r.visits, r.visit_orders, _year()).orderBy("year_")


@query(
    "device_gap_by_week",
    sql(
        _device_gap("week"),
        "joined",
        by_device=f"SELECT CAST(CAST(date_trunc('week', created_at) AS DATE) AS VARCHAR) AS k, device_type, {SESSIONS} AS s, {CONVERTED} AS c FROM joined GROUP BY 1, 2",
        wide=_DEVICE_PIVOT,
    ),
)
def _(r):
    week = calendar.week_start(F.col("created_at")).alias("week")
    return sessions.device_gap(r.web_sessions, r.web_orders, week).orderBy("week")


_MIX = (
    "count(*) AS total_sessions, count(*) FILTER (WHERE device_type = 'desktop') AS desktop_sessions, "
    "count(*) FILTER (WHERE device_type = 'mobile') AS mobile_sessions, "
    + percent("count(*) FILTER (WHERE device_type = 'mobile')", "count(*)", 1)
    + " AS mobile_pct_of_traffic"
)


@query("device_mix_by_year", sql(f"SELECT {year('created_at')} AS year_, {_MIX} FROM visits GROUP BY 1", "visits"))
def _(r):
    return sessions.device_mix(r.visits, _year()).orderBy("year_")


@query(
    "device_mix_like_for_like",
    sql(
        f"SELECT * EXCLUDE (desktop_sessions) FROM (SELECT {year('created_at')} AS year_, {_MIX} FROM visits "
        "WHERE strftime(created_at, '%m-%d') <= '03-19' GROUP BY 1)",
        "visits",
    ),
)
def _(r):
    window = r.visits.where(calendar.until_day_of_year(F.col("created_at"), 3, 19))
    return sessions.device_mix(window, _year()).drop("desktop_sessions").orderBy("year_")


# --- campaigns -----------------------------------------------------------------


@query("campaign_volume", sql("SELECT utm_campaign, count(*) AS sessions FROM sessions GROUP BY 1", "sessions"))
def _(r):
    return sessions.campaign_volume(r.web_sessions)


@query(
    "campaign_performance",
    sql(
        f"SELECT utm_campaign, {SESSIONS} AS sessions, {ORDERS} AS orders, {CONV} AS conversion_rate_pct, "
        f"{dollars(REVENUE)} AS revenue, {PER_SESSION} AS revenue_per_session FROM joined GROUP BY 1",
        "joined",
    ),
)
def _(r):
    return sessions.campaign_performance(r.web_sessions, r.web_orders)


@query(
    "repeat_share_by_campaign",
    sql(
        f"SELECT utm_campaign, count(*) AS total_sessions, {big('sum(is_repeat_session)')} AS repeated_sessions, "
        f"{percent('sum(is_repeat_session)', 'count(*)', 2)} AS repeat_session_pct FROM sessions GROUP BY 1",
        "sessions",
    ),
)
def _(r):
    return sessions.repeat_share(r.web_sessions)


@query(
    "conversion_by_campaign_repeat",
    sql(
        f"SELECT utm_campaign, is_repeat_session, {SESSIONS} AS sessions, {ORDERS} AS orders, {CONV} AS conversion_rate_pct "
        "FROM joined GROUP BY 1, 2",
        "joined",
    ),
)
def _(r):
    return sessions.conversion_by_campaign_repeat(r.web_sessions, r.web_orders)


_RANGES = (
    "SELECT utm_campaign, count(*) AS sessions, {0} AS first_session, {1} AS last_session, "
    "CAST(date_diff('day', CAST(min(created_at) AS DATE), CAST(max(created_at) AS DATE)) AS INTEGER) AS days_active "
    "FROM {2} GROUP BY 1"
)


@query(
    "campaign_date_ranges",
    sql(_RANGES.format(text("min(created_at)"), text("max(created_at)"), "sessions"), "sessions"),
)
def _(r):
    return sessions.campaign_date_ranges(r.web_sessions)


# --- repeat visits and users -----------------------------------------------------


@query(
    "repeat_vs_first_time",
    sql(
        f"SELECT is_repeat_session, {SESSIONS} AS sessions, {percent(SESSIONS, '(SELECT count(*) FROM sessions)', 1)} AS pct_of_sessions, "
        f"{ORDERS} AS orders, {CONV} AS conversion_rate_pct, {dollars(REVENUE)} AS revenue, "
        f"{percent(REVENUE, '(SELECT sum(price) FROM web_orders)', 1)} AS pct_of_revenue, "
        f"{PER_SESSION} AS revenue_per_session FROM joined GROUP BY 1",
        "joined",
    ),
)
def _(r):
    return sessions.repeat_vs_first_time(r.web_sessions, r.web_orders)


@query(
    "sessions_per_user",
    sql(
        "SELECT n AS sessions_per_user, count(*) AS users, "
        f"{percent('count(*)', '(SELECT count(DISTINCT user_id) FROM sessions)', 2)} AS pct_of_users FROM per_user GROUP BY 1",
        "sessions",
        per_user="SELECT user_id, count(*) AS n FROM sessions GROUP BY 1",
    ),
)
def _(r):
    return users.sessions_per_user(r.web_sessions)


_TIERS = (
    "SELECT n AS orders_per_user, count(*) AS customers, "
    + percent("count(*)", "(SELECT count(DISTINCT user_id) FROM {0})", 2)
    + " AS pct_of_customers, "
    + dollars("sum(v)")
    + " AS revenue, "
    + percent("sum(v)", "(SELECT sum(price) FROM {0})", 1)
    + " AS pct_of_revenue FROM (SELECT user_id, count(*) AS n, sum(price) AS v FROM {0} GROUP BY 1) GROUP BY 1"
)


@query("orders_per_customer", sql(_TIERS.format("shop_orders"), "shop_orders"))
def _(r):
    return users.orders_per_customer(r.orders)


@query(
    "repeat_purchase_reconciliation",
    sql(
        f"SELECT {big('count(*) FILTER (WHERE nth > 1)')} AS second_or_later_orders, "
        "count(*) FILTER (WHERE is_repeat_session = 1) AS repeat_session_orders, "
        "count(*) FILTER (WHERE is_repeat_session = 1 AND nth = 1) AS first_purchases_on_return, "
        f"{percent('count(*) FILTER (WHERE is_repeat_session = 1 AND nth = 1)', 'count(*) FILTER (WHERE is_repeat_session = 1)', 1)} AS first_purchase_pct "
        "FROM numbered JOIN sessions USING (website_session_id)",
        "sessions",
        "web_orders",
        numbered="SELECT website_session_id, row_number() OVER (PARTITION BY user_id ORDER BY created_at, order_id) AS nth FROM web_orders",
    ),
)
def _(r):
    return users.repeat_purchase_reconciliation(r.web_sessions, r.web_orders)


@query(
    "repeat_purchase_counts",
    sql(
        f"SELECT a AS second_or_later_orders, b AS repeat_session_orders, b - a AS first_purchases_on_return, "
        f"{percent('b - a', 'b', 1)} AS first_purchase_pct FROM "
        "(SELECT count(*) - count(DISTINCT user_id) AS a FROM web_orders), "
        "(SELECT count(order_id) AS b FROM joined WHERE is_repeat_session = 1)",
        "joined",
    ),
)
def _(r):
    tiers = users.orders_per_customer(r.web_orders)
    by_repeat = sessions.totals(sessions.join_orders(r.web_sessions, r.web_orders), "is_repeat_session")
    return users.repeat_purchase_counts(
        tiers, by_repeat.where(F.col("is_repeat_session") == 1).select("orders").scalar()
    )


_COHORT = dict(
    active="SELECT DISTINCT o_custkey AS u, date_trunc('month', o_orderdate) AS m FROM orders",
    first="SELECT u, min(m) AS c FROM active GROUP BY 1",
    cells="SELECT c, CAST(date_diff('month', c, m) AS INTEGER) AS k, count(*) AS n FROM active JOIN first USING (u) GROUP BY 1, 2",
    size="SELECT c, count(*) AS z FROM first GROUP BY 1",
)


@query(
    "cohort_retention",
    sql(
        f"SELECT {label('c')} AS cohort_month, k AS months_since, n AS users, z AS cohort_size, "
        f"{percent('n', 'z', 1)} AS retention_pct FROM cells JOIN size USING (c)",
        **_COHORT,
    ),
)
def _(r):
    return users.cohort_retention(r.orders)


@query(
    "cohort_matrix",
    sql(
        f"SELECT {label('c')} AS cohort_month, max(z) AS cohort_size, "
        + ", ".join(f"max(CASE WHEN k = {m} THEN n END) AS month_{m}" for m in range(7))
        + ", CAST(coalesce(sum(CASE WHEN k > 6 THEN n END), 0) AS BIGINT) AS later_months FROM cells JOIN size USING (c) GROUP BY 1",
        **_COHORT,
    ),
)
def _(r):
    return users.cohort_matrix(users.cohort_retention(r.orders), 6)
