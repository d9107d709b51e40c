"""SQL for the oracles: the roles as common table expressions, and exact rounding.

The SQL is written independently of the operators: it joins first and counts distinct
keys where the operators fold first, uses window ranks where they use minima, and so on.
"""

from __future__ import annotations


def half_up(num: str, den: str, scale: int) -> str:
    """round(num / den, scale) half away from zero over whole numbers, as DOUBLE; NULL when den is 0."""
    n, d = f"CAST(({num}) AS HUGEINT)", f"CAST(({den}) AS HUGEINT)"
    return (
        f"(CASE WHEN {d} <> 0 THEN CAST((CASE WHEN {n} < 0 THEN -1 ELSE 1 END)"
        f" * ((2 * {10**scale} * abs({n}) + {d}) // (2 * {d})) AS DOUBLE) / {10**scale} END)"
    )


def percent(num: str, den: str, scale: int) -> str:
    return half_up(f"100 * CAST(({num}) AS HUGEINT)", den, scale)


def per_unit(cents: str, den: str, scale: int = 2) -> str:
    return half_up(cents, f"100 * CAST(({den}) AS HUGEINT)", scale)


def cents(expr: str) -> str:
    return f"CAST(CAST({expr} AS DECIMAL(18,2)) * 100 AS BIGINT)"


def dollars(expr: str) -> str:
    return f"(CAST({expr} AS DOUBLE) / 100)"


def big(expr: str) -> str:
    return f"CAST({expr} AS BIGINT)"


def year(ts: str) -> str:
    return f"CAST(year({ts}) AS INTEGER)"


def month(ts: str) -> str:
    return f"CAST(month({ts}) AS INTEGER)"


def label(ts: str) -> str:
    return f"strftime({ts}, '%Y-%m')"


def text(ts: str) -> str:
    return f"strftime({ts}, '%Y-%m-%d %H:%M:%S')"


_DEVICE = "CASE WHEN {0} % 10 < 7 THEN 'desktop' ELSE 'mobile' END AS device_type"
_SESSION = "user_id * 1000000 + date_diff('day', DATE '1970-01-01', CAST(ts AS DATE)) AS website_session_id"

CTES: dict[str, str] = {
    "sessions": f"""
        SELECT user_id * 1000000 + date_diff('day', DATE '1970-01-01', d) AS website_session_id, created_at, user_id,
               CAST(row_number() OVER (PARTITION BY user_id ORDER BY d) > 1 AS INTEGER) AS is_repeat_session,
               CASE WHEN k0 < 60 THEN 'search_a' WHEN k0 < 80 THEN 'search_b' END AS utm_source,
               CASE WHEN k0 < 15 THEN 'brand' WHEN k0 < 70 THEN 'nonbrand' WHEN k0 < 80 THEN 'pilot' END AS utm_campaign,
               CASE WHEN k0 < 90 THEN 'ref' END AS http_referer, {_DEVICE.format("user_id")}
        FROM (SELECT user_id, CAST(ts AS DATE) AS d, min(ts) AS created_at,
                     arg_min(CAST(regexp_extract(props, '"k": *([0-9]+)', 1) AS INTEGER), event_id) AS k0
              FROM events GROUP BY 1, 2)""",
    "web_orders": f"""
        SELECT event_id AS order_id, ts AS created_at, user_id, {_SESSION}, {cents("value")} AS price
        FROM events WHERE event_type = 'purchase'""",
    "pageviews": f"""
        SELECT event_id, ts AS created_at, {_SESSION},
               CASE WHEN event_type = 'view' THEN '/products' WHEN event_type = 'click' THEN '/the-item'
                    WHEN event_type = 'signup' AND event_id % 2 = 0 THEN '/cart' WHEN event_type = 'signup' THEN '/shipping'
                    WHEN event_type = 'error' AND event_id % 2 = 0 THEN '/billing' WHEN event_type = 'error' THEN '/billing-2'
                    WHEN event_type = 'purchase' THEN '/thank-you-for-your-order' END AS pageview_url
        FROM events""",
    "joined": """
        SELECT s.*, o.order_id, o.price FROM sessions s LEFT JOIN web_orders o USING (website_session_id)""",
    "visits": f"""
        SELECT o_orderkey AS website_session_id, o_orderdate AS created_at,
               NULLIF(o_orderpriority, '4-NOT SPECIFIED') AS utm_campaign, {_DEVICE.format("o_custkey")}
        FROM orders""",
    "visit_orders": f"""
        SELECT l_orderkey AS website_session_id, 1 AS order_id, {cents("l_extendedprice")} AS price
        FROM lineitem""",
    "vjoined": """
        SELECT v.*, o.order_id, o.price FROM visits v LEFT JOIN visit_orders o USING (website_session_id)""",
    "shop_orders": f"""
        SELECT o_orderkey AS order_id, o_orderdate AS created_at, o_custkey AS user_id, o_orderpriority AS priority,
               {cents("o_totalprice")} AS price,
               (SELECT count(*) FROM lineitem WHERE l_orderkey = o_orderkey) AS items_purchased
        FROM orders""",
    "items": f"""
        SELECT l_orderkey AS order_id, l_partkey AS product_id, CAST(l_linenumber = 1 AS INTEGER) AS is_primary_item,
               p_brand AS product_name, p_type AS product_type, o_orderdate AS ordered_at, l_shipdate AS refunded_at,
               {cents("l_extendedprice")} AS price, CAST(l_returnflag = 'R' AS INTEGER) AS refunded,
               CAST(round(CAST(l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l_discount AS DECIMAL(4,2))), 2) * 100 AS BIGINT) AS refund
        FROM lineitem LEFT JOIN part ON l_partkey = p_partkey JOIN orders ON l_orderkey = o_orderkey""",
    "launches": """
        SELECT p_brand AS launch, DATE '1995-06-01' + 80 * CAST(split_part(p_brand, '#', 2) AS INTEGER) AS launch_day
        FROM part GROUP BY 1, 2""",
    "listings": f"""
        SELECT c_custkey AS listing_id, n_name AS city, r_name AS currency,
               CASE WHEN {cents("c_acctbal")} > 0 THEN {cents("c_acctbal")} END AS price
        FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
    "trips": f"""
        SELECT s_nationkey AS pickup_zone_id, c_nationkey AS dropoff_zone_id, l_shipdate AS picked_up_at,
               {cents("l_quantity")} AS distance
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
             JOIN supplier ON l_suppkey = s_suppkey""",
}

_NEEDS = {
    "joined": ("sessions", "web_orders"),
    "vjoined": ("visits", "visit_orders"),
}


def sql(select: str, *roles: str, **extra: str) -> str:
    """``select`` over the named roles; ``extra`` adds further named steps, in order."""
    wanted: list[str] = []
    for r in roles:
        wanted += [n for n in (*_NEEDS.get(r, ()), r) if n not in wanted]
    steps = [f"{r} AS ({CTES[r].strip()})" for r in wanted]
    steps += [f"{name} AS ({body.strip()})" for name, body in extra.items()]
    return ("WITH " + ",\n".join(steps) + "\n" if steps else "") + select.strip()


# Aggregates over a session-order join that may fan out.
SESSIONS = "count(DISTINCT website_session_id)"
ORDERS = "count(order_id)"
CONVERTED = "count(DISTINCT CASE WHEN order_id IS NOT NULL THEN website_session_id END)"
REVENUE = "sum(price)"
# The channel rule.
CHANNEL = (
    "CASE WHEN utm_source IS NOT NULL THEN 'Paid' WHEN http_referer IS NOT NULL THEN 'Organic Search' ELSE 'Direct' END"
)
