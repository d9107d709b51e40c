"""Load verification, data quality, CSV exchange and physical layout."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import exact
from ..operators import funnel, quality, sessions, users
from ..sources import csv, layout
from . import load
from .oracle import CONVERTED, ORDERS, REVENUE, SESSIONS, big, cents, dollars, label, per_unit, percent, sql
from .registry import query

_SIZED = (
    *("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"),
    *("documents", "embeddings", "pages", "benchmark", "labels", "conversations"),
)


@query(
    "check_table_sizes",
    " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS rows_loaded FROM {t}" for t in _SIZED),
)
def _(r):
    return quality.table_sizes({t: r.table(t) for t in _SIZED})


# Rows that a complete load has, and one that it must not reach.
_EXPECTED = {"region": 5, "nation": 25, "lineitem": 1}


@query(
    "check_row_counts",
    " UNION ALL ".join(
        f"SELECT 'row_count' AS check_name, '{t}' AS subject, CAST({n} AS BIGINT) AS expected, count(*) AS actual, "
        f"CAST(count(*) = {n} AS INTEGER) AS ok FROM {t}"
        for t, n in _EXPECTED.items()
    ),
)
def _(r):
    """Loaded rows against expected rows; the last expectation is wrong on purpose and must be reported."""
    return quality.row_counts({t: r.table(t) for t in _EXPECTED}, _EXPECTED)


@query(
    "check_null_text",
    sql(
        "SELECT count(*) AS total_rows, count(*) FILTER (WHERE utm_campaign = 'NULL') AS literal_null_text, "
        "count(*) FILTER (WHERE utm_campaign IS NULL) AS real_nulls FROM visits",
        "visits",
    ),
)
def _(r):
    return quality.null_text(r.visits, "utm_campaign")


@query(
    "check_text_lengths",
    "SELECT DISTINCT p_name, CAST(length(p_name) AS INTEGER) AS len, CAST(p_name LIKE '%' || chr(13) AS INTEGER) AS trailing_cr FROM part",
)
def _(r):
    return quality.text_lengths(r.table("part").select("p_name").distinct(), "p_name")


_KEYS = {
    "region": ["r_regionkey"],
    "nation": ["n_nationkey"],
    "customer": ["c_custkey"],
    "supplier": ["s_suppkey"],
    "part": ["p_partkey"],
    "orders": ["o_orderkey"],
    "lineitem": ["l_orderkey", "l_linenumber"],
    "events": ["event_id"],
    "documents": ["doc_id"],
    "embeddings": ["vec_id"],
    "pages": ["page_id"],
    "benchmark": ["item_id"],
    "labels": ["doc_id"],
    "conversations": ["conv_id", "turn"],
}


def _check(name: str, subject: str, actual: str) -> str:
    return (
        f"SELECT '{name}' AS check_name, '{subject}' AS subject, CAST(0 AS BIGINT) AS expected, "
        f"CAST(n AS BIGINT) AS actual, CAST(n = 0 AS INTEGER) AS ok FROM ({actual})"
    )


@query(
    "check_primary_keys",
    " UNION ALL ".join(
        _check("primary_key", t, f"SELECT count(*) - count(DISTINCT ({', '.join(k)})) AS n FROM {t}")
        for t, k in _KEYS.items()
    ),
)
def _(r):
    return quality.union([quality.primary_key(r.table(t), t, k) for t, k in _KEYS.items()])


_REFERENCES = (
    ("nation", "n_regionkey", "region", "r_regionkey"),
    ("customer", "c_nationkey", "nation", "n_nationkey"),
    ("supplier", "s_nationkey", "nation", "n_nationkey"),
    ("orders", "o_custkey", "customer", "c_custkey"),
    ("lineitem", "l_orderkey", "orders", "o_orderkey"),
    ("lineitem", "l_partkey", "part", "p_partkey"),
    ("lineitem", "l_suppkey", "supplier", "s_suppkey"),
    ("events", "user_id", "customer", "c_custkey"),
)


@query(
    "check_foreign_keys",
    " UNION ALL ".join(
        _check("foreign_key", f"{c}.{k}", f"SELECT count(*) AS n FROM {c} WHERE {k} NOT IN (SELECT {pk} FROM {p})")
        for c, k, p, pk in _REFERENCES
    ),
)
def _(r):
    return quality.union(
        [quality.foreign_key(r.table(c), r.table(p), f"{c}.{k}", k, pk) for c, k, p, pk in _REFERENCES]
    )


_RULES = {
    "orders": {
        "orders.o_orderdate not null": "o_orderdate IS NULL",
        "orders.o_totalprice not negative": "o_totalprice < 0",
        "orders.o_orderpriority fits 10": "length(o_orderpriority) > 10",
    },
    "lineitem": {
        "lineitem.l_linenumber from 1": "l_linenumber < 1",
        "lineitem.l_discount at most 0.08": "l_discount > 0.08",
        "lineitem.l_returnflag in R A": "l_returnflag NOT IN ('R', 'A')",
    },
    "customer": {"customer.c_acctbal not negative": "c_acctbal < 0"},
}


@query(
    "check_domains",
    " UNION ALL ".join(
        _check("domain", name, f"SELECT count(*) AS n FROM {t} WHERE {bad}")
        for t, rules in _RULES.items()
        for name, bad in rules.items()
    ),
)
def _(r):
    return quality.union(
        [quality.domains(r.table(t), {n: F.expr(bad) for n, bad in rules.items()}) for t, rules in _RULES.items()]
    )


@query(
    "check_tie_outs",
    sql(
        "SELECT 'tie_out' AS check_name, s AS subject, e AS expected, a AS actual, CAST(e = a AS INTEGER) AS ok FROM ("
        "SELECT 'last funnel step = converting sessions' AS s, (SELECT count(DISTINCT website_session_id) FROM web_orders) AS e, "
        "(SELECT count(DISTINCT website_session_id) FROM pageviews WHERE pageview_url = '/thank-you-for-your-order') AS a UNION ALL "
        "SELECT 'devices sum to sessions', (SELECT count(*) FROM sessions), "
        "(SELECT CAST(sum(n) AS BIGINT) FROM (SELECT count(*) AS n FROM sessions WHERE device_type IN ('desktop', 'mobile') GROUP BY device_type)) UNION ALL "
        "SELECT 'visit devices sum to visits', (SELECT count(*) FROM visits), "
        "(SELECT count(*) FROM visits WHERE device_type IN ('desktop', 'mobile')) UNION ALL "
        f"SELECT 'item prices sum to order prices', (SELECT CAST(sum({cents('o_totalprice')}) AS BIGINT) FROM orders), "
        f"(SELECT CAST(sum({cents('l_extendedprice')}) AS BIGINT) FROM lineitem) UNION ALL "
        "SELECT 'orders with items = orders', (SELECT count(*) FROM orders), (SELECT count(DISTINCT l_orderkey) FROM lineitem))",
        "sessions",
        "web_orders",
        "pageviews",
        "visits",
    ),
)
def _(r):
    last_step = funnel.funnel(r.web_pageviews).select("reached_thankyou")
    converting = r.web_orders.select("website_session_id").distinct().agg(exact.rows())
    return quality.union(
        [
            quality.tie_out("last funnel step = converting sessions", converting, last_step),
            quality.segments_sum_to_total(
                "devices sum to sessions",
                r.web_sessions,
                sessions.session_counts(r.web_sessions, [F.col("device_type")]),
                "sessions",
            ),
            quality.segments_sum_to_total(
                "visit devices sum to visits",
                r.visits,
                sessions.session_counts(r.visits, [F.col("device_type")]),
                "sessions",
            ),
            # these two set one table against another, and say so where the data does not tie
            quality.tie_out(
                "item prices sum to order prices",
                r.orders.agg(exact.sum_cents("price_usd")),
                r.items.agg(exact.sum_cents("price_usd")),
            ),
            quality.tie_out(
                "orders with items = orders",
                r.orders.agg(exact.rows()),
                r.items.select("order_id").distinct().agg(exact.rows()),
            ),
        ]
    )


@query(
    "check_price_dependency",
    sql(
        "SELECT p_brand AS product_name, count(DISTINCT c) AS distinct_prices, "
        f"{dollars('min(c)')} AS lowest, {dollars('max(c)')} AS highest FROM g GROUP BY 1 HAVING count(DISTINCT c) > 1",
        g=f"SELECT p_brand, {cents('p_retailprice')} AS c FROM part",
    ),
)
def _(r):
    priced = r.table("part").select(
        F.col("p_brand").alias("product_name"), exact.money(F.col("p_retailprice")).alias("price")
    )
    return quality.price_dependency(priced, "product_name", "price")


@query(
    "check_partial_periods",
    sql(
        f"SELECT {label('m')} AS month, n, CAST((SELECT min(o_orderdate) FROM orders) > m "
        "OR (SELECT max(o_orderdate) FROM orders) < last_day(m) AS INTEGER) AS is_partial "
        "FROM (SELECT date_trunc('month', o_orderdate) AS m, count(*) AS n FROM orders GROUP BY 1)"
    ),
)
def _(r):
    return quality.partial_periods(r.orders, "created_at")


@query(
    "check_right_censoring",
    sql(
        f"SELECT {label('m')} AS month, n, CAST(last_day(m) > (SELECT CAST(max(o_orderdate) AS DATE) FROM orders) - 90 AS INTEGER) AS right_censored "
        "FROM (SELECT date_trunc('month', o_orderdate) AS m, count(*) AS n FROM orders GROUP BY 1)"
    ),
)
def _(r):
    months = r.orders.groupBy(F.trunc(F.col("created_at").cast("date"), "month").alias("m")).agg(
        exact.rows().alias("n")
    )
    seen = r.orders.agg(F.max("created_at").cast("date")).scalar()
    flagged = quality.right_censored(months, F.last_day("m"), seen, 90)
    return flagged.select(F.substring(F.col("m").cast("string"), 1, 7).alias("month"), "n", "right_censored")


@query(
    "check_simulation_signals",
    sql(
        "SELECT signal, observed, CAST(CASE WHEN signal LIKE 'refunds%' THEN observed = 0 ELSE observed > 0 END AS INTEGER) AS verdict FROM ("
        "SELECT 'segments with exactly zero repeats' AS signal, count(*) AS observed FROM "
        "(SELECT utm_campaign FROM sessions GROUP BY 1 HAVING sum(is_repeat_session) = 0) UNION ALL "
        "SELECT 'frequency tiers larger than the tier before', count(*) FILTER (WHERE u > p) FROM "
        "(SELECT u, lag(u) OVER (ORDER BY n) AS p FROM (SELECT n, count(*) AS u FROM "
        "(SELECT user_id, count(*) AS n FROM sessions GROUP BY 1) GROUP BY 1)) UNION ALL "
        "SELECT 'refunds that differ from the price', count(*) FILTER (WHERE refunded = 1 AND refund <> price) FROM items)",
        "sessions",
        "items",
    ),
)
def _(r):
    return quality.simulation_signals(
        sessions.repeat_share(r.web_sessions),
        users.sessions_per_user(r.web_sessions),
        r.item_facts.where(F.col("refunded") == 1),
    )


# --- exchange and layout -----------------------------------------------------------

_CAMPAIGN_CSV = T.StructType(
    [
        T.StructField("utm_campaign", T.StringType()),
        T.StructField("sessions", T.LongType()),
        T.StructField("orders", T.LongType()),
        T.StructField("conversion_rate_pct", T.DecimalType(10, 2)),
        T.StructField("revenue", T.DecimalType(24, 2)),
        T.StructField("revenue_per_session", T.DecimalType(12, 2)),
    ]
)


@query(
    "csv_exchange",
    sql(
        f"SELECT utm_campaign, {SESSIONS} AS sessions, {ORDERS} AS orders, {percent(CONVERTED, SESSIONS, 2)} AS conversion_rate_pct, "
        f"{dollars(REVENUE)} AS revenue, {per_unit(REVENUE, SESSIONS)} AS revenue_per_session FROM vjoined GROUP BY 1",
        "vjoined",
    ),
)
def _(r):
    """Export a result with NULL as text, then scan it back under its schema."""
    path = layout.scratch_path(r.spark, "csv")
    csv.write_result(sessions.campaign_performance(r.visits, r.visit_orders), path)
    return csv.null_text(csv.read(r.spark, path, _CAMPAIGN_CSV), ["utm_campaign"])


_ORDERS_CSV = T.StructType(
    [
        T.StructField("order_id", T.LongType()),
        T.StructField("created_at", T.TimestampNTZType()),
        T.StructField("price_usd", T.DecimalType(18, 2)),
        T.StructField("priority", T.StringType()),
    ]
)


@query(
    "csv_files_as_one_table",
    sql(
        "SELECT CAST(year(o_orderdate) AS INTEGER) AS year_, count(*) AS orders, "
        f"{dollars('sum(' + cents('o_totalprice') + ')')} AS revenue, "
        "CAST(max(length(o_orderpriority)) AS INTEGER) AS longest_priority FROM orders GROUP BY 1"
    ),
)
def _(r):
    """Orders written as CSV twice, even years with CRLF and odd years with LF, and read as one typed table.

    The text column is last on the line: a carriage return that stayed would make it longer.
    """
    orders = r.orders.select("order_id", "created_at", exact.money(F.col("price_usd")).alias("price_usd"), "priority")
    paths = []
    for odd, ending in ((0, "\r\n"), (1, "\n")):
        paths.append(layout.scratch_path(r.spark, "yearly-csv"))
        csv.write_result(orders.where(F.year("created_at") % 2 == odd), paths[-1], ending)
    read = csv.read(r.spark, paths, _ORDERS_CSV)
    return read.groupBy(F.year("created_at").alias("year_")).agg(
        exact.rows().alias("orders"),
        exact.from_cents(exact.sum_cents("price_usd")).alias("revenue"),
        F.max(F.length("priority")).alias("longest_priority"),
    )


@query(
    "month_layout",
    sql(
        f"SELECT CAST(year(o_orderdate) AS INTEGER) AS year_, CAST(month(o_orderdate) AS INTEGER) AS month_, count(*) AS orders, "
        f"{dollars('sum(' + cents('o_totalprice') + ')')} AS revenue FROM orders GROUP BY 1, 2"
    ),
)
def _(r):
    """Lay the order table out by month and read it back through its partition columns."""
    laid_out = load.by_month(r.orders, "created_at", ("created_at", "order_id"))
    return laid_out.groupBy("year_", "month_").agg(exact.rows().alias("orders"), exact.from_cents(exact.sum_cents("price_usd")).alias("revenue"))
