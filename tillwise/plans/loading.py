"""Loads: keys in any spelling, months that come again, files with bad lines."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import exact
from ..functions.collation import collated, one_spelling
from ..functions.rules import CHECKOUT_STEPS
from ..operators import funnel, sessions
from ..sources import layout, lookup, months, quarantine
from .oracle import CONVERTED, ORDERS, REVENUE, SESSIONS, big, cents, dollars, half_up, per_unit, percent, sql
from .registry import query

# --- keys in any spelling ----------------------------------------------------


def _respelled(text: str, n: str) -> str:
    return f"CASE WHEN {n} % 4 = 1 THEN upper({text}) WHEN {n} % 4 = 2 THEN translate({text}, 'ao', 'áö') ELSE {text} END"


def _plain(text: str) -> str:
    return f"lower(strip_accents({text}))"


def _chosen(table: str, column: str) -> str:
    """Class of a spelling and the text that stands for it: the most frequent, then the smallest."""
    return (
        f"SELECT k, s AS chosen FROM (SELECT {_plain(column)} AS k, {column} AS s, row_number() OVER "
        f"(PARTITION BY {_plain(column)} ORDER BY count(*) DESC, {column}) AS i FROM {table} WHERE {column} IS NOT NULL GROUP BY 1, 2) WHERE i = 1"
    )


@query(
    "campaign_performance_any_spelling",
    sql(
        f"SELECT chosen AS utm_campaign, {SESSIONS} AS sessions, {ORDERS} AS orders, {percent(CONVERTED, SESSIONS, 2)} AS conversion_rate_pct, "
        f"{dollars(REVENUE)} AS revenue, {per_unit(REVENUE, SESSIONS)} AS revenue_per_session FROM mixed LEFT JOIN visit_orders USING (website_session_id) "
        f"LEFT JOIN named ON k = {_plain('utm_campaign')} GROUP BY 1",
        "visits",
        "visit_orders",
        mixed=f"SELECT * REPLACE ({_respelled('lower(utm_campaign)', 'website_session_id')} AS utm_campaign) FROM visits",
        named=_chosen("mixed", "utm_campaign"),
    ),
)
def _(r):
    """Campaigns spelled in capitals or with accents are one campaign; a session without one stays a group of its own."""
    return sessions.campaign_performance(one_spelling(r.mixed_visits, ["utm_campaign"]), r.visit_orders)


_REACHED = {
    "reached_products": "= '/products'",
    "reached_product_detail": "LIKE '/the-%'",
    "reached_cart": "= '/cart'",
    "reached_shipping": "= '/shipping'",
    "reached_billing": "IN ('/billing', '/billing-2')",
    "reached_thankyou": "= '/thank-you-for-your-order'",
}


@query(
    "conversion_funnel_any_spelling",
    sql(
        "SELECT count(DISTINCT website_session_id) AS sessions, "
        + ", ".join(f"count(DISTINCT CASE WHEN u {test} THEN website_session_id END) AS {name}" for name, test in _REACHED.items())
        + " FROM mixed",
        "pageviews",
        mixed=f"SELECT website_session_id, {_plain(_respelled('pageview_url', 'event_id'))} AS u FROM pageviews",
    ),
)
def _(r):
    """Equality, lists and prefixes of the funnel's steps follow the column's collation; sessions are grouped, so nothing sorts by text."""
    return funnel.funnel(collated(r.mixed_pageviews, ["pageview_url"]), steps=CHECKOUT_STEPS)


@query(
    "refund_rate_any_spelling",
    sql(
        f"SELECT chosen AS product_name, count(*) AS items_sold, {big('sum(refunded)')} AS items_refunded, {half_up('100 * sum(refunded)', 'count(*)', 2)} AS refund_rate_pct "
        f"FROM items JOIN mixed USING (product_id) LEFT JOIN named ON k = {_plain('mixed.name')} GROUP BY 1",
        "items",
        mixed=f"SELECT p_partkey AS product_id, {_respelled('lower(p_brand)', 'p_partkey')} AS name FROM part",
        named=_chosen("mixed", "name"),
    ),
)
def _(r):
    """Products are named once per product, so only the product table is brought to one spelling."""
    per_product = r.item_facts.groupBy("product_id").agg(exact.rows().alias("items_sold"), F.count("refunded").alias("items_refunded"))
    named = one_spelling(r.mixed_products, ["product_name"]).select("product_id", "product_name")
    t = per_product.join(named, "product_id").groupBy("product_name").agg(F.sum("items_sold").alias("items_sold"), F.sum("items_refunded").alias("items_refunded"))
    return t.withColumn("refund_rate_pct", exact.percent(F.col("items_refunded"), F.col("items_sold"), 2))


@query(
    "source_sessions_any_spelling",
    sql(
        "SELECT CASE WHEN k IS NOT NULL THEN 'Paid' WHEN http_referer IS NOT NULL THEN 'Organic Search' ELSE 'Direct' END AS channel, k AS utm_source, count(*) AS sessions, "
        "count(DISTINCT user_id) AS users FROM (SELECT *, utm_source AS k FROM sessions) GROUP BY 1, 2",
        "sessions",
    ),
)
def _(r):
    """Sources come back in the spelling that is declared for them, so that it does not depend on what the files hold."""
    mixed = r.web_sessions.withColumn("utm_source", r._respelled(F.col("utm_source"), F.col("user_id")))
    t = one_spelling(mixed, ["utm_source"], known={"utm_source": ["search_a", "search_b"]})
    channel = F.when(F.col("utm_source").isNotNull(), "Paid").when(F.col("http_referer").isNotNull(), "Organic Search").otherwise("Direct")
    return t.groupBy(channel.alias("channel"), "utm_source").agg(exact.rows().alias("sessions"), F.countDistinct("user_id").alias("users"))


# --- months that come again --------------------------------------------------


@query(
    "months_loaded_again",
    sql(
        f"SELECT CAST(year(o_orderdate) AS INTEGER) AS year_, CAST(month(o_orderdate) AS INTEGER) AS month_, count(*) AS orders, "
        f"{dollars('sum(' + cents('o_totalprice') + ')')} AS revenue FROM orders GROUP BY 1, 2"
    ),
)
def _(r):
    """Orders loaded by month with 1997 incomplete and March 1998 wrong, then these months loaded again; the table is as if it had come right at once."""
    path = layout.scratch_path(r.spark, "months")
    orders = r.orders.select("order_id", "created_at", exact.money(F.col("price_usd")).alias("price_usd"))
    late = (F.year("created_at") == 1997) & (F.col("order_id") % 3 == 0)
    wrong = (F.year("created_at") == 1998) & (F.month("created_at") == 3)
    first = orders.where(~late).withColumn("price_usd", F.when(wrong, F.col("price_usd") * 2).otherwise(F.col("price_usd")).cast("decimal(18,2)"))
    months.load_months(first, path, "created_at", ("created_at", "order_id"))
    months.load_months(orders.where((F.year("created_at") == 1997) | wrong), path, "created_at", ("created_at", "order_id"))
    t = months.open_months(r.spark, path)
    return t.groupBy("year_", "month_").agg(exact.rows().alias("orders"), exact.from_cents(exact.sum_cents("price_usd")).alias("revenue"))


# --- files with bad lines ----------------------------------------------------

_LINES = T.StructType(
    [
        T.StructField("order_id", T.LongType(), False),
        T.StructField("created_at", T.TimestampNTZType(), False),
        T.StructField("price_usd", T.DecimalType(18, 2), False),
        T.StructField("priority", T.StringType()),
    ]
)

_FAULT = (
    "CASE WHEN o_orderkey % 97 = 0 THEN 'too few columns' WHEN o_orderkey % 89 = 0 THEN 'too many columns' WHEN o_orderkey % 83 = 0 THEN 'price_usd is not decimal(18,2)' "
    "WHEN o_orderkey % 79 = 0 THEN 'created_at is not timestamp_ntz' WHEN o_orderkey % 73 = 0 THEN 'no value in order_id' END"
)


def _faulty_lines(r):
    """Orders as CSV lines, some of them spoiled in one of five ways."""
    i = F.col("order_id")
    price = exact.money(F.col("price_usd")).cast("string")
    day = F.substring(F.col("created_at").cast("string"), 1, 19)
    priority = F.when(F.col("priority") == "4-NOT SPECIFIED", "NULL").otherwise(F.concat(F.lit('"'), F.col("priority"), F.lit(', set"')))
    line = (
        F.when(i % 97 == 0, F.concat_ws(",", i, day))
        .when(i % 89 == 0, F.concat_ws(",", i, day, price, priority, F.lit("more")))
        .when(i % 83 == 0, F.concat_ws(",", i, day, F.concat(F.lit("$"), price), priority))
        .when(i % 79 == 0, F.concat_ws(",", i, F.lit("yesterday"), price, priority))
        .when(i % 73 == 0, F.concat_ws(",", F.lit(""), day, price, priority))
        .otherwise(F.concat_ws(",", i, day, price, priority))
    )
    return r.orders.select(line.alias("value"), F.year("created_at").alias("year"))


@query(
    "csv_with_bad_lines",
    sql(
        f"SELECT reason, count(*) AS lines, {dollars('sum(CASE WHEN reason IS NULL THEN c END)')} AS revenue, "
        "count(DISTINCT CASE WHEN reason IS NULL THEN o_orderpriority END) AS priorities FROM f GROUP BY 1",
        f=f"SELECT {_FAULT} AS reason, {cents('o_totalprice')} AS c, NULLIF(o_orderpriority, '4-NOT SPECIFIED') AS o_orderpriority FROM orders",
    ),
)
def _(r):
    """Files with bad lines among good ones: the good are loaded, the bad are counted by reason, and no line is lost."""
    path = layout.scratch_path(r.spark, "faulty-csv")
    _faulty_lines(r).write.partitionBy("year").text(path)
    out = layout.scratch_path(r.spark, "two-way")
    good, bad = quarantine.load(r.spark, path, _LINES, out, null_text=["priority"], max_bad_share=0.25)
    loaded = good.agg(F.lit(None).cast("string").alias("reason"), exact.rows().alias("lines"), exact.from_cents(exact.sum_cents("price_usd")).alias("revenue"), F.countDistinct("priority").alias("priorities"))
    aside = bad.groupBy("reason").agg(exact.rows().alias("lines"), F.lit(None).cast("decimal(21,2)").alias("revenue"), F.lit(0).cast("long").alias("priorities"))
    return loaded.union(aside)


# --- point lookups -----------------------------------------------------------


@query(
    "point_lookups",
    sql(
        "SELECT 'user' AS lookup, count(*) AS pageviews FROM events WHERE user_id = 17 UNION ALL "
        "SELECT 'url', count(*) FROM pageviews WHERE pageview_url = '/cart' UNION ALL "
        "SELECT 'day', count(*) FROM events WHERE ts >= TIMESTAMP '2024-01-10' AND ts < TIMESTAMP '2024-01-11' UNION ALL "
        "SELECT 'url and day', count(*) FROM pageviews WHERE pageview_url = '/cart' AND created_at >= TIMESTAMP '2024-01-10' AND created_at < TIMESTAMP '2024-01-11'",
        "pageviews",
    ),
)
def _(r):
    """Pageviews in Morton order of url and day, with a bloom filter on the user: each filter alone skips most of the files."""
    views = r.web_pageviews.withColumn("user_id", F.call_function("div", F.col("website_session_id"), F.lit(1000000))).withColumn("day", F.col("created_at").cast("date"))
    path = layout.scratch_path(r.spark, "lookups")
    lookup.write_for_lookups(views, path, ["pageview_url", "day"], {"user_id": 100_000})
    t = r.spark.read.schema(views.schema).parquet(path)
    day = F.col("day") == F.lit("2024-01-10").cast("date")
    url = F.col("pageview_url") == "/cart"
    out = None
    for name, test in (("user", F.col("user_id") == 17), ("url", url), ("day", day), ("url and day", url & day)):
        one = t.where(test).agg(exact.rows().alias("pageviews")).select(F.lit(name).alias("lookup"), "pageviews")
        out = one if out is None else out.union(one)
    return out
