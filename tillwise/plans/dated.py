"""Amounts at the rate of their own day."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import exact
from ..operators import asof
from .oracle import big, cents, dollars, sql, year
from .registry import query

# The rate history as the roles derive it, in ten-thousandths.
_HISTORY = """
    SELECT currency, CAST(rate * (9800 + (n * 37 + length(currency) * 11) % 401) // 10000 AS BIGINT) AS rate,
           CAST(DATE '1995-07-01' + to_months(CAST(3 * n AS INTEGER)) AS DATE) AS taken_on
    FROM (VALUES ('AFRICA', 543), ('AMERICA', 10000), ('ASIA', 87), ('EUROPE', 10845), ('MIDDLE EAST', 2723)) v(currency, rate),
         (SELECT unnest(range(0, 22)) AS n)"""
_BASE = "CAST((2 * price * rate + 10000) // 20000 AS BIGINT)"


@query(
    "revenue_at_rate_of_day",
    sql(
        f"SELECT cur AS currency, {year('day')} AS year_, count(*) AS orders, count(*) - count(rate) AS without_rate, {dollars('sum(price)')} AS revenue, "
        f"{dollars('sum(' + _BASE + ')')} AS base_revenue FROM o ASOF LEFT JOIN history ON o.cur = history.currency AND o.day >= history.taken_on GROUP BY 1, 2",
        "listings",
        history=_HISTORY,
        o=f"SELECT currency AS cur, CAST(o_orderdate AS DATE) AS day, {cents('o_totalprice')} AS price FROM orders JOIN listings ON o_custkey = listing_id",
    ),
)
def _(r):
    """Orders before a currency's first rate count, without a base price; salted, since one currency may have most orders."""
    priced = asof.in_one_currency(r.dated_orders, r.rate_history, "price_usd", "day", salts=4)
    return priced.groupBy("currency", F.year("day").alias("year_")).agg(
        exact.rows().alias("orders"),
        F.count_if(F.col("rate").isNull()).alias("without_rate"),
        exact.from_cents(exact.sum_cents("price_usd")).alias("revenue"),
        exact.from_cents(exact.sum_cents("base_price")).alias("base_revenue"),
    )


@query(
    "listing_price_at_last_review",
    sql(
        f"SELECT city, count(*) AS listings, count(*) - count(day) AS never_reviewed, {big('sum(CAST(day IS NOT NULL AND rate IS NULL AS INTEGER))')} AS without_rate, "
        f"{dollars('sum(' + _BASE + ')')} AS base_value FROM l ASOF LEFT JOIN history ON l.cur = history.currency AND l.day >= history.taken_on GROUP BY 1",
        "listings",
        history=_HISTORY,
        l="SELECT city, currency AS cur, price, (SELECT max(CAST(o_orderdate AS DATE)) FROM orders WHERE o_custkey = listing_id) AS day FROM listings",
    ),
)
def _(r):
    """Listing prices at the rate of the day of their last review; a listing without a review has no such day and no rate."""
    last = r.reviews.groupBy("listing_id").agg(F.max("created_at").cast("date").alias("day"))
    dated = r.listings.join(last, "listing_id", "left")
    priced = asof.in_one_currency(dated, r.rate_history, "price", "day")
    return priced.groupBy("city").agg(
        exact.rows().alias("listings"),
        F.count_if(F.col("day").isNull()).alias("never_reviewed"),
        F.count_if(F.col("day").isNotNull() & F.col("rate").isNull()).alias("without_rate"),
        exact.from_cents(exact.sum_cents("base_price")).alias("base_value"),
    )
