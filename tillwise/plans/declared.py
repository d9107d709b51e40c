"""Listing, trip and time-series questions."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import calendar, exact
from ..operators import market, quality, quantiles, series, trips
from .oracle import big, cents, dollars, half_up, month, per_unit, percent, sql, year
from .registry import query

YM_ORDER = ["year_", "month_"]


def _months(ts="created_at"):
    return calendar.year_month(F.col(ts))


# --- listings ------------------------------------------------------------------


@query(
    "market_comparison",
    sql(
        f"SELECT city, count(*) AS listings, {per_unit('sum(price)', 'count(price)')} AS avg_price, "
        f"{dollars('quantile_disc(price, 0.5)')} AS median_price, "
        f"{dollars('quantile_disc(price, 0.75) - quantile_disc(price, 0.25)')} AS price_spread FROM listings GROUP BY 1",
        "listings",
    ),
)
def _(r):
    return market.market_comparison(r.listings, "city", "price")


# Rates in force on 2001-12-31, in ten-thousandths.
_RATES = "SELECT * FROM (VALUES ('AFRICA', 561), ('AMERICA', 10000), ('ASIA', 91), ('EUROPE', 10845), ('MIDDLE EAST', 2723)) v(currency, rate)"
_BASE = "SELECT l.*, CAST((2 * price * rate + 10000) // 20000 AS BIGINT) AS base FROM listings l JOIN rates USING (currency)"


def _normalised(r):
    rates = market.rates_as_of(r.rates, F.lit("2001-12-31").cast("date"))
    return market.in_one_currency(r.listings, rates)


@query(
    "currency_normalised_price",
    sql(
        f"SELECT city, currency, count(*) AS listings, {dollars('sum(base)')} AS total_base_price, "
        f"{per_unit('sum(base)', 'count(base)')} AS avg_base_price FROM b GROUP BY 1, 2",
        "listings",
        rates=_RATES,
        b=_BASE,
    ),
)
def _(r):
    t = _normalised(r).groupBy("city", "currency").agg(
        exact.rows().alias("listings"),
        exact.from_cents(exact.sum_cents("base_price")).alias("total_base_price"),
        F.count("base_price").alias("priced"),
    )
    avg = exact.per_unit(F.col("total_base_price"), F.col("priced"))
    return t.withColumn("avg_base_price", avg).drop("priced")


def _goods(r):
    return r.table("part").select(
        "p_size", "p_brand", "p_type", "p_partkey", exact.money(F.col("p_retailprice")).alias("price")
    )


@query(
    "price_drivers_numeric",
    sql(
        "SELECT 'p_size' AS attribute, round(corr(p_retailprice, p_size), 6) AS correlation FROM part "
        "UNION ALL SELECT 'p_partkey', round(corr(p_retailprice, p_partkey), 6) FROM part"
    ),
)
def _(r):
    return market.price_correlations(_goods(r), "price", ["p_size", "p_partkey"])


_LEVEL = (
    "SELECT '{0}' AS attribute, {0} AS level, count(*) AS listings, "
    + per_unit("sum(c)", "count(*)")
    + " AS avg_price, "
    + percent(
        "sum(c) * CAST((SELECT count(*) FROM g) AS HUGEINT) - CAST((SELECT sum(c) FROM g) AS HUGEINT) * count(*)",
        "CAST((SELECT sum(c) FROM g) AS HUGEINT) * count(*)",
        2,
    )
    + " AS pct_vs_overall FROM g GROUP BY 2"
)


@query(
    "price_drivers_by_level",
    sql(
        _LEVEL.format("p_brand") + " UNION ALL " + _LEVEL.format("p_type"),
        g=f"SELECT p_brand, p_type, {cents('p_retailprice')} AS c FROM part",
    ),
)
def _(r):
    return market.price_by_level(_goods(r), "price", ["p_brand", "p_type"])


@query(
    "review_seasonality",
    sql(
        f"SELECT currency, month_, {half_up('sum(n)', 'count(*)', 1)} AS average, "
        f"{percent('sum(n) * CAST(max(k) AS HUGEINT)', 'count(*) * CAST(max(t) AS HUGEINT)', 1)} AS seasonal_index "
        "FROM m JOIN a USING (currency) GROUP BY 1, 2",
        "listings",
        m=f"SELECT currency, {year('o_orderdate')} AS year_, {month('o_orderdate')} AS month_, count(*) AS n "
        "FROM orders JOIN listings ON o_custkey = listing_id GROUP BY 1, 2, 3",
        a="SELECT currency, count(*) AS k, sum(n) AS t FROM m GROUP BY 1",
    ),
)
def _(r):
    monthly = market.reviews_by_market(r.reviews, r.listings, "currency")
    return series.seasonality_index(monthly, ["currency"], "month_", "reviews")


@query(
    "review_trend",
    sql(
        f"SELECT currency, year_, month_, n AS reviews, prev AS last_year, {half_up('n', 'prev', 2)} AS yoy_ratio FROM "
        "(SELECT a.*, b.n AS prev FROM m a LEFT JOIN m b ON a.currency = b.currency AND a.year_ = b.year_ + 1 AND a.month_ = b.month_)",
        "listings",
        m=f"SELECT currency, {year('o_orderdate')} AS year_, {month('o_orderdate')} AS month_, count(*) AS n "
        "FROM orders JOIN listings ON o_custkey = listing_id GROUP BY 1, 2, 3",
    ),
)
def _(r):
    monthly = market.reviews_by_market(r.reviews, r.listings, "currency")
    return series.same_month_last_year(monthly, ["currency"], "reviews")


@query(
    "best_value",
    sql(
        "SELECT *, CAST(rank() OVER (ORDER BY value_score DESC NULLS LAST) AS INTEGER) AS value_rank FROM (SELECT city, listings, "
        f"{dollars('med')} AS median_price, {half_up('n', 'listings', 2)} AS reviews_per_listing, "
        f"{half_up('CAST(n AS HUGEINT) * 100000', 'CAST(listings AS HUGEINT) * med', 4)} AS value_score FROM t)",
        "listings",
        rates=_RATES,
        b=_BASE,
        t="SELECT city, count(*) AS listings, quantile_disc(base, 0.5) AS med, "
        "sum((SELECT count(*) FROM orders WHERE o_custkey = listing_id)) AS n FROM b GROUP BY 1",
    ),
)
def _(r):
    return market.best_value(_normalised(r), r.reviews, "city", "base_price")


# --- trips ---------------------------------------------------------------------

_WEEK = "CAST(date_trunc('week', picked_up_at) AS DATE)"
_WEEKS = f"SELECT {_WEEK} AS w, count(*) AS n FROM trips GROUP BY 1"


@query(
    "weekly_trips",
    sql(
        f"SELECT CAST(w AS VARCHAR) AS week, n AS trips, p AS previous, n - p AS change, {percent('n - p', 'p', 1)} AS change_pct "
        "FROM (SELECT *, lag(n) OVER (ORDER BY w) AS p FROM weeks)",
        "trips",
        weeks=_WEEKS,
    ),
)
def _(r):
    return trips.weekly_trips(r.trips)


@query(
    "average_trips_per_week",
    sql(
        f"SELECT {year('w')} AS year_, count(*) AS weeks, {big('sum(n)')} AS trips, {half_up('sum(n)', 'count(*)', 1)} AS avg_trips_per_week "
        "FROM weeks GROUP BY 1",
        "trips",
        weeks=_WEEKS,
    ),
)
def _(r):
    return trips.average_trips_per_week(r.trips)


_KEPT = "FILTER (WHERE 2 * d >= lo AND 2 * d <= hi)"


@query(
    "avg_distance",
    sql(
        f"SELECT year_, count(*) AS trips, {big('sum(CAST(2 * d < lo OR 2 * d > hi AS INTEGER))')} AS outliers, "
        f"{per_unit('sum(d) ' + _KEPT, 'count(*) ' + _KEPT)} AS avg_distance, {per_unit('sum(d)', 'count(*)')} AS avg_with_outliers FROM v JOIN f USING (year_) GROUP BY 1",
        "trips",
        v=f"SELECT {year('picked_up_at')} AS year_, distance AS d FROM trips",
        f="SELECT year_, 2 * q1 - 3 * (q3 - q1) AS lo, 2 * q3 + 3 * (q3 - q1) AS hi FROM (SELECT year_, quantile_disc(d, 0.25) AS q1, quantile_disc(d, 0.75) AS q3 FROM v GROUP BY 1)",
    ),
)
def _(r):
    return trips.average_distance(r.trips, F.year("picked_up_at").alias("year_"))


@query(
    "busiest_times",
    sql(
        "SELECT CAST(isodow(ts) - 1 AS INTEGER) AS weekday, CAST(hour(ts) AS INTEGER) AS hour, count(*) AS n, "
        "CAST(rank() OVER (ORDER BY count(*) DESC) AS INTEGER) AS busy_rank FROM events GROUP BY 1, 2"
    ),
)
def _(r):
    return trips.busiest_times(r.table("events"), "ts")


@query(
    "time_of_day_volume",
    sql(
        "SELECT CASE WHEN isodow(ts) >= 6 THEN 'weekend' ELSE 'weekday' END AS day_kind, "
        "CASE WHEN hour(ts) < 6 THEN 'night' WHEN hour(ts) < 12 THEN 'morning' WHEN hour(ts) < 18 THEN 'afternoon' ELSE 'evening' END AS time_of_day, "
        "count(*) AS n FROM events GROUP BY 1, 2"
    ),
)
def _(r):
    return trips.volume_by_time_of_day(r.table("events"), "ts")


def _popular(role: str) -> str:
    return sql(
        f"SELECT n_name AS zone, count(*) AS trips FROM trips JOIN nation ON n_nationkey = {role}_zone_id "
        "GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10",
        "trips",
    )


@query("popular_pickups", _popular("pickup"))
def _(r):
    return trips.popular_places(r.pickup_counts, r.zones, 10)


@query("popular_dropoffs", _popular("dropoff"))
def _(r):
    return trips.popular_places(r.dropoff_counts, r.zones, 10)


@query(
    "popular_pairs",
    sql(
        "SELECT p.n_name AS pickup, d.n_name AS dropoff, count(*) AS trips FROM trips "
        "JOIN nation p ON p.n_nationkey = pickup_zone_id JOIN nation d ON d.n_nationkey = dropoff_zone_id "
        "GROUP BY 1, 2 ORDER BY 3 DESC, 1, 2 LIMIT 20",
        "trips",
    ),
)
def _(r):
    return trips.popular_pairs(r.pair_counts, r.zones, 20)


@query(
    "regime_break",
    sql(
        "SELECT n0 AS periods_before, "
        f"{half_up('t0', 'n0', 1)} AS average_before, n1 AS periods_after, {half_up('t1', 'n1', 1)} AS average_after, "
        f"{percent('CAST(t1 AS HUGEINT) * n0 - CAST(t0 AS HUGEINT) * n1', 'CAST(t0 AS HUGEINT) * n1', 1)} AS change_pct FROM "
        "(SELECT count(*) FILTER (WHERE w < DATE '2001-05-07') AS n0, count(*) FILTER (WHERE w >= DATE '2001-05-07') AS n1, "
        "sum(n) FILTER (WHERE w < DATE '2001-05-07') AS t0, sum(n) FILTER (WHERE w >= DATE '2001-05-07') AS t1 FROM weeks)",
        "trips",
        weeks=_WEEKS,
    ),
)
def _(r):
    weeks = trips.weekly_trips(r.trips).select("week", "trips")
    return series.regime_break(weeks, "week", "trips", F.lit("2001-05-07").cast("date"))


_START = "(make_date({0}, 1, 28) + (7 - CAST(dayofweek(make_date({0}, 1, 28)) AS INTEGER)))"


@query(
    "retail_calendar",
    sql(
        "SELECT CAST(ry AS INTEGER) AS retail_year, CAST(3 * (q - 1) + CASE WHEN wk - 13 * (q - 1) <= 4 THEN 1 "
        "WHEN wk - 13 * (q - 1) <= 9 THEN 2 ELSE 3 END AS INTEGER) AS retail_period, "
        "count(DISTINCT wk) AS weeks, count(*) AS trips FROM w GROUP BY 1, 2",
        "trips",
        d="SELECT CAST(picked_up_at AS DATE) AS d, year(picked_up_at) AS y FROM trips",
        s=f"SELECT d, CASE WHEN d >= {_START.format('y')} THEN y ELSE y - 1 END AS ry FROM d",
        k=f"SELECT d, ry, date_diff('day', {_START.format('ry')}, d) // 7 + 1 AS wk FROM s",
        w="SELECT d, ry, wk, least((wk - 1) // 13 + 1, 4) AS q FROM k",
    ),
)
def _(r):
    bounds = r.trips.agg(
        F.min("picked_up_at").cast("date").alias("first"), F.max("picked_up_at").cast("date").alias("last")
    )
    days = calendar.retail_calendar(calendar.spine(bounds, "first", "last", "1 day", "day"))
    return trips.trips_by_retail_period(r.trips, days)


# --- time series -----------------------------------------------------------------


def _monthly_orders(r):
    return r.orders.groupBy("priority", *_months()).agg(
        exact.rows().alias("orders"), exact.from_cents(exact.sum_cents("price_usd")).alias("revenue")
    )


_MONTHLY = (
    f"SELECT o_orderpriority AS priority, {year('o_orderdate')} AS year_, {month('o_orderdate')} AS month_, "
    f"count(*) AS orders, sum({cents('o_totalprice')}) AS c FROM orders GROUP BY 1, 2, 3"
)
_OVER = "OVER (PARTITION BY priority ORDER BY year_, month_{})"


@query(
    "period_over_period",
    sql(
        f"SELECT priority, year_, month_, orders, prev AS previous, nxt AS next, orders - prev AS change, {percent('orders - prev', 'prev', 1)} AS change_pct "
        f"FROM (SELECT *, lag(orders) {_OVER.format('')} AS prev, lead(orders) {_OVER.format('')} AS nxt FROM m)",
        m=_MONTHLY,
    ),
)
def _(r):
    return series.period_over_period(_monthly_orders(r).drop("revenue"), ["priority"], YM_ORDER, "orders")


@query(
    "running_total",
    sql(
        f"SELECT priority, year_, month_, {dollars('c')} AS revenue, {dollars(f'sum(c) {_OVER.format(str())}')} AS running_total FROM m",
        m=_MONTHLY,
    ),
)
def _(r):
    return series.running_total(_monthly_orders(r).drop("orders"), ["priority"], YM_ORDER, "revenue")


@query(
    "moving_average",
    sql(
        f"SELECT priority, year_, month_, orders, {half_up('s', 'k', 2)} AS moving_average FROM (SELECT *, "
        f"sum(orders) {_OVER.format(' ROWS 2 PRECEDING')} AS s, count(*) {_OVER.format(' ROWS 2 PRECEDING')} AS k FROM m)",
        m=_MONTHLY,
    ),
)
def _(r):
    return series.moving_average(_monthly_orders(r).drop("revenue"), ["priority"], YM_ORDER, "orders", 3)


_DAY_REVENUE = dollars(f"coalesce(sum({cents('o_totalprice')}), 0)")


@query(
    "date_spine",
    sql(
        f"SELECT strftime(d, '%Y-%m-%d') AS day, count(o_orderkey) AS orders, {_DAY_REVENUE} AS revenue "
        "FROM generate_series((SELECT min(o_orderdate) FROM orders), (SELECT max(o_orderdate) FROM orders), INTERVAL 1 DAY) g(d) "
        "LEFT JOIN orders ON CAST(o_orderdate AS DATE) = CAST(d AS DATE) GROUP BY 1"
    ),
)
def _(r):
    daily = r.orders.groupBy(F.col("created_at").cast("date").alias("day")).agg(
        exact.rows().alias("orders"), exact.from_cents(exact.sum_cents("price_usd")).alias("revenue")
    )
    bounds = daily.agg(F.min("day").alias("first"), F.max("day").alias("last"))
    return series.zero_filled(daily, calendar.spine(bounds, "first", "last", "1 day", "day"), "day", ["orders", "revenue"])


@query(
    "ranked_within_group",
    sql(
        f"SELECT product_type, product_id, {dollars('v')} AS revenue, CAST(rn AS INTEGER) AS row_number, CAST(rk AS INTEGER) AS rank FROM "
        "(SELECT *, row_number() OVER (PARTITION BY product_type ORDER BY v DESC, product_id) AS rn, "
        "rank() OVER (PARTITION BY product_type ORDER BY v DESC) AS rk FROM "
        f"(SELECT p_type AS product_type, p_partkey AS product_id, sum({cents('l_extendedprice')}) AS v "
        "FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2)) WHERE rn <= 3"
    ),
)
def _(r):
    revenue = r.items.groupBy("product_id").agg(exact.from_cents(exact.sum_cents("price_usd")).alias("revenue"))
    named = revenue.join(r.products.select("product_id", "product_type"), "product_id")
    return series.top_in_group(named, ["product_type"], [F.desc("revenue")], ["product_id"], 3)


# --- deduplication and outliers -----------------------------------------------------


@query(
    "dedup_latest",
    sql(
        f"SELECT l_returnflag, count(*) AS rows_kept, {big('sum(l_partkey)')} AS partkeys, {dollars('sum(' + cents('l_extendedprice') + ')')} AS value FROM "
        "(SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC, "
        "l_quantity DESC, l_extendedprice DESC, l_discount DESC, l_tax DESC, l_returnflag DESC, l_linestatus DESC) AS rn FROM lineitem) "
        "WHERE rn = 1 GROUP BY 1"
    ),
)
def _(r):
    kept = quality.latest_per_key(r.table("lineitem"), ["l_orderkey", "l_linenumber"], ["l_shipdate"])
    return kept.groupBy("l_returnflag").agg(
        exact.rows().alias("rows_kept"),
        F.sum("l_partkey").alias("partkeys"),
        exact.from_cents(exact.sum_cents("l_extendedprice")).alias("value"),
    )


@query(
    "dedup_exact",
    sql("SELECT l_returnflag, l_linestatus, count(*) AS lines FROM (SELECT DISTINCT l_orderkey, l_linenumber, l_returnflag, l_linestatus FROM lineitem) GROUP BY 1, 2"),
)
def _(r):
    lines = r.table("lineitem").select("l_orderkey", "l_linenumber", "l_returnflag", "l_linestatus")
    distinct = lines.dropDuplicates()
    return distinct.groupBy("l_returnflag", "l_linestatus").agg(exact.rows().alias("lines"))


@query(
    "outlier_treatment",
    sql(
        f"SELECT event_type, count(*) AS n, {big('sum(CAST(2 * c < lo OR 2 * c > hi AS INTEGER))')} AS outliers, "
        "CAST(max(lo) AS DOUBLE) / 200 AS low_fence, CAST(max(hi) AS DOUBLE) / 200 AS high_fence, "
        f"{per_unit('sum(c)', 'count(*)')} AS avg_all, CAST(sum(greatest(least(2 * c, hi), lo)) AS DOUBLE) / 200 AS clipped_total, "
        f"{per_unit('sum(c) FILTER (WHERE 2 * c >= lo AND 2 * c <= hi)', 'count(*) FILTER (WHERE 2 * c >= lo AND 2 * c <= hi)')} AS avg_without "
        "FROM v JOIN f USING (event_type) GROUP BY 1",
        v=f"SELECT event_type, {cents('value')} AS c FROM events",
        q="SELECT event_type, quantile_disc(c, 0.25) AS q1, quantile_disc(c, 0.75) AS q3 FROM v GROUP BY 1",
        f="SELECT event_type, 2 * q1 - 3 * (q3 - q1) AS lo, 2 * q3 + 3 * (q3 - q1) AS hi FROM q",
    ),
)
def _(r):
    values = r.table("events").select("event_type", exact.money(F.col("value")).alias("value"))
    t = quantiles.outlier_summary(values, ["event_type"], "value")
    return t.select(
        "event_type",
        "n",
        "outliers",
        "low_fence",
        "high_fence",
        exact.per_unit(F.col("total").cast("decimal(21,2)"), F.col("n")).alias("avg_all"),
        "clipped_total",
        exact.per_unit(F.col("kept_total").cast("decimal(21,2)"), F.col("kept")).alias("avg_without"),
    )
