"""Attributes together, chains of launches, columns from the data, the six declared tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import exact
from ..operators import products, regression, sessions
from ..sources.schemas import SCHEMAS
from .oracle import cents, sql
from .registry import query

_EFFECTS = """
    SELECT p_brand AS b, CAST(p_size AS DOUBLE) AS x, p_retailprice AS y FROM part WHERE p_brand IS NOT NULL AND p_size IS NOT NULL AND p_retailprice IS NOT NULL"""


@query(
    "price_drivers_together",
    sql(
        "SELECT attribute, level, round(effect, 4) AS effect, n, round(r2, 6) AS r_squared FROM ("
        "SELECT 'p_size' AS attribute, NULL AS level, slope AS effect FROM s UNION ALL "
        "SELECT '(intercept)', NULL, my - slope * mx FROM m, s WHERE b = (SELECT min(b) FROM m) UNION ALL "
        "SELECT 'p_brand', b, (my - slope * mx) - (SELECT my - slope * mx FROM m, s WHERE b = (SELECT min(b) FROM m)) FROM m, s), r",
        g=_EFFECTS,
        m="SELECT b, avg(x) AS mx, avg(y) AS my FROM g GROUP BY 1",
        s="SELECT sum((x - mx) * (y - my)) / sum((x - mx) * (x - mx)) AS slope FROM g JOIN m USING (b)",
        r="SELECT count(*) AS n, 1 - sum(((y - my) - slope * (x - mx)) ** 2) / (SELECT sum((y - t.a) ** 2) FROM g, (SELECT avg(y) AS a FROM g) t) AS r2 FROM g JOIN m USING (b), s",
    ),
)
def _(r):
    """Size and brand in one least-squares fit; the first brand is the base."""
    part = r.table("part").select("p_retailprice", "p_size", "p_brand")
    fitted = regression.as_rows(regression.least_squares(part, "p_retailprice", ["p_size"], ["p_brand"]), r.spark)
    # adding zero turns -0.0 into 0.0
    return fitted.select("attribute", "level", (F.round("effect", 4) + 0.0).alias("effect"), "n", F.round("r_squared", 6).alias("r_squared"))


@query(
    "launch_chains",
    sql(
        "SELECT root AS first_launch, count(*) AS launches, CAST(min(launch_day) AS VARCHAR) AS first_day, CAST(max(launch_day) AS VARCHAR) AS last_day "
        "FROM (SELECT launch, launch_day, arg_min(root, (root_day, root)) AS root FROM chain GROUP BY 1, 2) GROUP BY 1",
        "launches",
        chain="SELECT launch AS root, launch_day AS root_day, launch, launch_day FROM launches UNION "
        "SELECT c.root, c.root_day, l.launch, l.launch_day FROM chain c JOIN launches l ON abs(date_diff('day', c.launch_day, l.launch_day)) < 85",
    ).replace("WITH ", "WITH RECURSIVE ", 1),
)
def _(r):
    """Launches that follow on each other within 85 days, however many; a chain is named by its first."""
    launched = r.products.groupBy("product_name").agg(F.min("created_at").cast("date").alias("launch_day")).withColumnRenamed("product_name", "launch")
    chains = products.launch_chains(launched, 85)
    return chains.groupBy("first_launch").agg(exact.rows().alias("launches"), F.min("launch_day").alias("first_day"), F.max("launch_day").alias("last_day"))


@query(
    "yearly_sessions_pivot",
    sql(
        "SELECT CAST(month(created_at) AS INTEGER) AS month_, "
        + ", ".join(f"count(*) FILTER (WHERE year(created_at) = {y}) AS sessions_{y}" for y in range(1995, 2002))
        + " FROM visits GROUP BY 1",
        "visits",
    ),
)
def _(r):
    """A column for every year that the visits have."""
    return sessions.sessions_by_every_year_pivot(r.visits)


@query(
    "declared_shop_tables",
    sql(
        "SELECT * FROM (SELECT 'products' AS table_name, count(*) AS n, count(DISTINCT p_partkey) AS keys, CAST(NULL AS DOUBLE) AS money FROM part UNION ALL "
        f"SELECT 'orders', count(*), count(DISTINCT o_orderkey), CAST(sum({cents('o_totalprice')}) AS DOUBLE) / 100 FROM orders UNION ALL "
        f"SELECT 'order_items', count(*), count(DISTINCT l_orderkey * 10 + l_linenumber), CAST(sum({cents('l_extendedprice')}) AS DOUBLE) / 100 FROM lineitem UNION ALL "
        "SELECT 'order_item_refunds', count(*), (SELECT count(DISTINCT l_orderkey * 10 + l_linenumber) FROM lineitem WHERE l_returnflag = 'R'), "
        "CAST(sum(refund) AS DOUBLE) / 100 FROM items WHERE refunded = 1 UNION ALL "
        "SELECT 'website_sessions', count(*), count(DISTINCT website_session_id), NULL FROM sessions UNION ALL "
        "SELECT 'website_pageviews', count(*), count(DISTINCT event_id), NULL FROM pageviews)",
        "items",
        "sessions",
        "pageviews",
    ),
)
def _(r):
    """The given tables brought under the six declared schemas, types and order of columns included, and counted through them."""
    out = None
    for name, df in r.declared_tables.items():
        kinds = [(f.name, f.dataType.simpleString()) for f in SCHEMAS[name].fields]
        if [(c, t) for c, t in df.dtypes] != kinds:
            raise TypeError(f"{name}: {df.dtypes} are not the declared {kinds}")
        key = SCHEMAS[name].fieldNames()[0]
        money = next((c for c in ("price_usd", "refund_amount_usd") if c in df.columns), None)
        total = exact.from_cents(exact.sum_cents(money)) if money else F.lit(None).cast("decimal(21,2)")
        t = df.agg(exact.rows().alias("n"), F.countDistinct(key).alias("keys"), total.alias("money")).select(F.lit(name).alias("table_name"), "n", "keys", "money")
        out = t if out is None else out.union(t)
    return out
