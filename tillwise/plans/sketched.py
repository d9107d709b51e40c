"""Questions answered from mergeable summaries, each measured against the exact answer."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import calendar, exact
from ..operators import quantiles, sketches
from ..sources import layout
from .oracle import big, sql
from .registry import query


def _kept(r, df, label):
    """A summary table: written once, read by every period."""
    path = layout.scratch_path(r.spark, label)
    df.write.parquet(path)
    return r.spark.read.schema(df.schema).parquet(path)


@query(
    "distinct_customers_by_sketch",
    sql(
        "SELECT 'month' AS grain, strftime(o_orderdate, '%Y-%m') AS period, count(DISTINCT o_custkey) AS customers, true AS within_bound FROM orders GROUP BY 2 "
        "UNION ALL SELECT 'year', strftime(o_orderdate, '%Y'), count(DISTINCT o_custkey), true FROM orders GROUP BY 2"
    ),
)
def _(r):
    """Customers of a month and a year from sketches of their days, beside the exact count and whether the stated bound holds."""
    orders = r.orders.withColumn("day", F.col("created_at").cast("date"))
    daily = _kept(r, sketches.distinct_sketches(orders, ["day"], "user_id"), "daily-sketches")
    out = None
    for grain, length in (("month", 7), ("year", 4)):
        period = F.substring(F.col("day").cast("string"), 1, length).alias("period")
        told = sketches.distinct_rollup(daily, [period])
        right = orders.groupBy(period).agg(F.countDistinct("user_id").alias("customers"))
        off = F.abs(F.col("estimate") - F.col("customers"))
        t = right.join(told, "period").select(F.lit(grain).alias("grain"), "period", "customers", (off <= F.ceil(sketches.distinct_bound() * F.col("customers"))).alias("within_bound"))
        out = t if out is None else out.union(t)
    return out


@query(
    "price_quartiles_by_sketch",
    sql(
        "SELECT l_returnflag AS returnflag, count(*) AS n, true AS q1_within, true AS median_within, true AS q3_within, true AS fences_within FROM lineitem GROUP BY 1"
    ),
)
def _(r):
    """Quartiles and fences of prices from sketches by month, and whether they lie between the exact quantiles a rank error apart."""
    lines = r.table("lineitem").select(F.col("l_returnflag").alias("returnflag"), "l_shipdate", exact.money(F.col("l_extendedprice")).alias("price"))
    monthly = sketches.quantile_sketches(lines, ["returnflag", calendar.month_start(F.col("l_shipdate")).alias("month")], F.rint(F.col("price").cast("double") * 100))
    told = sketches.fences(sketches.quantile_rollup(_kept(r, monthly, "monthly-sketches"), ["returnflag"], {"q1": "0.25", "median": "0.5", "q3": "0.75"}))
    e = sketches.rank_bound()
    probs = {f"{name}_{side}": f"{p + s * e:.6f}" for name, p in (("q1", 0.25), ("median", 0.5), ("q3", 0.75)) for side, s in (("low", -1), ("high", 1))}
    right = quantiles.from_fold(quantiles.fold(lines, ["returnflag"], "price"), ["returnflag"], "price", probs)
    right = right.select("returnflag", "rows", *[(F.col(c) * 100).cast("decimal(20,0)").alias(c) for c in probs])
    t = told.join(right, "returnflag")

    def within(name):
        return F.col(name).between(F.col(f"{name}_low"), F.col(f"{name}_high")).alias(f"{name}_within")

    def fence(a, b, c, d):  # q1 - 1.5 (q3 - q1) or q3 + 1.5 (q3 - q1), from the ends that make it least or greatest
        return F.col(a) + (F.col(b) - F.col(c)) * F.lit(1.5).cast("decimal(2,1)") * d

    low = F.col("low_fence").between(fence("q1_low", "q3_high", "q1_low", -1), fence("q1_high", "q3_low", "q1_high", -1))
    high = F.col("high_fence").between(fence("q3_low", "q3_low", "q1_high", 1), fence("q3_high", "q3_high", "q1_low", 1))
    return t.select("returnflag", F.col("n"), within("q1"), within("median"), within("q3"), (low & high).alias("fences_within"))


@query(
    "busiest_supplier_months",
    sql(
        f"SELECT l_suppkey AS supplier_id, strftime(l_shipdate, '%Y-%m-01') AS month, {big('count(*)')} AS n FROM lineitem GROUP BY 1, 2 "
        "ORDER BY 3 DESC, 1, 2 LIMIT 20"
    ),
)
def _(r):
    """Most frequent pairs of supplier and month; the sketch has room for all pairs here, so its proposals account for every row."""
    lines = r.table("lineitem").select(F.col("l_suppkey").alias("supplier_id"), calendar.month_start(F.col("l_shipdate")).alias("month"))
    return sketches.heavy_hitters(lines, ["supplier_id", "month"], 20)[0]


@query(
    "busiest_part_supplier_pairs",
    sql("SELECT l_partkey AS part_id, l_suppkey AS supplier_id, count(*) AS n FROM lineitem GROUP BY 1, 2 ORDER BY 3 DESC, 1, 2 LIMIT 20"),
)
def _(r):
    """Most frequent pairs of part and supplier: nearly as many pairs as rows, so unless some stand out all are counted."""
    lines = r.table("lineitem").select(F.col("l_partkey").alias("part_id"), F.col("l_suppkey").alias("supplier_id"))
    return sketches.heavy_hitters(lines, ["part_id", "supplier_id"], 20, tracked=4096)[0]
