"""Formulas fed with published aggregates must give the published numbers."""

from __future__ import annotations

from pyspark.sql import functions as F

from tillwise.functions.rules import CHECKOUT_STEPS
from tillwise.operators import effects, funnel, returns, sessions, users

from .conftest import rows

YEARS = [(2012, 62470, 2586, "129274.14"), (2013, 112781, 7447, "393276.07"), (2014, 233422, 16860, "1075668.00"), (2015, 64198, 5420, "340376.00")]
FUNNEL = (472871, 261231, 210214, 94953, 64484, 52058, 32313)


def money(spark, data, schema):
    return spark.createDataFrame(data, schema).withColumn("revenue", F.col("revenue").cast("decimal(20,2)"))


def wide(spark):
    return spark.createDataFrame([FUNNEL], ", ".join(f"{n} long" for n in ["sessions", *[s.name for s in CHECKOUT_STEPS]]))


def test_growth_of_revenue_per_session(spark):
    t = money(spark, YEARS, "year_ int, sessions long, orders long, revenue string")
    assert rows(effects.growth_decomposition(t)) == [(2012, 2015, "2.56", "2.04", "1.26")]


def test_funnel_step_conversion_and_losses(spark):
    got = funnel.funnel_steps(wide(spark)).orderBy("step_no").collect()
    assert [str(r.step_conversion_pct) for r in got] == ["None", "55.2", "80.5", "45.2", "67.9", "80.7", "62.1"]
    assert [r.lost for r in got] == [None, 211640, 51017, 115261, 30469, 12426, 19745]


def test_abandoned_value_at_the_last_step(spark):
    orders = money(spark, [(1, "1938509.75")], "id int, revenue string")
    steps = funnel.funnel_steps(wide(spark))
    # 32,313 orders at 1,938,509.75 average 59.99
    many = orders.select(F.explode(F.sequence(F.lit(1), F.lit(32313))).alias("i"), F.when(F.col("i") == 1, F.col("revenue")).otherwise(0).alias("price_usd"))
    got = rows(funnel.abandoned_value(steps, many).where("step_no = 6"), "avg_order_value", "abandoned_value")
    assert got == [("59.99", "1184502.55")]


def test_orders_gained_by_a_point(spark):
    got = funnel.sensitivity(wide(spark)).orderBy("step_no").collect()
    assert got[0].extra_orders_per_point == 586 and str(got[0].onward_conversion_pct) == "12.4"
    assert got[-1].extra_orders_per_point == 521


def test_channel_shares_and_relative_value(spark):
    t = money(
        spark,
        [("Paid", 389543, 26195, "1567076.72"), ("Organic Search", 43411, 3262, "196809.19"), ("Direct", 39917, 2856, "174623.84")],
        "channel string, sessions long, orders long, revenue string",
    )
    assert rows(sessions.channel_share(t)) == [
        ("Direct", 39917, "8.4", "1.09"),
        ("Organic Search", 43411, "9.2", "1.13"),
        ("Paid", 389543, "82.4", "1.00"),
    ]


def test_segments_improve_and_cost(spark):
    years = spark.createDataFrame(
        [("desktop", 2012, 46575, 2353), ("desktop", 2015, 44742, 4740), ("mobile", 2012, 15895, 233), ("mobile", 2015, 19456, 680)],
        "device string, y int, sessions long, orders long",
    )
    assert rows(effects.relative_improvement(years, "device", "y"), "device", "improvement") == [("desktop", "2.10"), ("mobile", "2.38")]
    overall = money(
        spark,
        [("desktop", 327027, 27805, "1665774.00"), ("mobile", 145844, 4508, "272734.00")],
        "device string, sessions long, orders long, revenue string",
    )
    [(_, orders, expected, missing, value)] = rows(effects.opportunity_cost(overall, "device", "desktop"))
    assert (orders, expected, missing) == (4508, 12400, 7892)
    assert 476_500 < float(value) < 478_000


def test_mix_shift_between_two_windows(spark):
    t = money(
        spark,
        [("desktop", "year", 666, "3902.76"), ("mobile", "year", 334, "704.74"), ("desktop", "q1", 602, "3200.00"), ("mobile", "q1", 398, "840.00")],
        "device string, w string, sessions long, revenue string",
    )
    [(total, mix, rate)] = rows(effects.mix_shift(t, "device", "w", F.lit("year"), F.lit("q1")))
    assert (total, mix) == ("-0.57", "-0.24")
    assert round(float(mix) + float(rate), 2) == float(total)


def test_composition_explains_most_of_a_conversion_lead(spark):
    t = spark.createDataFrame(
        [("brand", 0, 15019, 1071), ("brand", 1, 26224, 2141), ("nonbrand", 0, 337615, 22640)],
        "c string, rep int, sessions long, orders long",
    )
    got = rows(effects.composition_vs_performance(t, "c", "rep", "brand", "nonbrand", 0))
    assert got == [("1.08", "0.43", "0.66", "61")]


def test_second_purchases_against_return_visits(spark):
    tiers = spark.createDataFrame([(1, 31105), (2, 565), (3, 26)], "orders_per_user long, customers long")
    assert rows(users.repeat_purchase_counts(tiers, F.lit(6149))) == [(617, 6149, 5532, "90.0")]


def test_excess_refunds_over_the_baseline(spark):
    t = spark.createDataFrame(
        [("A", "rest of 2014", 10106, 371), ("A", "2014-08", 958, 132), ("A", "2014-09", 1056, 140)],
        "product_name string, order_month string, items_sold long, items_refunded long",
    )
    got = returns.excess_vs_baseline(t, F.col("order_month").isin("2014-08", "2014-09"), F.lit("49.99").cast("decimal(10,2)"))
    assert rows(got) == [("A", "3.67", 272, "73.9", "198.1", "9901")]


def test_only_one_product_moved(spark):
    t = spark.createDataFrame(
        [("A", "base", 10106, 371), ("A", "2014-08", 2014, 272), ("B", "base", 4000, 240), ("B", "2014-08", 600, 40)],
        "product_name string, order_month string, items_sold long, items_refunded long",
    )
    assert rows(returns.peer_check(t, F.col("order_month") == "2014-08"), "product_name", "moved") == [("A", 1), ("B", 0)]


def test_role_gaps(spark):
    t = spark.createDataFrame(
        [("B", 0, 1917, 110), ("B", 1, 3068, 191), ("C", 0, 993, 19), ("C", 1, 4803, 110), ("D", 0, 4437, 57), ("D", 1, 581, 7), ("A", 0, 365, 8), ("A", 1, 23861, 1229)],
        "product_name string, is_primary_item int, items_sold long, items_refunded long",
    )
    assert rows(returns.gap_by_role(t), "product_name", "gap_points") == [("A", "2.96"), ("B", "0.49"), ("C", "0.38"), ("D", "-0.08")]


def test_net_revenue(spark):
    items = money(spark, [("1938509.75",)], "revenue string").withColumnRenamed("revenue", "price_usd")
    refunds = money(spark, [("85338.69",)], "revenue string").withColumnRenamed("revenue", "refund_amount_usd")
    assert rows(returns.net_revenue(items, refunds)) == [("1938509.75", "85338.69", "1853171.06", "4.4")]
