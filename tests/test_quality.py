from __future__ import annotations

from datetime import datetime
from decimal import Decimal

from pyspark.sql import functions as F

from tillwise.operators import quality, sessions, users

from . import shop
from .conftest import rows


def tables(spark):
    return {
        "products": shop.products(spark),
        "website_sessions": shop.sessions(spark),
        "website_pageviews": shop.pageviews(spark),
        "orders": shop.orders(spark),
        "order_items": shop.items(spark),
        "order_item_refunds": shop.refunds(spark),
    }


def failures(df):
    return rows(df.where("ok = 0"), "check_name", "subject", "expected", "actual")


def test_a_sound_load_passes_every_check(spark):
    counts = {"products": 3, "website_sessions": 6, "website_pageviews": 17, "orders": 4, "order_items": 5, "order_item_refunds": 3}
    result = quality.run(tables(spark), counts)
    assert failures(result) == []
    assert result.count() > 50


def test_each_kind_of_damage_is_found(spark):
    t = tables(spark)
    t["orders"] = t["orders"].union(t["orders"].where("order_id = 104"))
    t["order_items"] = t["order_items"].withColumn("order_id", F.when(F.col("order_item_id") == 1003, 999).otherwise(F.col("order_id")))
    t["website_pageviews"] = t["website_pageviews"].withColumn("pageview_url", F.when(F.col("pageview_url") == "/cart", F.repeat(F.lit("x"), 51)).otherwise(F.col("pageview_url")))
    t["products"] = t["products"].withColumn("created_at", F.when(F.col("product_id") == 2, F.col("created_at")))
    t["website_sessions"] = t["website_sessions"].withColumn("is_repeat_session", F.col("is_repeat_session") * 2)
    assert failures(quality.run(t, {"orders": 4})) == [
        ("domain", "products.created_at not null", 0, 2),
        ("domain", "website_pageviews.pageview_url fits 50", 0, 1),
        ("domain", "website_sessions.is_repeat_session is 0 or 1", 0, 1),
        ("foreign_key", "order_items.order_id", 0, 1),
        ("primary_key", "orders", 0, 1),
        ("row_count", "orders", 4, 5),
    ]


def test_segments_tie_out(spark):
    s = shop.sessions(spark)
    by_device = sessions.session_counts(s, [F.col("device_type")])
    assert rows(quality.segments_sum_to_total("d", s, by_device, "sessions"), "expected", "actual", "ok") == [(6, 6, 1)]
    assert rows(quality.segments_sum_to_total("d", s, by_device.where("device_type = 'mobile'"), "sessions"), "ok") == [(0,)]


def test_carriage_returns_and_prices(spark):
    df = spark.createDataFrame([("Bear\r",), ("Bear",)], "name string")
    assert rows(quality.text_lengths(df, "name")) == [("Bear", 4, 0), ("Bear\r", 5, 1)]
    assert rows(quality.price_dependency(shop.items(spark), "product_id", "price_usd")) == []
    two = shop.items(spark).withColumn("price_usd", F.when(F.col("order_item_id") == 1005, Decimal("1.00")).otherwise(F.col("price_usd")))
    assert rows(quality.price_dependency(two, "product_id", "price_usd")) == [(1, 2, "1.00", "49.99")]


def test_partial_and_censored_months(spark):
    days = [datetime(2012, 3, 19), datetime(2012, 4, 1), datetime(2012, 4, 30), datetime(2012, 5, 31)]
    df = spark.createDataFrame([(d,) for d in days], "ts timestamp_ntz")
    got = quality.partial_periods(df, "ts")
    assert rows(got) == [("2012-03", 1, 1), ("2012-04", 2, 0), ("2012-05", 1, 0)]
    months = spark.sql("SELECT explode(array(date '2015-01-31', date '2015-02-28')) AS last")
    flagged = quality.right_censored(months, F.col("last"), F.lit("2015-03-19").cast("date"), 30)
    assert [r.right_censored for r in flagged.orderBy("last").collect()] == [0, 1]


def test_simulation_signals(spark):
    frequency = spark.createDataFrame([(1, 343048), (2, 37386), (3, 485), (4, 13399)], "sessions_per_user long, users long")
    share = spark.createDataFrame([("brand", 26224), ("nonbrand", 0)], "utm_campaign string, repeated_sessions long")
    full = spark.createDataFrame([(Decimal("49.99"), Decimal("49.99"))], "refund_amount_usd decimal(10,2), price_usd decimal(10,2)")
    assert [r[1:] for r in rows(quality.simulation_signals(share, frequency, full))] == [(1, 1), (0, 1), (1, 1)]
    calm = users.sessions_per_user(shop.sessions(spark))
    partial = full.withColumn("refund_amount_usd", F.lit(Decimal("10.00")))
    assert [r[2] for r in rows(quality.simulation_signals(share.where("repeated_sessions > 0"), calm, partial))] == [0, 0, 0]


def test_latest_per_key_settles_ties(spark):
    df = spark.createDataFrame(
        [(1, datetime(2020, 1, 1), "a"), (1, datetime(2020, 1, 2), "b"), (1, datetime(2020, 1, 2), "c"), (2, datetime(2020, 1, 1), None)],
        "k int, t timestamp_ntz, v string",
    )
    assert rows(quality.latest_per_key(df, ["k"], ["t"]), "k", "v") == [(1, "c"), (2, None)]
