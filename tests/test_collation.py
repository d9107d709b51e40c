from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tillwise.functions import collation
from tillwise.operators import funnel, sessions

from .conftest import rows

NAMES = ["Brand", "brand", "BRÄND", "brand", "other", None, "Óther", "óTHER", "brand ", None]


def table(spark):
    return spark.createDataFrame([(i, n) for i, n in enumerate(NAMES)], "id int, name string")


def test_one_spelling_stands_for_its_class(spark):
    t = collation.one_spelling(table(spark), ["name"])
    assert t.schema["name"].dataType.simpleString() == "string" and t.columns == ["id", "name"]
    got = [r["name"] for r in t.orderBy("id").collect()]
    # the most frequent, then the smallest; a trailing space and NULL are classes of their own
    assert got == ["brand", "brand", "brand", "brand", "other", None, "other", "other", "brand ", None]


def test_known_spellings_come_first_and_case_alone_can_count(spark):
    t = collation.one_spelling(table(spark), ["name"], known={"name": ["BRAND", "ÖTHER"]})
    assert {r["name"] for r in t.collect()} == {"BRAND", "ÖTHER", "brand ", None}
    t = collation.one_spelling(table(spark), ["name"], collation.ANY_CASE)
    assert [r["name"] for r in t.orderBy("id").collect()] == ["brand", "brand", "BRÄND", "brand", "other", None, "Óther", "Óther", "brand ", None]


def test_reports_by_one_spelling_keep_hash_aggregation(spark):
    t = collation.one_spelling(table(spark), ["name"])
    plan = t.groupBy("name").count()._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and "HashAggregate" in plan
    plan = collation.collated(table(spark), ["name"]).groupBy("name").count()._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" in plan  # what grouping under a collation costs


def test_comparisons_follow_the_collation(spark):
    t = collation.collated(table(spark), ["name"])
    assert t.where(F.col("name") == "BRAND").count() == 4
    assert t.where(F.col("name").startswith("bra")).count() == 5
    assert t.where(F.col("name").isin("ÓTHER", "x")).count() == 3
    right = spark.createDataFrame([("BRAND", 1)], "key string, v int")
    assert t.join(right, F.col("name") == F.collate("key", collation.ANY_CASE_AND_ACCENT)).count() == 4
    assert t.select("name").distinct().count() == 4
    lower = collation.collated(table(spark), ["name"], collation.ANY_CASE)
    assert lower.where(F.col("name").like("BRA%")).count() == 4


@pytest.fixture
def shop(spark):
    visits = spark.createDataFrame([(i, c, s, None if i == 5 else "ref") for i, (c, s) in enumerate([("brand", "g"), ("BRAND", "G"), ("bränd", "g"), (None, None), ("pilot", "b"), ("PILOT", None)])],
                                   "website_session_id long, utm_campaign string, utm_source string, http_referer string")
    orders = spark.createDataFrame([(0, 1.0), (1, 2.0), (4, 3.0)], "website_session_id long, price_usd double")
    return visits, orders


def test_campaigns_and_channels_agree_with_clean_keys(shop):
    visits, orders = shop
    clean = visits.withColumn("utm_campaign", F.translate(F.lower("utm_campaign"), "ä", "a"))
    mixed = collation.one_spelling(visits, ["utm_campaign", "utm_source"])
    known = collation.one_spelling(visits, ["utm_campaign"], known={"utm_campaign": ["brand", "pilot"]})
    assert rows(sessions.campaign_performance(known, orders)) == rows(sessions.campaign_performance(clean, orders))
    assert rows(sessions.channel_performance(mixed, orders)) == rows(sessions.channel_performance(clean, orders))


def test_the_funnel_follows_its_column(spark):
    urls = ["/PRODUCTS", "/The-Bear", "/cart", "/Shipping", "/BILLING-2", "/thänk-you-for-your-order"]
    views = spark.createDataFrame([(1, u) for u in urls] + [(2, "/products")], "website_session_id long, pageview_url string")
    plain = views.withColumn("pageview_url", F.translate(F.lower("pageview_url"), "ä", "a"))
    assert rows(funnel.funnel(collation.collated(views, ["pageview_url"]))) == rows(funnel.funnel(plain)) == [(2, 2, 1, 1, 1, 1, 1)]
