from __future__ import annotations

import math
from collections import defaultdict
from decimal import Decimal

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tillwise.operators import market, quantiles

from .conftest import rows

PROBS = {"q1": "0.25", "median": "0.5", "q9": "0.9"}
values = st.lists(
    st.tuples(st.sampled_from(["a", "b", None]), st.one_of(st.none(), st.integers(-5000, 5000))), min_size=1, max_size=80
)


def brute(data):
    groups = defaultdict(list)
    for k, v in data:
        if v is not None:
            groups[k].append(Decimal(v).scaleb(-2))
    out = {}
    for k, vs in groups.items():
        vs.sort()
        out[k] = tuple(vs[max(math.ceil(Decimal(p) * len(vs)), 1) - 1] for p in PROBS.values())
    return out


@settings(max_examples=10, deadline=None)
@given(data=values)
def test_quantiles_match_sorting_each_group(spark, data):
    df = spark.createDataFrame([(k, None if v is None else Decimal(v).scaleb(-2)) for k, v in data], "k string, v decimal(18,2)")
    got = {r.k: (r.q1, r.median, r.q9) for r in quantiles.quantiles(df, ["k"], "v", PROBS).collect()}
    assert got == brute(data)


def test_a_long_tail_neither_makes_many_buckets_nor_one_large_one(spark):
    df = spark.range(50_000).select(F.lit("a").alias("k"), F.pow(F.lit(1.0004), F.col("id")).cast("decimal(18,2)").alias("v"))
    counts = quantiles.fold(df, ["k"], "v").withColumn("b", quantiles._bucket(F.col("v"), 2))
    sizes = [r["count"] for r in counts.groupBy("b").count().collect()]
    assert len(sizes) < 9000 and max(sizes) < 200
    vs = sorted(r.v for r in df.collect())
    got = quantiles.quantiles(df, ["k"], "v", PROBS).first()
    assert (got.q1, got.median, got.q9) == (vs[12_499], vs[24_999], vs[44_999])


def test_totals_come_with_the_quantiles_and_groups_without_values_stay(spark):
    df = spark.createDataFrame([("a", Decimal("1.50")), ("a", Decimal("1.50")), ("a", None), ("b", None), (None, Decimal("-2.00"))], "k string, v decimal(18,2)")
    got = quantiles.from_fold(quantiles.fold(df, ["k"], "v"), ["k"], "v", {"median": "0.5"})
    assert rows(got, "k", "median", "rows", "valued", "total") == [("a", "1.50", 3, 2, "3.00"), ("b", None, 1, 0, None), (None, "-2.00", 1, 1, "-2.00")]


def test_outliers_are_flagged_and_clipped_per_group(spark):
    df = spark.createDataFrame([("a", Decimal(v)) for v in (1, 2, 3, 4, 100)] + [(None, Decimal(5))], "k string, v decimal(18,2)")
    fences = quantiles.iqr_fences(df, ["k"], "v")
    got = quantiles.mark_outliers(df, fences, ["k"], "v")
    assert rows(got.where("is_outlier = 1"), "k", "v", "clipped") == [("a", "100.00", "7.000")]
    assert got.count() == 6 and got.where("is_outlier IS NULL").count() == 0


def test_dated_rates_and_missing_currencies(spark):
    rates = spark.sql("SELECT * FROM VALUES ('EUR', 1.10BD, DATE '2020-01-01'), ('EUR', 1.20BD, DATE '2021-01-01'), ('TRY', 0.05BD, DATE '2020-06-01') AS t(currency, rate, taken_on)")
    listings = spark.createDataFrame([(1, "EUR", Decimal("200.00")), (2, "TRY", Decimal("15000.01")), (3, "ZAR", Decimal("9.00"))], "id int, currency string, price decimal(18,2)")
    got = market.in_one_currency(listings, market.rates_as_of(rates, F.lit("2020-12-31").cast("date")))
    assert rows(got, "id", "base_price") == [(1, "220.00"), (2, "750.00"), (3, None)]
