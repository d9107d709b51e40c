from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tillwise.operators import sketches

from .conftest import rows


def test_sketches_of_days_add_up_to_months(spark):
    t = spark.range(60_000).select(F.expr("date_add(DATE '2013-05-01', CAST(id % 61 AS INT))").alias("day"), (F.col("id") % 20_011).alias("user"))
    daily = sketches.distinct_sketches(t, ["day"], "user")
    assert daily.count() == 61
    period = F.month("day").alias("m")
    told = sketches.distinct_rollup(daily, [period])
    right = t.groupBy(period).agg(F.countDistinct("user").alias("n"))
    for r in right.join(told, "m").collect():
        assert abs(r["estimate"] - r["n"]) <= sketches.distinct_bound() * r["n"]
    assert sketches.distinct_rollup(daily.where("false"), [period]).count() == 0


def test_few_keys_and_null_keys_are_counted_right(spark):
    t = spark.createDataFrame([(1, 5), (1, 5), (1, None), (2, None), (3, 7), (3, 8)], "g int, k long")
    assert rows(sketches.distinct_rollup(sketches.distinct_sketches(t, ["g"], "k"), ["g"])) == [(1, 1), (2, 0), (3, 2)]


def test_merged_quantiles_are_within_the_rank_bound(spark):
    n = 100_000
    t = spark.range(n).select((F.col("id") % 12).alias("month"), (F.col("id") % 3).alias("g"), ((F.col("id") * 7919) % n).alias("v"))
    monthly = sketches.quantile_sketches(t, ["g", "month"], F.col("v"))
    told = sketches.fences(sketches.quantile_rollup(monthly, ["g"], {"q1": "0.25", "median": "0.5", "q3": "0.75"}))
    for r in told.collect():
        assert r["n"] == t.where(F.col("g") == r["g"]).count()
        for name, p in (("q1", 0.25), ("median", 0.5), ("q3", 0.75)):
            assert abs(r[name] / n - p) <= sketches.rank_bound() + 1e-3
        assert float(r["high_fence"]) == r["q3"] + 1.5 * (r["q3"] - r["q1"])


def hot(spark, n=30_000):
    """Items 0 and 1 stand out of a long tail; keys have NULLs and quotes."""
    i = F.when(F.col("id") % 3 == 0, F.lit(0)).when(F.col("id") % 7 == 0, F.lit(1)).otherwise(F.col("id"))
    return spark.range(n).select(i.alias("a"), F.when(i == 0, F.lit(None)).otherwise(F.lit('q"x')).cast("string").alias("b"))


@pytest.mark.parametrize("k,way", [(2, "proposed"), (3, "counted")])
def test_a_result_stands_only_where_nothing_can_be_missing(spark, k, way):
    t = hot(spark)
    got, how = sketches.heavy_hitters(t, ["a", "b"], k, tracked=256)
    right = t.groupBy("a", "b").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "a", "b").limit(k)
    assert how == way and got.collect() == right.collect()


def test_a_sketch_with_room_for_all_is_exact(spark):
    t = spark.range(5_000).select((F.col("id") % 40).alias("a"))
    got, how = sketches.heavy_hitters(t, ["a"], 7, tracked=256)
    assert how == "proposed" and [tuple(r) for r in got.collect()] == [(i, 125) for i in range(7)]
    got, how = sketches.heavy_hitters(t.where("false"), ["a"], 7)
    assert got.count() == 0
    assert [tuple(r) for r in sketches.heavy_hitters(t.where("a < 3"), ["a"], 7)[0].collect()] == [(i, 125) for i in range(3)]
