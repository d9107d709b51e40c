"""What the physical plans may and may not contain."""

from __future__ import annotations

import re
from collections import Counter

import pytest
from plans import final_only
from pyspark.sql import functions as F

import __spark_entry__ as entry
from tillwise.operators import funnel, returns, sessions
from tillwise.plans.catalogue import REGISTRY
from tillwise.plans.roles import Roles

from .conftest import SMALL

# these write files as a load step before they return


def initial(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def without_broadcasts(spark):
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    for k in keys:
        spark.conf.set(k, "-1")
    yield
    for k in keys:
        spark.conf.unset(k)


WRITES = {"csv_exchange", "month_layout", "like_for_like_pushed_down", "csv_files_as_one_table", "bucketed_session_join"}


@pytest.mark.parametrize("name", sorted(set(REGISTRY) - WRITES))
def test_no_python_and_no_pairwise_join(spark, name, without_broadcasts):
    plan = initial(entry.queries()[name](spark, SMALL))
    for node in ("Python", "Arrow", "CartesianProduct", "NestedLoopJoin", "BroadcastExchange", "Scan ExistingRDD"):
        assert node not in plan, f"{node} in\n{plan}"


def test_scans_read_only_the_needed_columns(spark):
    plan = initial(entry.queries()["monthly_conversion"](spark, SMALL))
    schemas = [part.split("\n")[0] for part in plan.split("ReadSchema: ")[1:]]
    assert any("struct<o_orderkey:bigint,o_orderdate:timestamp_ntz>" in s for s in schemas)
    assert any("struct<l_orderkey:bigint>" in s for s in schemas)


def test_the_session_join_has_one_row_per_session_on_both_sides(spark, without_broadcasts):
    r = Roles(spark, SMALL)
    plan = initial(sessions.conversion(r.visits, r.visit_orders))
    # one shuffle per side and one for the total: the fold's own shuffle serves the join
    assert plan.count("Exchange hashpartitioning") == 2 and plan.count("Exchange SinglePartition") == 1


def test_the_funnel_shuffles_flags_not_pageviews(spark):
    plan = initial(funnel.funnel(Roles(spark, SMALL).web_pageviews))
    assert plan.count("Exchange hashpartitioning") == 1
    assert "partial_max" in plan.split("Exchange hashpartitioning")[1]
    assert "SortAggregate" not in plan


def test_top_in_group_cuts_groups_before_the_shuffle(spark):
    plan = initial(entry.queries()["ranked_within_group"](spark, SMALL))
    assert "row_number(), 3, Partial" in plan
    assert "row_number(), 1, Partial" in initial(entry.queries()["dedup_latest"](spark, SMALL))


def test_top_k_reports_do_not_sort_everything(spark):
    assert "TakeOrderedAndProject" in initial(entry.queries()["popular_pairs"](spark, SMALL))


def scans(spark, name):
    """Tables that the final plan reads, and how often each."""
    df = entry.queries()[name](spark, SMALL)
    query = df._jdf.queryExecution()
    df.collect()
    plan = final_only(query.executedPlan().toString())
    return Counter(re.findall(r"Scan parquet.*?/(\w+)\.parquet", plan)), plan


def test_places_read_only_what_is_asked_for(spark, without_broadcasts):
    assert set(scans(spark, "popular_pickups")[0]) == {"lineitem", "supplier", "nation"}
    assert set(scans(spark, "popular_dropoffs")[0]) == {"lineitem", "orders", "customer", "nation"}
    pairs, plan = scans(spark, "popular_pairs")
    assert pairs["lineitem"] == 1


@pytest.mark.parametrize("name,table", [("market_comparison", "customer"), ("outlier_treatment", "events")])
def test_one_fold_serves_counts_totals_and_quantiles(spark, name, table, without_broadcasts):
    read, plan = scans(spark, name)
    assert read[table] == 1, plan
    if name == "outlier_treatment":  # nothing is shuffled straight from the scan
        for part in plan.split("Exchange hashpartitioning")[1:]:
            below = part.split("Exchange")[0].split("ReusedExchange")[0]
            assert "FileScan" not in below or "partial_" in below, part


def test_first_purchases_are_found_without_sorting(spark, without_broadcasts):
    assert "SortAggregate" not in initial(entry.queries()["repeat_purchase_reconciliation"](spark, SMALL))


def test_bucketed_sessions_and_purchases_join_without_a_shuffle(spark, without_broadcasts):
    plan = initial(entry.queries()["bucketed_session_join"](spark, SMALL))
    assert "SortMergeJoin" in plan and "Exchange" not in plan.split("SortMergeJoin")[1]


def test_like_for_like_reads_only_the_months_it_needs(spark):
    plan = initial(entry.queries()["like_for_like_pushed_down"](spark, SMALL))
    assert "PartitionFilters: [" in plan and "month_" in plan.split("PartitionFilters: [")[1].split("]")[0]


def test_a_skewed_order_is_split_at_run_time(spark, without_broadcasts):
    """One order holds a third of the items: the adaptive skew join must split it, with equal results."""
    n = 300_000
    items = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 5000).alias("order_id"),
        (F.col("id") % 50).alias("product_id"),
        F.lit(1.5).alias("price_usd"),
        F.when(F.col("id") % 10 == 0, 1).alias("refunded"),
        F.lit(None).cast("double").alias("refund_amount_usd"),
    )
    orders = spark.range(5000).select(
        F.col("id").alias("order_id"), F.expr("timestamp_ntz '2014-01-01 00:00:00'").alias("created_at")
    )
    products = spark.range(50).select(F.col("id").alias("product_id"), F.concat(F.lit("p"), F.col("id")).alias("product_name"))
    settings = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "200KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100KB",
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "50KB",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        df = returns.monthly_refund_rate(items, orders, products)
        query = df._jdf.queryExecution()
        got = df.collect()
        plan = final_only(query.executedPlan().toString())
    finally:
        for k, v in before.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)
    assert "skew=true" in plan
    assert sum(r.items_sold for r in got) == n and sum(r.items_refunded for r in got) == n // 10
