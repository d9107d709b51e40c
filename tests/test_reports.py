from __future__ import annotations

import pytest

from tillwise import settings
from tillwise.plans import load, reports
from tillwise.plans.reports import REPORTS, Settings

from .conftest import rows
from .test_quality import tables

S = Settings(pivot_years=(2013, 2014), blank_years=(2013,), min_items=1, refund_product="Alpha")


@pytest.fixture(scope="module")
def opened(spark, tmp_path_factory):
    """CSV files, read, verified and laid out."""
    raw, out = (str(tmp_path_factory.mktemp(n)) for n in ("raw", "out"))
    for name, df in tables(spark).items():
        (
            df.coalesce(1).write.option("header", True).option("nullValue", "NULL").option("lineSep", "\r\n")
            .option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss").csv(f"{raw}/{name}.csv")
        )
    staged = load.stage(load.read_shop(spark, raw), f"{out}/staged")
    assert rows(load.verify(staged).where("ok = 0")) == []
    load.lay_out(staged, f"{out}/shop", buckets=4)
    return load.open_shop(spark, f"{out}/shop")


@pytest.mark.parametrize("name", sorted(REPORTS))
def test_reports_from_files_equal_reports_from_memory(spark, opened, name):
    assert rows(REPORTS[name](opened, S)) == rows(REPORTS[name](tables(spark), S))


def test_reports_over_the_layout_join_without_a_shuffle_and_prune(spark, opened):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        plan = REPORTS["annual_revenue_like_for_like"](opened, S)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    join = plan.split("SortMergeJoin")[1]
    assert "Exchange" not in join
    assert "month_" in plan.split("PartitionFilters: [")[1].split("]")[0]


def test_files_open_without_the_catalogue(spark, opened, tmp_path):
    path = {n: df.inputFiles()[0] for n, df in opened.items()}["orders"]
    folder = path.split("/shop/")[0] + "/shop"
    again = load.open_shop(spark, folder + "/")
    assert again["orders"].count() == opened["orders"].count()


def test_thirty_reports():
    assert len(REPORTS) == 30


def test_launches_after_the_opening(spark):
    got = rows(REPORTS["launch_windows"](tables(spark), S), "launch", "window_", "orders")
    assert got == [("Beta", "after", 3), ("Beta", "before", 0), ("Gamma", "after", 2), ("Gamma", "before", 1)]


def test_the_refund_date_report_needs_a_product(spark):
    with pytest.raises(ValueError, match="refund_product"):
        REPORTS["refunds_by_refund_date"](tables(spark), Settings())


def test_export_writes_every_report(spark, opened, tmp_path):
    reports.export(opened, S, str(tmp_path / "r"))
    assert {p.name for p in (tmp_path / "r").iterdir()} == set(REPORTS)
    text = [r[0] for r in spark.read.text(str(tmp_path / "r" / "campaign_volume")).collect()]
    assert "NULL,2" in text


def test_shuffle_partitions_follow_the_data_and_the_cores():
    assert settings.shuffle_partitions(1 << 40, 100) == 8192
    assert settings.shuffle_partitions(0, 100) == 200
