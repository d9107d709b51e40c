from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import functions as F

from tillwise.functions import calendar
from tillwise.sources import layout

from .conftest import rows


def stamps(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "ts timestamp_ntz")


def test_keys_do_not_depend_on_the_session_zone(spark):
    # 02:30 on this day does not exist in New York
    df = stamps(spark, datetime(2014, 3, 9, 2, 30), datetime(2014, 12, 31, 23, 59, 59))
    keys = [calendar.month_label(calendar.month_start(F.col("ts"))), F.hour("ts"), calendar.month_start(F.col("ts")).cast("string")]
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        away = rows(df.select(*keys))
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert away == rows(df.select(*keys)) == [("2014-03", 2, "2014-03-01"), ("2014-12", 23, "2014-12-01")]


def test_like_for_like_window_is_inclusive_in_both_forms(spark):
    df = stamps(
        spark,
        datetime(2013, 3, 19, 23, 59, 59),
        datetime(2013, 3, 20),
        datetime(2014, 1, 1),
        datetime(2014, 3, 19, 12),
        datetime(2014, 12, 31),
    )
    plain = df.where(calendar.until_day_of_year(F.col("ts"), 3, 19))
    ranged = df.where(calendar.until_day_in_months(F.month("ts"), F.col("ts"), 3, 19))
    assert rows(plain) == rows(ranged)
    assert plain.count() == 3


def test_like_for_like_over_a_month_layout_covers_every_year(spark, tmp_path):
    df = stamps(spark, datetime(2013, 3, 19), datetime(2014, 6, 1), datetime(2031, 1, 5), datetime(2031, 3, 20))
    layout.write_by_month(df, str(tmp_path / "t"), "ts")
    kept = spark.read.parquet(str(tmp_path / "t")).where(calendar.until_day_in_months(F.col("month_"), F.col("ts"), 3, 19))
    assert sorted(r.year_ for r in kept.collect()) == [2013, 2031]
    assert "month_" in kept._jdf.queryExecution().executedPlan().toString().split("PartitionFilters: [")[1].split("]")[0]


def brute_retail(day: date):
    def start(year):
        d = date(year, 1, 31)
        saturdays = [d + timedelta(n) for n in range(-6, 7) if (d + timedelta(n)).weekday() == 5]
        return min(saturdays, key=lambda x: abs((x - d).days)) + timedelta(1)

    year = day.year if day >= start(day.year) else day.year - 1
    week = (day - start(year)).days // 7 + 1
    lengths = [4, 5, 4] * 4
    if week == 53:
        return year, 53, 12
    seen = 0
    for period, n in enumerate(lengths, 1):
        seen += n
        if week <= seen:
            return year, week, period
    raise AssertionError


def test_retail_calendar_matches_a_walk_over_the_year(spark):
    bounds = spark.sql("SELECT date '2010-01-01' AS a, date '2024-12-31' AS b")
    got = calendar.retail_calendar(calendar.spine(bounds, "a", "b", "1 day", "day")).collect()
    assert len(got) == 5479
    for r in got:
        assert (r.retail_year, r.retail_week, r.retail_period) == brute_retail(r.day)
    assert {r.retail_year for r in got if r.retail_week == 53} == {2012, 2017, 2023}


def test_spine_has_every_month(spark):
    bounds = spark.sql("SELECT date '2013-11-01' AS a, date '2014-02-01' AS b")
    got = rows(calendar.spine(bounds, "a", "b", "1 month", "m").select(F.col("m").cast("string")))
    assert got == [("2013-11-01",), ("2013-12-01",), ("2014-01-01",), ("2014-02-01",)]
