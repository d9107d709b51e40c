from __future__ import annotations

import random
from datetime import date, datetime, timedelta

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tillwise.sources import lookup

from .conftest import rows

N = 40_000


@pytest.fixture(scope="module")
def views(spark):
    rnd = random.Random(5)
    start = datetime(2013, 1, 1)
    data = [(i, f"/page-{rnd.randrange(40):02d}" if i % 97 else None, start + timedelta(minutes=rnd.randrange(500_000)), rnd.randrange(10**9)) for i in range(N)]
    return spark.createDataFrame(data, "id int, url string, at timestamp_ntz, user_id long").withColumn("day", F.col("at").cast("date"))


@pytest.fixture(scope="module")
def laid_out(spark, views, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("lookup") / "views")
    lookup.write_for_lookups(views, path, ["url", "day"], {"user_id": 3000}, partitions=16)
    return spark.read.schema(views.schema).parquet(path), path


def test_nothing_is_lost(views, laid_out):
    table, _ = laid_out
    assert table.columns == views.columns
    assert rows(table) == rows(views)


@pytest.mark.parametrize("by", ["url", "time", "user"])
def test_each_filter_alone_skips_row_groups(views, laid_out, by):
    table, _ = laid_out
    some = views.where("id = 12345").first()
    test = {
        "url": F.col("url") == "/page-07",
        "time": F.col("day").between(F.lit("2013-03-01").cast("date"), F.lit("2013-03-03").cast("date")),
        "user": F.col("user_id") == some["user_id"],
    }[by]
    found = table.where(test)
    assert rows(found) == rows(views.where(test))
    assert lookup.rows_read(found) < {"url": 0.5, "time": 0.5, "user": 0.2}[by] * N


def test_row_groups_are_narrow_in_both_columns_and_have_bloom_filters(laid_out):
    _, path = laid_out
    import pathlib

    groups = []
    for f in pathlib.Path(path).glob("*.parquet"):
        meta = pq.ParquetFile(f).metadata
        for g in range(meta.num_row_groups):
            stats = {meta.row_group(g).column(c).path_in_schema: meta.row_group(g).column(c).statistics for c in range(meta.num_columns)}
            groups.append((stats["url"].min, stats["url"].max, stats["day"].min, stats["day"].max))
    assert len(groups) >= 16
    in_url = sum(a <= "/page-07" <= b for a, b, _, _ in groups)
    in_time = sum(a <= date(2013, 3, 2) <= b for _, _, a, b in groups)
    assert in_url <= len(groups) / 2 and in_time <= len(groups) / 2


def test_the_curve_alternates_bits(spark):
    t = spark.createDataFrame([(0, 0), (0, 1), (1, 0), (1, 1), (2, 0), (65535, 65535)], "a long, b long").select(lookup.morton([F.col("a"), F.col("b")]).alias("m"))
    assert sorted(r["m"] for r in t.collect()) == [0, 1, 2, 3, 8, 2**32 - 1]


def test_unfit_columns_are_refused(spark, views, tmp_path, monkeypatch):
    with pytest.raises(ValueError, match="two or three"):
        lookup.write_for_lookups(views, str(tmp_path / "a"), ["url"])
    with pytest.raises(ValueError, match="add the date"):
        lookup.write_for_lookups(views, str(tmp_path / "a"), ["url", "at"])
    monkeypatch.setattr(lookup, "MAX_TEXTS", 10)
    with pytest.raises(ValueError, match="bloom"):
        lookup.write_for_lookups(views, str(tmp_path / "b"), ["url", "day"])


def test_empty_and_constant_tables(spark, views, tmp_path):
    lookup.write_for_lookups(views.where("false"), str(tmp_path / "a"), ["url", "day"])
    assert spark.read.schema(views.schema).parquet(str(tmp_path / "a")).count() == 0
    same = spark.range(10).select(F.col("id").cast("int"), F.lit("/x").alias("url"), F.lit(None).cast("date").alias("day"))
    lookup.write_for_lookups(same, str(tmp_path / "b"), ["url", "day"])
    assert rows(spark.read.parquet(str(tmp_path / "b"))) == rows(same)
