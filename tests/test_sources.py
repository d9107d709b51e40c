from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillwise.operators import quality
from tillwise.sources import csv, layout, schemas

from .conftest import rows

HEADER = "website_session_id,created_at,user_id,is_repeat_session,utm_source,utm_campaign,utm_content,device_type,http_referer"
LINES = [
    HEADER,
    '1,2012-03-19 08:04:16,10,0,search,nonbrand,ad_1,mobile,"https://www.example.com"',
    "2,2012-03-19 08:16:49,11,1,NULL,NULL,NULL,desktop,NULL",
]


def write(path, lines, ending):
    path.write_bytes((ending.join(lines) + ending).encode())
    return str(path)


@pytest.mark.parametrize("ending", ["\r\n", "\n"])
def test_sessions_load_with_either_line_ending(spark, tmp_path, ending):
    df = csv.read_table(spark, "website_sessions", write(tmp_path / "s.csv", LINES, ending))
    got = df.orderBy("website_session_id").collect()
    assert got[0].http_referer == "https://www.example.com"
    assert got[0].created_at == datetime(2012, 3, 19, 8, 4, 16)
    assert (got[1].utm_source, got[1].utm_campaign, got[1].utm_content, got[1].http_referer) == (None,) * 4
    assert rows(quality.text_lengths(df.where("utm_source IS NOT NULL"), "http_referer")) == [
        ("https://www.example.com", 23, 0)
    ]
    assert rows(quality.null_text(df, "utm_source")) == [(2, 0, 1)]


def test_null_text_is_only_special_in_the_named_columns(spark, tmp_path):
    path = write(tmp_path / "p.csv", ["product_id,created_at,product_name", "1,2012-03-19 09:00:00,NULL"], "\r\n")
    df = csv.read_table(spark, "products", path)
    assert df.first().product_name == "NULL"
    assert rows(quality.null_text(df, "product_name")) == [(1, 1, 0)]


def test_a_malformed_row_fails_the_load(spark, tmp_path):
    path = write(tmp_path / "p.csv", ["product_id,created_at,product_name", "x,2012-03-19 09:00:00,Bear"], "\n")
    with pytest.raises(Exception, match="(?i)malformed|FAILFAST"):
        csv.read_table(spark, "products", path).collect()


def test_yearly_files_scan_as_one_table(spark, tmp_path):
    schema = T.StructType([T.StructField("picked_up_at", T.TimestampNTZType()), T.StructField("distance", T.DecimalType(8, 2))])
    paths = [
        write(tmp_path / f"{y}_trips.csv", ["picked_up_at,distance", f"{y}-06-01 10:00:00,1.5{y % 10}"], "\n")
        for y in (2017, 2018, 2019, 2020)
    ]
    df = csv.read(spark, paths, schema)
    assert rows(df.groupBy(F.year("picked_up_at")).count()) == [(y, 1) for y in (2017, 2018, 2019, 2020)]


def test_result_export_writes_null_as_text_and_reads_back(spark, tmp_path):
    df = spark.createDataFrame([("a b", 1, datetime(2014, 1, 2, 3, 4, 5)), (None, 2, None)], "k string, n long, t timestamp_ntz")
    path = str(tmp_path / "out")
    csv.write_result(df.coalesce(1), path)
    text = spark.read.text(path).collect()
    assert sorted(r[0] for r in text) == ["NULL,2,NULL", "a b,1,2014-01-02 03:04:05", "k,n,t"]
    text3 = T.StructType([T.StructField(c, T.StringType()) for c in "knt"])
    back = csv.null_text(csv.read(spark, path, text3), ["k", "t"])
    assert rows(back) == [("a b", "1", "2014-01-02 03:04:05"), (None, "2", None)]


def test_every_table_has_types_keys_and_parents():
    assert set(schemas.SCHEMAS) == set(schemas.PRIMARY_KEYS)
    for child, key, parent, parent_key in schemas.FOREIGN_KEYS:
        assert key in schemas.SCHEMAS[child].names and schemas.PRIMARY_KEYS[parent] == parent_key
    nullable = [f.name for f in schemas.SCHEMAS["website_sessions"] if f.nullable]
    assert tuple(nullable) == schemas.NULL_TEXT_COLUMNS["website_sessions"]
    money = schemas.SCHEMAS["orders"]["price_usd"].dataType
    assert (money.precision, money.scale) == (10, 2)


def test_month_layout_prunes_partitions(spark, tmp_path):
    df = spark.range(400).select(
        F.col("id"), F.expr("timestamp_ntz '2014-01-01 00:00:00' + make_interval(0, 0, 0, cast(id as int))").alias("ts")
    )
    path = str(tmp_path / "m")
    layout.write_by_month(df, path, "ts", ("ts", "id"))
    back = spark.read.parquet(path)
    march = back.where("year_ = 2014 AND month_ = 3")
    assert march.count() == 31 and back.count() == 400
    plan = march._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year_" in plan


def test_bucketed_tables_join_without_a_shuffle(spark):
    for name in ("sessions_b", "orders_b"):
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        layout.write_bucketed(spark.range(1000).withColumnRenamed("id", "k").withColumn(name, F.lit(1)), name, "k", 4)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        joined = spark.table("sessions_b").join(spark.table("orders_b"), "k")
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert joined.count() == 1000
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "SortMergeJoin" in plan and "Exchange" not in plan


def test_scratch_paths_lie_in_the_shared_folder_and_differ(spark):
    a, b = layout.scratch_path(spark, "x"), layout.scratch_path(spark, "x")
    assert a != b and a.startswith(spark.conf.get("spark.checkpoint.dir").rstrip("/"))


class FakeSession:
    """Only what ``scratch_path`` asks of a session."""

    def __init__(self, folder=None):
        self.conf = {"spark.sql.warehouse.dir": "hdfs:/warehouse"} | ({"spark.checkpoint.dir": folder} if folder else {})


def test_scratch_paths_without_a_shared_folder_lie_in_the_warehouse():
    assert layout.scratch_path(FakeSession("s3a://bucket/x/"), "t").startswith("s3a://bucket/x/t-")
    assert layout.scratch_path(FakeSession(), "t").startswith("hdfs:/warehouse/_scratch/t-")
