from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tillwise.sources import csv, quarantine
from tillwise.sources.schemas import NULL_TEXT_COLUMNS, SCHEMAS

from .conftest import rows
from .test_sources import HEADER, LINES, write

BAD = {
    "7,2012-03-19 08:00:00,1,0,a,b": "too few columns",
    "8,2012-03-19 08:00:00,1,0,a,b,c,d,e,f": "too many columns",
    "x,2012-03-19 08:00:00,1,0,a,b,c,desktop,e": "website_session_id is not bigint",
    "9,yesterday,1,0,a,b,c,desktop,e": "created_at is not timestamp_ntz",
    ",2012-03-19 08:00:00,1,0,a,b,c,desktop,e": "no value in website_session_id",
    "10,2012-03-19 08:00:00,1,zero,a,b,c,desktop,e": "is_repeat_session is not int",
}


def load(spark, tmp_path, paths, **limits):
    return quarantine.load(spark, paths, SCHEMAS["website_sessions"], str(tmp_path / "out"), NULL_TEXT_COLUMNS["website_sessions"], **limits)


@pytest.mark.parametrize("ending", ["\r\n", "\n"])
def test_good_and_bad_make_up_the_files(spark, tmp_path, ending):
    one = write(tmp_path / "one.csv", [*LINES, *BAD], ending)
    two = write(tmp_path / "two.csv", [*LINES, "", '3,2012-03-20 00:00:00,12,0,"a,b",NULL,NULL,desktop,NULL'], ending)
    good, bad = load(spark, tmp_path, [one, two])
    plain = csv.read_table(spark, "website_sessions", [write(tmp_path / "good.csv", LINES, ending), two])
    assert good.dtypes == plain.dtypes
    assert rows(good) == rows(plain)
    assert {r["line"]: r["reason"] for r in bad.collect()} == BAD
    counts = {r["file"].rsplit("/", 1)[1]: (r["lines"], r["good"], r["bad"]) for r in quarantine.per_file(spark, str(tmp_path / "out")).collect()}
    assert counts == {"one.csv": (8, 2, 6), "two.csv": (3, 3, 0)}


def test_the_limit_ends_the_load_and_leaves_the_lines(spark, tmp_path):
    path = write(tmp_path / "one.csv", [*LINES, *BAD], "\n")
    with pytest.raises(quarantine.TooManyBadLines, match="6 of 8"):
        load(spark, tmp_path, path, max_bad=5)
    assert spark.read.parquet(str(tmp_path / "out")).where("bad = 1").count() == 6
    (tmp_path / "b").mkdir()
    assert load(spark, tmp_path / "b", path, max_bad=6, max_bad_share=0.75)[1].count() == 6


def test_a_file_with_another_header_has_a_bad_line(spark, tmp_path):
    path = write(tmp_path / "one.csv", [HEADER.replace("user_id", "visitor"), *LINES[1:]], "\n")
    good, bad = load(spark, tmp_path, path)
    assert good.count() == 2 and rows(bad.select("reason")) == [("website_session_id is not bigint",)]


def test_an_empty_file_loads_nothing(spark, tmp_path):
    good, bad = load(spark, tmp_path, write(tmp_path / "one.csv", [HEADER], "\n"), max_bad=0, max_bad_share=0)
    assert good.count() == bad.count() == 0


def test_null_text_is_special_in_the_named_columns_only(spark, tmp_path):
    path = write(tmp_path / "p.csv", ["product_id,created_at,product_name", "1,2012-03-19 09:00:00,NULL", "NULL,2012-03-19 09:00:00,Bear"], "\n")
    good, bad = quarantine.load(spark, path, SCHEMAS["products"], str(tmp_path / "out"))
    assert rows(good.select("product_name")) == [("NULL",)]
    assert rows(bad.select("reason")) == [("product_id is not int",)]
    assert good.select(F.max("product_id")).first()[0] == 1
