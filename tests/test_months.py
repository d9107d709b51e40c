from __future__ import annotations

from datetime import datetime
from pathlib import Path

import pytest

from tillwise.sources import months

from .conftest import rows


def frame(spark, data):
    return spark.createDataFrame([(i, None if d is None else datetime.fromisoformat(d), v) for i, d, v in data], "id int, ts timestamp_ntz, v int")


FIRST = [(1, "2013-04-30 23:59:59", 1), (2, "2013-05-01 00:00:00", 1), (3, "2013-05-20 10:00:00", 1), (4, "2014-05-01 00:00:00", 1), (5, None, 1)]
MAY = [(2, "2013-05-01 00:00:00", 2), (3, "2013-05-20 10:00:00", 2), (6, "2013-05-31 23:59:59", 2)]


def files(path):
    return {str(f): f.stat().st_mtime_ns for f in Path(path).rglob("*.parquet")}


def current(spark, path, only=None):
    return rows(months.open_months(spark, path, only), "id", "v")


@pytest.fixture
def path(spark, tmp_path):
    p = str(tmp_path / "table")
    assert months.load_months(frame(spark, FIRST), p, "ts") == ["2013-04", "2013-05", "2014-05", "none"]
    return p


def test_a_month_replaces_itself_and_no_other_file_is_touched(spark, path):
    before = files(path)
    assert months.load_months(frame(spark, MAY), path, "ts") == ["2013-05"]
    assert current(spark, path) == [(1, 1), (2, 2), (3, 2), (4, 1), (5, 1), (6, 2)]
    assert {f: t for f, t in files(path).items() if f in before} == before
    again = current(spark, path)
    months.load_months(frame(spark, MAY), path, "ts")  # run again: the same table
    assert current(spark, path) == again
    assert current(spark, path, ["2013-05"]) == [(2, 2), (3, 2), (6, 2)]


def test_a_load_that_fails_between_its_steps_leaves_the_old_months(spark, path):
    def stop():
        raise ValueError("the new month does not tie out")

    with pytest.raises(ValueError, match="tie out"):
        months.load_months(frame(spark, MAY), path, "ts", before_publish=stop)
    assert current(spark, path) == [(i, v) for i, _, v in FIRST]
    months.load_months(frame(spark, MAY), path, "ts")
    assert months.drop_replaced(spark, path) == 2  # the load that failed, and the May it would have replaced
    assert current(spark, path) == [(1, 1), (2, 2), (3, 2), (4, 1), (5, 1), (6, 2)]


def test_two_loads_cannot_publish_the_same_number(spark, path):
    def other():
        months.load_months(frame(spark, MAY), path, "ts")

    with pytest.raises(months.LoadConflict):
        months.load_months(frame(spark, [(9, "2013-04-01 00:00:00", 9)]), path, "ts", before_publish=other)
    assert current(spark, path) == [(1, 1), (2, 2), (3, 2), (4, 1), (5, 1), (6, 2)]


def test_a_month_filter_reads_its_folders_only(spark, path):
    t = months.open_months(spark, path).where("year_ = 2013 AND month_ = 5")
    plan = t._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year_" in plan
    assert rows(t, "id") == [(2,), (3,)]


def test_what_is_not_there_is_an_error(spark, path, tmp_path):
    with pytest.raises(FileNotFoundError, match="no month"):
        months.open_months(spark, str(tmp_path / "nothing"))
    with pytest.raises(FileNotFoundError, match="none of the months"):
        months.open_months(spark, path, ["1999-01"])
    assert months.load_months(frame(spark, []), path, "ts") == []  # an empty load changes nothing
    assert current(spark, path) == [(i, v) for i, _, v in FIRST]
