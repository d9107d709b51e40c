from __future__ import annotations

import random
from datetime import date, datetime, timedelta

import numpy as np
import pytest

from tillwise.functions import recursion
from tillwise.operators import products, regression, sessions

from .conftest import rows


def listings(seed=1, n=400):
    rnd = random.Random(seed)
    out = []
    for _ in range(n):
        size, city, kind = rnd.randrange(20, 200), rnd.choice("abc"), rnd.choice(["room", "flat"])
        out.append((size, 1000 + 2 * size, city, kind, "one", 50 + 3.0 * size + 40 * (city == "b") - 15 * (city == "c") + 25 * (kind == "room") + rnd.gauss(0, 5)))
    out += [(None, 1, "a", "flat", "one", 9.0), (50, 1100, None, "flat", "one", 9.0), (50, 1, "a", "flat", "one", None)]
    return out


@pytest.fixture(scope="module")
def table(spark):
    return spark.createDataFrame(listings(), "size int, twice long, city string, kind string, same string, price double")


def test_coefficients_and_fit_equal_a_plain_solve(table):
    whole = [x for x in listings() if None not in x]
    x = np.array([[1, s, c == "b", c == "c", k == "room"] for s, _, c, k, _, _ in whole], float)
    y = np.array([r[-1] for r in whole])
    beta, rest, *_ = np.linalg.lstsq(x, y, rcond=None)
    m = regression.least_squares(table, "price", ["size"], ["city", "kind"])
    names = [("(intercept)", None), ("size", None), ("city", "b"), ("city", "c"), ("kind", "room")]
    assert list(m.coefficients) == names and m.bases == {"city": "a", "kind": "flat"} and m.n == len(whole) and m.left_out == []
    assert np.allclose([m.coefficients[n] for n in names], beta)
    assert np.isclose(m.r_squared, 1 - rest[0] / ((y - y.mean()) ** 2).sum())
    other = regression.least_squares(table, "price", ["size"], ["city", "kind"], bases={"city": "c"})
    assert np.isclose(other.coefficients["city", "b"], m.coefficients["city", "b"] - m.coefficients["city", "c"])


def test_columns_that_others_determine_are_named(table, spark):
    m = regression.least_squares(table, "price", ["size", "twice"], ["same"])
    assert m.left_out == [("twice", None)] and np.isclose(m.r_squared, regression.least_squares(table, "price", ["size"]).r_squared)
    got = {r["attribute"]: r["effect"] for r in regression.as_rows(m, spark).collect()}
    assert got["twice"] is None and got["same"] == 0.0
    constant = regression.least_squares(table.selectExpr("price", "1 AS one"), "price", ["one"])
    assert constant.left_out == [("one", None)] and constant.r_squared == 0


def test_no_rows_give_no_model_and_too_many_levels_an_error(table, spark, monkeypatch):
    m = regression.least_squares(table.where("false"), "price", ["size"], ["city"])
    assert (m.n, m.coefficients, m.r_squared) == (0, {}, None)
    nothing = regression.Model({}, {}, [], 0, None)
    assert regression.as_rows(nothing, table.sparkSession).count() == 0
    with pytest.raises(ValueError, match="levels"):
        regression.levels(table, ["city", "kind"], most=4)
    monkeypatch.setattr(regression, "MAX_COLUMNS", 4)
    with pytest.raises(ValueError, match="columns"):
        regression.least_squares(table, "price", ["size"], ["city", "kind"])


def test_chains_of_launches_have_the_depth_of_the_data(spark):
    start = date(2012, 1, 1)
    days = [i * 80 for i in range(130)] + [130 * 80 + 500 + i * 10 for i in range(3)] + [50_000]
    data = [(f"p{i:03d}", start + timedelta(d)) for i, d in enumerate(days)] + [("a-twin", start)]
    launched = spark.createDataFrame(data, "launch string, launch_day date")
    got = {r["launch"]: r["first_launch"] for r in products.launch_chains(launched, 85).collect()}
    assert got == {"a-twin": "a-twin"} | {f"p{i:03d}": "a-twin" if i < 130 else "p130" if i < 133 else "p133" for i in range(134)}
    got = {r["launch"]: r["first_launch"] for r in products.launch_chains(launched, 80).collect()}
    assert got["p001"] == "p001" and got["p131"] == "p130"  # 80 days apart is not less than 80


def test_following_links(spark):
    links = spark.createDataFrame([(i, i + 1 if i % 10 else None) for i in range(1, 31)], "n int, up int")
    assert dict(map(tuple, recursion.follow(links, "n", "up").collect())) == {i: -(-i // 10) * 10 for i in range(1, 31)}
    assert recursion.follow(links.where("false"), "n", "up").count() == 0
    with pytest.raises(ValueError, match="circle"):
        recursion.follow(spark.createDataFrame([(1, 2), (2, 3), (3, 1)], "n int, up int"), "n", "up")


def test_closure_equals_reachability(spark):
    edges = spark.createDataFrame([(1, 2), (2, 3), (3, 1), (3, 4), (5, 6), (None, 7)], "a int, b int")
    seed = edges.where("a = 1 OR a IS NULL").selectExpr("a AS root", "b AS at")
    step = lambda f: f.join(edges, f["at"] == edges["a"]).select("root", edges["b"].alias("at"))
    assert rows(recursion.closure(seed, step)) == sorted([(1, 1), (1, 2), (1, 3), (1, 4), (None, 7)], key=repr)
    assert recursion.closure(seed.where("false"), step).count() == 0


def test_a_new_year_gets_its_own_column(spark):
    t = spark.createDataFrame([(datetime(2012, 3, 1),), (datetime(2013, 3, 1),), (datetime(2013, 4, 1),), (None,)], "created_at timestamp_ntz")
    assert sessions.sessions_by_every_year_pivot(t).columns == ["month_", "sessions_2012", "sessions_2013"]
    assert rows(sessions.sessions_by_every_year_pivot(t)) == [(3, 1, 1), (4, 0, 1)]
    more = t.union(spark.createDataFrame([(datetime(2015, 4, 1),)], t.schema))
    assert rows(sessions.sessions_by_every_year_pivot(more)) == [(3, 1, 1, 0), (4, 0, 1, 1)]
    with pytest.raises(ValueError, match="more than 2 years"):
        sessions.sessions_by_every_year_pivot(more, most=2)


def test_buckets_grow_with_the_table_and_share_a_hot_key(spark, tmp_path):
    from tillwise.sources import layout

    assert [layout.buckets_for(b) for b in (0, 1, 2**30, 2**30 + 1, 5 * 2**30, 100 * 2**40)] == [1, 1, 1, 2, 8, 65_536]
    t = spark.range(4000).selectExpr("IF(id % 3 = 0, 7, id) AS k", "id AS v")
    spark.sql("DROP TABLE IF EXISTS hot_buckets")
    layout.write_bucketed_by_month(t, "hot_buckets", str(tmp_path / "hot"), "k", 4, files=3)
    try:
        back = spark.table("hot_buckets")
        assert rows(back) == rows(t)
        hot = back.where("k = 7").selectExpr("_metadata.file_name AS f").distinct().count()
        assert hot == 3  # a third of all rows, written by three tasks
        plan = back.groupBy("k").count()._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan
    finally:
        spark.sql("DROP TABLE IF EXISTS hot_buckets")
    assert layout.staged_bytes(spark, str(tmp_path / "hot")) > 0
