"""Every query of the catalogue against its SQL oracle, on even and on badly skewed tables."""

from __future__ import annotations

import duckdb
import pytest
from compare import TABLES, compare

import __spark_entry__ as entry
from tillwise.plans.catalogue import REGISTRY

from .conftest import SMALL

QUERIES = {name: entry.queries()[name] for name in REGISTRY}
ORACLES = {name: sql for name, sql in entry.oracle_sql().items() if name in REGISTRY}


def connect(folder):
    con = duckdb.connect()
    for t in TABLES.split():
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return con


@pytest.fixture(scope="module")
def even():
    return SMALL, connect(SMALL)


@pytest.fixture(scope="module")
def skewed(tmp_path_factory):
    """A third of all lines on one order, one product and one supplier; a third of all orders on
    one customer; a third of all events in one session; NULLs where the roles allow them."""
    folder = str(tmp_path_factory.mktemp("skewed"))
    con = connect(SMALL)
    changed = {
        "lineitem": "SELECT * REPLACE (CASE WHEN hash(l_orderkey, l_partkey) % 3 = 0 THEN 7 ELSE l_orderkey END AS l_orderkey, "
        "CASE WHEN hash(l_partkey, l_suppkey) % 3 = 0 THEN 11 ELSE l_partkey END AS l_partkey, "
        "CASE WHEN hash(l_suppkey, l_shipdate) % 3 = 0 THEN 3 ELSE l_suppkey END AS l_suppkey), row_number() OVER () AS n FROM lineitem",
        "orders": "SELECT * REPLACE (CASE WHEN o_orderkey % 3 = 0 THEN 5 ELSE o_custkey END AS o_custkey) FROM orders",
        "events": "SELECT * REPLACE (CASE WHEN event_id % 3 = 0 THEN 1 ELSE user_id END AS user_id, "
        "CASE WHEN event_id % 3 = 0 THEN TIMESTAMP '2024-01-15 00:00:00' + INTERVAL (event_id) SECOND ELSE ts END AS ts) FROM events",
    }
    for t in TABLES.split():
        body = changed.get(t, f"SELECT * FROM {t}")
        if t == "lineitem":
            # the item key must stay unique: drop the few lines that the skew made equal
            body = (
                f"SELECT * EXCLUDE (n) FROM ({body}) QUALIFY row_number() OVER "
                "(PARTITION BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate ORDER BY n) = 1"
            )
        con.execute(f"COPY ({body}) TO '{folder}/{t}.parquet' (FORMAT parquet)")
    return folder, connect(folder)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_oracle(spark, even, name):
    folder, con = even
    ok, note, _ = compare(spark, con, folder, name, QUERIES[name], ORACLES.get(name))
    assert ok, note


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_oracle_under_skew(spark, skewed, name):
    folder, con = skewed
    ok, note, _ = compare(spark, con, folder, name, QUERIES[name], ORACLES[name])
    assert ok, note


CHANGE_POINTS = {
    # lines of the orders of each month; None: orders without a date
    "none above the floor": {"2001-01-05": [4, 4], "2001-02-05": [1, 0]},
    "the floor itself": {"2001-01-05": [4] * 9 + [5], "2001-02-05": [4]},
    "no orders": {},
    "undated and dated above": {None: [6, 6], "2001-01-05": [4], "2001-03-05": [5, 4], "2001-02-05": [7]},
    "undated alone above": {None: [6, 6], "2001-01-05": [4]},
}


@pytest.mark.parametrize("case", CHANGE_POINTS)
def test_first_change_point_equals_its_sql(spark, tmp_path, case):
    con = connect(SMALL)
    orders = [(day, n) for day, sizes in CHANGE_POINTS[case].items() for n in sizes]
    dated = "".join(f", ({i}, {f'TIMESTAMP {day!r}' if day else 'NULL'})" for i, (day, _) in enumerate(orders))
    lines = "".join(f", ({i})" for i, (_, n) in enumerate(orders) for _ in range(n))
    made = {
        "orders": f"SELECT o.* REPLACE (m.k AS o_orderkey, m.t AS o_orderdate) FROM (VALUES (-1, NULL::TIMESTAMP){dated}) m(k, t), (FROM orders LIMIT 1) o WHERE k >= 0",
        "lineitem": f"SELECT l.* REPLACE (m.k AS l_orderkey) FROM (VALUES (-1){lines}) m(k), (FROM lineitem LIMIT 1) l WHERE k >= 0",
    }
    for t in TABLES.split():
        con.execute(f"COPY ({made.get(t, f'FROM {t}')}) TO '{tmp_path}/{t}.parquet' (FORMAT parquet)")
    ok, note, _ = compare(spark, connect(str(tmp_path)), str(tmp_path), "first_change_point", QUERIES["first_change_point"], ORACLES["first_change_point"])
    assert ok, note


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


def test_the_flagship_runs(spark):
    df = entry.entry(spark)
    assert df.columns == ["channel", "sessions", "orders", "conversion_rate_pct", "revenue", "revenue_per_session"]
    assert df.count() == 3
