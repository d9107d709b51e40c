from __future__ import annotations

import random
from datetime import date, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tillwise.operators import asof

from .conftest import rows

RATES = [("X", date(2001, 1, 10), 2), ("X", date(2001, 1, 20), 3), ("X", date(2003, 6, 1), 4), ("X", date(2003, 6, 1), 5), ("Y", date(2002, 1, 1), 7)]


def frames(spark, asked, rates=RATES):
    history = spark.createDataFrame(rates, "cur string, taken date, rate int")
    return spark.createDataFrame(asked, "id int, cur string, day date"), history


def brute(asked, rates=RATES):
    out = []
    for i, cur, day in asked:
        known = [(t, v) for c, t, v in rates if c == cur and day is not None and t <= day]
        out.append((i, cur, day, max(known)[1] if known else None))
    return sorted(out, key=repr)


@pytest.mark.parametrize("bucket_days", [1, 7, 32, 5000])
@pytest.mark.parametrize("salts", [1, 3])
def test_equals_brute_force(spark, bucket_days, salts):
    rnd = random.Random(bucket_days)
    asked = [(i, rnd.choice(["X", "X", "X", "Y", "Z", None]), date(2000, 11, 1) + timedelta(rnd.randrange(1500))) for i in range(300)]
    asked += [(900, "X", date(2001, 1, 9)), (901, "X", date(2001, 1, 10)), (902, "X", date(2001, 1, 19)), (903, "X", date(2001, 1, 20)), (904, "X", None), (905, "Y", date(1960, 1, 1)), (905, "Y", date(1960, 1, 1)), (906, "X", date(2099, 1, 1))]
    left, history = frames(spark, asked)
    got = asof.as_of(left, history, ["cur"], "day", "taken", ["rate"], bucket_days, salts)
    assert rows(got) == brute(asked)


def test_an_empty_history_leaves_every_row_without_an_entry(spark):
    asked = [(1, "X", date(2001, 1, 1)), (2, None, None)]
    left, history = frames(spark, asked)
    assert rows(asof.as_of(left, history.where("false"), ["cur"], "day", "taken", ["rate"])) == brute(asked, [])
    assert asof.as_of(left.where("false"), history, ["cur"], "day", "taken", ["rate"]).count() == 0


def test_rows_meet_their_bucket_not_the_whole_history(spark):
    left, history = frames(spark, [(1, "X", date(2001, 1, 1))])
    plan = asof.as_of(left, history, ["cur"], "day", "taken", ["rate"])._jdf.queryExecution().executedPlan().toString()
    join = next(line for line in plan.splitlines() if "Join" in line)
    assert "__at_bucket" in join and "NestedLoop" not in plan and "Cartesian" not in plan


def test_a_price_is_rounded_once_at_its_own_rate(spark):
    t = spark.createDataFrame([(1, "X", date(2001, 1, 12), Decimal("0.25")), (2, "X", date(2001, 1, 1), Decimal("9.00")), (3, "X", date(2001, 1, 12), None)], "id int, currency string, day date, price decimal(18,2)")
    rates = spark.sql("SELECT 'X' AS currency, 0.3BD AS rate, DATE '2001-01-10' AS taken_on")
    got = asof.in_one_currency(t, rates, "price", "day").select("id", F.col("base_price").cast("string"))
    assert rows(got) == [(1, "0.08"), (2, None), (3, None)]
