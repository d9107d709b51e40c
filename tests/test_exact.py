from __future__ import annotations

from decimal import ROUND_HALF_UP, Decimal

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tillwise.functions import exact

from .conftest import rows


def expected(n, d, scale):
    if n is None or not d:
        return None
    exact_tie = Decimal(abs(n)) * 10**scale * 2 + abs(d)
    whole = int(exact_tie // (2 * abs(d)))
    value = Decimal(whole).scaleb(-scale)
    return str(-value if (n < 0) != (d < 0) and whole else value)


pairs = st.lists(
    st.tuples(
        st.one_of(st.none(), st.integers(-(10**13), 10**13)),
        st.one_of(st.none(), st.integers(0, 10**13)),
    ),
    min_size=1,
    max_size=60,
)


@settings(max_examples=12, deadline=None)
@given(data=pairs, scale=st.sampled_from([0, 1, 2, 3, 5]))
def test_half_up_matches_integer_arithmetic(spark, data, scale):
    # the quotient of 10**13 by 1 at five places is the largest that fits the whole-number result
    data = [(n, d if d is None or d == 0 else max(d, 10)) for n, d in data]
    df = spark.createDataFrame([(i, n, d) for i, (n, d) in enumerate(data)], "i long, n long, d long")
    got = {r[0]: r[1] for r in df.select("i", exact.half_up(F.col("n"), F.col("d"), scale).alias("q")).collect()}
    for i, (n, d) in enumerate(data):
        want = expected(n, d, scale)
        assert (None if got[i] is None else Decimal(got[i])) == (None if want is None else Decimal(want))


def test_ties_round_away_from_zero(spark):
    df = spark.createDataFrame([(285, 1000), (1005, 1000), (-285, 1000), (1, 8)], "n long, d long")
    assert [str(r[0]) for r in df.select(exact.ratio(F.col("n"), F.col("d"), 2)).collect()] == [
        "0.29",
        "1.01",
        "-0.29",
        "0.13",
    ]


def test_a_quotient_just_below_a_tie_is_not_rounded_twice(spark):
    # 0.28499999975 shows as 0.285000 at six places, which would round up to 0.29
    df = spark.createDataFrame([(1139999999, 4000000000)], "n long, d long")
    assert str(df.select(exact.ratio(F.col("n"), F.col("d"), 2)).first()[0]) == "0.28"


def test_zero_denominator_is_null_under_ansi(spark):
    assert spark.conf.get("spark.sql.ansi.enabled") == "true"
    df = spark.createDataFrame([(5, 0), (5, None)], "n long, d long")
    got = df.select(
        exact.percent(F.col("n"), F.col("d"), 2), exact.per_unit(F.col("n"), F.col("d")), exact.rate(F.col("n"), F.col("d"))
    ).collect()
    assert all(v is None for r in got for v in r)


def test_cents_are_exact_for_doubles_and_decimals(spark):
    prices = [Decimal("49.99"), Decimal("0.07"), Decimal("1234567.89"), Decimal("0.10"), Decimal("-3.01")] * 300
    df = spark.createDataFrame([(p, float(p)) for p in prices], "d decimal(10,2), x double")
    total = exact.from_cents
    got = df.agg(total(exact.sum_cents("d")), total(exact.sum_cents("x")), total(exact.sum_cents(F.lit(None).cast("double")))).first()
    assert got[0] == got[1] == sum(prices)
    assert got[2] is None


def test_money_is_rounded_half_up(spark):
    df = spark.createDataFrame([(0.285,), (1.005,), (2.675,)], "x double")
    assert rows(df.select(exact.money(F.col("x")))) == [("0.29",), ("1.01",), ("2.68",)]


def test_expected_helper_agrees_with_decimal_quantize():
    assert Decimal(expected(1005, 1000, 2)) == Decimal("1.005").quantize(Decimal("0.01"), ROUND_HALF_UP)
