"""Exact ratios of aggregates.

Counts and money are divided as integers and rounded half-up once, at the end.
Dividing decimals and then rounding would round twice (Spark keeps as few as six
places of a quotient), which turns 0.2849999… into 0.29 when the denominator is
large.  A zero or NULL denominator gives NULL instead of an ANSI error.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(18,2)"


def money(col: Column) -> Column:
    """Turn a floating price into exact money *before* it is summed."""
    return col.cast(MONEY)


def cents(amount: Column) -> Column:
    """A money amount (any precision, two places) as a whole number of cents."""
    return (amount.cast("decimal(30,2)") * F.lit(100)).cast("decimal(32,0)")


def sum_cents(amount: Column | str) -> Column:
    """The exact sum of a price column, in whole cents (BIGINT).

    A price is at most some billions, so its double is within half a cent of one whole
    number of cents whether it was stored as DECIMAL or DOUBLE; whole cents then add without
    error.  Long sums also stay in fixed-width aggregation buffers, where a wide decimal
    would be rebuilt as an object for every row.  An overflow is an error, not a wrap.
    """
    col = F.col(amount) if isinstance(amount, str) else amount
    return F.sum(F.rint(col.cast("double") * 100).cast("bigint"))


def from_cents(whole: Column) -> Column:
    """Whole cents back to money."""
    return (whole.cast("decimal(19,0)") * F.lit(Decimal("0.01"))).cast("decimal(21,2)")


def rows() -> Column:
    return F.count(F.lit(1))


def half_up(num: Column, den: Column, scale: int) -> Column:
    """round(num / den, scale), half away from zero, for whole-number inputs."""
    factor = 2 * 10**scale
    wide = 38 - len(str(factor))
    n = num.cast(f"decimal({wide},0)")
    d = den.cast("decimal(36,0)")
    magnitude = F.call_function(
        "div", F.abs(n) * F.lit(Decimal(factor)) + F.abs(d), F.abs(d) * F.lit(Decimal(2))
    ).cast("decimal(19,0)")
    unit = F.lit(Decimal(1).scaleb(-scale))
    negative = (n < 0) != (d < 0)
    signed = F.when(negative, -magnitude).otherwise(magnitude)
    return F.when(d != 0, (signed * unit).cast(f"decimal(24,{scale})"))


def ratio(num: Column, den: Column, scale: int) -> Column:
    """Count over count."""
    return half_up(num, den, scale)


def percent(num: Column, den: Column, scale: int) -> Column:
    """Count over count, in percent."""
    return half_up(num.cast("decimal(28,0)") * F.lit(100), den, scale)


def per_unit(amount: Column, den: Column, scale: int = 2) -> Column:
    """Money over count, e.g. revenue per session."""
    return half_up(cents(amount), den.cast("decimal(28,0)") * F.lit(100), scale)


def money_percent(amount: Column, total: Column, scale: int) -> Column:
    """Money over money, in percent."""
    return half_up(cents(amount) * F.lit(100), cents(total), scale)


def money_ratio(amount: Column, total: Column, scale: int) -> Column:
    return half_up(cents(amount), cents(total), scale)


def rate(num: Column, den: Column) -> Column:
    """An *unrounded* quotient (12 places) for arithmetic that rounds later."""
    quotient = num.cast("decimal(28,2)") / F.nullif(den.cast("decimal(20,0)"), F.lit(Decimal(0)))
    return quotient.cast("decimal(24,12)")


def rounded(value: Column, scale: int) -> Column:
    return F.round(value, scale).cast(f"decimal(24,{scale})")
