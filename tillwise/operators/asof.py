"""As-of joins: each row meets the entry of a dated history that was in force on its own day.

A history becomes half-open intervals per key.  An interval is listed in every bucket of days that it
touches, so the join is an equality on (key, bucket) with the interval as a residual test, and a row meets the few
entries of its bucket, however long the history is.  Rows after the last entry share one bucket.
"""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BUCKET_DAYS = 32


def intervals(history: DataFrame, keys: Sequence[str], taken: str, columns: Sequence[str]) -> DataFrame:
    """(keys, valid_from, valid_until, columns): half-open; the last entry of a key has no end.

    Of several entries of one key and day the greatest is kept, so that the result does not depend on row order.
    """
    one = history.where(F.col(taken).isNotNull()).groupBy(*keys, F.col(taken).alias("valid_from")).agg(F.max(F.struct(*columns)).alias("v"))
    ends = F.lead("valid_from").over(Window.partitionBy(*keys).orderBy("valid_from"))
    return one.select(*keys, "valid_from", ends.alias("valid_until"), "v.*")


def _bucket(day: Column, days: int) -> Column:
    return F.floor(F.unix_date(day) / F.lit(days))


def as_of(
    rows: DataFrame,
    history: DataFrame,
    keys: Sequence[str],
    at: str,
    taken: str,
    columns: Sequence[str],
    bucket_days: int = BUCKET_DAYS,
    salts: int = 1,
) -> DataFrame:
    """``rows`` with ``columns`` of the latest entry of their keys taken on or before the day ``at``.

    A row before its key's first entry, without a day, or of an unknown or NULL key stays, with NULLs.  ``at`` and ``taken`` are dates.
    ``salts`` spreads a key that holds most of the rows: such rows are dealt over that many tasks, each with a copy of the (small) history.
    """
    last = history.agg(F.max(_bucket(F.col(taken), bucket_days))).scalar() + 1
    spans = intervals(history, keys, taken, columns)
    through = F.coalesce(_bucket(F.date_sub("valid_until", 1), bucket_days), last)
    spans = spans.select(
        *[F.col(k).alias(f"__{k}") for k in keys],
        "valid_from",
        "valid_until",
        *[F.col(c).alias(f"__{c}") for c in columns],
        F.explode(F.sequence(_bucket(F.col("valid_from"), bucket_days), through)).alias("__bucket"),
    )
    asked = rows.withColumn("__at_bucket", F.least(_bucket(F.col(at), bucket_days), last))
    same = F.col("__at_bucket") == F.col("__bucket")
    for k in keys:
        same = same & (F.col(k) == F.col(f"__{k}"))
    if salts > 1:
        asked = asked.withColumn("__at_salt", F.pmod(F.xxhash64(*rows.columns), F.lit(salts)))
        spans = spans.withColumn("__salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long"))))
        same = same & (F.col("__at_salt") == F.col("__salt"))
    inside = (F.col(at) >= F.col("valid_from")) & (F.col("valid_until").isNull() | (F.col(at) < F.col("valid_until")))
    joined = asked.join(spans, same & inside, "left")
    return joined.select(*[F.col(c) for c in rows.columns], *[F.col(f"__{c}").alias(c) for c in columns])


def in_one_currency(rows: DataFrame, history: DataFrame, price: str, at: str, salts: int = 1) -> DataFrame:
    """Add ``rate`` and ``base_price``: the price at the rate of the row's own day, rounded to cents; NULL where no rate was known yet.

    ``history`` has currency, rate and taken_on; rows have currency.
    """
    rated = as_of(rows, history, ["currency"], at, "taken_on", ["rate"], salts=salts)
    converted = (F.col(price).cast("decimal(18,2)") * F.col("rate")).cast("decimal(38,8)")
    return rated.withColumn("base_price", F.round(converted, 2).cast("decimal(18,2)"))


def drifting_rates(base: DataFrame, first_day: str, last_day: str, step_months: int = 3) -> DataFrame:
    """A history for tables that come without one: ``base`` (currency, rate), moved a little at the start of each step by a fixed rule."""
    steps = F.sequence(F.lit(first_day).cast("date"), F.lit(last_day).cast("date"), F.expr(f"interval {step_months} months"))
    t = base.select("currency", "rate", F.posexplode(steps).alias("n", "taken_on"))
    moved = F.floor(F.col("rate") * 10000 * (9800 + (F.col("n") * 37 + F.length("currency") * 11) % 401) / 10000)
    return t.select("currency", (moved.cast("decimal(14,0)") * F.lit(Decimal("0.0001"))).cast("decimal(14,4)").alias("rate"), "taken_on")
