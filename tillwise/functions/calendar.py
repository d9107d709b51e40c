"""Calendar keys from a zoneless timestamp.

Keys are built from date parts rather than ``date_format``, which would move a
``timestamp_ntz`` through the session time zone (and so through its DST gaps).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def year_month(ts: Column) -> list[Column]:
    return [F.year(ts).alias("year_"), F.month(ts).alias("month_")]


def month_label(day: Column) -> Column:
    """``2014-08`` from a date.  Group by ``month_start`` and label the groups: a date key is an
    integer, a label is text to be built and hashed for every row."""
    return F.substring(day.cast("string"), 1, 7)


def month_start(ts: Column) -> Column:
    return F.trunc(ts.cast("date"), "month")


def week_start(ts: Column) -> Column:
    """Monday of the ISO week."""
    return F.trunc(ts.cast("date"), "week")


def time_of_day(ts: Column) -> Column:
    """Night, morning, afternoon or evening, six hours each from midnight."""
    names = F.array(*[F.lit(n) for n in ("night", "morning", "afternoon", "evening")])
    return F.element_at(names, F.floor(F.hour(ts) / 6).cast("int") + 1)


def until_day_of_year(ts: Column, month: int, day: int) -> Column:
    """Like-for-like window: 1 January to the given day, inclusive, every year."""
    return F.month(ts) * 100 + F.dayofmonth(ts) <= F.lit(month * 100 + day)


def until_day_in_months(month_key: Column, ts: Column, month: int, day: int) -> Column:
    """The same window over a table laid out by month: whole months up to the last are taken by
    their partition, so months after it are not read, and every year is covered."""
    return (month_key < F.lit(month)) | ((month_key == F.lit(month)) & (F.dayofmonth(ts) <= F.lit(day)))


def retail_year_start(year: Column) -> Column:
    """The day after the Saturday nearest to 31 January: the first Sunday after 28 January."""
    return F.next_day(F.make_date(year, F.lit(1), F.lit(28)), "Sun")


def retail_calendar(days: DataFrame, day: str = "day") -> DataFrame:
    """Add the 4-5-4 retail year, week, quarter and period to a table of days.

    A quarter is 13 weeks split 4-5-4; a 53rd week, when there is one, stays in the
    last period.  ``days`` is a calendar dimension: one row per date.
    """
    d = F.col(day)
    this_year = F.year(d)
    start_year = F.when(d >= retail_year_start(this_year), this_year).otherwise(this_year - 1)
    week = F.floor(F.datediff(d, retail_year_start(F.col("retail_year"))) / 7).cast("int") + 1
    quarter = F.least(F.floor((F.col("retail_week") - 1) / 13).cast("int") + 1, F.lit(4))
    week_in_quarter = F.col("retail_week") - 13 * (F.col("retail_quarter") - 1)
    period_in_quarter = F.when(week_in_quarter <= 4, 1).when(week_in_quarter <= 9, 2).otherwise(3)
    return (
        days.withColumn("retail_year", start_year)
        .withColumn("retail_week", week)
        .withColumn("retail_quarter", quarter)
        .withColumn("retail_period", 3 * (F.col("retail_quarter") - 1) + period_in_quarter)
    )


def spine(bounds: DataFrame, first: str, last: str, step: str, name: str) -> DataFrame:
    """Every date from ``first`` to ``last`` of a one-row frame, ``step`` apart."""
    steps = F.sequence(F.col(first), F.col(last), F.expr(f"interval {step}"))
    return bounds.select(F.explode(steps).alias(name))
