"""Load verification and data-quality checks.

Each check returns rows of (check_name, subject, expected, actual, ok); ``run`` unites
them.  ``ok`` is 1 or 0.  Keys and domains that a row store would enforce are checked here.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import exact
from ..sources import schemas


def _row(check: str, subject: Column | str, expected: Column, actual: Column) -> list[Column]:
    e, a = expected.cast("bigint"), actual.cast("bigint")
    return [
        F.lit(check).alias("check_name"),
        (F.lit(subject) if isinstance(subject, str) else subject).alias("subject"),
        e.alias("expected"),
        a.alias("actual"),
        F.coalesce((e == a).cast("int"), F.lit(0)).alias("ok"),
    ]


def union(checks: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, checks)


def row_counts(tables: Mapping[str, DataFrame], expected: Mapping[str, int]) -> DataFrame:
    return union(
        [
            tables[t].agg(exact.rows().alias("n")).select(*_row("row_count", t, F.lit(n), F.col("n")))
            for t, n in expected.items()
        ]
    )


def table_sizes(tables: Mapping[str, DataFrame]) -> DataFrame:
    return union(
        [
            df.agg(exact.rows().alias("rows_loaded")).select(F.lit(t).alias("table_name"), "rows_loaded")
            for t, df in tables.items()
        ]
    )


def null_text(df: DataFrame, column: str, sentinel: str = "NULL") -> DataFrame:
    """Rows, rows still holding the text ``NULL``, and real nulls."""
    return df.agg(
        exact.rows().alias("total_rows"),
        F.count_if(F.col(column) == sentinel).alias("literal_null_text"),
        F.count_if(F.col(column).isNull()).alias("real_nulls"),
    )


def text_lengths(df: DataFrame, column: str) -> DataFrame:
    """Length of each text, and whether a carriage return is stuck to its end."""
    return df.select(
        column,
        F.char_length(column).alias("len"),
        F.col(column).endswith("\r").cast("int").alias("trailing_cr"),
    )


def primary_key(df: DataFrame, table: str, key: Sequence[str]) -> DataFrame:
    """Surplus rows (all but one of each key) plus rows with a NULL key; expected 0.

    The count per key combines map-side, so a key repeated a billion times is no hot spot.
    """
    missing = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in key])
    per_key = df.groupBy(*key).agg(exact.rows().alias("n"))
    bad = F.coalesce(F.sum(F.when(missing, F.col("n")).otherwise(F.col("n") - 1)), F.lit(0))
    return per_key.agg(bad.alias("bad")).select(*_row("primary_key", table, F.lit(0), F.col("bad")))


def foreign_key(child: DataFrame, parent: DataFrame, subject: str, key: str, parent_key: str) -> DataFrame:
    """Child rows whose key has no parent; expected 0.  Children are folded per key first."""
    per_key = child.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("k")).agg(exact.rows().alias("n"))
    parents = parent.select(F.col(parent_key).alias("k"))
    orphans = per_key.join(parents, "k", "left_anti").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"))
    return orphans.select(*_row("foreign_key", subject, F.lit(0), F.col("n")))


def domain_rules(table: str, schema: T.StructType | None = None) -> dict[str, Column]:
    """Violations per rule for a declared table: not-null, unsigned, 0/1 flag, text width."""
    schema = schema or schemas.SCHEMAS[table]
    rules: dict[str, Column] = {}
    for field in schema:
        c = F.col(field.name)
        if not field.nullable:
            rules[f"{table}.{field.name} not null"] = c.isNull()
        if isinstance(field.dataType, T.NumericType):
            rules[f"{table}.{field.name} not negative"] = c < 0
        if field.name.startswith("is_"):
            rules[f"{table}.{field.name} is 0 or 1"] = ~c.isin(0, 1)
    for name, width in schemas.TEXT_LIMITS.get(table, {}).items():
        rules[f"{table}.{name} fits {width}"] = F.char_length(name) > width
    return rules


def domains(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """Rows violating each rule; expected 0.  All rules of a table take one pass."""
    names = list(rules)
    counts = df.agg(*[F.count_if(rules[r]).alias(f"v{i}") for i, r in enumerate(names)])
    rows = [F.struct(*_row("domain", r, F.lit(0), F.col(f"v{i}"))) for i, r in enumerate(names)]
    return counts.select(F.inline(F.array(*rows)))


def tie_out(subject: str, expected: DataFrame, actual: DataFrame) -> DataFrame:
    """Two one-row, one-column frames that must agree."""
    named = expected.toDF("expected_n")
    return named.select(*_row("tie_out", subject, F.col("expected_n"), actual.scalar()))


def segments_sum_to_total(subject: str, df: DataFrame, segments: DataFrame, count: str) -> DataFrame:
    """Exhaustive segments: their counts add up to the table's rows."""
    return tie_out(subject, df.agg(exact.rows()), segments.agg(F.sum(count)))


def price_dependency(items: DataFrame, product: str, price: str) -> DataFrame:
    """Products with more than one distinct price (``max(price)`` is not *the* price there).

    Distinct values are found in two steps that combine map-side.
    """
    pairs = items.select(product, price).distinct()
    return (
        pairs.groupBy(product)
        .agg(F.count(price).alias("distinct_prices"), F.min(price).alias("lowest"), F.max(price).alias("highest"))
        .where(F.col("distinct_prices") > 1)
    )


def partial_periods(df: DataFrame, ts: str) -> DataFrame:
    """Months of the observation window, flagging one the window does not cover to its ends.

    The window is the days seen; a month at its edge is partial when the first day seen is
    not its first, or the last day seen not its last.
    """
    day = F.col(ts).cast("date")
    months = df.groupBy(F.trunc(day, "month").alias("month")).agg(
        exact.rows().alias("n"), F.min(day).alias("first_day"), F.max(day).alias("last_day")
    )
    seen = Window.partitionBy()
    start, end = F.min("first_day").over(seen), F.max("last_day").over(seen)
    partial = (start > F.col("month")) | (end < F.last_day("month"))
    return months.select(
        F.substring(F.col("month").cast("string"), 1, 7).alias("month"), "n", partial.cast("int").alias("is_partial")
    )


def right_censored(periods: DataFrame, period_end: Column, observed_until: Column, horizon_days: int) -> DataFrame:
    """Flag periods that end less than ``horizon_days`` before the data stops."""
    censored = period_end > F.date_sub(observed_until, horizon_days)
    return periods.withColumn("right_censored", censored.cast("int"))


def simulation_signals(repeat_share: DataFrame, frequency: DataFrame, refunds: DataFrame) -> DataFrame:
    """Structural signs that data was generated: verdict 1 means the sign is present.

    ``repeat_share``: repeated_sessions per segment; ``frequency``: sessions_per_user, users;
    ``refunds``: refund_amount_usd with the item's price_usd.
    """
    zero = repeat_share.agg(F.count_if(F.col("repeated_sessions") == 0).alias("observed")).select(
        F.lit("segments with exactly zero repeats").alias("signal"), "observed", (F.col("observed") > 0).alias("v")
    )
    more = F.col("users") > F.lag("users").over(Window.partitionBy().orderBy("sessions_per_user"))
    rising = frequency.select(more.alias("more")).agg(F.count_if("more").alias("observed")).select(
        F.lit("frequency tiers larger than the tier before").alias("signal"), "observed", (F.col("observed") > 0).alias("v")
    )
    partial = refunds.agg(
        F.count_if(F.col("refund_amount_usd") != F.col("price_usd")).alias("observed")
    ).select(
        F.lit("refunds that differ from the price").alias("signal"), "observed", (F.col("observed") == 0).alias("v")
    )
    return union([zero, rising, partial]).select("signal", "observed", F.col("v").cast("int").alias("verdict"))


def latest_per_key(df: DataFrame, keys: Sequence[str], newest: Sequence[str]) -> DataFrame:
    """Keep one row per key: the newest, ties settled by the remaining columns.

    Asking for the first row number only lets Spark cut each key to one row per task before
    the shuffle, so a key that holds most of the rows does not end up in one task.
    """
    rest = [c for c in df.columns if c not in keys and c not in newest]
    newest_first = Window.partitionBy(*keys).orderBy(*[F.desc(c) for c in (*newest, *rest)])
    return df.withColumn("__nth", F.row_number().over(newest_first)).where("__nth = 1").drop("__nth")


def run(
    tables: Mapping[str, DataFrame], expected_counts: Mapping[str, int] | None = None
) -> DataFrame:
    """Every declared check over the shop's tables, as one result."""
    checks = []
    if expected_counts:
        checks.append(row_counts(tables, expected_counts))
    for name, df in tables.items():
        checks.append(primary_key(df, name, [schemas.PRIMARY_KEYS[name]]))
        checks.append(domains(df, domain_rules(name)))
    for child, key, parent, parent_key in schemas.FOREIGN_KEYS:
        if child in tables and parent in tables:
            checks.append(
                foreign_key(tables[child], tables[parent], f"{child}.{key}", key, parent_key)
            )
    return union(checks)
