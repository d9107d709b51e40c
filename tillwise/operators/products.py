"""Product mix, add-on attachment and launch windows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import exact
from ..functions.recursion import follow


def items_per_order(orders: DataFrame, period: Sequence[Column]) -> DataFrame:
    """Keyed on the *order's* time, unlike the session-keyed revenue metrics."""
    t = orders.groupBy(*period).agg(
        exact.rows().alias("orders"),
        F.sum("items_purchased").alias("items"),
        exact.from_cents(exact.sum_cents("price_usd")).alias("revenue"),
    )
    return t.select(
        *t.columns[: len(period)],
        exact.ratio(F.col("items"), F.col("orders"), 3).alias("items_per_order"),
        exact.per_unit(F.col("revenue"), F.col("orders")).alias("average_order_value"),
    )


def attach_rate(orders: DataFrame, period: Sequence[Column]) -> DataFrame:
    """Items per order less one: the share of orders with a second item when orders hold one or two."""
    t = orders.groupBy(*period).agg(
        exact.rows().alias("orders"), F.sum("items_purchased").alias("items")
    )
    return t.select(
        *t.columns[: len(period)],
        "orders",
        exact.percent(F.col("items") - F.col("orders"), F.col("orders"), 1).alias("attach_rate_pct"),
    )


def first_change_point(series: DataFrame, order: Sequence[str], metric: str, floor: Column) -> DataFrame:
    """The first period in which a bounded metric leaves its floor (one row; NULL if it never does).

    A period of unknown time comes after all others.
    """
    key = [c for name in order for c in (F.col(name).isNull().alias(f"no_{name}"), F.col(name))]
    first = F.min(F.struct(*key, F.col(metric))).alias("first")
    return series.where(F.col(metric) > floor).agg(first).select(*[f"first.{c}" for c in (*order, metric)])


def product_mix(items: DataFrame, products: DataFrame) -> DataFrame:
    """Primary and add-on units per product.

    Items are folded to one row per product id before the join, so a best-seller with a
    large part of all items costs the join one row.  ``price`` is the highest price seen;
    it is *the* price only where ``quality.price_dependency`` finds nothing.
    """
    by_id = items.groupBy("product_id").agg(
        F.max("price_usd").alias("price"),
        F.count_if(F.col("is_primary_item") == 1).alias("sold_as_primary"),
        F.count_if(F.col("is_primary_item") == 0).alias("sold_as_addon"),
    )
    named = by_id.join(products.select("product_id", "product_name"), "product_id")
    mix = named.groupBy("product_name").agg(
        F.max("price").alias("price"),
        F.sum("sold_as_primary").alias("sold_as_primary"),
        F.sum("sold_as_addon").alias("sold_as_addon"),
    )
    addon = F.col("sold_as_addon")
    return mix.withColumn(
        "pct_sold_as_addon", exact.percent(addon, F.col("sold_as_primary") + addon, 2)
    ).orderBy(F.desc("sold_as_addon"), "product_name")


def launches(products: DataFrame) -> DataFrame:
    """One launch per product name: the day its first product row was created."""
    return products.groupBy(F.col("product_name").alias("launch")).agg(
        F.min("created_at").cast("date").alias("launch_day")
    )


def _days(start: Column, days: int) -> Column:
    return F.explode(F.sequence(start, F.date_add(start, days - 1)))


def _sides(launched: DataFrame, days: int) -> DataFrame:
    """Two half-open windows per launch, [launch - days, launch) and [launch, launch + days)."""
    sides = F.array(
        F.struct(F.lit("before").alias("window_"), F.date_sub("launch_day", days).alias("from_day")),
        F.struct(F.lit("after").alias("window_"), F.col("launch_day").alias("from_day")),
    )
    return launched.select("launch", "launch_day", F.inline(sides))


def launch_windows(orders: DataFrame, launched: DataFrame, days: int = 90) -> DataFrame:
    """Orders, items per order and order value either side of each launch.

    Launches fall on whole days, so orders are folded to one row per day (one scan, at most
    one row per calendar day after the fold) and windows are spelled out as days: the range
    condition becomes an equi-join.  A window without orders keeps its row, with zero orders.
    """
    daily = orders.groupBy(F.col("created_at").cast("date").alias("day")).agg(
        exact.rows().alias("n"), F.sum("items_purchased").alias("items"), exact.sum_cents("price_usd").alias("value")
    )
    windows = _sides(launched, days).select("launch", "window_", _days(F.col("from_day"), days).alias("day"))
    t = windows.join(daily, "day", "left").groupBy("launch", "window_").agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("orders"),
        F.sum("items").alias("items"),
        exact.from_cents(F.sum("value")).alias("revenue"),
    )
    return t.select(
        "launch",
        "window_",
        "orders",
        exact.ratio(F.col("items"), F.col("orders"), 3).alias("items_per_order"),
        exact.per_unit(F.col("revenue"), F.col("orders")).alias("avg_order_value"),
    )


def launch_overlap(launched: DataFrame, days: int = 90) -> DataFrame:
    """Per launch and window, how many other launches it contains and how far the nearest one is (NULL if none).

    Two rows per launch.  Launches are folded to days, and running sums over the days of the calendar
    count a window's launches, so launches that fall together never pair up.
    """
    daily = launched.groupBy("launch_day").agg(exact.rows().alias("n")).withColumn("d", F.unix_date("launch_day"))
    order = Window.orderBy("d")
    before, after = order.rangeBetween(-days, -1), order.rangeBetween(1, days - 1)
    around = daily.select(
        "launch_day",
        F.coalesce(F.sum("n").over(before), F.lit(0)).alias("n_before"),
        (F.col("d") - F.max("d").over(before)).alias("days_before"),
        (F.coalesce(F.sum("n").over(after), F.lit(0)) + F.col("n") - 1).alias("n_after"),
        F.when(F.col("n") > 1, 0).otherwise(F.min("d").over(after) - F.col("d")).alias("days_after"),
    )
    sides = [
        F.struct(F.lit(w).alias("window_"), F.col(f"n_{w}").alias("other_launches"), F.col(f"days_{w}").alias("nearest_days"))
        for w in ("before", "after")
    ]
    others = around.select("launch_day", F.inline(F.array(*sides)))
    return launched.join(others, "launch_day").select("launch", "window_", "other_launches", "nearest_days")


def launch_chains(launched: DataFrame, days: int = 90) -> DataFrame:
    """(launch, launch_day, first_launch): launches less than ``days`` apart belong to one chain, and so on along it.

    A chain is named by its first launch, ties by name.  ``launched`` has distinct (launch, launch_day).  Launches are folded to days; a day is linked to the
    launch day before it if that is near enough, and following the links to their end takes as many rounds as the logarithm of the longest chain.
    """
    daily = launched.groupBy("launch_day").agg(F.min("launch").alias("first_launch"))
    before = F.lag("launch_day").over(Window.orderBy("launch_day"))  # a row per day of the calendar at most
    near = F.datediff("launch_day", before) < days
    ends = follow(daily.select("launch_day", F.when(near, before).alias("before")), "launch_day", "before")
    named = ends.join(daily.withColumnRenamed("launch_day", "end"), "end").select(F.col("node").alias("launch_day"), "first_launch")
    return launched.join(named, "launch_day").select("launch", "launch_day", "first_launch")
