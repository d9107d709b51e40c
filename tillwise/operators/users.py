"""People rather than visits: frequency tables, cohorts and repeat purchase."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import calendar, exact
from ..functions.joins import null_safe_join


def _tier_total(c: str) -> Column:
    """A total over the tiers of a frequency table.

    Such a table is short, since n rows have at most about sqrt(2 n) different counts per
    user: the total fits one task and saves a second pass over the raw rows.
    """
    return F.sum(c).over(Window.partitionBy())


def sessions_per_user(sessions: DataFrame, user: str = "user_id") -> DataFrame:
    """How many users had 1, 2, 3 … sessions."""
    per_user = sessions.groupBy(user).agg(exact.rows().alias("sessions_per_user"))
    tiers = per_user.groupBy("sessions_per_user").agg(exact.rows().alias("users"), F.count(user).alias("known"))
    return tiers.select(
        "sessions_per_user",
        "users",
        exact.percent(F.col("users"), _tier_total("known"), 2).alias("pct_of_users"),
    ).orderBy("sessions_per_user")


def orders_per_customer(orders: DataFrame, user: str = "user_id") -> DataFrame:
    """How many customers placed 1, 2, 3 … orders, and the revenue of each tier."""
    per_user = orders.groupBy(user).agg(
        exact.rows().alias("orders_per_user"), exact.sum_cents("price_usd").alias("user_cents")
    )
    tiers = per_user.groupBy("orders_per_user").agg(
        exact.rows().alias("customers"),
        F.count(user).alias("known"),
        exact.from_cents(F.sum("user_cents")).alias("revenue"),
    )
    return tiers.select(
        "orders_per_user",
        "customers",
        exact.percent(F.col("customers"), _tier_total("known"), 2).alias("pct_of_customers"),
        "revenue",
        exact.money_percent(F.col("revenue"), _tier_total("revenue"), 1).alias("pct_of_revenue"),
    ).orderBy("orders_per_user")


def repeat_purchase_counts(tiers: DataFrame, repeat_session_orders: Column) -> DataFrame:
    """Second-and-later orders against orders placed in return visits, from the tier table.

    What a return visit sold beyond second-and-later orders was a first purchase.
    """
    later = F.sum((F.col("orders_per_user") - 1) * F.col("customers")).alias("second_or_later_orders")
    t = tiers.agg(later).withColumn("repeat_session_orders", repeat_session_orders)
    first = F.col("repeat_session_orders") - F.col("second_or_later_orders")
    return t.withColumn("first_purchases_on_return", first).withColumn(
        "first_purchase_pct",
        exact.percent(F.col("first_purchases_on_return"), F.col("repeat_session_orders"), 1),
    )


def repeat_purchase_reconciliation(
    sessions: DataFrame, orders: DataFrame, order_id: str = "order_id", key: str = "website_session_id"
) -> DataFrame:
    """The exact form: which orders of return visits were the user's very first.

    A user's first order is the least id among those at the user's earliest time.  Both minima are of
    fixed width and combine map-side by hash, so a user with a large part of all orders costs a task one row.
    """
    earliest = orders.groupBy("user_id").agg(F.min("created_at").alias("earliest"))
    at_once = null_safe_join(orders.select("user_id", "created_at", order_id), earliest, ["user_id"])
    first = at_once.where(F.col("created_at").eqNullSafe(F.col("earliest"))).groupBy("user_id").agg(F.min(order_id).alias(order_id))
    flagged = orders.join(
        first.select(order_id, F.lit(1).alias("is_first")), order_id, "left"
    ).groupBy(key).agg(exact.rows().alias("n"), F.count("is_first").alias("firsts"))
    t = flagged.join(sessions.select(key, "is_repeat_session"), key).agg(
        F.coalesce(F.sum(F.col("n") - F.col("firsts")), F.lit(0)).alias("second_or_later_orders"),
        F.coalesce(F.sum(F.when(F.col("is_repeat_session") == 1, F.col("n"))), F.lit(0)).alias(
            "repeat_session_orders"
        ),
        F.coalesce(F.sum(F.when(F.col("is_repeat_session") == 1, F.col("firsts"))), F.lit(0)).alias(
            "first_purchases_on_return"
        ),
    )
    return t.withColumn(
        "first_purchase_pct",
        exact.percent(F.col("first_purchases_on_return"), F.col("repeat_session_orders"), 1),
    )


def cohort_retention(orders: DataFrame, user: str = "user_id", ts: str = "created_at") -> DataFrame:
    """Users by month of first order and months since, as a share of the cohort.

    Orders are folded to one row per user and month first, so the window per user is never
    longer than the calendar, whatever one user orders.
    """
    active = orders.select(user, calendar.month_start(F.col(ts)).alias("month")).distinct()
    cohort = F.min("month").over(Window.partitionBy(user))
    cells = (
        active.withColumn("cohort", cohort)
        .groupBy("cohort", F.months_between("month", "cohort").cast("int").alias("months_since"))
        .agg(exact.rows().alias("users"))
    )
    size = F.max(F.when(F.col("months_since") == 0, F.col("users"))).over(Window.partitionBy("cohort"))
    return cells.withColumn("cohort_size", size).select(
        calendar.month_label(F.col("cohort")).alias("cohort_month"),
        "months_since",
        "users",
        "cohort_size",
        exact.percent(F.col("users"), F.col("cohort_size"), 1).alias("retention_pct"),
    )


def cohort_matrix(retention: DataFrame, months: int) -> DataFrame:
    """The retention table as one row per cohort and one column per month since.

    ``later_months`` adds up the users of all months past the last column, so no cell is lost.
    """
    columns = [
        F.max(F.when(F.col("months_since") == m, F.col("users"))).alias(f"month_{m}") for m in range(months + 1)
    ]
    later = F.coalesce(F.sum(F.when(F.col("months_since") > months, F.col("users"))), F.lit(0)).alias("later_months")
    return retention.groupBy("cohort_month").agg(F.max("cohort_size").alias("cohort_size"), *columns, later)
