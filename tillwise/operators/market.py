"""Listing markets: price levels, one currency, price drivers, review seasonality, value."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import calendar, exact
from . import quantiles


def rates_as_of(rates: DataFrame, day: Column) -> DataFrame:
    """The latest rate of each currency taken on or before ``day``."""
    known = rates.where(F.col("taken_on") <= day)
    return known.groupBy("currency").agg(
        F.max_by("rate", "taken_on").alias("rate"), F.max("taken_on").alias("taken_on")
    )


def in_one_currency(listings: DataFrame, rates: DataFrame, price: str = "price") -> DataFrame:
    """Add ``base_price``: the local price at the given rate, rounded to cents.

    A listing whose currency has no rate keeps its row with a NULL ``base_price``.
    """
    converted = (F.col(price) * F.col("rate")).cast("decimal(38,8)")
    return listings.join(rates.select("currency", "rate"), "currency", "left").withColumn(
        "base_price", F.round(converted, 2).cast("decimal(18,2)")
    )


def market_comparison(listings: DataFrame, by: str, price: str) -> DataFrame:
    """Listings, mean, median and quartile spread of price per market, all from one fold of the listings."""
    counts = quantiles.fold(listings, [by], price)
    q = quantiles.from_fold(counts, [by], price, {"q1": "0.25", "median_price": "0.5", "q3": "0.75"})
    return q.select(
        by,
        F.col("rows").alias("listings"),
        exact.per_unit(F.col("total").cast("decimal(21,2)"), F.col("valued")).alias("avg_price"),
        "median_price",
        (F.col("q3") - F.col("q1")).alias("price_spread"),
    )


def price_correlations(listings: DataFrame, price: str, attributes: Sequence[str]) -> DataFrame:
    """Pearson correlation of each numeric attribute with price, one row per attribute, in one pass."""
    t = listings.agg(*[F.corr(F.col(price).cast("double"), F.col(a).cast("double")).alias(a) for a in attributes])
    pairs = [F.struct(F.lit(a).alias("attribute"), F.round(a, 6).alias("correlation")) for a in attributes]
    return t.select(F.inline(F.array(*pairs)))


def price_by_level(listings: DataFrame, price: str, attributes: Sequence[str]) -> DataFrame:
    """Mean price of each level of each category, and how far it lies from the overall mean.

    All categories are grouped in one pass over the listings; the overall mean is a one-row aggregate,
    so no task sees all levels of a category.
    """
    levels = F.array(
        *[F.struct(F.lit(a).alias("attribute"), F.col(a).cast("string").alias("level")) for a in attributes]
    )
    t = (
        listings.select(price, F.inline(levels))
        .groupBy("attribute", "level")
        .agg(exact.rows().alias("listings"), exact.from_cents(exact.sum_cents(price)).alias("total"))
    )
    overall = listings.agg(F.struct(exact.rows().alias("n"), exact.sum_cents(price).alias("cents"))).scalar()
    all_total = overall["cents"].cast("decimal(20,0)")
    all_rows = overall["n"].cast("decimal(13,0)")
    own = exact.cents(F.col("total")).cast("decimal(20,0)")
    n = F.col("listings").cast("decimal(13,0)")
    gap = (own * all_rows - all_total * n).cast("decimal(33,0)")
    return t.select(
        "attribute",
        "level",
        "listings",
        exact.per_unit(F.col("total"), F.col("listings")).alias("avg_price"),
        exact.percent(gap, (all_total * n).cast("decimal(33,0)"), 2).alias("pct_vs_overall"),
    )


def reviews_by_market(reviews: DataFrame, listings: DataFrame, by: str, ts: str = "created_at") -> DataFrame:
    """Reviews per market and month.

    Reviews are folded per listing and month first, so a much-reviewed listing reaches the
    join as one row a month.
    """
    folded = reviews.groupBy("listing_id", *calendar.year_month(F.col(ts))).agg(exact.rows().alias("n"))
    return (
        folded.join(listings.select("listing_id", by), "listing_id")
        .groupBy(by, "year_", "month_")
        .agg(F.sum("n").alias("reviews"))
    )


def best_value(listings: DataFrame, reviews: DataFrame, by: str, price: str) -> DataFrame:
    """Markets ranked by reviews per listing for each 1,000 of median price.

    Reviews are folded to one row per listing before they meet the listings, and these to one row per
    market and price: the median and the numbers of listings and reviews come from that one fold.
    """
    per_listing = reviews.groupBy("listing_id").agg(exact.rows().alias("reviews"))
    known = listings.select("listing_id", by, price).join(per_listing, "listing_id", "left")
    counts = known.groupBy(by, price).agg(exact.rows().alias("n"), F.coalesce(F.sum("reviews"), F.lit(0)).alias("reviews"))
    q = quantiles.from_fold(counts, [by], price, {"median_price": "0.5"}, carry=["reviews"])
    t = q.select(by, F.col("rows").alias("listings"), "median_price", "reviews")
    scored = t.select(
        by,
        "listings",
        "median_price",
        exact.ratio(F.col("reviews"), F.col("listings"), 2).alias("reviews_per_listing"),
        exact.half_up(
            F.col("reviews").cast("decimal(16,0)") * 100000,
            F.col("listings").cast("decimal(16,0)") * exact.cents(F.col("median_price")).cast("decimal(16,0)"),
            4,
        ).alias("value_score"),
    )
    best_first = Window.partitionBy().orderBy(F.desc_nulls_last("value_score"))
    return scored.withColumn("value_rank", F.rank().over(best_first))
