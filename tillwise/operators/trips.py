"""Trip volumes, distances, busy hours and popular places."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import calendar, exact
from . import quantiles, series


def trips_per_day(trips: DataFrame, ts: str = "picked_up_at") -> DataFrame:
    return trips.groupBy(F.col(ts).cast("date").alias("day")).agg(exact.rows().alias("trips"))


def weekly_trips(trips: DataFrame, ts: str = "picked_up_at") -> DataFrame:
    """Trips per ISO week, with the change on the week before."""
    weeks = trips.groupBy(calendar.week_start(F.col(ts)).alias("week")).agg(exact.rows().alias("trips"))
    return series.period_over_period(weeks, [], ["week"], "trips").drop("next")


def average_trips_per_week(trips: DataFrame, ts: str = "picked_up_at") -> DataFrame:
    """Average weekly trips in each year (a week belongs to the year of its Monday)."""
    weeks = trips.groupBy(calendar.week_start(F.col(ts)).alias("week")).agg(exact.rows().alias("trips"))
    t = weeks.groupBy(F.year("week").alias("year_")).agg(
        exact.rows().alias("weeks"), F.sum("trips").alias("trips")
    )
    return t.withColumn("avg_trips_per_week", exact.ratio(F.col("trips"), F.col("weeks"), 1))


def average_distance(trips: DataFrame, period: Column, distance: str = "distance") -> DataFrame:
    """Mean distance per trip and period, outliers left out and counted beside it; distances are recorded to a hundredth.

    An outlier lies more than one and a half quartile ranges outside its period's quartiles.  Trips without a
    distance are not counted.  Everything comes from one fold of the trips to distinct distances.
    """
    t = trips.select(period, exact.money(F.col(distance)).alias(distance))
    key = t.columns[0]
    s = quantiles.outlier_summary(t, [key], distance)
    return s.select(
        key,
        F.col("n").alias("trips"),
        "outliers",
        exact.per_unit(F.col("kept_total").cast("decimal(21,2)"), F.col("kept")).alias("avg_distance"),
        exact.per_unit(F.col("total").cast("decimal(21,2)"), F.col("n")).alias("avg_with_outliers"),
    )


def busiest_times(events: DataFrame, ts: str) -> DataFrame:
    """Volume by weekday (Monday = 0) and hour, ranked; at most 168 rows reach the window."""
    t = events.groupBy(F.weekday(ts).alias("weekday"), F.hour(ts).alias("hour")).agg(exact.rows().alias("n"))
    return t.withColumn("busy_rank", F.rank().over(Window.partitionBy().orderBy(F.desc("n"))))


def volume_by_time_of_day(events: DataFrame, ts: str) -> DataFrame:
    """Volume by part of the day, weekdays and weekends apart."""
    weekend = F.when(F.weekday(ts) >= 5, "weekend").otherwise("weekday")
    return events.groupBy(
        weekend.alias("day_kind"), calendar.time_of_day(F.col(ts)).alias("time_of_day")
    ).agg(exact.rows().alias("n"))


def popular_places(counts: DataFrame, zones: DataFrame, k: int) -> DataFrame:
    """The top ``k`` zones by name, from trips per zone id (an id may come in several rows)."""
    t = counts.groupBy("zone_id").agg(F.sum("trips").alias("trips"))
    return t.join(zones, "zone_id").select("zone", "trips").orderBy(F.desc("trips"), "zone").limit(k)


def popular_pairs(counts: DataFrame, zones: DataFrame, k: int) -> DataFrame:
    """The top ``k`` pairs, from trips per pair of zone ids; the zone table plays both roles."""
    t = counts.groupBy("pickup_zone_id", "dropoff_zone_id").agg(F.sum("trips").alias("trips"))
    pickup = zones.select(F.col("zone_id").alias("pickup_zone_id"), F.col("zone").alias("pickup"))
    dropoff = zones.select(F.col("zone_id").alias("dropoff_zone_id"), F.col("zone").alias("dropoff"))
    named = t.join(pickup, "pickup_zone_id").join(dropoff, "dropoff_zone_id")
    return (
        named.select("pickup", "dropoff", "trips")
        .orderBy(F.desc("trips"), "pickup", "dropoff")
        .limit(k)
    )


def trips_by_retail_period(trips: DataFrame, retail_days: DataFrame, ts: str = "picked_up_at") -> DataFrame:
    """Trips per 4-5-4 period.  Trips are folded to days before they meet the calendar dimension."""
    return (
        trips_per_day(trips, ts)
        .join(retail_days, "day")
        .groupBy("retail_year", "retail_period")
        .agg(F.countDistinct("retail_week").alias("weeks"), F.sum("trips").alias("trips"))
    )
