"""Historical fact tables.

Dimension joins carry no broadcast hint: Spark broadcasts the dimension while its size is
under ``spark.sql.autoBroadcastJoinThreshold`` and otherwise sorts and merges, where AQE
splits a route that holds too many rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetpulse.functions.timecols import rounded
from fleetpulse.operators.delay import LATE_AFTER_S


def fct_delay_alerts(trips: DataFrame, routes: DataFrame, threshold_s: int = LATE_AFTER_S) -> DataFrame:
    late = trips.where(F.col("delay") > threshold_s)
    named = routes.select("route_id", "route_name", "route_type_label")
    return late.join(named, "route_id", "left").select(
        *("event_id", "event_date", "event_hour", "route_id", "route_name", "route_type_label"),
        *("trip_id", "delay", "delay_minutes", "event_ts"),
    )


def fct_delay_by_hour(trips: DataFrame, threshold_s: int = LATE_AFTER_S) -> DataFrame:
    """Delay per local hour over all trips, on time or not."""
    delayed_minutes = F.when(F.col("delay") > 0, F.col("delay_minutes"))
    return trips.groupBy("event_date", "event_hour").agg(
        rounded(F.avg("delay_minutes"), 2).alias("avg_delay_minutes"),
        rounded(F.avg(delayed_minutes), 2).alias("avg_delay_minutes_delayed_only"),
        F.count(F.lit(1)).alias("trip_count"),
        F.count_if(F.col("delay") > threshold_s).alias("delayed_trip_count"),
    )


def fct_stall_incidents(stalls: DataFrame, routes: DataFrame) -> DataFrame:
    return stalls.join(routes.select("route_id", "route_name"), "route_id", "left").select(
        *("stall_id", "event_date", "event_hour", "vehicle_id", "route_id", "route_name"),
        *("latitude", "longitude", "stall_duration_s", "detected_at"),
    )


def fct_headway_regularity(windows: DataFrame, routes: DataFrame) -> DataFrame:
    """Hourly roll-up of sliding windows per route.

    Rolled up before the join: route names depend on the route, so the join sees one row per
    route and hour. ``trip_count`` sums over overlapping windows. ``event_date`` is the local
    date of the hour, which incremental loads compare against the same column of the source.
    """
    hourly = windows.groupBy(
        "route_id", "event_date", F.date_trunc("hour", "window_start").alias("hour_bucket")
    ).agg(
        rounded(F.avg("headway_mean_s"), 1).alias("avg_headway_s"),
        rounded(F.avg("headway_cv"), 3).alias("headway_cv"),
        rounded(F.lit(100.0) * F.count_if("is_bunching") / F.count(F.lit(1)), 1).alias("bunching_pct"),
        F.sum("trip_count").alias("trip_count"),
    )
    named = routes.select("route_id", "route_name", "route_type_label")
    return hourly.join(named, "route_id", "left").select(
        *("route_id", "route_name", "route_type_label", "hour_bucket", "avg_headway_s"),
        *("headway_cv", "bunching_pct", "trip_count", "event_date"),
    )
