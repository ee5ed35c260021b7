"""Cleaned views of the bronze tables. Plain transforms, inlined by Catalyst into every mart."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetpulse.config import LOCAL_ZONE
from fleetpulse.functions.geo import COUNTRY, GLOBE, in_box
from fleetpulse.functions.timecols import local_date, local_hour
from fleetpulse.operators.dedup import keep_first, keep_last


def _local_parts(ts: str, zone: str) -> list:
    return [
        local_date(F.col(ts), zone).alias("event_date"),
        local_hour(F.col(ts), zone).alias("event_hour"),
    ]


def stg_trip_updates(bronze: DataFrame, zone: str = LOCAL_ZONE) -> DataFrame:
    """First ingested copy of each update; deletions are judged on that copy, so they go after."""
    first = keep_first(bronze, ["source_id", "event_ts"], ["ingested_at", "event_id"])
    return first.where(~F.col("is_deleted")).select(
        *("event_id", "source_id", "trip_id", "route_id", "direction_id", "start_time", "start_date", "delay"),
        F.round(F.col("delay") / F.lit(60.0), 2).alias("delay_minutes"),
        "event_ts",
        *_local_parts("event_ts", zone),
    )


def stg_vehicle_positions(bronze: DataFrame, zone: str = LOCAL_ZONE) -> DataFrame:
    first = keep_first(bronze, ["vehicle_id", "event_ts"], ["ingested_at", "event_id"])
    return first.where(in_box(F.col("latitude"), F.col("longitude"), GLOBE)).select(
        *("event_id", "vehicle_id", "trip_id", "route_id", "latitude", "longitude"),
        F.col("speed").alias("speed_kmh"),
        *("current_stop_sequence", "stop_id", "current_status", "event_ts"),
        *_local_parts("event_ts", zone),
    )


def stg_stall_events(bronze: DataFrame, zone: str = LOCAL_ZONE) -> DataFrame:
    detected = F.timestamp_seconds("stall_detected_ts")
    return bronze.select(
        *("stall_id", "vehicle_id", "route_id", "latitude", "longitude", "reading_count", "first_seen"),
        detected.alias("stall_detected_at"),
        (F.col("stall_detected_ts") - F.unix_timestamp("first_seen")).alias("stall_duration_s"),
        "detected_at",
        *_local_parts("first_seen", zone),
    )


def stg_headway_metrics(bronze: DataFrame, zone: str = LOCAL_ZONE) -> DataFrame:
    """Windows with trips. Where the table says when and in which trigger a row was written, only the last revision
    of a window counts: the stream writes a window again every time it changes. Triggers are counted from 0 again
    after a new checkpoint, so the time comes first."""
    order = [c for c in ("written_at", "batch_id") if c in bronze.columns]
    if order:
        bronze = keep_last(bronze, ["window_start", "route_id", "direction_id"], order)
    return bronze.where(F.col("trip_count") > 0).select(
        *("route_id", "direction_id", "window_start", "window_end", "trip_count"),
        *("headway_mean_s", "headway_stddev_s", "headway_cv", "is_bunching"),
        *_local_parts("window_start", zone),
    )


def stg_routes(seed: DataFrame) -> DataFrame:
    # Schedule codes with a label of their own.
    label = F.when(F.col("route_type") == 2, "Rail").when(F.col("route_type") == 3, "Bus").otherwise("Other")
    return seed.where(F.col("route_id").isNotNull()).select(
        "route_id", "route_short_name", "route_long_name", "route_type", label.alias("route_type_label")
    )


def stg_stops(seed: DataFrame) -> DataFrame:
    inside = in_box(F.col("stop_lat"), F.col("stop_lon"), COUNTRY)
    return seed.where(F.col("stop_id").isNotNull() & inside).select(
        "stop_id", "stop_name", "stop_lat", "stop_lon", "stop_code"
    )
