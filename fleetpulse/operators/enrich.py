"""Flat feed records to bronze rows: identity, ingest time, trusted event time, partitions."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetpulse import contracts
from fleetpulse.functions.keys import natural_key, random_key
from fleetpulse.functions.timecols import epoch_ts, ts_clamped, ts_status


@dataclass(frozen=True)
class Feed:
    """How one feed becomes a bronze table."""

    table: str
    contract: object
    entity: str
    renames: tuple[tuple[str, str], ...] = ()
    epochs: tuple[str, ...] = ()
    after_time: tuple[str, ...] = ()


POSITIONS = Feed("vehicle_positions", contracts.VEHICLE_POSITION, "vehicle_id")
TRIPS = Feed("trip_updates", contracts.TRIP_UPDATE, "id", renames=(("id", "source_id"),), after_time=("is_deleted",))
SERVICE_ALERTS = Feed(
    "service_alerts", contracts.SERVICE_ALERT, "id", renames=(("id", "alert_id"),),
    epochs=("active_period_start", "active_period_end"),
)
FEEDS = {f.table: f for f in (POSITIONS, TRIPS, SERVICE_ALERTS)}


def enrich(df: DataFrame, feed: Feed, now: Column | int | None = None, ids: str = "natural") -> DataFrame:
    """Bronze rows of a feed.

    ``now`` is the instant the clock is judged against; pass the ingest time on a backfill.
    ``ids`` is ``natural`` (same row, same id on a replay) or ``random``.
    """
    if now is None:
        clock = F.unix_timestamp()
        ingested = F.current_timestamp()
    else:
        clock = (now if isinstance(now, Column) else F.lit(now)).cast("bigint")
        ingested = epoch_ts(clock)
    raw = F.col("timestamp")
    renames = dict(feed.renames)

    def column(name: str) -> Column:
        value = epoch_ts(F.col(name)) if name in feed.epochs else F.col(name)
        return value.alias(renames.get(name, name))

    body = [c for c in feed.contract.fieldNames() if c != "timestamp" and c not in feed.after_time]
    event_ts = epoch_ts(ts_clamped(raw, clock))
    ident = (
        random_key()
        if ids == "random"
        else natural_key(feed.table, feed.entity, "timestamp", "_raw_payload")
    )
    return df.select(
        ident.alias("event_id"),
        ingested.alias("ingested_at"),
        *[column(c) for c in body],
        event_ts.alias("event_ts"),
        epoch_ts(raw).alias("event_ts_raw"),
        ts_status(raw, clock).alias("event_ts_status"),
        *[column(c) for c in feed.after_time],
        "_raw_payload",
        F.to_date(event_ts).alias("event_date"),
        F.hour(event_ts).alias("event_hour"),
    )


def enrich_vehicle_positions(df: DataFrame, now: Column | int | None = None) -> DataFrame:
    return enrich(df, POSITIONS, now)


def enrich_trip_updates(df: DataFrame, now: Column | int | None = None) -> DataFrame:
    return enrich(df, TRIPS, now)


def enrich_service_alerts(df: DataFrame, now: Column | int | None = None) -> DataFrame:
    return enrich(df, SERVICE_ALERTS, now)
