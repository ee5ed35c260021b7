"""Roll-ups of the recent messages that a live board shows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetpulse.config import LOCAL_ZONE
from fleetpulse.functions.geo import MAP_AREA, Box, in_box
from fleetpulse.functions.timecols import display_instant, display_time
from fleetpulse.operators.delay import tier_names
from fleetpulse.operators.dedup import keep_last

# How long a message stays on the board; the columns shown as local time.
RETENTION_S = 300
TIME_COLUMNS = (
    "detected_at", "first_seen", "stall_detected_ts", "window_start",
    "event_ts",
)
_FIELDS = (
    "event_id", "trip_id", "route_id", "delay", "severity", "start_time", "start_date",
    "event_timestamp", "detected_at", "stall_id", "vehicle_id", "latitude", "longitude",
    "reading_count", "stall_duration_s", "first_seen", "stall_detected_ts",
)
_UNREADABLE = "_unreadable"
_MESSAGE = T.StructType([T.StructField(f, T.StringType()) for f in (*_FIELDS, _UNREADABLE)])


def classify(messages: DataFrame, value: str = "value") -> DataFrame:
    """Messages with their fields as text and ``kind``: delay, stall, other, or malformed.

    Rows keep their other columns. Malformed ones can be counted before they are dropped.
    """
    body = F.from_json(F.col(value).cast("string"), _MESSAGE, {"columnNameOfCorruptRecord": _UNREADABLE})
    parsed = messages.withColumn("m", body)
    kind = (
        F.when(F.col("m").isNull() | F.col(f"m.{_UNREADABLE}").isNotNull(), "malformed")
        .when(F.col("m.severity").isNotNull() & F.col("m.delay").isNotNull(), "delay")
        .when(F.col("m.stall_duration_s").isNotNull() | F.col("m.reading_count").isNotNull(), "stall")
        .otherwise("other")
    )
    rest = [c for c in messages.columns if c != value]
    return parsed.select(*rest, kind.alias("kind"), *[F.col(f"m.{f}") for f in _FIELDS])


def recent(df: DataFrame, now: Column | None = None, window_s: int = RETENTION_S,
           received: str = "received_at") -> DataFrame:
    """Rows received within the retention window, its edge included."""
    instant = F.current_timestamp() if now is None else now
    return df.where(F.col(received) >= instant - F.make_dt_interval(secs=F.lit(window_s)))


def latest_stalls(events: DataFrame) -> DataFrame:
    """The furthest reading of each (vehicle, route, trip); the earliest of equals.

    An aggregate of whole rows, so copies of a key are folded before the shuffle.
    """
    keyed = events.where(F.col("vehicle_id").isNotNull() & F.col("reading_count").isNotNull()).select(
        *[
            F.coalesce(F.col(c), F.lit("")).alias(c) if c in ("route_id", "trip_id") else F.col(c)
            for c in events.columns
        ]
    )
    rest = [c for c in events.columns if c not in ("vehicle_id", "route_id", "trip_id")]
    rank = F.struct(F.col("reading_count").cast("bigint"), -F.col("stall_detected_ts").cast("bigint"), F.col("stall_id"))
    best = keyed.groupBy("vehicle_id", "route_id", "trip_id").agg(F.max_by(F.struct(*rest), rank).alias("best"))
    return best.select("vehicle_id", "route_id", "trip_id", "best.*").select(*events.columns)


def map_points(events: DataFrame, area: Box = MAP_AREA) -> DataFrame:
    """Stall locations for the map; rows without a usable position are left out."""
    points = events.select(
        F.col("latitude").try_cast("double").alias("lat"),
        F.col("longitude").try_cast("double").alias("lon"),
        F.coalesce(F.col("reading_count").try_cast("int"), F.lit(1)).alias("reading_count"),
    )
    return points.where(in_box(F.col("lat"), F.col("lon"), area))


def severity_counts(alerts: DataFrame, tiers: Sequence[str] | None = None) -> DataFrame:
    """Alerts per tier in tier order, with a zero for a tier that has none."""
    names = list(tier_names() if tiers is None else tiers)
    counts = alerts.where(F.col("severity").isin(*names)).agg(
        *[F.count_if(F.col("severity") == n).alias(f"n{i}") for i, n in enumerate(names)]
    )
    lines = [
        F.struct(F.lit(i).alias("tier"), F.lit(n).alias("severity"), F.col(f"n{i}").alias("alerts"))
        for i, n in enumerate(names)
    ]
    return counts.select(F.inline(F.array(*lines))).orderBy("tier")


def kind_counts(classified: DataFrame) -> DataFrame:
    """Delay alerts and stall events on the board."""
    return classified.agg(
        F.count_if(F.col("kind") == "delay").alias("delay_alerts"),
        F.count_if(F.col("kind") == "stall").alias("stall_events"),
    )


def headway_summary(windows: DataFrame) -> DataFrame:
    """Reporting routes, bunching (route, direction) pairs and mean variation.

    Folded to one row per pair first, so the exact distinct counts run on few rows.
    """
    lines = windows.groupBy("route_id", "direction_id").agg(
        F.max("is_bunching").alias("bunching"), F.sum("headway_cv").alias("cv_sum"), F.count("headway_cv").alias("cv_n")
    )
    return lines.agg(
        F.count_distinct("route_id").alias("routes_reporting"),
        F.count_if("bunching").alias("bunching_lines"),
        F.try_divide(F.sum("cv_sum"), F.sum("cv_n")).alias("avg_headway_cv"),
    )


def routes_reporting(windows: DataFrame) -> DataFrame:
    """Approximate number of reporting routes; a single sketch, so it also runs on a stream."""
    return windows.agg(F.approx_count_distinct("route_id").alias("routes_reporting"))


def worst_windows(windows: DataFrame, limit: int = 20) -> DataFrame:
    """Bunching windows with the highest variation."""
    shown = ("route_id", "direction_id", "headway_cv", "headway_mean_s", "trip_count", "window_start")
    return (
        windows.where("is_bunching")
        .select(*[c for c in shown if c in windows.columns])
        .orderBy(F.desc("headway_cv"), "route_id", "direction_id", "window_start")
        .limit(limit)
    )


def busiest_route_variation(windows: DataFrame, limit: int = 15) -> DataFrame:
    """Mean variation of the routes with the most rows; routes without one are left out."""
    per_route = windows.groupBy("route_id").agg(
        F.count(F.lit(1)).alias("rows"), F.avg("headway_cv").alias("avg_headway_cv")
    )
    busiest = per_route.orderBy(F.desc("rows"), "route_id").limit(limit)
    return (
        busiest.where(F.col("avg_headway_cv").isNotNull())
        .select("route_id", "avg_headway_cv")
        .orderBy(F.desc("avg_headway_cv"), "route_id")
    )


def in_busiest(windows: DataFrame, limit: int = 15) -> DataFrame:
    """All windows of the routes with the most rows. Reads its input twice, so give it a stored table."""
    busiest = windows.groupBy("route_id").count().orderBy(F.desc("count"), "route_id").limit(limit)
    return windows.join(busiest, "route_id", "left_semi")


def trip_choices(alerts: DataFrame) -> DataFrame:
    """Trips that can be picked as a filter, in order."""
    return alerts.where(F.col("trip_id").isNotNull()).select("trip_id").distinct().orderBy("trip_id")


def drill_down(alerts: DataFrame, severity: str | None = None, trip_id: str | None = None) -> DataFrame:
    """Alerts of one tier and one trip; None stands for all."""
    for column, wanted in (("severity", severity), ("trip_id", trip_id)):
        if wanted is not None:
            alerts = alerts.where(F.col(column) == wanted)
    return alerts


def latest_rows(df: DataFrame, order: str = "event_ts", limit: int = 5, ties: Sequence[str] = ()) -> DataFrame:
    return df.orderBy(F.desc(order), *ties).limit(limit)


def latest_messages(messages: DataFrame, order: str = "offset", limit: int = 20) -> DataFrame:
    """The newest raw messages, newest first."""
    return latest_rows(messages, order, limit)


def board(
    rows: DataFrame,
    preferred: Sequence[str],
    sort_candidates: Sequence[str],
    dedup_candidates: Sequence[str] = (),
    renames: Mapping[str, str] | None = None,
    arrival: Sequence[str] = ("received_at",),
    zone: str = LOCAL_ZONE,
    limit: int = 50,
) -> DataFrame:
    """A display table: last row per key, newest first, local times, only the columns at hand.

    The first candidate that exists decides, both for the key and for the order; without one, arrival decides. ``arrival``
    lists the columns that say which of two rows of a key came last.
    """
    key = next((c for c in dedup_candidates if c in rows.columns), None)
    if key:
        rows = keep_last(rows, [key], [c for c in arrival if c in rows.columns])
    rows = rows.withColumnsRenamed(dict(renames or {}))
    times = [c for c in (*TIME_COLUMNS, "received_at") if c in rows.columns]
    instants = {f.name for f in rows.schema.fields if isinstance(f.dataType, T.TimestampType)}
    rows = rows.withColumns({c: (display_instant if c in instants else display_time)(F.col(c), zone) for c in times})
    by = [c for c in sort_candidates if c in rows.columns][:1] or [c for c in arrival if c in rows.columns]
    if not by:
        raise ValueError("a board needs a sort or an arrival column: without an order its rows would be arbitrary")
    rows = rows.orderBy(*[F.col(c).desc_nulls_last() for c in by], *[c for c in preferred if c in rows.columns and c not in by])
    shown = [c for c in preferred if c in rows.columns]
    if "received_at" in rows.columns and "received_at" not in shown:
        shown.append("received_at")
    return rows.limit(limit).select(*shown)
