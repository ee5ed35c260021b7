"""Nested feed responses (one JSON document per poll) to flat feed records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetpulse.contracts import FEED_RESPONSE

_PARTS = ("vehicle", "trip_update", "alert")


def _response_schema(parts: tuple[str, ...]) -> T.StructType:
    """The response schema with only the named entity parts; the parser skips the others."""
    entity = FEED_RESPONSE["response"].dataType["entity"].dataType.elementType
    kept = T.StructType([f for f in entity.fields if f.name not in _PARTS or f.name in parts])
    body = T.StructType([T.StructField("entity", T.ArrayType(kept))])
    return T.StructType([T.StructField("response", body)])


def feed_entities(responses: DataFrame, *parts: str, value: str = "value") -> DataFrame:
    """One row per entity of every response.

    Name the parts that are used (``vehicle``, ``trip_update``, ``alert``): columns are not
    pruned through the exploded array, so this is what keeps unused ones from being parsed.
    """
    schema = _response_schema(parts or _PARTS)
    parsed = responses.select(F.from_json(F.col(value).cast("string"), schema).alias("doc"))
    return parsed.select(F.explode("doc.response.entity").alias("entity"))


def _first(array: str, item: str) -> Column:
    """A field of the first array element; null for a missing or empty array."""
    return F.get(F.col(array), F.lit(0)).getField(item)


def _text_or_blank(path: str) -> Column:
    return F.coalesce(F.col(path), F.lit(""))


def positions_from_feed(entities: DataFrame) -> DataFrame:
    v = "entity.vehicle"
    return entities.where(F.col(v).isNotNull()).select(
        F.col("entity.id").alias("vehicle_id"),
        _text_or_blank(f"{v}.trip.trip_id").alias("trip_id"),
        _text_or_blank(f"{v}.trip.route_id").alias("route_id"),
        *[F.col(f"{v}.position.{c}") for c in ("latitude", "longitude", "bearing", "speed")],
        *[
            F.col(f"{v}.{c}")
            for c in (
                "current_stop_sequence", "stop_id", "current_status",
                "congestion_level", "occupancy_status", "timestamp",
            )
        ],
    )


def trip_updates_from_feed(entities: DataFrame) -> DataFrame:
    u = "entity.trip_update"
    return entities.where(F.col(u).isNotNull()).select(
        F.col("entity.id").alias("id"),
        F.col(f"{u}.trip.trip_id"),
        _text_or_blank(f"{u}.trip.route_id").alias("route_id"),
        *[F.col(f"{u}.trip.{c}") for c in ("direction_id", "start_time", "start_date", "schedule_relationship")],
        F.coalesce(F.col(f"{u}.delay"), F.lit(0)).alias("delay"),
        F.col(f"{u}.timestamp"),
        F.coalesce(F.col("entity.is_deleted"), F.lit(False)).alias("is_deleted"),
    )


def service_alerts_from_feed(entities: DataFrame, now: Column | int | None = None) -> DataFrame:
    """Only the first affected route, active period and translation of each alert are kept."""
    a = "entity.alert"
    clock = F.unix_timestamp() if now is None else (now if isinstance(now, Column) else F.lit(now))
    return entities.where(F.col(a).isNotNull()).select(
        F.col("entity.id").alias("id"),
        _first(f"{a}.informed_entity", "route_id").alias("route_id"),
        F.col(f"{a}.cause"),
        F.col(f"{a}.effect"),
        _first(f"{a}.header_text.translation", "text").alias("header_text"),
        _first(f"{a}.description_text.translation", "text").alias("description_text"),
        _first(f"{a}.active_period", "start").alias("active_period_start"),
        _first(f"{a}.active_period", "end").alias("active_period_end"),
        F.coalesce(F.col("entity.timestamp"), clock.cast("bigint")).alias("timestamp"),
    )
