"""Record contracts: the columns each feed, detection and seed carries."""

from __future__ import annotations

import json

from pyspark.sql import types as T

_AVRO_TYPES = {
    "string": "string",
    "double": "double",
    "float": "float",
    "int": "int",
    "bigint": "long",
    "boolean": "boolean",
}

# Built from type objects, not DDL text: parsing DDL needs a running session.
_S, _D, _F = T.StringType(), T.DoubleType(), T.FloatType()
_I, _L, _B = T.IntegerType(), T.LongType(), T.BooleanType()
_TS, _DATE = T.TimestampType(), T.DateType()


def _need(dtype: T.DataType, *names: str) -> list[T.StructField]:
    return [T.StructField(n, dtype, False) for n in names]


def _may(dtype: T.DataType, *names: str) -> list[T.StructField]:
    return [T.StructField(n, dtype, True) for n in names]


def _record(*groups: list[T.StructField]) -> T.StructType:
    return T.StructType([field for group in groups for field in group])


# Field names, order and types of the feed records.
VEHICLE_POSITION = _record(
    _need(_S, "vehicle_id", "trip_id", "route_id"),
    _need(_D, "latitude", "longitude"),
    _may(_F, "bearing", "speed"),
    _may(_I, "current_stop_sequence"),
    _may(_S, "stop_id", "current_status", "congestion_level", "occupancy_status"),
    _need(_L, "timestamp"),
)
TRIP_UPDATE = _record(
    _need(_S, "id", "trip_id", "route_id"),
    _may(_I, "direction_id"),
    _may(_S, "start_time", "start_date"),
    _may(_I, "schedule_relationship"),
    _need(_I, "delay"),
    _need(_L, "timestamp"),
    _need(_B, "is_deleted"),
)
SERVICE_ALERT = _record(
    _need(_S, "id"),
    _may(_S, "route_id", "cause", "effect", "header_text", "description_text"),
    _may(_L, "active_period_start", "active_period_end"),
    _need(_L, "timestamp"),
)

# What the detections write.
DELAY_ALERT = _record(
    _may(_S, "event_id", "trip_id", "route_id"),
    _may(_I, "delay"),
    _may(_S, "severity", "start_time", "start_date"),
    _may(_L, "event_timestamp"),
    _may(_TS, "detected_at"),
)
STALL_EVENT = _record(
    _may(_S, "stall_id", "vehicle_id", "route_id", "trip_id"),
    _may(_D, "latitude", "longitude"),
    _may(_I, "reading_count", "stall_duration_s"),
    _may(_TS, "first_seen"),
    _may(_L, "stall_detected_ts"),
)
HEADWAY_METRIC = _record(
    _may(_TS, "window_start", "window_end"),
    _may(_S, "route_id"),
    _may(_I, "direction_id"),
    _may(_L, "trip_count"),
    _may(_D, "headway_mean_s", "headway_stddev_s", "headway_cv"),
    _may(_B, "is_bunching"),
)
ALERT = _record(
    _may(_S, "alert_id", "alert_type", "route_id", "vehicle_id", "trip_id"),
    _may(_TS, "event_ts", "detected_at"),
    _may(_S, "payload"),
    _may(_TS, "ingested_at"),
    _may(_DATE, "event_date"),
)

# Static schedule files.
ROUTES_SEED = _record(
    _may(_S, "route_id", "agency_id", "route_short_name", "route_long_name", "route_desc"),
    _may(_I, "route_type"),
    _may(_S, "route_url", "route_color", "route_text_color", "route_sort_order", "contract_id"),
)
STOPS_SEED = _record(
    _may(_S, "stop_id", "stop_code", "stop_name", "stop_desc"),
    _may(_D, "stop_lat", "stop_lon"),
    _may(_S, "zone_id", "stop_url"),
    _may(_I, "location_type"),
    _may(_S, "parent_station", "stop_timezone", "platform_code"),
    _may(_I, "wheelchair_boarding"),
    _may(_S, "start_date", "end_date"),
)


def _many(item: T.StructType) -> T.ArrayType:
    return T.ArrayType(item)


# Nested JSON of a feed response. A numeric occupancy status reads as text.
_TRIP = _record(
    _may(_S, "trip_id", "route_id"),
    _may(_I, "direction_id"),
    _may(_S, "start_time", "start_date"),
    _may(_I, "schedule_relationship"),
)
_VEHICLE = _record(
    _may(_record(_may(_D, "latitude", "longitude"), _may(_F, "bearing", "speed")), "position"),
    _may(_TRIP, "trip"),
    _may(_L, "timestamp"),
    _may(_I, "current_stop_sequence"),
    _may(_S, "stop_id", "current_status", "congestion_level", "occupancy_status"),
)
_UPDATE = _record(_may(_TRIP, "trip"), _may(_I, "delay"), _may(_L, "timestamp"))
_NOTICE = _record(
    _may(_many(_record(_may(_S, "route_id"))), "informed_entity"),
    _may(_many(_record(_may(_L, "start", "end"))), "active_period"),
    _may(_record(_may(_many(_record(_may(_S, "text"))), "translation")), "header_text", "description_text"),
    _may(_S, "cause", "effect"),
)
_ENTITY = _record(
    _may(_S, "id"),
    _may(_B, "is_deleted"),
    _may(_L, "timestamp"),
    _may(_VEHICLE, "vehicle"),
    _may(_UPDATE, "trip_update"),
    _may(_NOTICE, "alert"),
)
FEED_RESPONSE = _record(_may(_record(_may(_many(_ENTITY), "entity")), "response"))


def avro_schema(contract: T.StructType, name: str) -> str:
    """The Avro schema text of a flat contract; nullable columns become unions with null."""
    fields = []
    for field in contract.fields:
        avro = _AVRO_TYPES[field.dataType.simpleString()]
        entry: dict = {"name": field.name, "type": avro}
        if field.nullable:
            entry = {"name": field.name, "type": ["null", avro], "default": None}
        fields.append(entry)
    return json.dumps({"type": "record", "name": name, "fields": fields})
