import datetime as dt

import pytest
from pyspark.sql import types as T

from fleetpulse import contracts
from fleetpulse.operators import enrich as en

NOW = 1_774_345_000


def rows(spark, contract, **values):
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in contract.fields]).add("_raw_payload", "string")
    return spark.createDataFrame([tuple(values.get(f.name) for f in schema.fields)], schema)


def position(spark, **over):
    base = dict(vehicle_id="v1", trip_id="t1", route_id="r1", latitude=-36.85, longitude=174.76, speed=59.0,
                timestamp=NOW - 10, _raw_payload="{}")
    return rows(spark, contracts.VEHICLE_POSITION, **(base | over))


def test_position_columns_and_order(spark):
    got = en.enrich_vehicle_positions(position(spark), NOW)
    feed = [c for c in contracts.VEHICLE_POSITION.fieldNames() if c != "timestamp"]
    assert got.columns == ["event_id", "ingested_at", *feed, "event_ts", "event_ts_raw", "event_ts_status",
                           "_raw_payload", "event_date", "event_hour"]
    row = got.first()
    assert row.speed == pytest.approx(59.0) and row.event_ts_status == "ok" and row.event_ts == row.event_ts_raw
    assert row.event_date == row.event_ts.date() and row.event_hour == row.event_ts.hour


def test_position_keeps_nulls(spark):
    row = en.enrich_vehicle_positions(position(spark, speed=None), NOW).first()
    assert row.speed is None and row.bearing is None and row.stop_id is None


def test_old_clock_is_clamped_and_kept_raw(spark):
    row = en.enrich_vehicle_positions(position(spark, timestamp=NOW - 9000), NOW).first()
    assert row.event_ts_status == "clamped_past"
    assert (row.event_ts - row.event_ts_raw) == dt.timedelta(seconds=9000 - 3600)


def test_missing_clock(spark):
    row = en.enrich_vehicle_positions(position(spark, timestamp=None), NOW).first()
    assert row.event_ts is None and row.event_ts_status == "missing"


def test_wall_clock_is_the_default(spark):
    row = en.enrich_vehicle_positions(position(spark, timestamp=4_000_000_000)).first()
    assert row.event_ts_status == "clamped_future" and row.ingested_at is not None


def test_trip_update_renames_id_and_keeps_deletion_flag(spark):
    df = rows(spark, contracts.TRIP_UPDATE, id="tu1", trip_id="T", route_id="R", delay=42, timestamp=NOW - 10,
              is_deleted=False, _raw_payload="{}")
    got = en.enrich_trip_updates(df, NOW)
    row = got.first()
    assert "id" not in got.columns and row.source_id == "tu1" and row.delay == 42 and row.is_deleted is False
    assert row.direction_id is None


def test_service_alert_period_becomes_instants(spark):
    df = rows(spark, contracts.SERVICE_ALERT, id="sa1", active_period_start=NOW - 1000, active_period_end=None,
              timestamp=NOW - 10, _raw_payload="{}")
    row = en.enrich_service_alerts(df, NOW).first()
    assert row.alert_id == "sa1" and row.active_period_end is None
    assert row.active_period_start == row.event_ts - dt.timedelta(seconds=990)


def test_ids_repeat_on_replay_unless_random(spark):
    df = position(spark)
    ids = {en.enrich(df, en.POSITIONS, NOW).first().event_id for _ in range(2)}
    loose = {en.enrich(df, en.POSITIONS, NOW, ids="random").first().event_id for _ in range(2)}
    assert len(ids) == 1 and len(loose) == 2
