import json

import pytest
from pyspark.sql import functions as F

from fleetpulse import contracts
from fleetpulse.operators import alerts as al

DELAY = {"event_id": "d1", "trip_id": "T", "route_id": "R", "delay": 400, "severity": "MODERATE",
         "event_timestamp": 1704067200, "detected_at": "2024-01-01T00:00:05.000Z"}
STALL = {"stall_id": "s1", "vehicle_id": "V", "route_id": "R", "trip_id": "T", "stall_detected_ts": 1704067260,
         "detected_at": "2024-01-01T00:01:05.000Z"}
BUNCH = {"alert_type": "bunching_alert", "route_id": "R", "direction_id": 1, "headway_cv": 0.7,
         "window_start": "2024-01-01T00:02:00.000Z", "detected_at": "2024-01-01T00:03:00.000Z"}


def messages(spark, *docs):
    return spark.createDataFrame([(d if isinstance(d, str) else json.dumps(d),) for d in docs], "value string")


def normalized(spark, *docs):
    return al.normalize_alerts(messages(spark, *docs))


def test_three_shapes(spark):
    d, s, b = normalized(spark, DELAY, STALL, BUNCH).collect()
    assert (d.alert_id, d.alert_type, d.vehicle_id, str(d.event_ts)) == ("d1", "DELAY", None, "2024-01-01 00:00:00")
    assert (s.alert_id, s.alert_type, s.vehicle_id, str(s.event_ts)) == ("s1", "STALL", "V", "2024-01-01 00:01:00")
    assert (b.alert_type, b.trip_id, str(b.event_ts)) == ("BUNCHING", None, "2024-01-01 00:02:00")
    assert len(b.alert_id) == 64 and str(d.detected_at) == "2024-01-01 00:00:05" and str(d.event_date) == "2024-01-01"


def test_contract(spark):
    got = normalized(spark, DELAY).schema
    assert [(f.name, f.dataType) for f in got] == [(f.name, f.dataType) for f in contracts.ALERT]


def test_unknown_and_broken_messages_are_kept_as_such(spark):
    rows = normalized(spark, {"x": 1}, "{broken", DELAY).collect()
    assert [r.alert_type for r in rows] == ["UNKNOWN", "UNKNOWN", "DELAY"]
    assert rows[1].payload == "{broken" and rows[0].alert_id != rows[1].alert_id


def test_bunching_replay_has_the_same_id(spark):
    a, b, c = normalized(spark, BUNCH, BUNCH | {"detected_at": "2024-02-01T00:00:00Z"}, BUNCH | {"direction_id": 0}).collect()
    assert a.alert_id == b.alert_id != c.alert_id


def test_message_keys(spark):
    df = spark.createDataFrame([("R", 1, True, "T", "V"), ("R", 0, False, "T", "V")],
                               "route_id string, direction_id int, is_bunching boolean, trip_id string, vehicle_id string")
    full = df.withColumns({"headway_cv": F.lit(0.6), "trip_count": F.lit(3), "window_start": F.current_timestamp(),
                           "window_end": F.current_timestamp()})
    assert [r.key for r in al.headway_messages(full).collect()] == ["R:1", "R:0"]
    (b,) = al.bunching_messages(full).collect()
    assert b.key == "R" and json.loads(b.value)["alert_type"] == "bunching_alert"
    assert al.delay_messages(df).first().key == "T" and al.stall_messages(df).first().key == "V"


def test_union_keeps_rows_and_fills_columns(spark):
    a, b = spark.createDataFrame([("k", "v")], "key string, value string"), spark.createDataFrame([("v",)], "value string")
    assert sorted(map(tuple, al.union_messages(a, b, a).collect()), key=str) == [("k", "v"), ("k", "v"), (None, "v")]


@pytest.mark.parametrize("prune", [False, True])
def test_upsert_inserts_each_id_once(spark, tmp_path, prune):
    path = str(tmp_path / "alerts")
    al.upsert_alerts(spark, normalized(spark, DELAY, DELAY, STALL), path, prune_by_date=prune)
    assert spark.read.parquet(path).count() == 2
    al.upsert_alerts(spark, normalized(spark, DELAY, BUNCH, {"x": 1}), path, prune_by_date=prune)
    al.upsert_alerts(spark, normalized(spark, DELAY, BUNCH, {"x": 1}), path, prune_by_date=prune)
    ids = [r.alert_type for r in spark.read.parquet(path).collect()]
    assert sorted(ids) == ["BUNCHING", "DELAY", "STALL", "UNKNOWN"]


def test_upsert_keeps_the_earliest_of_a_batch_and_the_stored_row(spark, tmp_path):
    path = str(tmp_path / "alerts")
    early, late = DELAY | {"detected_at": "2024-01-01T00:00:01Z"}, DELAY | {"detected_at": "2024-01-01T00:09:00Z"}
    al.upsert_alerts(spark, normalized(spark, late, early), path)
    al.upsert_alerts(spark, normalized(spark, late), path)
    assert [str(r.detected_at) for r in spark.read.parquet(path).collect()] == ["2024-01-01 00:00:01"]


def test_a_moved_date_is_only_caught_without_pruning(spark, tmp_path):
    path = str(tmp_path / "alerts")
    al.upsert_alerts(spark, normalized(spark, DELAY), path)
    al.upsert_alerts(spark, normalized(spark, DELAY | {"event_timestamp": 1704067200 + 9 * 86400}), path)
    assert spark.read.parquet(path).count() == 1


def test_upsert_reads_only_the_dates_of_its_batch(spark, tmp_path):
    """Nine dates stored; a batch of one of them, one far off and one row without a date reads two folders and the undated one."""
    path, day = str(tmp_path / "alerts"), 86400
    many = [DELAY | {"event_id": f"d{i}", "event_timestamp": 1704067200 + i * day} for i in range(9)]
    al.upsert_alerts(spark, normalized(spark, *many, {"x": 1}), path)
    batch = normalized(spark, many[2], many[8], DELAY | {"event_id": "new", "event_timestamp": 1704067200 + 8 * day}, {"x": 1}, {"x": 2})
    fresh = al.unseen(al.first_of_each(batch), spark.read.parquet(path), prune_by_date=True)
    plan = fresh._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan
    kept = al.of_dates(spark.read.parquet(path).select("event_date", "alert_id"), batch).select(F.input_file_name()).distinct().collect()
    assert len({r[0].split("event_date=")[1].split("/")[0] for r in kept}) == 3
    assert sorted(r.alert_type for r in fresh.collect()) == ["DELAY", "UNKNOWN"]
