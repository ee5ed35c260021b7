import datetime as dt
import json
import random

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from fleetpulse import contracts
from fleetpulse.checks import replays
from fleetpulse.config import Settings
from fleetpulse.operators import alerts as al
from fleetpulse.operators import stall
from fleetpulse.operators.enrich import TRIPS
from fleetpulse.operators.headway import headway_lag_form
from fleetpulse.operators.stall import StallParams, stall_events
from fleetpulse.plans.staging import stg_headway_metrics
from fleetpulse.session import scratch_dir
from fleetpulse.streaming import jobs, sinks, stall_state
from fleetpulse.streaming.headway_state import SHIFT, WORD, Seconds
from fleetpulse.streaming.stall_state import closed_readings, judged
from fleetpulse.streaming.transport import FolderTransport, KafkaTransport
from tests.test_stall import SCHEMA as POSITIONS
from tests.test_stall import SPOT, at, random_walk

UPDATES = ("id string, trip_id string, route_id string, direction_id int, start_time string, start_date string, "
           "schedule_relationship int, delay int, timestamp bigint, is_deleted boolean")


def drop_files(folder, *parts):
    """One JSON-lines file per part, in an order the file source keeps."""
    folder.mkdir(parents=True, exist_ok=True)
    for i, rows in enumerate(parts):
        path = folder / f"{len(list(folder.iterdir())):04d}.json"
        path.write_text("".join(json.dumps(r) + "\n" for r in rows))
        import os

        os.utime(path, (1_700_000_000 + 10 * i, 1_700_000_000 + 10 * i))


def stream(spark, folder, schema):
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).json(str(folder))


def run(df, tmp_path, mode, name="q"):
    query = sinks.stream_to_sinks(df, name, str(tmp_path / f"{name}_cp"), sinks.fan_out(
        sinks.append_table(str(tmp_path / name))), mode)
    query.awaitTermination()
    return query


def positions(rows):
    names = [c.split()[0] for c in POSITIONS.split(", ")]
    return [dict(zip(names, r)) for r in rows]


def judge(spark, tmp_path, params=StallParams(), delay="1 minute", slice_s=60, *more, name="q", interval=None):
    rows = closed_readings(stream(spark, tmp_path / "in", POSITIONS), params, delay, slice_s)
    sink = judged(str(tmp_path / "runs"), params, jobs.stall_rows, *more, sinks.append_table(str(tmp_path / name)), slice_s=900)
    return sinks.stream_to_sinks(rows, name, str(tmp_path / f"{name}_cp"), sink, "append", interval)


def stall_columns(df):
    return sorted(tuple(r) for r in df.select(*contracts.STALL_EVENT.fieldNames()).collect())


def test_stall_stream_over_many_triggers_equals_batch(spark, tmp_path):
    """Out of order within and between triggers, and a far-off clock at the end that closes all slices."""
    rng = random.Random(3)
    rows = random_walk(rng, 240)
    order = sorted(rows, key=lambda r: r[5] + rng.randrange(3000))
    far = at(10**7, vehicle="none")
    drop_files(tmp_path / "in", *[positions(order[i:i + 40]) for i in range(0, 240, 40)], positions([far]))
    judge(spark, tmp_path, delay="2 hours").awaitTermination()
    want = stall_columns(stall_events(spark.createDataFrame(rows, POSITIONS)))
    got = sinks.read_committed(spark, str(tmp_path / "q"))
    assert len(want) > 5 and stall_columns(got) == want
    assert got.select("batch_id").distinct().count() > 1
    # Runs of two triggers are kept, whatever the number of triggers.
    assert len(list((tmp_path / "runs" / "_committed").iterdir())) == 2


def test_a_trigger_that_fails_between_its_sinks_writes_each_row_once(spark, tmp_path):
    rows = [at(1000 + 30 * i, vehicle=f"V{v}") for i in range(40) for v in range(3)]
    drop_files(tmp_path / "in", *[positions(rows[i:i + 20]) for i in range(0, 120, 20)], positions([at(10**6, vehicle="none")]))
    topic = sinks.publish(jobs.without_date(al.stall_messages), "json", str(tmp_path / "topic"))
    fail = replays.failing_once(3)
    with pytest.raises(StreamingQueryException):
        judge(spark, tmp_path, StallParams(), "1 minute", 60, topic, fail).awaitTermination()
    judge(spark, tmp_path, StallParams(), "1 minute", 60, topic, fail).awaitTermination()
    want = [r[0] for r in stall_columns(stall_events(spark.createDataFrame(rows, POSITIONS)))]
    sent = spark.read.schema("key string, value string").option("recursiveFileLookup", "true").json(str(tmp_path / "topic"))
    ids = sorted(r[0] for r in sent.select(F.get_json_object("value", "$.stall_id")).collect())
    assert len(want) > 50 and ids == want
    assert [r[0] for r in stall_columns(sinks.read_committed(spark, str(tmp_path / "q")))] == want


def test_readers_see_complete_triggers_only(spark, tmp_path):
    path = str(tmp_path / "t")
    assert sinks.read_committed(spark, path) is None
    df = spark.createDataFrame([(1, "d")], "id int, event_date string")
    write = sinks.append_table(path)
    write(df, 0)
    write(df, 1)
    write(df, 1)
    df.write.parquet(sinks.trigger_folder(path, "q0", 2) + "/event_date=d")
    assert spark.read.parquet(path).count() == 3
    assert sorted(r.batch_id for r in sinks.read_committed(spark, path).collect()) == [0, 1]
    sinks.forget(spark, path, "q0", 0)
    assert [r.batch_id for r in sinks.read_committed(spark, path).collect()] == [1]


def test_one_busy_vehicle_fills_all_lists_of_a_slice(spark):
    rows = spark.createDataFrame([at(1000 + i % 60, lat=SPOT[0] + i * 1e-7) for i in range(4000)], POSITIONS)
    sizes = rows.groupBy(F.pmod(F.xxhash64("vehicle_id", F.col("timestamp"), "latitude", "longitude"), F.lit(stall_state.BUCKETS))).count()
    assert sizes.count() == stall_state.BUCKETS and sizes.agg(F.max("count")).first()[0] < 400


def test_a_silent_vehicle_is_forgotten(spark, tmp_path):
    """By event time: the run is left out of what is carried on, and the third reading starts afresh."""
    far = [at(50_000, vehicle="none")]
    drop_files(tmp_path / "in", positions([at(1000), at(1030)]), positions([at(2000, vehicle="V2")]), positions([at(3000)]), positions(far))
    judge(spark, tmp_path, StallParams(silence_s=600, max_span_s=10_000)).awaitTermination()
    assert not (tmp_path / "q").exists()
    kept = spark.read.schema(stall.RUN).option("recursiveFileLookup", "true").parquet(str(tmp_path / "runs"))
    assert {(r.vehicle_id, r.readings) for r in kept.collect()} <= {("V2", 1), ("V1", 1)}


def test_late_readings_of_a_closed_slice_are_dropped(spark, tmp_path):
    drop_files(tmp_path / "in", positions([at(1000), at(1030)]), positions([at(9000, vehicle="V2")]), positions([at(1060)]),
               positions([at(90_000, vehicle="none")]))
    judge(spark, tmp_path).awaitTermination()
    assert not (tmp_path / "q").exists()


def update(i, start, at_s, trip=None, delay=0):
    return dict(id=f"u{i}", trip_id=trip or f"T{i}", route_id="R", direction_id=0, start_time=start, start_date="20240101",
                schedule_relationship=0, delay=delay, timestamp=at_s, is_deleted=False)


T0 = 1_704_067_200


def test_headway_stream_drops_what_the_watermark_passed(spark, tmp_path):
    first = [update(i, s, T0 + 60) for i, s in enumerate(("08:00:00", "08:05:00", "08:10:00"))]
    later = [update(9, "12:00:00", T0 + 7200)]
    # Lateness is judged by the watermark one trigger back, hence the trigger in between.
    between = [update(11, "12:05:00", T0 + 7201)]
    late = [update(10, "08:20:00", T0 + 61), update(12, "12:07:00", T0 + 7202)]
    drop_files(tmp_path / "in", first, later, between, late)
    rows = jobs.headway_rows(stream(spark, tmp_path / "in", UPDATES), "10 minutes", dedup=False)
    run(rows, tmp_path, "update")
    stored = spark.read.parquet(str(tmp_path / "q"))
    final = stg_headway_metrics(stored).where(F.col("window_start") < F.timestamp_seconds(F.lit(T0 + 3600))).collect()
    assert len(final) == 5 and {r.trip_count for r in final} == {3}
    # The windows at noon were written more than once; staging keeps the last version.
    noon = stored.where(F.col("window_start") > F.timestamp_seconds(F.lit(T0 + 3600)))
    assert noon.count() > stg_headway_metrics(noon).count() >= 5


def test_repeats_within_the_watermark_count_once(spark, tmp_path):
    rows = [update(1, "08:00:00", T0 + 5, trip="T")] * 3
    drop_files(tmp_path / "in", rows, rows)
    live = jobs.headway_rows(stream(spark, tmp_path / "in", UPDATES), "10 minutes")
    run(live, tmp_path, "update")
    assert {r.trip_count for r in spark.read.parquet(str(tmp_path / "q")).collect()} == {1}


def test_seconds_of_a_window_keep_their_gaps():
    rng, stored = random.Random(5), {}
    seconds = [rng.choice([rng.randrange(-4000, 100_000), rng.randrange(30)]) for _ in range(600)]
    state = (0, None, None, 0)
    for i in range(0, 600, 7):
        live = Seconds(stored.__getitem__, *state)
        for s in seconds[i:i + 7]:
            live.add(s)
        stored |= {w: live.words[w] for w in live.changed}
        state = (live.used, live.first, live.last, live.squares)
    line = sorted(set(seconds))
    assert state[1:] == (line[0], line[-1], sum((b - a) ** 2 for a, b in zip(line, line[1:])))
    assert set(stored) == {(s + SHIFT) // WORD for s in line}


def test_headway_stream_equals_the_batch_form(spark, tmp_path):
    """A line with most rows, windows that are no whole number of slides, nulls, several triggers."""
    rng = random.Random(9)
    rows = [{**update(i, f"{rng.randrange(26):02d}:{rng.randrange(60):02d}:{rng.randrange(60):02d}", T0 + rng.randrange(1500), delay=rng.randrange(-900, 900)),
             "route_id": rng.choice(["R", "R", "R", "Q", ""]), "direction_id": rng.choice([0, 1, None])} for i in range(300)]
    rows[7]["start_time"] = None
    drop_files(tmp_path / "in", *[rows[i:i + 60] for i in range(0, 300, 60)])
    for window, slide in (("10 minutes", "2 minutes"), ("5 minutes", "2 minutes")):
        live = jobs.headway_rows(stream(spark, tmp_path / "in", UPDATES), "1 hour", dedup=False, window=window, slide=slide)
        run(live, tmp_path, "update", name=f"w{window[0]}")
        batch = spark.createDataFrame(rows, UPDATES).withColumn("event_ts", F.timestamp_seconds("timestamp"))
        want = stg_headway_metrics(headway_lag_form(batch, window=window, slide=slide))
        got = stg_headway_metrics(sinks.read_committed(spark, str(tmp_path / f"w{window[0]}")))
        assert want.count() > 20 and sorted(map(str, got.select(*want.columns).collect())) == sorted(map(str, want.collect()))


def test_headway_stream_in_append_mode(spark, tmp_path):
    drop_files(tmp_path / "in", [update(1, "08:00:00", T0)], [update(2, "08:00:00", T0 + 7200)], [update(3, "08:00:00", T0 + 7300)])
    run(jobs.headway_rows(stream(spark, tmp_path / "in", UPDATES), "10 minutes", mode="append"), tmp_path, "append")
    stored = spark.read.parquet(str(tmp_path / "q"))
    assert stored.count() == stored.select("window_start").distinct().count() >= 5


def test_bronze_never_drops_late_rows(spark, tmp_path):
    def messages(*rows):
        return [{"key": r["trip_id"], "value": json.dumps(r)} for r in rows]

    drop_files(tmp_path / "in", messages(update(1, "08:00:00", T0 + 86_400)), messages(update(2, "08:00:00", T0 + 90_000)),
               messages(update(3, "08:00:00", T0)))
    cfg = Settings(payload_codec="json", output_format="parquet")
    rows = jobs.bronze_rows(stream(spark, tmp_path / "in", "key string, value string"), TRIPS, cfg, now=T0 + 90_000)
    query = sinks.stream_to_table(rows, "late", str(tmp_path / "out"), str(tmp_path / "cp"))
    query.awaitTermination()
    got = {r.source_id: r.event_ts_status for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert got == {"u1": "ok", "u2": "ok", "u3": "clamped_past"} and len(query.recentProgress) >= 3


def test_fan_out_runs_every_sink_and_skips_empty_triggers(spark):
    calls = []
    sink = sinks.fan_out(lambda b, i: calls.append(("a", b.count(), i)), lambda b, i: calls.append(("b", b.count(), i)))
    df = spark.range(3)
    sink(df.limit(0), 0)
    sink(df, 1)
    assert calls == [("a", 3, 1), ("b", 3, 1)] and not df.is_cached


def test_a_failing_sink_releases_the_batch(spark):
    df = spark.range(3)

    def broken(batch, batch_id):
        raise RuntimeError("no")

    with pytest.raises(RuntimeError):
        sinks.fan_out(broken)(df, 0)
    assert not df.is_cached


def test_memory_sink(spark, tmp_path):
    drop_files(tmp_path / "in", [update(1, "08:00:00", T0)])
    query = sinks.stream_to_console(stream(spark, tmp_path / "in", UPDATES).select("id"), "looked_at", str(tmp_path / "cp"), fmt="memory")
    query.awaitTermination()
    assert [r.id for r in spark.table("looked_at").collect()] == ["u1"]


def test_transport_of_a_broker():
    spec = KafkaTransport(Settings()).source("alerts", 5000)
    assert spec.fmt == "kafka" and spec.reader_options(True)["maxOffsetsPerTrigger"] == "5000"


class _Session:
    """Only what scratch_dir asks a session for; the real setting is fixed at start-up."""

    def __init__(self, folder, master="local[4]"):
        self.conf = {"spark.checkpoint.dir": folder} if folder else {}
        self.sparkContext = type("Context", (), {"master": master})


def test_scratch_is_under_the_sessions_checkpoint_folder():
    shared = _Session("hdfs://shared/cp/")
    a, b = scratch_dir(shared, "x"), scratch_dir(shared, "x")
    assert a != b and a.startswith("hdfs://shared/cp/x-")
    assert "/x-" in scratch_dir(_Session(None), "x")
    with pytest.raises(ValueError):
        scratch_dir(_Session(None, "yarn"), "x")


def test_all_seven_jobs_end_to_end_and_again(spark, tmp_path):
    """Feeds in, detections out, one alert table; a second identical delivery adds no alert."""
    cfg = Settings(payload_codec="json", output_format="parquet", trigger_interval=None, stall_state_ttl_s=None,
                   output_path=str(tmp_path / "out"), checkpoint_path=str(tmp_path / "cp"), starting_offsets="earliest")
    transport = FolderTransport(str(tmp_path / "topics"))

    def message(key, doc):
        return {"key": key, "value": json.dumps({k: v for k, v in doc.items() if v is not None})}

    ts = int(dt.datetime(2024, 1, 1, 12, tzinfo=dt.timezone.utc).timestamp())
    trips = [update(i, s, ts, delay=d) for i, (s, d) in enumerate((("07:48:20", 700), ("08:01:00", 0), ("08:20:00", 10)))]
    spots = positions([at(ts + 30 * i, status="IN_TRANSIT_TO") for i in range(3)] + [at(ts + 900, vehicle="V2")])
    notice = {"id": "n1", "route_id": "R", "timestamp": ts, "active_period_start": ts}
    deliver = {"trip_updates": [message(t["trip_id"], t) for t in trips],
               "vehicle_positions": [message(p["vehicle_id"], p) for p in spots],
               "service_alerts": [message("n1", notice)]}
    for topic, docs in deliver.items():
        drop_files(tmp_path / "topics" / topic, docs)
    (tmp_path / "topics" / "alerts").mkdir()
    queries = jobs.start_bronze(spark, cfg, transport) + jobs.start_delays(spark, cfg, transport)
    queries += jobs.start_stalls(spark, cfg, transport) + jobs.start_headways(spark, cfg, transport)
    for q in queries:
        q.awaitTermination()
    (collector,) = jobs.start_alerts(spark, cfg, transport)
    collector.awaitTermination()

    def stored(table):
        return spark.read.parquet(cfg.table_path(table))

    assert [stored(t).count() for t in ("trip_updates", "vehicle_positions", "service_alerts")] == [3, 4, 1]
    assert {"event_date", "event_hour"} <= set(stored("trip_updates").columns)
    assert stored("delay_alerts").count() == 1 and stored("stall_events").count() == 1
    assert stored("headway_metrics").where("is_bunching").count() == 5
    kinds = {r.alert_type: r["count"] for r in stored("alerts").groupBy("alert_type").count().collect()}
    assert kinds == {"DELAY": 1, "STALL": 1, "BUNCHING": 5}
    assert stored("alerts").where(F.col("detected_at").isNull()).count() == 0

    # The same messages delivered again, as after a failed commit.
    alerts = tmp_path / "topics" / "alerts"
    again = [json.loads(line) for f in alerts.rglob("*.json") for line in f.read_text().splitlines()]
    assert len(again) == 7
    drop_files(alerts, again)
    (collector,) = jobs.start_alerts(spark, cfg, transport)
    collector.awaitTermination()
    assert stored("alerts").count() == 7
    assert len({q.name for q in queries} | {collector.name}) == 7
