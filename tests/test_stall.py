import math
import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from fleetpulse import contracts
from fleetpulse.operators import stall
from fleetpulse.operators.stall import Run, StallParams, readings, stall_events

SCHEMA = ("vehicle_id string, route_id string, trip_id string, latitude double, longitude double, "
          "timestamp bigint, current_status string")
SPOT = (-36.84, 174.76)


def at(ts, lat=SPOT[0], lon=SPOT[1], route="R1", trip="T1", status=None, vehicle="V1"):
    return (vehicle, route, trip, lat, lon, ts, status)


def detect(spark, *rows, params=StallParams(), slice_s=6 * 3600):
    df = spark.createDataFrame(list(rows), SCHEMA)
    return stall_events(df, params, slice_s).orderBy("vehicle_id", "stall_detected_ts", "reading_count").collect()


def test_two_readings_are_no_stall(spark):
    assert detect(spark, at(1000), at(1030)) == []


def test_third_reading_at_the_shortest_span(spark):
    (e,) = detect(spark, at(1000), at(1030), at(1060))
    assert (e.reading_count, e.stall_duration_s, e.stall_detected_ts) == (3, 60, 1060)
    assert e.first_seen.timestamp() == 1000 and (e.latitude, e.longitude) == SPOT and len(e.stall_id) == 64


def test_span_too_short_then_long_enough(spark):
    assert detect(spark, at(1000), at(1010), at(1020)) == []
    (e,) = detect(spark, at(1000), at(1010), at(1020), at(1070))
    assert e.reading_count == 4


def test_moving_away_restarts(spark):
    assert detect(spark, at(1000), at(1030), at(1060, lat=-36.839), at(1090, lat=-36.839)) == []


def test_trip_and_route_changes_restart(spark):
    assert detect(spark, at(1000), at(1030), at(1060, trip="T2")) == []
    assert detect(spark, at(1000), at(1030), at(1060, route="R2")) == []


def test_missing_trip_counts_as_blank(spark):
    assert len(detect(spark, at(1000, trip=None), at(1030, trip=""), at(1060, trip=None))) == 1


def test_every_further_reading_is_an_event(spark):
    got = detect(spark, *[at(t) for t in range(1000, 1121, 30)])
    assert [e.reading_count for e in got] == [3, 4, 5]


def test_all_stopped_is_no_stall_but_one_moving_reading_is(spark):
    stopped = [at(t, status="STOPPED_AT") for t in (1000, 1030, 1060)]
    assert detect(spark, *stopped) == []
    (e,) = detect(spark, *stopped, at(1090, status="IN_TRANSIT_TO"))
    assert e.reading_count == 4


def test_too_long_a_span_anchors_anew(spark):
    got = detect(spark, at(0), at(300), at(601), at(650), at(661))
    assert [(e.reading_count, e.stall_duration_s) for e in got] == [(3, 60)]
    assert got[0].first_seen.timestamp() == 601


def test_readings_outside_the_area_change_nothing(spark):
    (e,) = detect(spark, at(1000), at(1030), at(1045, lat=0.0), at(1060))
    assert e.reading_count == 3
    assert len(detect(spark, at(1000), at(1030), at(1045, lat=None), at(1060))) == 1


def test_slow_drift_is_measured_from_the_anchor(spark):
    step = 8 / 111_195
    rows = [at(1000 + 30 * i, lat=SPOT[0] + i * step) for i in range(6)]
    assert detect(spark, *rows) == []


def test_order_of_arrival_and_equal_clocks(spark):
    rows = [at(1060), at(1000), at(1030), at(1030, status="STOPPED_AT")]
    a = detect(spark, *rows)
    random.Random(1).shuffle(rows)
    assert a == detect(spark, *rows) and [e.reading_count for e in a] == [4]


def test_columns_match_the_contract(spark):
    df = stall_events(spark.createDataFrame([at(1)], SCHEMA))
    assert [(f.name, f.dataType) for f in df.schema] == [(f.name, f.dataType) for f in contracts.STALL_EVENT]


def test_a_known_run_goes_on():
    run = Run("R1", "T1", *SPOT, 2, 900, 960, True)
    assert run.advance(StallParams(), 1000, "R1", "T1", *SPOT, False) == 100 and run.n == 3


def test_silence_restarts(spark):
    rows = [at(1000), at(1030), at(1100), at(1130), at(1161)]
    assert [e.stall_detected_ts for e in detect(spark, *rows)] == [1100, 1130, 1161]
    got = detect(spark, *rows, params=StallParams(silence_s=69))
    assert [(e.reading_count, e.stall_detected_ts) for e in got] == [(3, 1161)]
    assert len(detect(spark, *rows, params=StallParams(silence_s=70))) == 3


def independent_stretches(rows, params, slice_s):
    return stall.independent_stretches(readings(rows, params), params, slice_s)


# An independent reading of the rules, with positions and history kept as they come.


def by_the_book(rows, p):
    events, per_vehicle = [], {}
    for v, route, trip, lat, lon, ts, status in sorted(rows, key=lambda r: (r[0], r[5])):
        per_vehicle.setdefault(v, []).append((ts, route, trip, lat, lon, status == "STOPPED_AT"))
    for v, line in per_vehicle.items():
        group = []
        for r in line:
            if group:
                a = group[0]
                far = metres(a[3], a[4], r[3], r[4]) > p.radius_m
                silent = p.silence_s is not None and r[0] - last > p.silence_s
                group = [r] if far or silent or a[1:3] != r[1:3] else group + [r]
            else:
                group = [r]
            last = r[0]
            span = r[0] - group[0][0]
            if len(group) >= p.min_readings and span > p.max_span_s:
                group = [r]
            elif len(group) >= p.min_readings and span >= p.min_span_s and not all(g[5] for g in group):
                events.append((v, len(group), span, r[0]))
    return sorted(events)


def metres(a, b, c, d):
    a, b, c, d = map(math.radians, (a, b, c, d))
    h = math.sin((c - a) / 2) ** 2 + math.cos(a) * math.cos(c) * math.sin((d - b) / 2) ** 2
    return 2 * 6_371_000 * math.asin(math.sqrt(h))


def random_walk(rng, n, vehicles=2):
    rows, lat, ts = [], {}, {}
    for _ in range(n):
        v = f"V{rng.randrange(vehicles)}"
        lat[v] = lat.get(v, SPOT[0]) + rng.choice([0, 0, 0, 5, -7, 12, 20, 29, -29, 35, 200]) / 111_195
        ts[v] = ts.get(v, 0) + rng.choice([1, 20, 30, 30, 61, 250, 700])
        rows.append(at(ts[v], lat=lat[v], trip=rng.choice(["T1"] * 9 + ["T2"]), vehicle=v,
                       status=rng.choice(["STOPPED_AT", "STOPPED_AT", "IN_TRANSIT_TO"])))
    return rows


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.integers(0, 10_000), st.sampled_from([60, 900, 5000, 10**7]), st.sampled_from([None, 60, 300]))
def test_cut_timelines_give_the_sequential_result(spark, seed, slice_s, silence_s):
    rows, p = random_walk(random.Random(seed), 250), StallParams(silence_s=silence_s)
    got = detect(spark, *rows, slice_s=slice_s, params=p)
    assert sorted((e.vehicle_id, e.reading_count, e.stall_duration_s, e.stall_detected_ts) for e in got) == by_the_book(rows, p)


@pytest.mark.parametrize("seed,silence_s", [(1, None), (2, None), (3, 60), (4, 300), (5, None)])
def test_steps_with_runs_between_them_give_the_sequential_result(spark, seed, silence_s):
    """Readings cut at any time into steps; only the runs go from one to the next."""
    rng, p = random.Random(seed), StallParams(silence_s=silence_s)
    rows = random_walk(rng, 250)
    top = max(r[5] for r in rows)
    cuts = [-1, *sorted(rng.sample(range(top), 5)), top]
    runs, got = spark.createDataFrame([], stall.RUN), []
    for low, high in zip(cuts, cuts[1:]):
        part = readings(spark.createDataFrame([r for r in rows if low < r[5] <= high], SCHEMA), p)
        step = spark.createDataFrame(stall.stall_step(part, runs, p, 900).collect(), f"{stall.FINDING}, stretch bigint, moved boolean")
        got += stall.found(step).collect()
        runs = spark.createDataFrame(stall.after(step, runs, p, high).collect(), stall.RUN)
        if silence_s:
            assert all(high - r["last"] <= silence_s for r in runs.collect())
    assert sorted((e.vehicle_id, e.reading_count, e.stall_duration_s, e.stall_detected_ts) for e in got) == by_the_book(rows, p)


@pytest.mark.parametrize("min_readings", [1, 2, 3])
def test_fewer_needed_readings_keep_short_runs(spark, min_readings):
    p = StallParams(min_readings=min_readings, min_span_s=0)
    rows = random_walk(random.Random(7), 120)
    got = detect(spark, *rows, params=p, slice_s=900)
    assert sorted((e.vehicle_id, e.reading_count, e.stall_duration_s, e.stall_detected_ts) for e in got) == by_the_book(rows, p)


def test_one_vehicle_with_all_rows_is_spread(spark):
    """A single vehicle that now and then moves is cut into many stretches of bounded size."""
    rows = spark.range(20_000).select(
        F.lit("V1").alias("vehicle_id"), F.lit("R").alias("route_id"), F.lit("T").alias("trip_id"),
        (F.lit(-36.9) + F.floor(F.col("id") / 50) % 2 * 0.01).alias("latitude"), F.lit(174.76).alias("longitude"),
        (F.col("id") * 30).alias("timestamp"), F.lit("MOVING").alias("current_status"),
    )
    sizes = independent_stretches(rows, StallParams(), 6 * 3600).groupBy("stretch").count().agg(
        F.count(F.lit(1)), F.max("count")).first()
    assert sizes[0] >= 25 and sizes[1] <= 6 * 3600 / 30 + 50


def parked(spark, n, status, moves_at=()):
    """One vehicle on one spot for n readings, stopped except at the given ones."""
    odd = F.col("id").isin(*moves_at) if moves_at else F.lit(False)
    return spark.range(n).select(
        F.lit("V1").alias("vehicle_id"), F.lit("R").alias("route_id"), F.lit("T").alias("trip_id"),
        F.lit(-36.84).alias("latitude"), F.lit(174.76).alias("longitude"), (F.col("id") * 30).alias("timestamp"),
        F.when(odd, "MOVING").otherwise(status).alias("current_status"))


def test_a_parked_vehicle_never_reaches_the_scan(spark):
    assert independent_stretches(parked(spark, 20_000, "STOPPED_AT"), StallParams(), 3600).count() == 0


@pytest.mark.parametrize("moves_at", [(0,), (999,), (500,), (130, 700)])
def test_one_moving_reading_keeps_the_whole_run(spark, moves_at):
    df = parked(spark, 1000, "STOPPED_AT", moves_at)
    rows = [tuple(r) for r in df.collect()]
    got = stall_events(df, slice_s=900).collect()
    assert independent_stretches(df, StallParams(), 900).count() == 1000
    assert sorted((e.vehicle_id, e.reading_count, e.stall_duration_s, e.stall_detected_ts) for e in got) == \
        by_the_book(rows, StallParams())


def test_parking_after_a_drive_is_dropped_slice_by_slice(spark):
    """Drive, park over many slices, drive on: only the slices with driving keep readings."""
    drive = [at(30 * i, lat=-36.9 + i * 0.001, status="IN_TRANSIT_TO") for i in range(100)]
    park = [at(3000 + 30 * i, lat=-36.7, status="STOPPED_AT") for i in range(3000)]
    on = [at(93_000 + 30 * i, lat=-36.9 + i * 0.001, status="IN_TRANSIT_TO") for i in range(100)]
    rows = drive + park + on
    kept = independent_stretches(spark.createDataFrame(rows, SCHEMA), StallParams(), 3600)
    assert kept.where("stopped").count() == 0 and kept.count() < 20
    assert detect(spark, *rows, slice_s=3600) == [] and by_the_book(rows, StallParams()) == []
