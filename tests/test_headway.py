import datetime as dt
import statistics

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from fleetpulse import contracts
from fleetpulse.operators.headway import headway_lag_form, headway_windows

SCHEMA = "route_id string, direction_id int, start_time string, delay int, event_ts timestamp"
AT = dt.datetime(2026, 3, 27, 10, 2)
FORMS = [headway_windows, headway_lag_form]


def trips(spark, *starts, route="NX1", direction=0, delay=0, at=AT):
    return spark.createDataFrame([(route, direction, s, delay, at) for s in starts], SCHEMA)


def clock(seconds):
    return f"{seconds // 3600:02d}:{seconds // 60 % 60:02d}:{seconds % 60:02d}"


@pytest.mark.parametrize("form", FORMS)
def test_even_service(spark, form):
    rows = form(trips(spark, "08:00:00", "08:05:00", "08:10:00")).collect()
    assert len(rows) == 5
    for r in rows:
        assert (r.trip_count, r.headway_mean_s, r.headway_stddev_s, r.headway_cv, r.is_bunching) == (3, 300, 0, 0, False)


@pytest.mark.parametrize("form", FORMS)
def test_uneven_service_bunches(spark, form):
    row = form(trips(spark, "08:00:00", "08:10:00", "08:01:00")).first()
    assert row.headway_mean_s == 300 and row.headway_stddev_s == pytest.approx(240)
    assert row.headway_cv == pytest.approx(0.8) and row.is_bunching


@pytest.mark.parametrize("form", FORMS)
def test_variation_at_the_threshold_is_not_bunching(spark, form):
    row = form(trips(spark, "08:00:00", "08:02:30", "08:10:00")).first()
    assert row.headway_cv == 0.5 and row.is_bunching is False


@pytest.mark.parametrize("form", FORMS)
def test_too_few_trips(spark, form):
    two = form(trips(spark, "08:00:00", "08:05:00")).first()
    one = form(trips(spark, "08:00:00")).first()
    assert two.headway_mean_s == 300 and two.headway_cv is None and two.is_bunching is False
    assert one.trip_count == 1 and one.headway_mean_s is None and one.headway_stddev_s is None


@pytest.mark.parametrize("form", FORMS)
def test_equal_departures_have_no_variation(spark, form):
    row = form(trips(spark, "08:00:00", "08:00:00", "08:00:00")).first()
    assert (row.trip_count, row.headway_mean_s, row.headway_cv, row.is_bunching) == (3, 0.0, None, False)


@pytest.mark.parametrize("form", FORMS)
def test_unusable_rows(spark, form):
    df = trips(spark, "08:00:00", route="").union(trips(spark, "08:00:00", route=None)).union(trips(spark, None))
    assert form(df).count() == 0
    junk = form(trips(spark, "junk")).first()
    assert junk.trip_count == 0 and junk.headway_mean_s is None and junk.is_bunching is False
    assert form(trips(spark, "junk", "24:10:00", "24:20:00")).first().trip_count == 2


@pytest.mark.parametrize("form", FORMS)
def test_directions_apart_overnight_and_null_delay(spark, form):
    df = trips(spark, "24:10:00", "24:20:00", "24:30:00").union(
        trips(spark, "24:10:00", "24:20:00", "24:30:00", direction=1, delay=None))
    rows = form(df).collect()
    assert {r.direction_id for r in rows} == {0, 1} and all(r.headway_mean_s == 600 for r in rows)


def test_schema_matches_the_contract(spark):
    for form in FORMS:
        got = form(trips(spark, "08:00:00")).schema
        assert [(f.name, f.dataType) for f in got] == [(f.name, f.dataType) for f in contracts.HEADWAY_METRIC]


@pytest.mark.parametrize("window,slide", [("10 minutes", "4 minutes"), ("1 hour", "1 hour"), ("90 seconds", "30 seconds")])
def test_other_windows(spark, window, slide):
    df = spark.createDataFrame(
        [("R", 0, clock(1000 + 37 * i % 900), 0, AT + dt.timedelta(seconds=41 * i)) for i in range(60)], SCHEMA)
    a, b = (form(df, window, slide).orderBy("window_start").collect() for form in FORMS)
    assert a == b and len(a) > 0


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 100_000), st.integers(-200, 2000), st.integers(0, 30)), min_size=1, max_size=25))
def test_both_forms_follow_the_definition(spark, rows):
    data = [("R", 0, clock(s), d, AT + dt.timedelta(minutes=m)) for s, d, m in rows]
    df = spark.createDataFrame(data, SCHEMA)
    a = headway_windows(df).orderBy("window_start").collect()
    assert a == headway_lag_form(df).orderBy("window_start").collect()
    for r in a:
        line = sorted(s + d for s, d, m in rows if r.window_start <= AT + dt.timedelta(minutes=m) < r.window_end)
        gaps = [y - x for x, y in zip(line, line[1:])]
        assert r.trip_count == len(line)
        if gaps:
            assert r.headway_mean_s == pytest.approx(statistics.fmean(gaps))
            assert r.headway_stddev_s == pytest.approx(statistics.pstdev(gaps), abs=1e-6)
