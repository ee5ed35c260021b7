import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from fleetpulse.operators import live, quality

STALLS = ("stall_id string, vehicle_id string, route_id string, trip_id string, reading_count int, stall_detected_ts bigint, "
          "latitude double, longitude double")


def test_classification(spark):
    docs = [{"severity": "HIGH", "delay": 700}, {"severity": "HIGH"}, {"stall_duration_s": 60}, {"reading_count": 3},
            {"severity": "LOW", "delay": 1, "reading_count": 3}, {"a": 1}]
    rows = [(i, json.dumps(d)) for i, d in enumerate(docs)] + [(6, "{cut"), (7, None), (8, "")]
    got = live.classify(spark.createDataFrame(rows, "i int, value string")).orderBy("i")
    assert [r.kind for r in got.collect()] == ["delay", "other", "stall", "stall", "delay", "other"] + ["malformed"] * 3
    assert tuple(live.kind_counts(got).first()) == (2, 2)


def test_retention_includes_its_edge(spark):
    now = dt.datetime(2024, 1, 1, 0, 5)
    rows = [(now - dt.timedelta(seconds=s),) for s in (0, 299, 300, 301)]
    got = live.recent(spark.createDataFrame(rows, "received_at timestamp"), F.lit(now))
    assert got.count() == 3


def test_latest_stall_per_vehicle_and_trip(spark):
    rows = [("a", "V", "R", None, 3, 10, 0.0, 0.0), ("b", "V", "R", "", 5, 30, 0.0, 0.0), ("c", "V", "R", None, 5, 20, 0.0, 0.0),
            ("d", "V", "R", "T", 1, 1, 0.0, 0.0), ("e", None, "R", "T", 9, 1, 0.0, 0.0)]
    got = live.latest_stalls(spark.createDataFrame(rows, STALLS))
    assert got.columns == [c.split()[0] for c in STALLS.split(", ")]
    assert sorted(r.stall_id for r in got.collect()) == ["c", "d"]


def test_map_points(spark):
    df = spark.createDataFrame([("-36.8", "174.7", "4"), ("-36.8", "174.7", None), ("x", "174.7", "1"), ("-37.21", "174.7", "1")],
                               "latitude string, longitude string, reading_count string")
    assert sorted(r.reading_count for r in live.map_points(df).collect()) == [1, 4]


def test_severity_counts_fill_zeros_in_order(spark):
    df = spark.createDataFrame([("HIGH",), ("HIGH",), ("odd",)], "severity string")
    assert [(r.severity, r.alerts) for r in live.severity_counts(df).collect()] == [("MODERATE", 0), ("HIGH", 2), ("SEVERE", 0)]
    assert [r.alerts for r in live.severity_counts(df.limit(0)).collect()] == [0, 0, 0]


WINDOWS = "route_id string, direction_id int, headway_cv double, is_bunching boolean, trip_count bigint, window_start int"


@pytest.fixture(scope="module")
def windows(spark):
    rows = [("A", 0, 0.9, True, 3, 1), ("A", 0, 0.7, True, 3, 2), ("A", 1, 0.2, False, 3, 1), ("B", 0, None, False, 1, 1)]
    return spark.createDataFrame(rows, WINDOWS)


def test_headway_roll_ups(windows):
    s = live.headway_summary(windows).first()
    assert (s.routes_reporting, s.bunching_lines) == (2, 1) and s.avg_headway_cv == pytest.approx(0.6)
    assert live.headway_summary(windows.limit(0)).first().avg_headway_cv is None
    assert live.routes_reporting(windows).first()[0] == 2
    assert [r.headway_cv for r in live.worst_windows(windows).collect()] == [0.9, 0.7]
    assert "headway_mean_s" not in live.worst_windows(windows).columns
    assert [(r.route_id, round(r.avg_headway_cv, 6)) for r in live.busiest_route_variation(windows).collect()] == [("A", 0.6)]
    assert live.in_busiest(windows, 1).count() == 3


def test_filters(spark):
    df = spark.createDataFrame([("HIGH", "T2"), ("HIGH", "T1"), ("SEVERE", None)], "severity string, trip_id string")
    assert [r.trip_id for r in live.trip_choices(df).collect()] == ["T1", "T2"]
    assert live.drill_down(df).count() == 3 and live.drill_down(df, "HIGH").count() == 2
    assert live.drill_down(df, "HIGH", "T1").count() == 1


def test_board(spark):
    rows = [("a", "T1", 5, "2024-01-01T00:00:00Z", 1), ("b", "T1", 6, "2024-01-01T00:00:09Z", 2), ("c", "T2", 7, None, 3)]
    df = spark.createDataFrame(rows, "event_id string, trip_id string, delay int, detected_at string, received_at int")
    got = live.board(df, ["alert_id", "delay_s", "absent", "detected_at"], ["nope", "detected_at"], ["trip_id", "alert_id"],
                     {"delay": "delay_s", "event_id": "alert_id"})
    assert got.columns == ["alert_id", "delay_s", "detected_at", "received_at"]
    assert [(r.alert_id, r.detected_at) for r in got.collect()] == [("b", "2024-01-01 13:00:09"), ("c", None)]
    assert got.first().received_at == "1970-01-01 12:00:02"


def test_quality_rules(spark):
    df = spark.createDataFrame([("a", 5, "Bus"), ("a", -1, "Tram"), (None, None, None)], "k string, n int, label string")
    rules = (quality.not_null("k", "n") + quality.unique("k") + quality.between("n", 0) + quality.between("n", None, 4)
             + quality.between("n", 0, 4) + quality.accepted("label", "Bus"))
    got = {(r.column_name, r.rule): r.violations for r in quality.check(df, "t", rules).collect()}
    assert got == {("k", "not_null"): 1, ("n", "not_null"): 1, ("k", "unique"): 1, ("n", "between(0,)"): 1,
                   ("n", "between(,4)"): 1, ("n", "between(0,4)"): 2, ("label", "accepted(Bus)"): 1}
    clean = quality.check(df.limit(0), "t", rules + quality.unique("n")).collect()
    assert len(clean) == 8 and all(r.violations == 0 for r in clean)


@pytest.mark.parametrize("date_col", [None, "d"])
def test_rules_counted_while_writing(spark, tmp_path, date_col):
    rows = [("a", 5, "Bus", "2024-01-01"), ("a", -1, "Tram", "2024-01-01"), (None, None, None, "2024-01-02")]
    df = spark.createDataFrame(rows, "k string, n int, label string, d string")
    rules = quality.not_null("k", "n") + quality.unique("k", "n") + quality.between("n", 0, 4) + quality.accepted("label", "Bus")
    stored, report = quality.write_checked(df, "t", f"{tmp_path}/t", rules, date_col=date_col)
    assert sorted(map(str, report.collect())) == sorted(map(str, quality.check(df, "t", rules).collect()))
    assert stored.count() == 3 and report.columns == ["table_name", "column_name", "rule", "violations"]
    _, again = quality.write_checked(df.where("n = 5"), "t", f"{tmp_path}/t", rules, mode="append", date_col=date_col)
    got = {(r.column_name, r.rule): r.violations for r in again.collect()}
    assert got[("n", "between(0,4)")] == 1 and got[("k", "unique")] == 1 and got[("n", "unique")] == 1


def test_empty_table_and_one_kind_of_rule(spark, tmp_path):
    df = spark.createDataFrame([("a",)], "k string")
    _, none = quality.write_checked(df.limit(0), "t", f"{tmp_path}/e", quality.not_null("k") + quality.unique("k"))
    assert [r.violations for r in none.collect()] == [0, 0]
    _, local = quality.write_checked(spark.createDataFrame([], "k string"), "t", f"{tmp_path}/l", quality.not_null("k"))
    assert [r.violations for r in local.collect()] == [0]
    _, one = quality.write_checked(df, "t", f"{tmp_path}/u", quality.unique("k"))
    assert [r.violations for r in one.collect()] == [0]
    plan = quality.write_checked(df, "t", f"{tmp_path}/p", quality.not_null("k") + quality.unique("k"))[1]._jdf.queryExecution().toString()
    assert plan.count("Exchange hashpartitioning") <= 2  # once in each of the two forms that are printed


def test_every_declared_rule_is_there():
    counts = {t: len(r) for t, r in quality.RULES.items()}
    assert counts == {"stg_vehicle_positions": 7, "stg_trip_updates": 7, "stg_stall_events": 6, "stg_headway_metrics": 5,
                      "stg_gtfs_routes": 5, "stg_gtfs_stops": 7, "dim_routes": 5, "dim_stops": 5, "fct_delay_alerts": 10,
                      "fct_stall_incidents": 7, "fct_delay_by_hour": 5, "fct_headway_regularity": 6}
    assert sum(counts.values()) == 75


def test_profile(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (None,)], "x double")
    r = quality.profile(df, ["x"]).first()
    assert (r.row_count, r.non_null, r.mean, r.stddev, r.min, r.max, r.p25, r.p50, r.p75) == (4, 3, 2.0, 1.0, 1.0, 3.0, 1.0, 2.0, 3.0)
    assert {x.table_name: x.rows for x in quality.row_counts({"a": df, "b": df.limit(1)}).collect()} == {"a": 4, "b": 1}
