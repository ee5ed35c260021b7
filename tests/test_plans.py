import datetime as dt

import pytest
from pyspark.sql import functions as F

from fleetpulse.checks.queries import QUERIES
from fleetpulse.operators.dedup import keep_first, keep_last
from fleetpulse.plans import dims, incremental as inc, marts, staging

TRIPS = ("event_id string, source_id string, trip_id string, route_id string, direction_id int, start_time string, "
         "start_date string, delay int, event_ts timestamp, ingested_at timestamp, is_deleted boolean")


def ts(text):
    return dt.datetime.fromisoformat(text)


def trip(event, source="s", delay=0, event_ts="2026-03-27 10:00:00", ingested="2026-03-27 10:00:05", deleted=False, route="R1"):
    return (event, source, "T", route, 0, "08:00:00", "20260327", delay, ts(event_ts), ts(ingested), deleted)


def test_first_copy_wins_and_deletion_is_judged_after(spark):
    df = spark.createDataFrame([
        trip("b", ingested="2026-03-27 10:01:00", delay=99), trip("a", delay=90),
        trip("c", source="gone", deleted=True), trip("d", source="gone", ingested="2026-03-27 10:02:00"),
        trip("e", source="unsure", deleted=None),
    ], TRIPS)
    (row,) = staging.stg_trip_updates(df).collect()
    assert (row.event_id, row.delay_minutes, str(row.event_date), row.event_hour) == ("a", 1.5, "2026-03-27", 23)


def test_keep_last_puts_nulls_last_and_ties_by_the_next_column(spark):
    df = spark.createDataFrame([(1, None, "x"), (1, 5, "a"), (1, 5, "b"), (2, None, "y")], "k int, o int, v string")
    assert {r.k: r.v for r in keep_last(df, ["k"], ["o", "v"]).collect()} == {1: "b", 2: "y"}
    assert {r.k: r.v for r in keep_first(df, ["k"], [F.col("o").asc_nulls_last(), "v"]).collect()} == {1: "a", 2: "y"}


def test_positions_outside_the_globe_go(spark):
    schema = ("event_id string, vehicle_id string, trip_id string, route_id string, latitude double, longitude double, "
              "speed float, current_stop_sequence int, stop_id string, current_status string, event_ts timestamp, ingested_at timestamp")
    base = ("T", "R")
    rows = [(e, e, *base, lat, lon, 3.0, 1, "P", "S", ts("2026-03-27 10:00:00"), ts("2026-03-27 10:00:00"))
            for e, lat, lon in (("a", 90.0, -180.0), ("b", 91.0, 0.0), ("c", 0.0, 181.0), ("d", None, 0.0))]
    (row,) = staging.stg_vehicle_positions(spark.createDataFrame(rows, schema)).collect()
    assert row.event_id == "a" and row.speed_kmh == 3.0


def test_headway_staging_takes_the_last_revision(spark):
    schema = ("route_id string, direction_id int, window_start timestamp, window_end timestamp, trip_count bigint, "
              "headway_mean_s double, headway_stddev_s double, headway_cv double, is_bunching boolean, batch_id bigint")
    w = (ts("2026-03-27 10:00:00"), ts("2026-03-27 10:10:00"))
    rows = [("R", 0, *w, 3, 1.0, 1.0, 1.0, True, 1), ("R", 0, *w, 4, 2.0, 0.0, 0.0, False, 2), ("R", 1, *w, 0, None, None, None, False, 2)]
    df = spark.createDataFrame(rows, schema)
    (row,) = staging.stg_headway_metrics(df).collect()
    assert row.trip_count == 4 and row.event_hour == 23
    assert staging.stg_headway_metrics(df.drop("batch_id")).count() == 2


def test_dimensions(spark):
    seed = spark.createDataFrame([("a", "A", "AA", 2), ("b", "B", "BB", 3), ("c", "C", "CC", 4), (None, "D", "DD", 3)],
                                 "route_id string, route_short_name string, route_long_name string, route_type int")
    got = {r.route_id: (r.route_name, r.route_type_label) for r in dims.dim_routes(seed).collect()}
    assert got == {"a": ("A", "Rail"), "b": ("B", "Bus"), "c": ("C", "Other")}
    stops = spark.createDataFrame([("s", "S", -36.8, 174.7, "1"), ("t", "T", -20.0, 174.7, "2"), (None, "U", -36.8, 174.7, "3")],
                                  "stop_id string, stop_name string, stop_lat double, stop_lon double, stop_code string")
    assert [r.stop_id for r in dims.dim_stops(stops).collect()] == ["s"]


@pytest.fixture(scope="module")
def routes(spark):
    return spark.createDataFrame([("R1", "One", "L", 3, "Bus")],
                                 "route_id string, route_name string, route_long_name string, route_type int, route_type_label string")


def test_delay_marts(spark, routes):
    df = spark.createDataFrame([trip("a", "s1", 600), trip("b", "s2", 300), trip("c", "s3", -60), trip("d", "s4", 301, route="RX")], TRIPS)
    stg = staging.stg_trip_updates(df)
    got = {r.event_id: r.route_name for r in marts.fct_delay_alerts(stg, routes).collect()}
    assert got == {"a": "One", "d": None}
    (hour,) = marts.fct_delay_by_hour(stg).collect()
    assert (hour.trip_count, hour.delayed_trip_count) == (4, 2)
    assert (hour.avg_delay_minutes, hour.avg_delay_minutes_delayed_only) == (4.76, 6.67)


def test_headway_mart(spark, routes):
    schema = ("route_id string, direction_id int, window_start timestamp, trip_count bigint, headway_mean_s double, "
              "headway_cv double, is_bunching boolean, event_date date")
    d = dt.date(2026, 3, 27)
    rows = [("R1", 0, ts("2026-03-27 10:02:00"), 3, 100.0, None, False, d), ("R1", 1, ts("2026-03-27 10:58:00"), 4, 101.0, 0.6, True, d),
            ("R1", 0, ts("2026-03-27 09:58:00"), 5, None, None, False, d)]
    got = {r.hour_bucket.hour: r for r in marts.fct_headway_regularity(spark.createDataFrame(rows, schema), routes).collect()}
    ten = got[10]
    assert (ten.avg_headway_s, ten.headway_cv, ten.bunching_pct, ten.trip_count, ten.route_name) == (100.5, 0.6, 50.0, 7, "One")
    assert got[9].avg_headway_s is None


def facts(spark, **per_date):
    rows = [(dt.date(2024, 1, int(d[1:])), v) for d, v in per_date.items()]
    return spark.createDataFrame(rows, "event_date date, v int")


def content(mart, spark):
    return sorted((r.event_date.day, r.v) for r in mart.read(spark).collect())


def test_append_freezes_a_day_and_replace_completes_it(spark, tmp_path):
    a, r = inc.Mart(path=str(tmp_path / "a")), inc.Mart(path=str(tmp_path / "r"))
    assert inc.high_water_mark(spark, a) is None
    for load, mart in ((inc.incremental_append, a), (inc.incremental_replace, r)):
        load(spark, facts(spark, d1=1, d2=2), mart)
        load(spark, facts(spark, d1=10, d2=20, d3=30), mart)
    assert content(a, spark) == [(1, 1), (2, 2), (3, 30)]
    assert content(r, spark) == [(1, 1), (2, 20), (3, 30)]
    inc.incremental_replace(spark, facts(spark, d1=7, d2=8, d3=9), r, lookback_days=1)
    assert content(r, spark) == [(1, 1), (2, 8), (3, 9)]
    inc.full_refresh(facts(spark, d5=5), r)
    assert content(r, spark) == [(5, 5)]


def test_an_empty_mart_loads_everything(spark, tmp_path):
    mart = inc.Mart(path=str(tmp_path / "m"))
    facts(spark, d1=1).limit(0).drop("event_date").write.parquet(mart.path + "/event_date=2024-01-01")
    # An existing folder without rows has no high-water mark.
    assert inc.high_water_mark(spark, mart) is None
    inc.incremental_append(spark, facts(spark, d1=1, d2=2), mart)
    assert content(mart, spark) == [(1, 1), (2, 2)]


def test_catalog_marts_views_and_snapshots(spark, tmp_path):
    spark.sql(f"create database if not exists gold location '{tmp_path / 'gold'}'")
    mart = inc.Mart(name="fct_x", namespace="gold")
    assert mart.read(spark) is None and mart.identifier == "gold.fct_x"
    inc.incremental_replace(spark, facts(spark, d1=1, d2=2), mart)
    inc.incremental_replace(spark, facts(spark, d1=5, d2=6, d3=7), mart)
    assert content(mart, spark) == [(1, 1), (2, 6), (3, 7)]
    inc.save_table(facts(spark, d1=1), name="gold.dim_x")
    inc.save_view(spark.table("gold.dim_x"), "v_x")
    assert spark.table("v_x").count() == 1
    inc.save_table(facts(spark, d1=1, d2=2), path=str(tmp_path / "t"))
    assert inc.snapshot(spark, str(tmp_path / "t"), str(tmp_path / "copy")) == 2
    spark.sql("drop database gold cascade")


def test_bronze_is_pruned_a_day_wide(spark):
    df = facts(spark, d1=1, d2=2, d3=3)
    assert [r.v for r in inc.prune_bronze(df, dt.date(2024, 1, 3)).collect()] == [2, 3]
    assert inc.prune_bronze(df, None).count() == 3


def test_pruned_bronze_gives_the_same_mart(spark):
    """A local date is at most a day ahead of the UTC folder, so the wider bound loses nothing."""
    df = spark.createDataFrame(
        [trip(f"e{h}", f"s{h}", h, str(ts("2026-03-25 00:00:00") + dt.timedelta(hours=h))) for h in range(0, 96)], TRIPS
    ).withColumn("utc_date", F.to_date("event_ts"))
    since = dt.date(2026, 3, 27)
    full = staging.stg_trip_updates(df).where(F.col("event_date") >= F.lit(since))
    pruned = staging.stg_trip_updates(inc.prune_bronze(df, since, "utc_date")).where(F.col("event_date") >= F.lit(since))
    assert full.count() == pruned.count() > 0 and full.exceptAll(pruned).count() == 0


def test_the_mark_comes_from_the_listing(spark, tmp_path):
    """Spark takes the columns from the first file and the mark opens the last date; what lies between may be unreadable."""
    mart = inc.Mart(path=str(tmp_path / "mart"))
    assert inc.high_water_mark(spark, mart) is None
    rows = spark.createDataFrame([(1, dt.date(2026, 3, 27)), (2, dt.date(2026, 3, 29)), (3, None), (4, dt.date(2026, 3, 28))], "n int, event_date date")
    mart.write(rows, "append")
    reader = inc.Mart(path=mart.path)
    for file in (tmp_path / "mart").rglob("event_date=2026-03-28/*.parquet"):
        file.write_bytes(b"x" * file.stat().st_size)
    assert inc.stored_dates(spark, reader) == {dt.date(2026, 3, d) for d in (27, 28, 29)}
    assert inc.high_water_mark(spark, reader) == dt.date(2026, 3, 29)
    named = inc.Mart(name="listed_mart")
    named.write(rows, "overwrite")
    try:
        assert inc.high_water_mark(spark, named) == dt.date(2026, 3, 29)
    finally:
        spark.sql("DROP TABLE listed_mart")


def test_the_route_dimension_has_every_route(spark, sf_dir):
    nation = spark.read.parquet(f"{sf_dir}/nation.parquet")
    found = QUERIES["routes_dim"](spark, sf_dir)
    assert {r["route_id"] for r in found.collect()} == {f"R{r[0]}" for r in nation.select("n_nationkey").collect()} and found.count() == nation.count()
