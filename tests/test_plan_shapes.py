"""What the plans must look like for the jobs to hold at scale."""

import pytest
from pyspark.sql import functions as F

from fleetpulse.checks.queries import LONG_STALLS, QUERIES
from fleetpulse.operators import live
from fleetpulse.operators.dedup import keep_first
from fleetpulse.operators.headway import headway_lag_form
from fleetpulse.operators.stall import stall_events
from fleetpulse.plans import incremental as inc
from fleetpulse.sources import adapters as ad


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan(df):
    df.write.format("noop").mode("overwrite").save()
    df.collect()
    return plan(df)


@pytest.fixture(scope="module")
def events(spark, sf_dir):
    return ad.table(spark, sf_dir, "events")


def test_no_query_crosses_rows_or_runs_row_python(spark, sf_dir):
    writes = {"incremental_append", "incremental_replace", "alerts_upsert"}
    for name in (n for n in QUERIES if not n.startswith("stream_") and n not in writes):
        text = plan(QUERIES[name](spark, sf_dir))
        assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text, name
        assert "BatchEvalPython" not in text and "FlatMapGroupsInPandas" not in text, name


def test_keep_first_limits_groups_before_the_shuffle(events):
    text = plan(keep_first(events, ["user_id"], ["ts", "event_id"]))
    partial = text.index("Exchange hashpartitioning")
    assert "WindowGroupLimit" in text[:partial] and "Partial" in text[partial:]


def test_only_used_columns_are_read_and_filters_reach_the_scan(spark, sf_dir, events):
    text = plan(events.where(F.col("event_type") == "view").groupBy("user_id").agg(F.sum("value")))
    assert "PushedFilters: [IsNotNull(event_type), EqualTo(event_type,view)]" in text
    scan = plan(QUERIES["delay_by_hour"](spark, sf_dir))
    assert "props" not in scan[scan.index("ReadSchema"):]


def test_headway_counts_departures_before_the_first_shuffle(events):
    trips = ad.trip_updates(events).withColumn("event_ts", F.timestamp_seconds("timestamp"))
    text = plan(headway_lag_form(trips))
    assert text.count("Exchange hashpartitioning") == 2
    assert "partial_count" in text[text.rindex("Exchange hashpartitioning"):]


def test_stall_detection_shuffles_readings_once_before_cutting(events):
    text = final_plan(stall_events(ad.vehicle_positions(events), LONG_STALLS))
    done = text[: text.index("== Initial Plan ==")]
    assert "ReusedExchange" in done and done.count("FileScan") == 1


def test_latest_stalls_fold_copies_before_the_shuffle(events):
    stalls = events.select(
        F.lit("s").alias("stall_id"), F.col("event_type").alias("vehicle_id"), F.lit("r").alias("route_id"),
        F.lit("t").alias("trip_id"), F.col("user_id").alias("reading_count"), F.col("event_id").alias("stall_detected_ts"))
    text = plan(live.latest_stalls(stalls))
    assert "partial_max_by" in text[text.index("Exchange"):]


def test_top_rows_are_taken_without_a_full_sort(events):
    assert "TakeOrderedAndProject" in plan(live.latest_rows(events, "ts", 5))


def test_dimension_joins_carry_no_hint(spark, sf_dir):
    df = QUERIES["fct_delay_alerts"](spark, sf_dir)
    assert "BroadcastHashJoin" in plan(df)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "SortMergeJoin" in plan(QUERIES["fct_delay_alerts"](spark, sf_dir))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_pruned_bronze_reads_fewer_folders(spark, tmp_path):
    import datetime as dt

    spark.sql("select id, date_add(date'2024-01-01', cast(id as int)) event_date from range(9)").write.partitionBy(
        "event_date").parquet(str(tmp_path / "b"))
    df = inc.prune_bronze(spark.read.parquet(str(tmp_path / "b")), dt.date(2024, 1, 8))
    assert df.count() == 3 and "PartitionFilters: [isnotnull(event_date" in plan(df)


def test_partitioned_writes_are_grouped_by_folder(spark, tmp_path):
    df = spark.range(0, 1000, 1, 16).selectExpr("id", "date_add(date'2024-01-01', cast(id % 3 as int)) event_date")
    mart = inc.Mart(path=str(tmp_path / "m"))
    inc.full_refresh(df, mart)
    files = list((tmp_path / "m").rglob("*.parquet"))
    assert len(files) == 3 and mart.read(spark).count() == 1000
