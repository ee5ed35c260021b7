"""Checks that need a table written more than once, or a stream run to its end.

Everything is written to and read back from the session's shared scratch folder.
"""

from __future__ import annotations

import datetime as dt
import functools
from collections.abc import Callable

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from fleetpulse import contracts
from fleetpulse.config import Settings
from fleetpulse.operators import alerts as al
from fleetpulse.operators import quality
from fleetpulse.operators.enrich import TRIPS
from fleetpulse.operators.stall import StallParams
from fleetpulse.plans import incremental as inc
from fleetpulse.plans import marts
from fleetpulse.plans.staging import stg_headway_metrics
from fleetpulse.session import scratch_dir
from fleetpulse.sources import adapters as ad
from fleetpulse.sources.messages import to_messages
from fleetpulse.sources.tables import per_folder, read_bronze
from fleetpulse.streaming import jobs
from fleetpulse.streaming import sinks
from fleetpulse.streaming.stall_state import closed_readings, judged

# Triggers of a replayed stream and files of each, and how late its rows may be where some are to be lost.
PARTS, FILES, LATENESS = 6, 2, "6 days"
# The first load ends here, in the middle of a local day.
FIRST_LOAD_END = dt.datetime(2024, 1, 15, 6)


def load_twice(spark: SparkSession, trips: DataFrame, replace: bool) -> DataFrame:
    """The hourly mart after a first load up to a cut and a second load of everything."""
    mart = inc.Mart(path=scratch_dir(spark, "mart"))
    load = inc.incremental_replace if replace else inc.incremental_append
    early = trips.where(F.col("event_ts") < F.lit(FIRST_LOAD_END).cast("timestamp"))
    load(spark, marts.fct_delay_by_hour(early), mart)
    load(spark, marts.fct_delay_by_hour(trips), mart)
    columns = marts.fct_delay_by_hour(trips).columns
    return mart.read(spark).select(*columns)


def refresh_twice(
    spark: SparkSession, bronze: DataFrame, build: Callable[[DataFrame], DataFrame], arrived: str = "event_ts", lookback_days: int = 0
) -> DataFrame:
    """A mart after two refreshes from a partitioned bronze table that grew in between.

    ``arrived`` says when a bronze row came, ``event_date`` (by default that of ``event_ts``) which folder it is in.
    """
    base = scratch_dir(spark, "refresh")
    mart = inc.Mart(path=f"{base}/mart")
    if "event_date" not in bronze.columns:
        bronze = bronze.withColumn("event_date", F.to_date("event_ts"))
    cut = F.lit(FIRST_LOAD_END).cast("timestamp")
    for part in (F.col(arrived) < cut, F.col(arrived) >= cut):
        per_folder(bronze.where(part), "event_date").write.mode("append").partitionBy("event_date").parquet(f"{base}/bronze")
        inc.refresh(spark, read_bronze(spark, "bronze", base), build, mart, lookback_days=lookback_days)
    return mart.read(spark).select(*build(bronze).columns)


def upsert_twice(spark: SparkSession, alerts: DataFrame) -> DataFrame:
    """The alert table after a part of the alerts, all of them, and all of them again."""
    base = scratch_dir(spark, "alerts")
    alerts.write.parquet(f"{base}/batch")
    batch, path = spark.read.parquet(f"{base}/batch"), f"{base}/alerts"
    al.upsert_alerts(spark, batch.where(F.col("event_ts") < F.lit(FIRST_LOAD_END).cast("timestamp")), path)
    al.upsert_alerts(spark, batch, path)
    al.upsert_alerts(spark, batch, path, prune_by_date=True)
    return spark.read.parquet(path).select(*alerts.columns)


def stored(df: DataFrame, label: str) -> DataFrame:
    """The rows written and read back, for a plan that needs them twice."""
    path = f"{scratch_dir(df.sparkSession, label)}/table"
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def build_checked(spark: SparkSession, models: dict[str, Callable[[dict[str, DataFrame]], DataFrame]]) -> DataFrame:
    """The reports of models stored one after another; each is built from the tables stored before it."""
    base = scratch_dir(spark, "models")
    tables: dict[str, DataFrame] = {}
    reports = []
    for name, build in models.items():
        tables[name], report = quality.write_checked(build(tables), name, f"{base}/{name}")
        reports.append(report)
    return functools.reduce(DataFrame.unionByName, reports)


def append_checked(spark: SparkSession, bronze: DataFrame) -> DataFrame:
    """Reports of a partitioned table's two loads; the second brings a sixth of the first's rows again."""
    path = f"{scratch_dir(spark, 'appended')}/table"
    rules = quality.not_null("delay", "start_time") + quality.unique("event_id") + quality.between("delay", None, 300)
    cut = F.lit(FIRST_LOAD_END).cast("timestamp")
    again = F.pmod(F.substring("event_id", 2, 20).cast("bigint"), F.lit(6)) == 0
    reports = []
    for part, rows in (("first", F.col("event_ts") < cut), ("second", (F.col("event_ts") >= cut) | again)):
        _, report = quality.write_checked(bronze.where(rows), part, path, rules, mode="append", date_col="event_date")
        # The first unique count is of the first part only if it is taken before the second is written.
        reports.append(stored(report, "report"))
    return functools.reduce(DataFrame.unionByName, reports)


def as_csv(spark: SparkSession, seed: DataFrame, contract: T.StructType) -> str:
    """A schedule file with all of its contract's columns; those that the seed lacks are empty."""
    path = scratch_dir(spark, "seed")
    columns = [F.col(f.name) if f.name in seed.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in contract]
    seed.select(*columns).write.option("header", True).csv(path)
    return path


def copied(spark: SparkSession, first: DataFrame, second: DataFrame) -> DataFrame:
    """Row counts of a table's copies: as first written, after a full refresh with other rows, and what the copy then holds."""
    base = scratch_dir(spark, "copies")
    mart = inc.Mart(path=f"{base}/mart")
    counts = []
    for rows in (first, second):
        inc.full_refresh(rows, mart)
        counts.append(inc.snapshot(spark, mart.path, f"{base}/copy"))
    held = spark.read.parquet(f"{base}/copy").agg(F.count(F.lit(1)).alias("held"))
    return held.select(F.lit(counts[0]).cast("bigint").alias("first_copy"), F.lit(counts[1]).cast("bigint").alias("second_copy"), "held")


def finish(query: StreamingQuery) -> StreamingQuery:
    """Wait for a bounded run; its error, if any, is raised here."""
    query.awaitTermination()
    return query


def bronze_stream(spark: SparkSession, sf_dir: str, now: int) -> DataFrame:
    """Trip updates as JSON messages through decode, enrichment and the partitioned sink."""
    base = scratch_dir(spark, "bronze")
    cfg = Settings(payload_codec="json", output_format="parquet")
    messages = to_messages(ad.event_stream(spark, sf_dir).select(*ad.trip_columns()), F.col("trip_id"))
    rows = jobs.bronze_rows(messages, TRIPS, cfg, now)
    finish(sinks.stream_to_table(rows, "bronze_trips", f"{base}/table", f"{base}/checkpoint"))
    return spark.read.parquet(f"{base}/table").drop("event_id", "ingested_at", "_raw_payload")


def replay(spark: SparkSession, sf_dir: str, tick: bool = False) -> DataFrame:
    """The events as a stream of PARTS triggers, out of order: some arrive one or two parts after their time.

    ``tick`` adds one event long after all others, so that the watermark passes them.
    """
    base = scratch_dir(spark, "replay")
    events = ad.table(spark, sf_dir, "events")
    second = F.unix_timestamp(F.col("ts").cast("timestamp"))
    low, high = events.agg(F.min(second), F.max(second)).first()
    n = F.col("event_id")
    wait = F.when(n % 50 == 7, 2).when(n % 10 == 3, 1).otherwise(0)
    part = F.least(F.floor((second - low) * PARTS / (high - low + 1)) + wait, F.lit(PARTS - 1))
    for i in range(PARTS):
        # A trigger takes the oldest files, so parts are written one after another.
        events.where(part == i).repartition(FILES).write.mode("append").parquet(base)
    if tick:
        last = events.where(F.col("event_type") == "view").orderBy(F.desc("ts"), "event_id").limit(1)
        later = last.withColumns({"ts": F.col("ts") + F.expr("INTERVAL 60 DAYS"), "event_id": F.lit(-1).cast("bigint"), "value": F.lit(0.0)})
        later.write.mode("append").parquet(base)
    return spark.readStream.schema(ad.EVENTS_DDL).option("maxFilesPerTrigger", FILES).parquet(base)


def _run(df: DataFrame, name: str, base: str, mode: str, *outputs: sinks.BatchSink) -> StreamingQuery:
    sink = sinks.fan_out(*(outputs or [sinks.append_table(f"{base}/table")]))
    return finish(sinks.stream_to_sinks(df, name, f"{base}/checkpoint", sink, mode))


def _table(spark: SparkSession, base: str) -> DataFrame:
    return sinks.read_committed(spark, f"{base}/table")


def failing_once(at: int) -> sinks.BatchSink:
    """A sink that breaks the first time it gets the trigger ``at``."""
    left = [at]

    def sink(batch: DataFrame, batch_id: int) -> None:
        if batch_id in left:
            left.remove(batch_id)
            raise RuntimeError("lost between two sinks")

    return sink


def _trip_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ad.event_stream(spark, sf_dir).select(*ad.trip_columns())


def delay_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Delay alerts of several triggers, one of which fails between its two sinks and is run again.

    The message count per alert is joined to its count in the table.
    """
    base = scratch_dir(spark, "delays")
    publish = sinks.publish(jobs.without_date(al.delay_messages), "json", f"{base}/topic")
    rows = jobs.delay_rows(replay(spark, sf_dir).select(*ad.trip_columns()))
    outputs = (publish, failing_once(2), sinks.append_table(f"{base}/table"), failing_once(3))
    for _ in range(2):
        try:
            _run(rows, "delay_alerts", base, "append", *outputs)
        except StreamingQueryException:
            continue
    _run(rows, "delay_alerts", base, "append", *outputs)
    stored = _table(spark, base).groupBy("event_id").agg(
        F.count(F.lit(1)).alias("table_rows"), F.min("severity").alias("severity")
    )
    topic = spark.read.schema("key string, value string").option("recursiveFileLookup", "true").json(f"{base}/topic")
    sent = topic.groupBy(F.get_json_object("value", "$.event_id").alias("event_id")).agg(
        F.count(F.lit(1)).alias("messages")
    )
    return stored.join(sent, "event_id", "full")


def headway_stream(spark: SparkSession, sf_dir: str, params: dict, mode: str = "update") -> DataFrame:
    """Windows over several triggers, revised by late updates until their end is passed; staging keeps the last
    revision. Repeats stay in: which one the watermarked de-duplication keeps depends on how rows fall into triggers."""
    base = scratch_dir(spark, "headways")
    trips = replay(spark, sf_dir, tick=mode == "append").select(*ad.trip_columns())
    rows = jobs.headway_rows(trips, LATENESS, dedup=False, mode=mode, **params)
    _run(rows, "headway_metrics", base, mode)
    return stg_headway_metrics(_table(spark, base))


def late_dedup_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trips of a day that pass the watermarked de-duplication; repeats come in later triggers, some too late."""
    base = scratch_dir(spark, "late-dedup")
    keys = ["trip_id", "route_id", "direction_id", "start_date"]
    trips = replay(spark, sf_dir).select(*ad.trip_columns())
    timed = trips.withColumn("event_ts", F.date_trunc("day", F.timestamp_seconds("timestamp"))).withWatermark("event_ts", LATENESS)
    rows = timed.dropDuplicatesWithinWatermark(keys).select(*keys, F.to_date("event_ts").alias("event_date"))
    _run(rows, "late_dedup", base, "append")
    return _table(spark, base).select(*keys)


def dedup_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys that pass the watermarked de-duplication."""
    base = scratch_dir(spark, "dedup")
    timed = _trip_stream(spark, sf_dir).withColumn("event_ts", F.timestamp_seconds("timestamp"))
    keys = ["trip_id", "route_id", "direction_id"]
    first = timed.withWatermark("event_ts", "10 minutes").dropDuplicatesWithinWatermark(keys)
    rows = first.select(*keys, F.to_date("event_ts").alias("event_date"))
    _run(rows, "dedup", base, "append")
    return _table(spark, base).select(*keys)


def stall_stream(spark: SparkSession, sf_dir: str, params: StallParams, delay: str) -> DataFrame:
    """Stall events of readings that come out of order over several triggers; a reading later than ``delay`` is lost."""
    base = scratch_dir(spark, "stalls")
    positions = replay(spark, sf_dir, tick=True).select(*ad.position_columns())
    rows = closed_readings(positions, params, delay, slice_s=86_400)
    sink = judged(f"{base}/runs", params, jobs.stall_rows, sinks.append_table(f"{base}/table"))
    finish(sinks.stream_to_sinks(rows, "vehicle_stalls", f"{base}/checkpoint", sink))
    return _table(spark, base).select(*contracts.STALL_EVENT.fieldNames())


def alert_stream(spark: SparkSession, messages: DataFrame, columns: list[str]) -> DataFrame:
    """The alert collector over a topic that holds every message twice, in different triggers."""
    base = scratch_dir(spark, "collector")
    for _ in range(2):
        messages.repartition(FILES).write.mode("append").parquet(f"{base}/topic")
    topic = spark.readStream.schema("key string, value string").option("maxFilesPerTrigger", FILES).parquet(f"{base}/topic")
    collect = jobs.collect_alerts(f"{base}/table", "parquet")
    finish(sinks.stream_to_sinks(al.normalize_alerts(topic), "alerts_consumer", f"{base}/checkpoint", collect))
    return spark.read.parquet(f"{base}/table").select(*columns)
