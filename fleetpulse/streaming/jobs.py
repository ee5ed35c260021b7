"""The live jobs: three bronze landings, three detections, one alert collector.

Every job is a plain DataFrame transform plus a transport and tables picked from the
settings, so tests run the same jobs on folders.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from fleetpulse import config, contracts
from fleetpulse.config import Settings
from fleetpulse.functions.timecols import epoch_date, epoch_ts
from fleetpulse.operators import alerts as al
from fleetpulse.operators.delay import detect_delays
from fleetpulse.operators.enrich import FEEDS, Feed, enrich
from fleetpulse.operators.stall import StallParams
from fleetpulse.sources.messages import decode, flatten, read_stream
from fleetpulse.streaming.headway_state import headway_windows_stream
from fleetpulse.streaming.sinks import BatchSink, append_table, fan_out, stream_to_sinks, stream_to_table
from fleetpulse.streaming.stall_state import closed_readings, judged
from fleetpulse.streaming.transport import KafkaTransport, Transport


def records(messages: DataFrame, contract: T.StructType, cfg: Settings, name: str) -> DataFrame:
    """Flat feed records out of raw messages."""
    return flatten(decode(messages, contract, cfg.payload_codec, cfg.header_bytes, name), contract)


def bronze_rows(messages: DataFrame, feed: Feed, cfg: Settings, now: Column | int | None = None) -> DataFrame:
    """Raw landing: no watermark, so late rows are never dropped."""
    return enrich(records(messages, feed.contract, cfg, feed.table), feed, now)


def delay_rows(updates: DataFrame, now: Column | None = None) -> DataFrame:
    """Stateless, so a watermark would change nothing and none is set."""
    return detect_delays(updates, now=now).withColumn("event_date", epoch_date(F.col("event_timestamp")))


def headway_rows(updates: DataFrame, watermark: str, dedup: bool = True, **params) -> DataFrame:
    """Windows of a stream of trip updates; late updates beyond the watermark are dropped.

    Repeats of a trip within the watermark count once. Which repeat is kept, and how long a
    repeat is recognised, depends on how rows fall into triggers.
    """
    timed = updates.withColumn("event_ts", epoch_ts(F.col("timestamp"))).withWatermark("event_ts", watermark)
    if dedup:
        timed = timed.dropDuplicatesWithinWatermark(["trip_id", "route_id", "direction_id"])
    return headway_windows_stream(timed, **params).withColumn("event_date", F.to_date("window_start"))


def stall_rows(events: DataFrame) -> DataFrame:
    """Detection time is stamped before the rows fan out, so messages carry it too."""
    return events.withColumn("detected_at", F.current_timestamp()).withColumn(
        "event_date", epoch_date(F.col("stall_detected_ts"))
    )


def without_date(to_messages: Callable[[DataFrame], DataFrame]) -> Callable[[DataFrame], DataFrame]:
    """Messages carry the contract's fields; the partition date is for the table only."""
    return lambda df: to_messages(df.drop("event_date"))


def _messages(spark: SparkSession, transport: Transport, topic: str, rows_per_trigger: int | None) -> DataFrame:
    return read_stream(spark, transport.source(topic, rows_per_trigger))


def _table(cfg: Settings, name: str) -> BatchSink:
    return append_table(cfg.table_path(name), cfg.output_format)


def _detection(rows: DataFrame, name: str, cfg: Settings, mode: str, *sinks: BatchSink) -> list[StreamingQuery]:
    return [stream_to_sinks(rows, name, cfg.checkpoint(name), fan_out(*sinks), mode, cfg.trigger_interval)]


def start_bronze(spark: SparkSession, cfg: Settings, transport: Transport | None = None) -> list[StreamingQuery]:
    transport = transport or KafkaTransport(cfg)
    queries = []
    for name, feed in FEEDS.items():
        rows = bronze_rows(_messages(spark, transport, name, cfg.bronze_rows_per_trigger), feed, cfg)
        queries.append(
            stream_to_table(
                rows, name, cfg.table_path(name), cfg.checkpoint(name), cfg.output_format, interval=cfg.trigger_interval
            )
        )
    return queries


def start_delays(spark: SparkSession, cfg: Settings, transport: Transport | None = None) -> list[StreamingQuery]:
    transport = transport or KafkaTransport(cfg)
    raw = _messages(spark, transport, config.TOPIC_TRIPS, cfg.trip_rows_per_trigger)
    rows = delay_rows(records(raw, contracts.TRIP_UPDATE, cfg, "trip_update"))
    return _detection(
        rows, "delay_alerts", cfg, "append",
        transport.sink(config.TOPIC_ALERTS, without_date(al.delay_messages)),
        _table(cfg, "delay_alerts"),
    )


def start_stalls(spark: SparkSession, cfg: Settings, transport: Transport | None = None,
                 params: StallParams = StallParams()) -> list[StreamingQuery]:
    transport = transport or KafkaTransport(cfg)
    params = replace(params, silence_s=cfg.stall_state_ttl_s)
    raw = _messages(spark, transport, config.TOPIC_POSITIONS, cfg.position_rows_per_trigger)
    positions = records(raw, contracts.VEHICLE_POSITION, cfg, "vehicle_position")
    rows = closed_readings(positions, params, cfg.stall_watermark, cfg.stall_slice_s)
    checkpoint = cfg.checkpoint("vehicle_stalls")
    sink = judged(
        f"{checkpoint}-runs", params, stall_rows,
        transport.sink(config.TOPIC_ALERTS, without_date(al.stall_messages)),
        _table(cfg, "stall_events"),
    )
    return [stream_to_sinks(rows, "vehicle_stalls", checkpoint, sink, "append", cfg.trigger_interval)]


def start_headways(spark: SparkSession, cfg: Settings, transport: Transport | None = None) -> list[StreamingQuery]:
    transport = transport or KafkaTransport(cfg)
    raw = _messages(spark, transport, config.TOPIC_TRIPS, cfg.trip_rows_per_trigger)
    rows = headway_rows(records(raw, contracts.TRIP_UPDATE, cfg, "trip_update"), cfg.headway_watermark)
    return _detection(
        rows, "headway_metrics", cfg, "update",
        transport.sink(config.TOPIC_HEADWAY, without_date(al.headway_messages)),
        _table(cfg, "headway_metrics"),
        transport.sink(config.TOPIC_ALERTS, al.bunching_messages),
    )


def collect_alerts(path: str, fmt: str) -> BatchSink:
    def sink(batch: DataFrame, batch_id: int) -> None:
        al.upsert_alerts(batch.sparkSession, batch, path, fmt, prune_by_date=True)

    return fan_out(sink)


def start_alerts(spark: SparkSession, cfg: Settings, transport: Transport | None = None) -> list[StreamingQuery]:
    transport = transport or KafkaTransport(cfg)
    rows = al.normalize_alerts(_messages(spark, transport, config.TOPIC_ALERTS, cfg.bronze_rows_per_trigger))
    sink = collect_alerts(cfg.table_path("alerts"), cfg.output_format)
    return [stream_to_sinks(rows, "alerts_consumer", cfg.checkpoint("alerts_consumer"), sink, "append", cfg.trigger_interval)]


def start_all(spark: SparkSession, cfg: Settings, transport: Transport | None = None) -> list[StreamingQuery]:
    """All seven queries on one session."""
    started: list[StreamingQuery] = []
    for job in (start_bronze, start_delays, start_stalls, start_headways, start_alerts):
        started += job(spark, cfg, transport)
    return started
