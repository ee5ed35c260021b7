"""Stall detection on a stream: readings wait in keyed state until their time is over, then are judged in order.

The state store holds readings by slice of event time, in lists under (slice, bucket); the bucket is a hash of the
reading, so a vehicle that sends a third of all rows fills as many lists as any others. An event-time timer at the end
of a slice, with the watermark, empties its lists into the trigger. What a trigger gets is thus complete up to the end
of a slice, and Spark sorts, cuts and walks it like stored positions (``operators.stall``); the runs that vehicles are
in at that moment are the only thing carried on, one row a vehicle, in a table with one folder a trigger.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import islice

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from fleetpulse.functions.timecols import epoch_ts
from fleetpulse.operators.stall import READING, RUN, StallParams, after, found, readings, stall_step
from fleetpulse.streaming.sinks import BatchSink, commit, committed, fan_out, forget, run_id, trigger_folder

WAITING = "vehicle_id string, ts bigint, route_id string, trip_id string, latitude double, longitude double, stopped boolean"
WAITING_COLUMNS = ["vehicle_id", *READING]
WAITING_ROW = Row(*WAITING_COLUMNS)
#: Lists of one slice, and readings that are added to a list at once.
BUCKETS, PORTION = 16, 1 << 12


class Waiting(StatefulProcessor):
    """Keeps a slice's readings until the watermark has passed its end. Readings of a slice that is over are dropped."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.list = handle.getListState("waiting", WAITING)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        end_ms = int(key[0]) * 1000
        if timerValues.getCurrentWatermarkInMs() < end_ms:
            if not self.list.exists():
                self.handle.registerTimer(end_ms)
            while part := [tuple(row[c] for c in WAITING_COLUMNS) for row in islice(rows, PORTION)]:
                self.list.appendList(part)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        for row in self.list.get():
            yield WAITING_ROW(*row)
        self.list.clear()

    def close(self) -> None:
        pass


def closed_readings(
    positions: DataFrame, params: StallParams = StallParams(), delay: str = "1 minute", slice_s: int = 60
) -> DataFrame:
    """Readings of a position stream, each given out once no earlier one can come (append mode).

    A reading may be late by ``delay`` and the rest of its slice; later ones are dropped.
    """
    timed = readings(positions, params).withColumn("event_ts", epoch_ts(F.col("ts"))).withWatermark("event_ts", delay)
    # Without the column that carries the watermark: what is late is decided by slice, not by row.
    plain = timed.select(
        ((F.floor(F.col("ts") / slice_s) + 1) * slice_s).alias("slice_end"),
        F.pmod(F.xxhash64("vehicle_id", "ts", "latitude", "longitude"), F.lit(BUCKETS)).cast("int").alias("bucket"),
        *WAITING_COLUMNS,
    )
    return plain.groupBy("slice_end", "bucket").transformWithState(
        statefulProcessor=Waiting(), outputStructType=WAITING, outputMode="Append", timeMode="EventTime"
    )


def triggers_before(spark: SparkSession, path: str, run: str, batch_id: int) -> list[int]:
    """Numbers of the complete triggers before this one, the last one first. Only the last two are kept."""
    done = committed(spark, path)
    if done is None:
        return []
    earlier = done.where((F.col("run_id") == run) & (F.col("batch_id") < batch_id)).distinct()
    return [row["batch_id"] for row in earlier.orderBy(F.desc("batch_id")).limit(3).collect()]


def runs_after(spark: SparkSession, path: str, run: str, batch_id: int | None) -> DataFrame:
    if batch_id is None:
        return spark.createDataFrame([], RUN)
    return spark.read.schema(RUN).parquet(trigger_folder(path, run, batch_id))


def judged(
    state_path: str, params: StallParams, to_events: Callable[[DataFrame], DataFrame], *sinks: BatchSink, slice_s: int = 3600
) -> BatchSink:
    """A sink that turns closed readings into stall events and hands those on.

    The runs are stored under the trigger's own number after the sinks are done, so a trigger that is run
    again starts from the same runs and its sinks replace what they wrote.
    """
    out = fan_out(*sinks)

    def sink(batch: DataFrame, batch_id: int) -> None:
        spark, run = batch.sparkSession, run_id(batch.sparkSession)
        # The state is read for these rows, so they are taken once.
        batch = batch.persist()
        try:
            now = batch.agg(F.max("ts")).first()[0]
            if now is not None:
                _judge(spark, run, batch, batch_id, now)
        finally:
            batch.unpersist()

    def _judge(spark: SparkSession, run: str, batch: DataFrame, batch_id: int, now: int) -> None:
        earlier = triggers_before(spark, state_path, run, batch_id)
        before = runs_after(spark, state_path, run, earlier[0] if earlier else None)
        step = stall_step(batch, before, params, slice_s).persist()
        try:
            out(to_events(found(step)), batch_id)
            after(step, before, params, now).write.mode("overwrite").parquet(trigger_folder(state_path, run, batch_id))
            commit(spark, state_path, run, batch_id)
            for old in earlier[1:]:
                forget(spark, state_path, run, old)
        finally:
            step.unpersist()

    return sink
