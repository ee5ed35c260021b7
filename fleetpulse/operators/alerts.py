"""One alert table out of three kinds of detection messages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetpulse.functions.keys import natural_key
from fleetpulse.functions.timecols import flexible_ts
from fleetpulse.operators.dedup import keep_first
from fleetpulse.sources.messages import payload_text, to_messages
from fleetpulse.sources.tables import per_folder, read_if_present

# Fields by which a message shows what it is, and the alert type names.
_TEXT_FIELDS = (
    "event_id", "stall_id", "route_id", "vehicle_id", "trip_id", "direction_id",
    "detected_at", "event_timestamp", "stall_detected_ts", "window_start",
)
# Every field as text: a JSON number reads as its digits, so one parse serves all shapes.
_ANY_ALERT = T.StructType([T.StructField(f, T.StringType()) for f in _TEXT_FIELDS])


def delay_messages(alerts: DataFrame) -> DataFrame:
    return to_messages(alerts, F.col("trip_id"))


def stall_messages(events: DataFrame) -> DataFrame:
    return to_messages(events, F.col("vehicle_id"))


def headway_messages(metrics: DataFrame) -> DataFrame:
    return to_messages(metrics, F.concat("route_id", F.lit(":"), F.col("direction_id").cast("string")))


def bunching_messages(metrics: DataFrame, now: Column | None = None) -> DataFrame:
    """Alert messages for the windows that bunch, and only those."""
    body = metrics.where("is_bunching").select(
        F.lit("bunching_alert").alias("alert_type"),
        *("route_id", "direction_id", "headway_cv", "trip_count", "window_start", "window_end"),
        (F.current_timestamp() if now is None else now).alias("detected_at"),
    )
    return to_messages(body, F.col("route_id"))


def union_messages(first: DataFrame, *others: DataFrame) -> DataFrame:
    """Fan-in of message sets into one topic's worth of messages."""
    for other in others:
        first = first.unionByName(other, allowMissingColumns=True)
    return first


def normalize_alerts(messages: DataFrame, now: Column | None = None) -> DataFrame:
    """Messages of any shape to alert rows; what fits no shape becomes UNKNOWN, never lost."""
    parsed = messages.select(payload_text().alias("payload")).select(
        "payload", F.from_json("payload", _ANY_ALERT).alias("m")
    )
    # Which key is present decides; the first match of the three wins.
    kind = (
        F.when(F.col("m.event_id").isNotNull(), "DELAY")
        .when(F.col("m.stall_id").isNotNull(), "STALL")
        .when(F.col("m.window_start").isNotNull(), "BUNCHING")
        .otherwise("UNKNOWN")
    )
    typed = parsed.select("payload", "m.*", kind.alias("alert_type"))

    def by_kind(delay: Column, stall: Column, bunching: Column, unknown: Column) -> Column:
        k = F.col("alert_type")
        return F.when(k == "DELAY", delay).when(k == "STALL", stall).when(k == "BUNCHING", bunching).otherwise(unknown)

    return typed.select(
        by_kind(
            F.col("event_id"),
            F.col("stall_id"),
            natural_key("bunching", "route_id", "direction_id", "window_start"),
            natural_key("unknown", "payload"),
        ).alias("alert_id"),
        "alert_type",
        "route_id",
        "vehicle_id",
        "trip_id",
        by_kind(
            flexible_ts(F.col("event_timestamp")),
            flexible_ts(F.col("stall_detected_ts")),
            flexible_ts(F.col("window_start")),
            F.lit(None).cast("timestamp"),
        ).alias("event_ts"),
        flexible_ts(F.col("detected_at")).alias("detected_at"),
        "payload",
        (F.current_timestamp() if now is None else now).alias("ingested_at"),
    ).withColumn("event_date", F.to_date("event_ts"))


def first_of_each(alerts: DataFrame) -> DataFrame:
    """One row per alert id; the earliest detection is kept."""
    return keep_first(alerts, ["alert_id"], [F.col("detected_at").asc_nulls_last(), F.col("payload")])


def of_dates(target: DataFrame, batch: DataFrame) -> DataFrame:
    """The target's rows of the dates that the batch has, each date by itself, and those without a date.

    Only dates are broadcast: 3.6 million at most, as many days as there are to write. The scan skips all other
    folders at run time, so one far-off clock adds one folder and not all between.
    """
    dates = batch.where(F.col("event_date") >= F.lit("0001-01-01").cast("date")).select("event_date").distinct()
    dated = target.join(F.broadcast(dates), "event_date", "left_semi")
    return dated.unionByName(target.where(F.col("event_date").isNull()))


def unseen(batch: DataFrame, target: DataFrame | None, prune_by_date: bool = False) -> DataFrame:
    """Rows of a deduplicated batch whose id the target does not hold yet.

    The target is read for its ids only and reduced to those of the batch before it meets the
    batch, so the table itself is not shuffled while the batch is small enough to broadcast.
    ``prune_by_date`` also skips the target's partitions other than the batch's dates; use it
    when an id fixes its date, as the ids made here do.
    """
    if target is None:
        return batch
    ids = target.select("event_date", "alert_id") if prune_by_date else target.select("alert_id")
    if prune_by_date:
        ids = of_dates(ids, batch).select("alert_id")
    known = ids.join(batch.select("alert_id"), "alert_id", "left_semi").distinct()
    return batch.join(known, "alert_id", "left_anti")


def upsert_alerts(
    spark: SparkSession, batch: DataFrame, path: str, fmt: str = "parquet", prune_by_date: bool = False
) -> None:
    """Insert the alerts a table does not hold yet. Running it twice changes nothing.

    Delta tables use MERGE; other formats anti-join and append, which assumes one writer.
    """
    fresh = first_of_each(batch).persist()
    try:
        if fmt == "delta":
            from delta.tables import DeltaTable

            if DeltaTable.isDeltaTable(spark, path):
                match = "t.alert_id = s.alert_id"
                if prune_by_date:
                    match += " AND t.event_date <=> s.event_date"
                merge = DeltaTable.forPath(spark, path).alias("t").merge(fresh.alias("s"), match)
                merge.whenNotMatchedInsertAll().execute()
                return
            rows = fresh
        else:
            rows = unseen(fresh, read_if_present(spark, path, fmt), prune_by_date)
        per_folder(rows, "event_date").write.format(fmt).mode("append").partitionBy("event_date").save(path)
    finally:
        fresh.unpersist()
