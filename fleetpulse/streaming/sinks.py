"""Stream outputs: partitioned tables, messages, and several of them per trigger."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from fleetpulse.sources.tables import per_folder

BatchSink = Callable[[DataFrame, int], None]


def start(writer: DataStreamWriter, name: str, checkpoint: str, interval: str | None) -> StreamingQuery:
    """Start a named query; without an interval it works off what is there and stops."""
    writer = writer.queryName(name).option("checkpointLocation", checkpoint)
    writer = writer.trigger(processingTime=interval) if interval else writer.trigger(availableNow=True)
    return writer.start()


def stream_to_table(
    df: DataFrame, name: str, path: str, checkpoint: str, fmt: str = "parquet",
    partitions: Sequence[str] = ("event_date", "event_hour"), interval: str | None = None,
) -> StreamingQuery:
    """Append a stream to a partitioned table."""
    writer = df.writeStream.format(fmt).outputMode("append").option("path", path).partitionBy(*partitions)
    return start(writer, name, checkpoint, interval)


def stream_to_console(df: DataFrame, name: str, checkpoint: str, interval: str | None = None,
                      fmt: str = "console") -> StreamingQuery:
    """Show a stream: ``console`` prints, ``memory`` keeps a small in-session table for looking at."""
    writer = df.writeStream.format(fmt).outputMode("append").option("truncate", "false")
    return start(writer, name, checkpoint, interval)


def run_id(spark: SparkSession) -> str:
    """Name of the checkpoint the current trigger belongs to; a new checkpoint counts its triggers from 0 again."""
    query = spark.sparkContext.getLocalProperty("sql.streaming.queryId") or ""
    return f"q{query.replace('-', '')[:12] or 0}"


def trigger_folder(path: str, run: str, batch_id: int) -> str:
    return f"{path.rstrip('/')}/run_id={run}/batch_id={batch_id}"


def commit(spark: SparkSession, path: str, run: str, batch_id: int) -> None:
    """Note that a trigger's folder is complete; the note is written after the folder."""
    note = spark.range(1).select(F.lit(run).alias("run_id"), F.lit(batch_id).cast("bigint").alias("batch_id"))
    note.coalesce(1).write.mode("overwrite").json(f"{path.rstrip('/')}/_committed/{run}-{batch_id}")


def forget(spark: SparkSession, path: str, run: str, batch_id: int) -> None:
    """Take away a trigger's note and folder, in this order."""
    context = spark.sparkContext
    for folder in (f"{path.rstrip('/')}/_committed/{run}-{batch_id}", trigger_folder(path, run, batch_id)):
        target = context._jvm.org.apache.hadoop.fs.Path(folder)
        target.getFileSystem(context._jsc.hadoopConfiguration()).delete(target, True)


def committed(spark: SparkSession, path: str) -> DataFrame | None:
    """``(run_id, batch_id)`` of the triggers written in full, or None before the first."""
    reader = spark.read.schema("run_id string, batch_id bigint").option("recursiveFileLookup", "true")
    try:
        return reader.json(f"{path.rstrip('/')}/_committed")
    except AnalysisException as err:
        if err.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def read_committed(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame | None:
    """A table's rows from complete triggers only, with their ``run_id`` and ``batch_id``; None before the first."""
    done = committed(spark, path)
    if done is None:
        return None
    rows = spark.read.format(fmt).load(path).withColumn("batch_id", F.col("batch_id").cast("bigint"))
    return rows.join(F.broadcast(done), ["run_id", "batch_id"], "left_semi")


def append_table(path: str, fmt: str = "parquet", partitions: Sequence[str] = ("event_date",)) -> BatchSink:
    """Add each trigger's rows once, however often the trigger is run.

    A trigger owns one folder, named after its checkpoint and number, which a second try replaces as a whole; then
    a note says that it is complete (``read_committed`` honours it). Delta tables skip a trigger they have already.
    """

    def sink(batch: DataFrame, batch_id: int) -> None:
        run = run_id(batch.sparkSession)
        rows = per_folder(batch.withColumn("written_at", F.current_timestamp()), *partitions)
        if fmt == "delta":
            marked = rows.withColumn("run_id", F.lit(run)).withColumn("batch_id", F.lit(batch_id).cast("bigint"))
            writer = marked.write.format(fmt).mode("append").option("txnAppId", f"{run}:{path}").option("txnVersion", batch_id)
            writer.partitionBy(*partitions).save(path)
            return
        rows.write.format(fmt).mode("overwrite").partitionBy(*partitions).save(trigger_folder(path, run, batch_id))
        commit(batch.sparkSession, path, run, batch_id)

    return sink


def publish(
    to_messages: Callable[[DataFrame], DataFrame], fmt: str = "kafka", path: str = "", **options: str
) -> BatchSink:
    """Write each trigger's rows as messages: to a topic, or as files of the same shape.

    Files lie in a folder of the trigger, which a second try replaces. A broker takes messages again; their
    keys and ids are the same both times, which is what consumers deduplicate on.
    """

    def sink(batch: DataFrame, batch_id: int) -> None:
        writer = to_messages(batch).write.format(fmt).options(**options)
        if fmt == "kafka":
            writer.save()
        else:
            writer.mode("overwrite").save(f"{path.rstrip('/')}/{run_id(batch.sparkSession)}-{batch_id}")

    return sink


def fan_out(*sinks: BatchSink) -> BatchSink:
    """Run several sinks on one trigger's rows, which are computed once; an empty trigger writes nothing.

    The sinks are separate writes: after a failure the trigger is run again, with the same rows and number, and
    each sink replaces what it wrote at the first try.
    """

    def sink(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            if not batch.isEmpty():
                for each in sinks:
                    each(batch, batch_id)
        finally:
            batch.unpersist()

    return sink


def stream_to_sinks(
    df: DataFrame, name: str, checkpoint: str, sink: BatchSink, mode: str = "append", interval: str | None = None
) -> StreamingQuery:
    return start(df.writeStream.foreachBatch(sink).outputMode(mode), name, checkpoint, interval)
