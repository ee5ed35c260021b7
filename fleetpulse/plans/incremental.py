"""Loading marts: append past the high-water mark, replace from it on, or rebuild."""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetpulse.sources.tables import per_folder, read_if_present


@dataclass(frozen=True)
class Mart:
    """A stored table partitioned by its date: a folder, or a catalog table when named.

    ``namespace`` routes a model to its schema.
    """

    path: str = ""
    name: str = ""
    namespace: str = ""
    fmt: str = "parquet"
    date_col: str = "event_date"

    @property
    def identifier(self) -> str:
        return f"{self.namespace}.{self.name}" if self.namespace else self.name

    def read(self, spark: SparkSession) -> DataFrame | None:
        if self.path:
            return read_if_present(spark, self.path, self.fmt)
        try:
            return spark.table(self.identifier)
        except AnalysisException as err:
            if err.getCondition() == "TABLE_OR_VIEW_NOT_FOUND":
                return None
            raise

    def write(self, df: DataFrame, mode: str, **options: str) -> None:
        if not self.path and mode == "overwrite" and options and df.sparkSession.catalog.tableExists(self.identifier):
            # Dynamic partition overwrite of a catalog table goes through insertInto, which is positional.
            columns = df.sparkSession.table(self.identifier).columns
            per_folder(df.select(*columns), self.date_col).write.mode("overwrite").options(**options).insertInto(self.identifier)
            return
        writer = per_folder(df, self.date_col).write.format(self.fmt).mode(mode).options(**options).partitionBy(self.date_col)
        if self.path:
            writer.save(self.path)
        else:
            writer.saveAsTable(self.identifier)


def stored_dates(spark: SparkSession, mart: Mart) -> set[dt.date]:
    """The dates a mart has folders for, from the listing."""
    stored = mart.read(spark)
    if stored is None:
        return set()
    if mart.fmt == "delta":
        return {row[0] for row in stored.select(mart.date_col).distinct().collect() if row[0]}
    if mart.path:
        folders = stored.inputFiles()
    else:
        folders = [row[0] + "/" for row in spark.sql(f"SHOW PARTITIONS {mart.identifier}").collect()]
    named = (re.search(rf"(?:^|/){re.escape(mart.date_col)}=(\d+-\d\d-\d\d)/", f) for f in folders)
    return {dt.date.fromisoformat(m.group(1)) for m in named if m}


def high_water_mark(spark: SparkSession, mart: Mart) -> dt.date | None:
    """Latest date a mart holds; None for a missing or empty one.

    Folders are asked for a row from the latest on, so as a rule one is opened.
    """
    for date in sorted(stored_dates(spark, mart), reverse=True):
        if not mart.read(spark).where(F.col(mart.date_col) == F.lit(date)).isEmpty():
            return date
    return None


def prune_bronze(bronze: DataFrame, since: dt.date | None, partition_col: str = "event_date") -> DataFrame:
    """Bronze partitions that can hold local dates on or after ``since``.

    Bronze is partitioned by UTC date and marts by local date, at most one day apart, so the
    literal bound is a day wider and prunes folders without touching a row that counts.
    """
    if since is None:
        return bronze
    return bronze.where(F.col(partition_col) >= F.lit(since - dt.timedelta(days=1)))


def incremental_append(spark: SparkSession, facts: DataFrame, mart: Mart) -> None:
    """Append the dates after the high-water mark. A day once loaded is never completed."""
    mark = high_water_mark(spark, mart)
    fresh = facts if mark is None else facts.where(F.col(mart.date_col) > F.lit(mark))
    mart.write(fresh, "append")


def incremental_replace(spark: SparkSession, facts: DataFrame, mart: Mart, lookback_days: int = 0) -> None:
    """Recompute the dates from the high-water mark on, and swap in just those partitions.

    ``lookback_days`` widens the recomputed range for rows that arrive days late, and for facts dated by a start
    that lies before their arrival: a stall by its longest span, a window by its length.
    """
    mark = high_water_mark(spark, mart)
    if mark is not None:
        facts = facts.where(F.col(mart.date_col) >= F.lit(mark - dt.timedelta(days=lookback_days)))
    mart.write(facts, "overwrite", partitionOverwriteMode="dynamic")


def refresh(
    spark: SparkSession,
    bronze: DataFrame,
    build: Callable[[DataFrame], DataFrame],
    mart: Mart,
    replace: bool = True,
    lookback_days: int = 0,
    partition_col: str = "event_date",
) -> None:
    """Bring a mart up to date from bronze, reading only the bronze folders that can matter.

    ``build`` turns bronze into the mart's rows. Copies of an event share its event time and
    so its folder, hence de-duplication sees all of them.
    """
    mark = high_water_mark(spark, mart)
    since = None if mark is None else mark - dt.timedelta(days=lookback_days)
    facts = build(prune_bronze(bronze, since, partition_col))
    if replace:
        incremental_replace(spark, facts, mart, lookback_days)
    else:
        incremental_append(spark, facts, mart)


def full_refresh(facts: DataFrame, mart: Mart) -> None:
    mart.write(facts, "overwrite", partitionOverwriteMode="static")


def save_table(df: DataFrame, path: str = "", name: str = "", fmt: str = "parquet") -> None:
    """Materialise an unpartitioned model, such as a dimension."""
    writer = df.write.format(fmt).mode("overwrite")
    writer.save(path) if path else writer.saveAsTable(name)


def save_view(df: DataFrame, name: str) -> None:
    df.createOrReplaceTempView(name)


def snapshot(spark: SparkSession, source: str, target: str, fmt: str = "parquet") -> int:
    """Copy a table folder as it is now and report its rows."""
    spark.read.format(fmt).load(source).write.format(fmt).mode("overwrite").save(target)
    return spark.read.format(fmt).load(target).count()
