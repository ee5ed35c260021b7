"""Headway regularity per route and direction in sliding event-time windows.

All statistics follow from four mergeable numbers of a window: how many departures, the
earliest, the latest, and the sum of squared gaps between neighbours. Gaps add up to
latest - earliest, and equal departures only add zero gaps, so it is enough to look at the
distinct departure seconds of a window.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetpulse.functions.timecols import clock_seconds, interval_seconds

# Fixed values.
WINDOW = "10 minutes"
SLIDE = "2 minutes"
BUNCHING_CV = 0.5
MIN_TRIPS = 3


def scheduled_plus_delay() -> Column:
    """Departure second of a trip update: scheduled start plus reported delay."""
    return clock_seconds(F.col("start_time")) + F.coalesce(F.col("delay"), F.lit(0))


def departures(updates: DataFrame, departure: Column | None) -> DataFrame:
    usable = updates.where((F.col("route_id") != "") & F.col("start_time").isNotNull())
    second = scheduled_plus_delay() if departure is None else departure
    return usable.select("event_ts", "route_id", "direction_id", second.cast("bigint").alias("departure"))


def metrics(stats: DataFrame, cv_threshold: float, min_trips: int) -> DataFrame:
    """Mean, population deviation and variation from trip_count, first, last and gap_squares."""
    gaps = F.col("trip_count") - 1
    span = F.col("last") - F.col("first")
    # n * sum(gap^2) - (sum gap)^2 in whole numbers: exactly zero for even headways.
    whole = "decimal(19,0)"
    spread = F.sqrt(
        (gaps.cast(whole) * F.col("gap_squares").cast(whole) - span.cast(whole) * span.cast(whole)).cast("double")
    )
    measured = stats.select(
        "*",
        F.when(gaps > 0, span / gaps).alias("headway_mean_s"),
        F.when(gaps > 0, spread / gaps).alias("headway_stddev_s"),
        F.when((F.col("trip_count") >= min_trips) & (span > 0), spread / span).alias("headway_cv"),
    )
    return measured.select(
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        "route_id",
        "direction_id",
        "trip_count",
        "headway_mean_s",
        "headway_stddev_s",
        "headway_cv",
        F.coalesce(F.col("headway_cv") > cv_threshold, F.lit(False)).alias("is_bunching"),
    )


def headway_windows(
    updates: DataFrame,
    window: str = WINDOW,
    slide: str = SLIDE,
    cv_threshold: float = BUNCHING_CV,
    min_trips: int = MIN_TRIPS,
    departure: Column | None = None,
) -> DataFrame:
    """One aggregation that holds the set of distinct departure seconds of each window.

    For small inputs; stored tables take ``headway_lag_form`` and streams ``headway_windows_stream``.
    """
    grouped = (
        departures(updates, departure)
        .groupBy(F.window("event_ts", window, slide).alias("window"), "route_id", "direction_id")
        .agg(
            F.count("departure").alias("trip_count"),
            F.array_sort(F.collect_set("departure")).alias("seconds"),
        )
    )
    zero = F.lit(0).cast("bigint")

    def add_gap(acc: Column, second: Column) -> Column:
        gap = F.coalesce(second - acc["previous"], zero)
        return F.struct(second.alias("previous"), (acc["squares"] + gap * gap).alias("squares"))

    start = F.struct(F.lit(None).cast("bigint").alias("previous"), zero.alias("squares"))
    stats = grouped.select(
        "window",
        "route_id",
        "direction_id",
        "trip_count",
        F.array_min("seconds").alias("first"),
        F.array_max("seconds").alias("last"),
        F.aggregate("seconds", start, add_gap, lambda acc: acc["squares"]).alias("gap_squares"),
    )
    return metrics(stats, cv_threshold, min_trips)


def headway_lag_form(
    updates: DataFrame,
    window: str = WINDOW,
    slide: str = SLIDE,
    cv_threshold: float = BUNCHING_CV,
    min_trips: int = MIN_TRIPS,
    departure: Column | None = None,
) -> DataFrame:
    """Batch form: departures are counted per second and pane before they meet their windows.

    A pane is one slide long. Where the window is a whole number of slides, all rows of a pane
    lie in the same windows, so rows are counted once per pane and only the counts are copied to
    the overlapping windows. A route with a huge share of the rows thus reaches the window step
    as a few rows per distinct departure second, whatever its number of updates. A second that
    occurs in several panes of a window just adds gaps of zero.
    """
    rows = departures(updates, departure)
    if interval_seconds(window) % interval_seconds(slide) == 0:
        pane = F.window("event_ts", slide)["start"]
    else:
        pane = F.col("event_ts")
    per_pane = rows.groupBy(pane.alias("pane"), "route_id", "direction_id", "departure").agg(
        F.count(F.lit(1)).alias("trips")
    )
    per_second = per_pane.select(
        F.window("pane", window, slide).alias("window"), "route_id", "direction_id", "departure", "trips"
    )
    line = Window.partitionBy("window", "route_id", "direction_id")
    gap = F.col("departure") - F.lag("departure").over(line.orderBy("departure"))
    stats = (
        per_second.withColumn("gap", gap)
        .groupBy("window", "route_id", "direction_id")
        .agg(
            F.coalesce(F.sum(F.when(F.col("departure").isNotNull(), F.col("trips"))), F.lit(0)).alias("trip_count"),
            F.min("departure").alias("first"),
            F.max("departure").alias("last"),
            F.coalesce(F.sum(F.col("gap") * F.col("gap")), F.lit(0)).alias("gap_squares"),
        )
    )
    return metrics(stats, cv_threshold, min_trips)
