"""Vehicles that stay within a small circle for a while.

A vehicle's readings are judged in time order against an anchor, the first reading of the
current run. A run ends when the route or trip changes, when a reading is farther than the
radius from the anchor, or when a run of enough readings lasts too long; the reading that
ended it anchors the next run. Each further reading of a long-enough run is one event,
unless every reading of the run was reported as a scheduled stop.

Where the batch form cuts the work
----------------------------------
The anchor rule is sequential, yet some readings anchor a run whatever came before them: a
reading whose route or trip differs from its predecessor, and one more than two radii away
from its predecessor (the anchor is within one radius of the predecessor, so by the triangle
inequality it is more than one radius from this reading). The timeline of a vehicle can be
cut at these *certain starts*, so even a vehicle that holds a third of all rows is spread
over tasks by time. Between cuts, rows stream through a task in sorted order with a constant
amount of state; no group is ever held in memory.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetpulse.functions.geo import EARTH_RADIUS_M, SERVICE_AREA, Box, haversine_m, in_box
from fleetpulse.functions.keys import natural_key


@dataclass(frozen=True)
class StallParams:
    """Fixed default values of the detection."""

    min_readings: int = 3
    radius_m: float = 15.0
    min_span_s: int = 60
    max_span_s: int = 600
    area: Box = SERVICE_AREA
    stopped_status: str = "STOPPED_AT"
    # A vehicle silent for longer is forgotten: its next reading starts a run. None: never.
    silence_s: int | None = None


# Columns of one reading, in the order that also breaks ties between equal timestamps.
READING = ("ts", "route_id", "trip_id", "latitude", "longitude", "stopped")
# Raw findings; ids and timestamps are added on the JVM side.
FINDING = (
    "vehicle_id string, route_id string, trip_id string, latitude double, longitude double, "
    "reading_count int, stall_duration_s int, first_ts bigint, stall_detected_ts bigint"
)
FINDING_COLUMNS = [part.split()[0] for part in FINDING.split(", ")]
# What is known of a vehicle's run after its last judged reading. ``stretch`` orders the runs of one walk.
RUN = (
    "vehicle_id string, route_id string, trip_id string, latitude double, longitude double, "
    "readings int, since bigint, last bigint, moved boolean"
)
RUN_COLUMNS = [part.split()[0] for part in RUN.split(", ")]
_BEFORE_ALL = -(1 << 62)


class Run:
    """The run a vehicle is in: its anchor and start, how many readings it has, whether one of them moved, the last one."""

    __slots__ = ("route", "trip", "lat", "lon", "n", "since", "last", "moved")

    def __init__(self, route="", trip="", lat=0.0, lon=0.0, n=0, since=0, last=0, moved=False) -> None:
        self.route, self.trip, self.lat, self.lon = route, trip, lat, lon
        self.n, self.since, self.last, self.moved = n, since, last, moved

    def near(self, lat: float, lon: float, radius_m: float) -> bool:
        if lat == self.lat and lon == self.lon:
            return True
        a, b = math.radians(self.lat), math.radians(lat)
        h = math.sin((b - a) / 2) ** 2
        h += math.cos(a) * math.cos(b) * math.sin(math.radians(lon - self.lon) / 2) ** 2
        return 2 * EARTH_RADIUS_M * math.atan2(math.sqrt(h), math.sqrt(1 - h)) <= radius_m

    def goes_on(self, p: StallParams, ts: int, route: str, trip: str, lat: float, lon: float) -> bool:
        silent = p.silence_s is not None and ts - self.last > p.silence_s
        return self.n > 0 and not silent and (route, trip) == (self.route, self.trip) and self.near(lat, lon, p.radius_m)

    def advance(self, p: StallParams, ts: int, route: str, trip: str, lat: float, lon: float, stopped: bool):
        """Take one reading; returns the run's span in seconds if it is an event, else None."""
        if self.goes_on(p, ts, route, trip, lat, lon):
            self.n, self.last, self.moved = self.n + 1, ts, self.moved or not stopped
        else:
            self.__init__(route, trip, lat, lon, 1, ts, ts, not stopped)
        span = ts - self.since
        if self.n < p.min_readings or span < p.min_span_s:
            return None
        if span > p.max_span_s:
            self.__init__(route, trip, lat, lon, 1, ts, ts, not stopped)
            return None
        return span if self.moved else None


def readings(positions: DataFrame, params: StallParams) -> DataFrame:
    """The columns the detection needs, without readings outside the area or without a clock."""
    kept = positions.where(
        in_box(F.col("latitude"), F.col("longitude"), params.area) & F.col("timestamp").isNotNull()
    )
    return kept.select(
        # Required by contract; saying so to the planner keeps it from adding null filters per use.
        F.coalesce("vehicle_id", F.lit("")).alias("vehicle_id"),
        F.col("timestamp").cast("bigint").alias("ts"),
        F.coalesce("route_id", F.lit("")).alias("route_id"),
        F.coalesce("trip_id", F.lit("")).alias("trip_id"),
        "latitude",
        "longitude",
        F.coalesce(F.col("current_status") == params.stopped_status, F.lit(False)).alias("stopped"),
    )


def as_events(findings: DataFrame) -> DataFrame:
    """Findings with their id and start time, as the event contract has them."""
    return findings.select(
        natural_key(
            "stall", "vehicle_id", "route_id", "trip_id", "first_ts", "stall_detected_ts", "reading_count"
        ).alias("stall_id"),
        *("vehicle_id", "route_id", "trip_id", "latitude", "longitude", "reading_count", "stall_duration_s"),
        F.timestamp_seconds("first_ts").alias("first_seen"),
        "stall_detected_ts",
    )


def _certain_start(params: StallParams, previous: Window) -> Column:
    """True where a run starts whatever the state before; false for the first row of a slice."""

    def before(c: str) -> Column:
        return F.lag(c).over(previous)

    apart = haversine_m(before("latitude"), before("longitude"), F.col("latitude"), F.col("longitude"))
    # A centimetre on top keeps float error in the two distances from mattering.
    certain = (
        (before("route_id") != F.col("route_id"))
        | (before("trip_id") != F.col("trip_id"))
        | (apart > 2 * params.radius_m + 0.01)
    )
    if params.silence_s is not None:
        certain = certain | (F.col("ts") - before("ts") > params.silence_s)
    return F.coalesce(certain, F.lit(False))


def independent_stretches(rows: DataFrame, params: StallParams, slice_s: int, open_ends: bool = False) -> DataFrame:
    """Readings that can be part of a stall, with the ``stretch`` they belong to.

    Stretches of a vehicle do not influence each other. Timelines are cut into fixed time
    slices; a stretch begins at the first certain start of a slice and reaches to the first
    certain start of a later slice, so only a small summary per slice is needed to find it.
    Readings that cannot matter are dropped before the last shuffle: runs that are too short,
    and runs over slices in which the vehicle reports nothing but a scheduled stop, such as a
    parked vehicle. ``open_ends`` keeps all of what may go on from before or after these rows.
    """
    sliced = rows.withColumn("slice", F.floor(F.col("ts") / slice_s))
    in_slice = Window.partitionBy("vehicle_id", "slice")
    ordered = in_slice.orderBy(*READING)
    marked = sliced.select(
        "*",
        _certain_start(params, ordered).alias("starts"),
        F.row_number().over(ordered).alias("pos"),
    )
    # Further window steps on the same sort. The neighbours tell which starts stand alone.
    start_pos = F.when(F.col("starts"), F.col("pos"))
    marked = marked.select(
        "*",
        F.min(start_pos).over(in_slice).alias("first_start"),
        F.max(start_pos).over(in_slice).alias("last_start"),
        F.lag("starts").over(ordered).alias("prev_starts"),
        F.lead("starts", 1).over(ordered).alias("next_starts"),
        F.lead("starts", 2).over(ordered).alias("after_next_starts"),
    )
    head = F.col("first_start").isNull() | (F.col("pos") < F.col("first_start"))
    tail = F.coalesce(F.col("pos") >= F.col("last_start"), F.lit(False))
    slices = _slice_summary(marked, head, tail)
    # A left join leaves both uses of ``marked`` with the same plan below, so its shuffle is reused.
    placed = marked.join(slices, ["vehicle_id", "slice"], "left").withColumn(
        "stretch", F.when(head, F.coalesce(F.col("carried"), F.lit(_BEFORE_ALL))).otherwise(F.col("slice"))
    )
    moves = F.when(head, F.col("head_moves")).when(tail, F.col("tail_moves")).otherwise(True)
    matters = moves & ~_too_short(params)
    if open_ends:
        last = (F.col("stretch") == F.col("last_start_slice")) & (head | tail)
        matters = matters | (F.col("stretch") == _BEFORE_ALL) | last
    return placed.where(matters)


def _slice_summary(marked: DataFrame, head: Column, tail: Column) -> DataFrame:
    """Per slice: where its head belongs, and whether the runs at its two ends ever move.

    The run after a slice's last certain start goes on through the heads of the next slices, up
    to and including the next slice with a start. One row per vehicle and slice.
    """
    moving = ~F.col("stopped")
    slices = marked.groupBy("vehicle_id", "slice").agg(
        F.max("starts").alias("has_start"),
        F.max(head & moving).alias("own_head_moves"),
        F.max(tail & moving).alias("own_tail_moves"),
    )
    line = Window.partitionBy("vehicle_id").orderBy("slice")
    earlier = line.rowsBetween(Window.unboundedPreceding, -1)
    linked = slices.select(
        "*",
        F.max(F.when(F.col("has_start"), F.col("slice"))).over(earlier).alias("carried"),
        F.last(F.when(F.col("has_start"), F.col("own_tail_moves")), ignorenulls=True).over(earlier).alias("before_moves"),
    )
    # All heads that continue the same run.
    heads = linked.withColumn(
        "heads_move", F.max("own_head_moves").over(Window.partitionBy("vehicle_id", "carried"))
    )
    return heads.select(
        "vehicle_id",
        "slice",
        "carried",
        F.max(F.when(F.col("has_start"), F.col("slice"))).over(Window.partitionBy("vehicle_id")).alias("last_start_slice"),
        (F.col("heads_move") | F.coalesce(F.col("before_moves"), F.lit(False))).alias("head_moves"),
        (F.col("own_tail_moves") | F.lead("heads_move", 1, False).over(line)).alias("tail_moves"),
    )


def _too_short(params: StallParams) -> Column:
    """Rows in runs of one or two readings between certain starts, where more are needed.

    Null at the rim of a slice, where the neighbour is unknown: such rows are kept.
    """
    if params.min_readings < 2:
        return F.lit(False)
    starts, after = F.col("starts"), F.col("next_starts")
    short = starts & after
    if params.min_readings > 2:
        short = short | (starts & F.col("after_next_starts")) | (F.col("prev_starts") & after)
    return F.coalesce(short, F.lit(False))


def _walk(rows: DataFrame, params: StallParams, slice_s: int, before: DataFrame | None) -> DataFrame:
    """Findings, and with ``before`` also the run at the end of each stretch (those have ``stretch`` set).

    ``before`` holds the runs (RUN) that the vehicles were in; each leads in its vehicle's first stretch.
    """
    steps = independent_stretches(rows, params, slice_s, before is not None).select(
        "vehicle_id", "stretch", "slice", "pos", "starts", *READING, F.lit(0).alias("readings"), F.lit(0).cast("bigint").alias("last")
    )
    if before is not None:
        steps = steps.unionByName(before.select(
            "vehicle_id", F.lit(_BEFORE_ALL).alias("stretch"), F.lit(None).cast("bigint").alias("slice"), F.lit(0).alias("pos"),
            F.lit(False).alias("starts"), F.col("since").alias("ts"), *READING[1:5], (~F.col("moved")).alias("stopped"), "readings", "last"
        ))
    lined_up = steps.repartition("vehicle_id", "stretch").sortWithinPartitions("vehicle_id", "stretch", "slice", "pos")
    wire = lined_up.select("vehicle_id", "stretch", "starts", *READING, "readings", "last")
    with_ends = before is not None
    columns = [*FINDING_COLUMNS, "stretch", "moved"]

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        current, run = None, Run()

        def end() -> list[tuple]:
            if not with_ends or current is None:
                return []
            return [(current[0], run.route, run.trip, run.lat, run.lon, run.n, 0, run.since, run.last, current[1], run.moved)]

        for batch in batches:
            found = []
            values = [batch[c].tolist() for c in ("vehicle_id", "stretch", "starts", *READING, "readings", "last")]
            for vehicle, stretch, starts, ts, route, trip, lat, lon, stopped, known, last in zip(*values):
                # The flag matters: what lay between this start and the row before may be dropped.
                if (vehicle, stretch) != current:
                    found += end()
                    current, run = (vehicle, stretch), Run()
                elif starts:
                    run = Run()
                if known:
                    run = Run(route, trip, lat, lon, known, ts, last, not stopped)
                    continue
                span = run.advance(params, ts, route, trip, lat, lon, stopped)
                if span is not None:
                    found.append((vehicle, route, trip, run.lat, run.lon, run.n, span, run.since, ts, None, None))
            if found:
                yield pd.DataFrame(found, columns=columns).astype({"stretch": "Int64", "moved": "boolean"})
        if end():
            yield pd.DataFrame(end(), columns=columns).astype({"stretch": "Int64", "moved": "boolean"})

    return wire.mapInPandas(scan, f"{FINDING}, stretch bigint, moved boolean")


def stall_events(
    positions: DataFrame, params: StallParams = StallParams(), slice_s: int = 3600
) -> DataFrame:
    """Stall events of stored positions, in event-time order per vehicle.

    ``slice_s`` only steers how finely a vehicle's timeline is spread; results do not depend on it.
    """
    return as_events(_walk(readings(positions, params), params, slice_s, None))


def stall_step(rows: DataFrame, before: DataFrame, params: StallParams, slice_s: int = 3600) -> DataFrame:
    """Findings of the readings that follow the runs in ``before``, and the runs after them, in one frame to be stored.

    ``found`` and ``after`` take it apart. No reading may be older than one judged before.
    """
    return _walk(rows, params, slice_s, before)


def found(step: DataFrame) -> DataFrame:
    return as_events(step.where("stretch IS NULL"))


def after(step: DataFrame, before: DataFrame, params: StallParams, now: Column | int) -> DataFrame:
    """The runs (RUN) of all vehicles up to ``now``; those that would be forgotten anyway are left out."""
    ends = step.where("stretch IS NOT NULL").groupBy("vehicle_id").agg(F.max_by(F.struct(
        "route_id", "trip_id", "latitude", "longitude", F.col("reading_count").alias("readings"), F.col("first_ts").alias("since"),
        F.col("stall_detected_ts").alias("last"), "moved"), "stretch").alias("run"))
    fresh = ends.select("vehicle_id", "run.*").select(*RUN_COLUMNS)
    silent = before.join(fresh.select("vehicle_id"), "vehicle_id", "left_anti").select(*RUN_COLUMNS)
    runs = fresh.unionByName(silent)
    return runs if params.silence_s is None else runs.where(F.lit(now) - F.col("last") <= params.silence_s)
