"""Headway windows of a stream on keyed map state.

A window's departure seconds lie in the state store as bits of words of WORD seconds, one map entry a word, next to its
four mergeable numbers (departures, first, last, squares of gaps). A second that comes up for the first time splits one
gap in two: its neighbours are found in its own word or, over a bit for each word in use, in the next one. A trigger thus
reads and writes the words of the seconds that changed, whatever the window holds.

Before the shuffle each task counts its rows by pane, route, direction and second, so a route with a third of all rows
reaches its windows as few rows a second.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from fleetpulse.functions.timecols import interval_seconds
from fleetpulse.operators import headway
from fleetpulse.operators.headway import departures, metrics

#: Seconds of a word, and what is added to a second so that none is negative (departures before midnight).
WORD, SHIFT = 1 << 12, 1 << 20
COUNTED = "pane bigint, route_id string, direction_id int, departure bigint, trips bigint"
NUMBERS = "trips bigint, first bigint, last bigint, squares bigint, words binary"
STATS = "window_start bigint, route_id string, direction_id int, trip_count bigint, first bigint, last bigint, gap_squares bigint"
STATS_ROW = Row(*[part.split()[0] for part in STATS.split(", ")])


def packed(bits: int) -> bytes:
    return bits.to_bytes((bits.bit_length() + 7) // 8, "little")


class Seconds:
    """The distinct seconds of a window; ``read`` gives a stored word, ``changed`` holds those to be stored."""

    def __init__(self, read, used: int = 0, first: int | None = None, last: int | None = None, squares: int = 0) -> None:
        self.read, self.used, self.first, self.last, self.squares = read, used, first, last, squares
        self.words: dict[int, int] = {}
        self.changed: set[int] = set()

    def word(self, w: int) -> int:
        if w not in self.words:
            self.words[w] = self.read(w) if self.used >> w & 1 else 0
        return self.words[w]

    def before(self, w: int, bit: int) -> int | None:
        here = self.word(w) & ((1 << bit) - 1)
        if not here:
            lower = self.used & ((1 << w) - 1)
            if not lower:
                return None
            w = lower.bit_length() - 1
            here = self.word(w)
        return w * WORD + here.bit_length() - 1

    def after(self, w: int, bit: int) -> int | None:
        here = self.word(w) >> (bit + 1) << (bit + 1)
        if not here:
            upper = self.used >> (w + 1) << (w + 1)
            if not upper:
                return None
            w = (upper & -upper).bit_length() - 1
            here = self.word(w)
        return w * WORD + (here & -here).bit_length() - 1

    def add(self, second: int) -> None:
        at = second + SHIFT
        w, bit = divmod(at, WORD)
        if self.word(w) >> bit & 1:
            return
        low, high = self.before(w, bit), self.after(w, bit)
        if low is not None and high is not None:
            self.squares -= (high - low) ** 2
        self.squares += 0 if low is None else (at - low) ** 2
        self.squares += 0 if high is None else (high - at) ** 2
        self.first = second if low is None else self.first
        self.last = second if high is None else self.last
        self.words[w] |= 1 << bit
        self.used |= 1 << w
        self.changed.add(w)


class HeadwayState(StatefulProcessor):
    """One window of a route and direction. ``final`` gives it out once, when the watermark has passed its end."""

    def __init__(self, window_s: int, final: bool) -> None:
        self.window_s, self.final = window_s, final

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.numbers = handle.getValueState("numbers", NUMBERS)
        self.words = handle.getMapState("words", "word int", "bits binary")

    def _row(self, key, numbers: tuple) -> Row:
        return STATS_ROW(*key, *numbers[:4])

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        end_ms = (int(key[0]) + self.window_s) * 1000
        if timerValues.getCurrentWatermarkInMs() >= end_ms:
            return
        trips, first, last, squares, used = self.numbers.get() if self.numbers.exists() else (None, None, None, 0, b"")
        if trips is None:
            trips = 0
            self.handle.registerTimer(end_ms)
        seconds = Seconds(lambda w: int.from_bytes(self.words.getValue((w,))[0], "little"), int.from_bytes(used, "little"), first, last, squares)
        for row in rows:
            if row.departure is not None:
                trips += row.trips
                seconds.add(row.departure)
        for w in seconds.changed:
            self.words.updateValue((w,), (packed(seconds.words[w]),))
        numbers = (trips, seconds.first, seconds.last, seconds.squares, packed(seconds.used))
        self.numbers.update(numbers)
        if not self.final:
            yield self._row(key, numbers)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        if self.final:
            yield self._row(key, self.numbers.get())
        self.words.clear()
        self.numbers.clear()

    def close(self) -> None:
        pass


def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sums = pa.Table.from_batches([batch]).group_by(["pane", "route_id", "direction_id", "departure"], use_threads=False).aggregate([("trips", "sum")])
        sums = sums.rename_columns({"trips_sum": "trips"}).select(["pane", "route_id", "direction_id", "departure", "trips"])
        yield from sums.combine_chunks().to_batches()


def headway_windows_stream(
    updates: DataFrame,
    window: str = headway.WINDOW,
    slide: str = headway.SLIDE,
    cv_threshold: float = headway.BUNCHING_CV,
    min_trips: int = headway.MIN_TRIPS,
    departure: Column | None = None,
    mode: str = "update",
) -> DataFrame:
    """The windows of a stream with a watermark on ``event_ts``; the same columns as in the batch forms.

    Update mode gives a window each time it changes, append mode once its end is passed. An update is late when its
    window's end is passed; other windows that it belongs to still take it.
    """
    window_s, slide_s = interval_seconds(window), interval_seconds(slide)
    pane_s = math.gcd(window_s, slide_s)
    rows = departures(updates, departure).select(
        (F.floor(F.unix_timestamp("event_ts") / pane_s) * pane_s).alias("pane"), "route_id", "direction_id", "departure", F.lit(1).cast("bigint").alias("trips")
    )
    latest, earliest = (F.floor(F.col("pane") / slide_s) * slide_s), F.ceil((F.col("pane") + pane_s - window_s) / slide_s) * slide_s
    spread = rows.mapInArrow(counted, COUNTED).select(
        F.explode(F.sequence(earliest, latest, F.lit(slide_s).cast("bigint"))).alias("window_start"), "route_id", "direction_id", "departure", "trips"
    )
    stats = spread.groupBy("window_start", "route_id", "direction_id").transformWithState(
        statefulProcessor=HeadwayState(window_s, mode == "append"), outputStructType=STATS,
        outputMode=mode.capitalize(), timeMode="EventTime",
    )
    bounds = F.struct(F.timestamp_seconds("window_start").alias("start"), F.timestamp_seconds(F.col("window_start") + window_s).alias("end"))
    return metrics(stats.withColumn("window", bounds), cv_threshold, min_trips)
