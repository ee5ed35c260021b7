"""Column expressions for feed clocks, local service time and display time.

Nothing here raises on bad input: the session runs in ANSI mode, so every parse of feed
text goes through ``try_`` forms.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from fleetpulse.config import LOCAL_ZONE

# Oldest believable feed clock and the accepted drift around now, in seconds.
OLDEST_PLAUSIBLE = 1_600_000_000
MAX_PAST_S = 3600
MAX_FUTURE_S = 300


def _now(now: Column | int | None) -> Column:
    """Reference instant in epoch seconds; a fixed one makes backfills repeatable."""
    if now is None:
        return F.unix_timestamp()
    return now if isinstance(now, Column) else F.lit(now).cast("bigint")


def _floor(now: Column) -> Column:
    return now - F.lit(MAX_PAST_S)


def _ceiling(now: Column) -> Column:
    return now + F.lit(MAX_FUTURE_S)


def ts_status(ts: Column, now: Column | int | None = None) -> Column:
    """Quality label of a feed clock. A missing clock is labelled ``missing``."""
    n = _now(now)
    return (
        F.when(ts.isNull(), "missing")
        .when(ts < OLDEST_PLAUSIBLE, "dropped_invalid")
        .when(ts < _floor(n), "clamped_past")
        .when(ts > _ceiling(n), "clamped_future")
        .otherwise("ok")
    )


def ts_clamped(ts: Column, now: Column | int | None = None) -> Column:
    """Feed clock forced into the accepted drift; anything implausible lands on its floor."""
    n = _now(now)
    believable = F.when(ts >= OLDEST_PLAUSIBLE, ts).when(ts.isNotNull(), _floor(n))
    # greatest/least skip nulls, which would turn a missing clock into a bound.
    return F.when(ts.isNotNull(), F.least(F.greatest(believable, _floor(n)), _ceiling(n)))


def epoch_ts(seconds: Column) -> Column:
    return F.timestamp_seconds(seconds)


def epoch_date(seconds: Column) -> Column:
    return F.to_date(F.timestamp_seconds(seconds))


def local_ts(ts: Column, zone: str = LOCAL_ZONE) -> Column:
    """Wall-clock reading of a UTC instant in the given zone, daylight saving included."""
    return F.from_utc_timestamp(ts, zone)


def local_date(ts: Column, zone: str = LOCAL_ZONE) -> Column:
    return F.to_date(local_ts(ts, zone))


def local_hour(ts: Column, zone: str = LOCAL_ZONE) -> Column:
    return F.hour(local_ts(ts, zone))


def clock_seconds(clock: Column) -> Column:
    """``HH:MM:SS`` as seconds after the start of the service day; hours may pass 24.

    Null when a part is missing or not a number.
    """
    parts = F.split(clock, ":")

    def part(i: int) -> Column:
        return F.get(parts, F.lit(i)).try_cast("int").cast("bigint")

    return part(0) * 3600 + part(1) * 60 + part(2)


def _epoch_text(text: Column) -> Column:
    """Instant of a text of epoch seconds, null for other text.

    The pattern comes first because a failing number cast is an exception inside, and slow.
    """
    return F.when(text.rlike(r"^\s*[+-]?\d+(\.\d*)?\s*$"), F.timestamp_seconds(text.try_cast("double")))


def flexible_ts(text: Column) -> Column:
    """Text holding either epoch seconds or an ISO time, as an instant."""
    return F.coalesce(_epoch_text(text), text.try_cast("timestamp"))


DISPLAY_PATTERN = "yyyy-MM-dd HH:mm:ss"


def display_instant(ts: Column, zone: str = LOCAL_ZONE, pattern: str = DISPLAY_PATTERN) -> Column:
    return F.date_format(local_ts(ts, zone), pattern)


def display_time(text: Column, zone: str = LOCAL_ZONE, pattern: str = DISPLAY_PATTERN) -> Column:
    """Local wall-clock text of an epoch, zoned ISO or naive ISO value.

    A naive value already is local time, so it is only reformatted.
    """
    raw = text.cast("string")
    zoned = raw.rlike(r"(Z|[+-]\d{2}:?\d{2})$")
    epoch = _epoch_text(raw)
    parsed = raw.try_cast("timestamp")
    wall = (
        F.when(epoch.isNotNull(), local_ts(epoch, zone))
        .when(zoned, local_ts(parsed, zone))
        .otherwise(parsed)
    )
    return F.date_format(wall, pattern)


def service_period(local: Column) -> Column:
    """Service tier of a local wall-clock time."""
    minute = F.hour(local) * 60 + F.minute(local)
    # 06:00-09:00 and 15:00-18:30 are peak, 22:00-06:00 is off-peak.
    peak = minute.between(360, 539) | minute.between(900, 1109)
    night = (minute >= 1320) | (minute < 360)
    return F.when(minute.isNull(), None).when(peak, "peak").when(night, "offpeak").otherwise("shoulder")


def rounded(value: Column, digits: int) -> Column:
    """Half-up rounding of a double that does not depend on the order of a float sum.

    A sum of cents divided by a count can sit exactly between two results; the detour over
    a decimal removes the last-bit noise that would otherwise decide it.
    """
    return F.round(value.cast("decimal(38,10)"), digits).cast("double")


# Seconds of the units that interval texts use.
_UNITS = {"second": 1, "minute": 60, "hour": 3600, "day": 86_400, "week": 604_800}


def interval_seconds(text: str) -> int:
    """Seconds of an interval text such as ``10 minutes`` or ``1 day 6 hours``."""
    parts = text.lower().removeprefix("interval").split()
    if not parts or len(parts) % 2:
        raise ValueError(f"no interval: {text!r}")
    return sum(int(n) * _UNITS[unit.removesuffix("s")] for n, unit in zip(parts[::2], parts[1::2]))
