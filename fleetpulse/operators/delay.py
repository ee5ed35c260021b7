"""Late trips: threshold and severity tier."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetpulse.functions.keys import natural_key

# A trip is late past this many seconds; upper bounds of the tiers below the top one.
LATE_AFTER_S = 300
TIERS = ((600, "MODERATE"), (1200, "HIGH"))
TOP_TIER = "SEVERE"


def severity(delay: Column, tiers: Sequence[tuple[int, str]] = TIERS, top: str = TOP_TIER) -> Column:
    """Name of the lowest tier whose upper bound covers the delay."""
    bounds = sorted(tiers)
    ladder = F.when(delay <= bounds[0][0], bounds[0][1])
    for limit, label in bounds[1:]:
        ladder = ladder.when(delay <= limit, label)
    return ladder.otherwise(top)


def tier_names(tiers: Sequence[tuple[int, str]] = TIERS, top: str = TOP_TIER) -> list[str]:
    return [label for _, label in sorted(tiers)] + [top]


def detect_delays(
    updates: DataFrame,
    threshold_s: int = LATE_AFTER_S,
    tiers: Sequence[tuple[int, str]] = TIERS,
    now: Column | None = None,
) -> DataFrame:
    """One alert per trip update strictly later than the threshold. Stateless, so it streams as is."""
    late = updates.where(F.col("delay") > threshold_s)
    return late.select(
        natural_key("delay", "id", "trip_id", "start_date", "timestamp", "delay").alias("event_id"),
        *("trip_id", "route_id", "delay"),
        severity(F.col("delay"), tiers).alias("severity"),
        *("start_time", "start_date"),
        F.col("timestamp").alias("event_timestamp"),
        (F.current_timestamp() if now is None else now).alias("detected_at"),
    )
