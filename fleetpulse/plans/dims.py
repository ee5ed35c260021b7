"""Route and stop dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetpulse.plans.staging import stg_routes, stg_stops


def dim_routes(seed: DataFrame) -> DataFrame:
    return stg_routes(seed).select(
        "route_id",
        F.col("route_short_name").alias("route_name"),
        *("route_long_name", "route_type", "route_type_label"),
    )


def dim_stops(seed: DataFrame) -> DataFrame:
    return stg_stops(seed)
