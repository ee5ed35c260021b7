"""Distances and boxes as column expressions."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_RADIUS_M = 6_371_000.0


class Box(NamedTuple):
    lat_min: float
    lat_max: float
    lon_min: float
    lon_max: float


# Area in which a stall counts, area drawn on the live map, country, globe.
SERVICE_AREA = Box(-37.05, -36.60, 174.62, 174.95)
MAP_AREA = Box(-37.20, -36.50, 174.50, 175.10)
COUNTRY = Box(-48.0, -34.0, 166.0, 179.0)
GLOBE = Box(-90.0, 90.0, -180.0, 180.0)


def in_box(lat: Column, lon: Column, box: Box) -> Column:
    return lat.between(box.lat_min, box.lat_max) & lon.between(box.lon_min, box.lon_max)


def haversine_m(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle distance in metres between two points given in degrees."""

    def half_chord(a: Column, b: Column) -> Column:
        half = F.sin(F.radians(b - a) / 2)
        return half * half

    h = half_chord(lat1, lat2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * half_chord(lon1, lon2)
    return F.lit(2 * EARTH_RADIUS_M) * F.atan2(F.sqrt(h), F.sqrt(1 - h))
