"""Distances and offsets on the globe as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The radius and the metres per degree that distances and offsets use.
EARTH_RADIUS_KM = 6371
METRES_PER_DEGREE = 111_000.0


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    dlat, dlon = F.radians(lat2) - F.radians(lat1), F.radians(lon2) - F.radians(lon1)
    half = F.pow(F.sin(dlat / 2), 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(dlon / 2), 2)
    return 2 * EARTH_RADIUS_KM * F.asin(F.least(F.lit(1.0), F.sqrt(half)))


def lat_degrees(metres: Column) -> Column:
    return metres / METRES_PER_DEGREE


def lon_degrees(metres: Column, lat: Column) -> Column:
    return metres / (METRES_PER_DEGREE * F.cos(F.radians(lat)))
