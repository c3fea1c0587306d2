"""Boxes, distances and the grid cells that make a radius join an equi-join."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from punctual.settings import EARTH_RADIUS_M, GREATER_MANCHESTER, Area


def in_area(lat: Column, lon: Column, area: Area = GREATER_MANCHESTER) -> Column:
    return lat.between(area.lat_min, area.lat_max) & lon.between(area.lon_min, area.lon_max)


def haversine_m(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    half_dlat = F.sin(F.radians(lat2 - lat1) / 2)
    half_dlon = F.sin(F.radians(lon2 - lon1) / 2)
    chord = half_dlat * half_dlat + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * half_dlon * half_dlon
    # Rounding may lift the chord of two antipodes just above one, where asin has no value.
    return F.lit(2 * EARTH_RADIUS_M) * F.asin(F.sqrt(F.least(chord, F.lit(1.0))))


def reach_lat(radius_m: float) -> float:
    """Degrees of latitude that certainly cover `radius_m` (a hair more, against rounding)."""
    return math.degrees(radius_m / EARTH_RADIUS_M) * (1 + 1e-9) + 1e-12


def reach_lon(lat: Column, radius_m: float) -> Column:
    """Degrees of longitude that certainly cover `radius_m` around a point at latitude `lat`."""
    ratio = math.sin(radius_m / EARTH_RADIUS_M)
    sine = F.least(F.lit(ratio) / F.cos(F.radians(lat)), F.lit(1.0))
    return F.degrees(F.asin(sine)) * (1 + 1e-9) + 1e-12


def grid_cell(degrees: Column, size: float) -> Column:
    return F.floor(degrees / F.lit(size)).cast("int")


def cells_within(center: Column, reach: Column, size: float) -> Column:
    """All cells of one axis that [center - reach, center + reach] touches, as an array."""
    return F.sequence(grid_cell(center - reach, size), grid_cell(center + reach, size))
