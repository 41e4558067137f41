"""Geography on the sphere and on regular longitude axes, as column expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_RADIUS_KM = 6371.0
KM_PER_DEGREE = math.radians(EARTH_RADIUS_KM)


def haversine_km(lon1: Column, lat1: Column, lon2: Column, lat2: Column) -> Column:
    """Great-circle distance of points in degrees."""
    north = F.sin((F.radians(lat2) - F.radians(lat1)) / 2)
    east = F.sin((F.radians(lon2) - F.radians(lon1)) / 2)
    a = north * north + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * east * east
    # Spark's least and greatest skip nulls; a missing coordinate must give no distance.
    return F.when(a.isNotNull(), 2 * EARTH_RADIUS_KM * F.asin(F.sqrt(F.least(F.lit(1.0), F.greatest(F.lit(0.0), a)))))


def unit_vector(lon: Column, lat: Column) -> tuple[Column, Column, Column]:
    """A point as x, y, z on the unit sphere."""
    return F.cos(F.radians(lat)) * F.cos(F.radians(lon)), F.cos(F.radians(lat)) * F.sin(F.radians(lon)), F.sin(F.radians(lat))


def chord_km(chord: Column) -> Column:
    """Great-circle distance of a straight-line distance between unit vectors."""
    return 2 * EARTH_RADIUS_KM * F.asin(F.least(F.lit(1.0), chord / 2))


def signed_shift(lon: Column) -> Column:
    """What moves a longitude into [-180, 180): a multiple of 360."""
    return F.pmod(lon + 180.0, F.lit(360.0)) - 180.0 - lon


def near_longitude(lon: Column, reference: Column) -> Column:
    """The copy of a longitude, by whole turns, that is nearest to a reference (halves to even)."""
    return lon + 360.0 * F.rint((reference - lon) / 360.0)


def wrapped_longitude(lon: Column) -> Column:
    """A longitude in [-180, 180) at two decimals, never 180 itself."""
    near = F.bround(F.pmod(lon + 180.0, F.lit(360.0)) - 180.0, 2)
    return F.when(near >= 180.0, near - 360.0).otherwise(near)


def offset_point(lon: Column, lat: Column, east_km: Column, north_km: Column) -> tuple[Column, Column]:
    """A point moved by distances east and north."""
    return lon + F.degrees(east_km / (EARTH_RADIUS_KM * F.cos(F.radians(lat)))), lat + F.degrees(north_km / EARTH_RADIUS_KM)


def axis_is_global(first: Column, second: Column, last: Column) -> Column:
    """Whether an even axis spans the globe: its span and one step make 360 degrees."""
    return F.abs(last - first + second - first - 360.0) <= 1e-6 + 1e-5 * 360.0


def axis_is_periodic(count: Column, first: Column, second: Column) -> Column:
    """Whether as many steps as points make 360 degrees."""
    return (count > 1) & (F.abs(count * F.abs(second - first) - 360.0) <= 1e-8 + 1e-5 * 360.0)
