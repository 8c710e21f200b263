"""Great-circle distance and bearing."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_RADIUS_KM = 6371.0


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    dlat, dlon = F.radians(lat2 - lat1) / 2, F.radians(lon2 - lon1) / 2
    a = F.pow(F.sin(dlat), 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(dlon), 2)
    return F.lit(2 * EARTH_RADIUS_KM) * F.asin(F.sqrt(F.least(a, F.lit(1.0))))


def bearing_deg(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Initial bearing from point 1 to point 2, clockwise from north."""
    a, b, dlon = F.radians(lat1), F.radians(lat2), F.radians(lon2 - lon1)
    y = F.sin(dlon) * F.cos(b)
    x = F.cos(a) * F.sin(b) - F.sin(a) * F.cos(b) * F.cos(dlon)
    return F.pmod(F.degrees(F.atan2(y, x)), F.lit(360.0))
