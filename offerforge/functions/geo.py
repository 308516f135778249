"""Great-circle distance."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Earth radius in km, branch position (latitude, longitude), near-branch limit in km.
EARTH_RADIUS_KM = 6371.0
BRANCH = (12.9698, 77.7500)
NEAR_KM = 15


def great_circle_km(latitude: Column, longitude: Column, point: tuple[float, float] = BRANCH) -> Column:
    """Haversine distance in km to a fixed point, two decimals."""
    lat0, lon0 = (F.radians(F.lit(float(v))) for v in point)
    lat, lon = F.radians(latitude), F.radians(longitude)
    half = F.pow(F.sin((lat - lat0) / 2), 2) + F.cos(lat) * F.cos(lat0) * F.pow(F.sin((lon - lon0) / 2), 2)
    return F.round(2 * EARTH_RADIUS_KM * F.asin(F.sqrt(half)), 2)


def near_flag(distance_km: Column, limit: int = NEAR_KM) -> Column:
    """1 when the whole kilometres are below the limit, else 0."""
    return (distance_km.cast("bigint") < limit).cast("int")
