"""Great-circle distance and inverse-distance weights as Column expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the model: mean Earth radius (km) and the IDW offset (km)
# that keeps a station sitting on a zone centre from getting infinite weight.
EARTH_RADIUS_KM = 6371.0
IDW_OFFSET_KM = 0.1

RAD_PER_DEG = math.pi / 180.0


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else (c if isinstance(c, Column) else F.lit(c))


def haversine_km(lon1, lat1, lon2, lat2) -> Column:
    """Haversine distance in km between (lon1, lat1) and (lon2, lat2), degrees.

    Coordinates are converted to radians before differencing; ``least``
    keeps rounding from pushing the asin argument above 1.
    """
    x1, y1 = _col(lon1) * RAD_PER_DEG, _col(lat1) * RAD_PER_DEG
    x2, y2 = _col(lon2) * RAD_PER_DEG, _col(lat2) * RAD_PER_DEG
    s_lat = F.sin((y2 - y1) / 2.0)
    s_lon = F.sin((x2 - x1) / 2.0)
    a = s_lat * s_lat + F.cos(y1) * F.cos(y2) * (s_lon * s_lon)
    return F.lit(EARTH_RADIUS_KM) * (2.0 * F.asin(F.sqrt(F.least(a, F.lit(1.0)))))


def idw_weight(dist_km) -> Column:
    return 1.0 / (_col(dist_km) + IDW_OFFSET_KM)


def angular_radius_deg(radius_km: float) -> float:
    """Latitude half-extent (degrees) of a circle of ``radius_km``."""
    return math.degrees(radius_km / EARTH_RADIUS_KM)


def lon_half_extent_deg(lat, radius_km: float) -> Column:
    """Longitude half-extent (degrees) of the circle of ``radius_km`` centred
    at latitude ``lat``: asin(sin(d) / cos(lat)). NULL where the circle
    reaches a pole (every longitude is then in range)."""
    d = radius_km / EARTH_RADIUS_KM
    ratio = math.sin(d) / F.cos(_col(lat) * RAD_PER_DEG)
    reaches_pole = F.abs(_col(lat)) + math.degrees(d) >= 90.0
    return F.when(reaches_pole | (ratio >= 1.0), F.lit(None).cast("double")) \
        .otherwise(F.degrees(F.asin(ratio)))
