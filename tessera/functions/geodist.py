"""Great-circle distance expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: mean Earth radius in kilometres.
EARTH_RADIUS_KM = 6371.0088


def haversine_km(lat1, lon1, lat2, lon2) -> Column:
    """Haversine distance in km between two points given in degrees."""
    p1, p2 = F.radians(lat1), F.radians(lat2)
    dphi = F.radians(lat2) - F.radians(lat1)
    dlmb = F.radians(lon2) - F.radians(lon1)
    h = F.pow(F.sin(dphi / 2), 2) + F.cos(p1) * F.cos(p2) * F.pow(F.sin(dlmb / 2), 2)
    return F.lit(2 * EARTH_RADIUS_KM) * F.asin(F.least(F.sqrt(h), F.lit(1.0)))
