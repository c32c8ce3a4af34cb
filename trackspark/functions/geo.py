from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: mean diameter of the Earth in kilometres.
EARTH_DIAMETER_KM = 12742


def _half_chord(a: Column, b: Column) -> Column:
    return F.pow(F.sin(F.radians(b - a) / 2), 2)


def haversine_km(lat0: Column, lon0: Column, lat1: Column, lon1: Column) -> Column:
    """Great-circle distance in km between two points given in degrees."""
    parallel = F.cos(F.radians(lat0)) * F.cos(F.radians(lat1))
    h = _half_chord(lat0, lat1) + parallel * _half_chord(lon0, lon1)
    return F.atan2(F.sqrt(h), F.sqrt(1 - h)) * EARTH_DIAMETER_KM
