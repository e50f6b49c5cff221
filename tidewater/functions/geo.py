"""Geographic column functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def haversine(lat1: Column, lon1: Column, lat2: Column, lon2: Column, degrees: bool = True) -> Column:
    """great-circle distance on the unit sphere (radians of arc);
    multiply by a radius for a length."""
    if degrees:
        lat1, lon1, lat2, lon2 = F.radians(lat1), F.radians(lon1), F.radians(lat2), F.radians(lon2)
    a = F.pow(F.sin((lat2 - lat1) / 2), 2) + F.cos(lat1) * F.cos(lat2) * F.pow(F.sin((lon2 - lon1) / 2), 2)
    return 2 * F.asin(F.sqrt(a))
