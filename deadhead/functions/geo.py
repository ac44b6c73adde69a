"""Road-mile estimate from coordinates, as one native column expression."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from deadhead.config import DEFAULT, Params


def sphere_metres(lon1: Column, lat1: Column, lon2: Column, lat2: Column, radius_m: float) -> Column:
    """Great-circle metres (haversine)."""
    north = F.pow(F.sin(F.radians(lat2 - lat1) / 2), F.lit(2.0))
    east = F.pow(F.sin(F.radians(lon2 - lon1) / 2), F.lit(2.0))
    chord = north + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * east
    return 2 * radius_m * F.asin(F.sqrt(F.least(F.lit(1.0), chord)))


def road_miles(lon1: Column, lat1: Column, lon2: Column, lat2: Column, p: Params = DEFAULT) -> Column:
    """Great-circle distance times the detour factor, in miles; NULL when a coordinate is NULL."""
    known = lon1.isNotNull() & lat1.isNotNull() & lon2.isNotNull() & lat2.isNotNull()
    metres = sphere_metres(lon1, lat1, lon2, lat2, p.earth_radius_m)
    return F.when(known, p.detour * metres / p.km_per_mile / 1000)
