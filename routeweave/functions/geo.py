"""Great-circle distance as a built-in column expression."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: mean Earth radius used for all distances, in km.
EARTH_RADIUS_KM = 6371.0
KM_PER_DEGREE_LAT = EARTH_RADIUS_KM * math.pi / 180.0


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    dlat = F.radians(lat2 - lat1)
    dlon = F.radians(lon2 - lon1)
    a = (F.pow(F.sin(dlat / 2), 2)
         + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(dlon / 2), 2))
    return F.lit(2 * EARTH_RADIUS_KM) * F.asin(F.sqrt(a))


def _band_height(radius_km: float) -> float:
    return radius_km / KM_PER_DEGREE_LAT


def lat_band(lat: Column, radius_km: float) -> Column:
    """Latitude band as high as the radius: points within it lie in one band
    or in two neighbouring ones (a great-circle distance is never shorter
    than its meridian component)."""
    return F.floor(lat / _band_height(radius_km)).cast("long")


def lon_cells(band: Column, radius_km: float) -> Column:
    """Number of longitude cells of a latitude band.  A cell is at least as
    wide as the radius reaches from any point of the band or of its
    neighbours; bands near a pole (or cells too few to tell neighbours
    apart) are one cell."""
    height = _band_height(radius_km)
    far = F.greatest(F.abs((band - 1) * height), F.abs((band + 2) * height))
    reach = math.sin(math.radians(height))
    width = F.degrees(F.asin(F.least(F.lit(1.0), F.lit(reach) / F.cos(F.radians(far)))))
    n = F.floor(F.lit(360.0) / width)
    return F.when((far + height >= 90.0) | (n < 3), F.lit(1)).otherwise(n).cast("long")


def lon_cell(lon: Column, n: Column) -> Column:
    """Cell of a longitude; -180 and 180 are one meridian."""
    return F.pmod(F.floor((lon + 180.0) / 360.0 * n).cast("long"), n)
