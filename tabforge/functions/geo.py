"""Geo column expressions (F12-F16): great-circle distance, corner
distance, initial bearing, speed and L1 distance of rotated points."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .contract import ColumnOrName, col, ratio

# Fixed value: mean Earth radius in km used by the distance features.
EARTH_RADIUS_KM = 6371.0


def haversine(lat1: ColumnOrName, lng1: ColumnOrName,
              lat2: ColumnOrName, lng2: ColumnOrName) -> Column:
    """Great-circle distance in km."""
    p1, l1 = F.radians(col(lat1)), F.radians(col(lng1))
    p2, l2 = F.radians(col(lat2)), F.radians(col(lng2))
    d = F.pow(F.sin((p2 - p1) * 0.5), 2) + F.cos(p1) * F.cos(p2) * F.pow(F.sin((l2 - l1) * 0.5), 2)
    return 2 * EARTH_RADIUS_KM * F.asin(F.sqrt(d))


def manhattan(lat1: ColumnOrName, lng1: ColumnOrName,
              lat2: ColumnOrName, lng2: ColumnOrName) -> Column:
    """Distance along the two legs through the corner (lat1, lng2)."""
    return haversine(lat1, lng1, lat1, lng2) + haversine(lat1, lng1, lat2, lng1)


def bearing(lat1: ColumnOrName, lng1: ColumnOrName,
            lat2: ColumnOrName, lng2: ColumnOrName) -> Column:
    """Initial bearing in degrees, in (-180, 180]."""
    dl = F.radians(col(lng2) - col(lng1))
    p1, p2 = F.radians(col(lat1)), F.radians(col(lat2))
    y = F.sin(dl) * F.cos(p2)
    x = F.cos(p1) * F.sin(p2) - F.sin(p1) * F.cos(p2) * F.cos(dl)
    return F.degrees(F.atan2(y, x))


def speed(distance_km: ColumnOrName, seconds: ColumnOrName) -> Column:
    """Average speed ``1000 * km / s``; a zero duration gives NULL."""
    return ratio(col(distance_km) * 1000, seconds)


def l1(ax: ColumnOrName, ay: ColumnOrName, bx: ColumnOrName, by: ColumnOrName) -> Column:
    """L1 distance of two points (used on PCA-rotated coordinates)."""
    return F.abs(col(bx) - col(ax)) + F.abs(col(by) - col(ay))
