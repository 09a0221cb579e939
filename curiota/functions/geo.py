"""Geometry expressions: distances, an equal-area grid, points in polygons."""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_KM = 6371.0088


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column, radius: float = EARTH_KM) -> Column:
    """Great-circle distance."""
    p1, p2 = F.radians(lat1), F.radians(lat2)
    dp, dl = F.radians(lat2 - lat1) / 2, F.radians(lon2 - lon1) / 2
    h = F.sin(dp) * F.sin(dp) + F.cos(p1) * F.cos(p2) * F.sin(dl) * F.sin(dl)
    return F.lit(2 * radius) * F.asin(F.sqrt(F.least(h, F.lit(1.0))))


def clamp(c: Column, low: float = 0.0, high: float = 1.0) -> Column:
    """Values limited to an interval; null stays null."""
    return F.when(c.isNotNull(), F.least(F.greatest(c, F.lit(low)), F.lit(high)))


def points_in_polygons(lat: np.ndarray, lon: np.ndarray, polygons: list[np.ndarray]) -> np.ndarray:
    """Whether each point lies in any polygon (rows of lon, lat), by ray casting inside bounding boxes."""
    inside = np.zeros(lat.size, dtype=bool)
    for ring in polygons:
        x, y = ring[:, 0], ring[:, 1]
        near = np.flatnonzero(~inside & (lon >= x.min()) & (lon <= x.max()) & (lat >= y.min()) & (lat <= y.max()))
        if not near.size:
            continue
        odd = np.zeros(near.size, dtype=bool)
        px, py = lon[near], lat[near]
        for x1, y1, x2, y2 in zip(x, y, np.roll(x, -1), np.roll(y, -1), strict=True):
            if y1 == y2:
                continue
            crosses = ((y1 > py) != (y2 > py)) & (px < (x2 - x1) * (py - y1) / (y2 - y1) + x1)
            odd ^= crosses
        inside[near] = odd
    return inside


def sphere_km2(radius: float = EARTH_KM) -> float:
    return 4 * math.pi * radius * radius
