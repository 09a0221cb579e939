"""Land masks: a raster of land (0), sea (1) and coast (2) with polygons for coastal cells."""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

LAND, SEA, COAST = 0, 1, 2


@dataclass(frozen=True)
class LandMask:
    """``mask[lat index, lon index]`` over axes that start at an origin with a step.

    A mask is an asset of fixed size (an equal-angle world at one minute of arc
    has 233 million cells of one byte), so it is broadcast once per executor.
    """

    mask: np.ndarray
    lat0: float
    lat_step: float
    lon0: float
    lon_step: float
    polygons: list[np.ndarray] = field(default_factory=list)

    def index(self, value: Column, origin: float, step: float, size: int) -> Column:
        """Index on an axis; −1 outside it and for null, which classify as land."""
        i = F.floor((value - F.lit(origin)) / F.lit(step))
        edge = value == F.lit(origin + step * size)
        return F.when(edge, F.lit(size - 1)).when((i >= 0) & (i < size), i).otherwise(F.lit(-1)).cast("int")

    def lat_index(self, lat: Column) -> Column:
        return self.index(lat, self.lat0, self.lat_step, self.mask.shape[0])

    def lon_index(self, lon: Column) -> Column:
        return self.index(lon, self.lon0, self.lon_step, self.mask.shape[1])


def coast_mask(mask: np.ndarray, kernel_size: int = 51, kernel: str = "square") -> np.ndarray:
    """Mark cells whose neighbourhood holds both land and sea as coast: the morphological gradient of the mask.

    ``kernel`` is ``square``, ``disk`` or ``cross``.  Longitudes do not wrap.
    """
    r = kernel_size // 2
    offsets = [
        (i, j)
        for i in range(-r, r + 1)
        for j in range(-r, r + 1)
        if kernel == "square" or (kernel == "disk" and i * i + j * j <= r * r) or (kernel == "cross" and (i == 0 or j == 0))
    ]
    low, high = mask.copy(), mask.copy()
    n, m = mask.shape
    for i, j in offsets:
        a, b = slice(max(0, i), n + min(0, i)), slice(max(0, -i), n + min(0, -i))
        c, d = slice(max(0, j), m + min(0, j)), slice(max(0, -j), m + min(0, -j))
        np.minimum(low[a, c], mask[b, d], out=low[a, c])
        np.maximum(high[a, c], mask[b, d], out=high[a, c])
    return np.where(high > low, COAST, mask).astype(mask.dtype)


def synthetic_world(n: int = 10) -> LandMask:
    """A small world: a square continent, its coast, sea around it."""
    mask = np.ones((n, 2 * n), dtype=np.int8)
    mask[n // 4 : 3 * n // 4, n // 2 : 3 * n // 2] = LAND
    step = 180.0 / n
    low, high = -90 + step * (n // 4), -90 + step * (3 * n // 4)
    west, east = -180 + step * (n // 2), -180 + step * (3 * n // 2)
    ring = np.array([[west, low], [east, low], [east, high], [west, high]])
    return LandMask(coast_mask(mask, 3), -90.0, step, -180.0, step, [ring])
