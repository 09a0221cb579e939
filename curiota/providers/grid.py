"""Grid providers: cell of a point, area of a cell, neighbours of a cell."""

from __future__ import annotations

from typing import Protocol

from pyspark.sql import Column
from pyspark.sql import functions as F

from curiota.functions.geo import sphere_km2


class Grid(Protocol):
    resolutions: int

    def cell(self, lat: Column, lon: Column, resolution: int) -> Column: ...

    def area_km2(self, cell: Column, resolution: int) -> Column: ...

    def ring(self, cell: int, resolution: int) -> list[int]: ...


class EqualAreaGrid:
    """Cells of equal area: 3 * 2**r rows equally spaced in the sine of latitude and twice as many columns.

    Built-in expressions only, so cells also exist in SQL.  Cell numbers are
    ``row * columns + column``; they are not those of any hexagonal grid.
    """

    resolutions = 12

    @staticmethod
    def rows(resolution: int) -> int:
        return 3 * 2**resolution

    def cell(self, lat: Column, lon: Column, resolution: int) -> Column:
        n = self.rows(resolution)
        row = F.least(F.floor((F.sin(F.radians(lat)) + 1) / 2 * n), F.lit(n - 1))
        column = F.least(F.floor((lon + 180) / 360 * (2 * n)), F.lit(2 * n - 1))
        valid = lat.between(-90, 90) & lon.between(-180, 180)
        return F.when(valid, (row * (2 * n) + column).cast("long"))

    def area_km2(self, cell: Column, resolution: int) -> Column:
        n = self.rows(resolution)
        return F.when(cell.isNotNull(), F.lit(sphere_km2() / (2 * n * n)))

    def ring(self, cell: int, resolution: int) -> list[int]:
        n = self.rows(resolution)
        row, column = divmod(cell, 2 * n)
        return [
            r * 2 * n + (column + d) % (2 * n)
            for r in range(max(0, row - 1), min(n, row + 2))
            for d in (-1, 0, 1)
            if (r, d) != (row, 0)
        ]
