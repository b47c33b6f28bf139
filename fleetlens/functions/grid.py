"""Hexagonal grid cells behind a small provider interface.

The built-in provider is a planar axial grid over plate carree degrees, in native columns, so that it pushes through
plans and can be replayed in SQL. Its cells are not H3 cells. A cell id is `resolution:q:r`.
"""

from __future__ import annotations

import math
from typing import Protocol

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Edge of a cell of resolution 0 in degrees; each finer resolution has an edge smaller by STEP.
EDGE_0, STEP = 10.0, math.sqrt(7.0)


class Grid(Protocol):
    def cell(self, lat: Column, lon: Column, resolution: int) -> Column: ...
    def parent(self, cell: Column, resolution: int) -> Column: ...
    def centre(self, cell: Column) -> tuple[Column, Column]: ...
    def boundary(self, cell: Column) -> Column: ...
    def disk(self, cell: Column, k: int) -> Column: ...


class HexGrid:
    """Pointy-top hexagons in axial coordinates."""

    @staticmethod
    def edge(resolution: int) -> float:
        return EDGE_0 / STEP**resolution

    def cell(self, lat: Column, lon: Column, resolution: int) -> Column:
        size = self.edge(resolution)
        q = lon * F.lit(math.sqrt(3) / 3 / size) - lat * F.lit(1 / 3 / size)
        r = lat * F.lit(2 / 3 / size)
        # cube rounding: the coordinate that moved most follows from the others
        s = -q - r
        rq, rr, rs = F.floor(q + 0.5), F.floor(r + 0.5), F.floor(s + 0.5)
        dq, dr, ds = F.abs(rq - q), F.abs(rr - r), F.abs(rs - s)
        cq = F.when((dq > dr) & (dq > ds), -rr - rs).otherwise(rq)
        cr = F.when((dq > dr) & (dq > ds), rr).when(dr > ds, -rq - rs).otherwise(rr)
        text = F.concat_ws(":", F.lit(str(resolution)), cq.cast("long").cast("string"), cr.cast("long").cast("string"))
        return F.when(lat.isNotNull() & lon.isNotNull(), text)

    @staticmethod
    def _parts(cell: Column) -> tuple[Column, Column, Column]:
        part = F.split(cell, ":")
        return part[0].cast("int"), part[1].cast("double"), part[2].cast("double")

    def centre(self, cell: Column) -> tuple[Column, Column]:
        """(lat, lon)."""
        resolution, q, r = self._parts(cell)
        size = F.lit(EDGE_0) / F.pow(F.lit(STEP), resolution)
        return size * 1.5 * r, size * F.lit(math.sqrt(3)) * (q + r / 2)

    def parent(self, cell: Column, resolution: int) -> Column:
        """The coarser cell that holds the cell's centre."""
        return self.cell(*self.centre(cell), resolution)

    def boundary(self, cell: Column) -> Column:
        """The six corners and the first again, as a WKT polygon of lon lat."""
        lat, lon = self.centre(cell)
        size = F.lit(EDGE_0) / F.pow(F.lit(STEP), self._parts(cell)[0])
        corners = []
        for k in (0, 1, 2, 3, 4, 5, 0):
            turn = math.pi / 180 * (60 * k - 30)
            corner = (lon + size * math.cos(turn), lat + size * math.sin(turn))
            corners.append(F.concat_ws(" ", *[F.round(x, 7).cast("string") for x in corner]))
        return F.when(cell.isNotNull(), F.concat(F.lit("POLYGON(("), F.concat_ws(", ", *corners), F.lit("))")))

    def disk(self, cell: Column, k: int) -> Column:
        """All cells at most k steps away."""
        resolution, q, r = self._parts(cell)
        at = lambda x: x.cast("long").cast("string")
        row = lambda a: F.transform(
            F.sequence(F.greatest(F.lit(-k), -a - k), F.least(F.lit(k), -a + k)),
            lambda b: F.concat_ws(":", resolution.cast("string"), at(q + a), at(r + b)),
        )
        return F.when(cell.isNotNull(), F.flatten(F.transform(F.sequence(F.lit(-k), F.lit(k)), row)))
