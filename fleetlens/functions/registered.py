"""Functions by name for SQL, with the grid behind them as a choice."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetlens.functions import h3
from fleetlens.functions.grid import HexGrid
from fleetlens.functions.scalars import EARTH_M, ROUTE_MODES

#: Arguments, result and body of functions that are SQL themselves and are inlined into plans.
BODIES = {
    "at_least_zero": ("x DOUBLE", "DOUBLE", "if(x is null, null, greatest(x, 0D))"),
    "distance_m": (
        "lat1 DOUBLE, lon1 DOUBLE, lat2 DOUBLE, lon2 DOUBLE", "DOUBLE",
        # least() passes over nulls
        f"case when lat1 + lon1 + lat2 + lon2 is not null then 2D * {EARTH_M!r}D * asin(sqrt(least(1D, pow(sin((radians(lat2) - radians(lat1)) / 2), 2)"
        " + cos(radians(lat1)) * cos(radians(lat2)) * pow(sin((radians(lon2) - radians(lon1)) / 2), 2)))) end",
    ),
    "route_mode": ("route_type BIGINT", "STRING", "case route_type " + " ".join(f"when {k} then '{v}'" for k, v in ROUTE_MODES.items()) + " end"),
    "percent_change": ("x DOUBLE, mean DOUBLE", "DOUBLE", "try_divide(x - mean, mean)"),
}


def register(spark: SparkSession, grid: str = "h3") -> None:
    """Make the functions known to the session's SQL: those of BODIES, grid_cell(lat, lon, resolution) and
    for h3 grid_parent(cell, resolution). grid is h3 or planar; registering again swaps it under the same names."""
    for name, (arguments, result, body) in BODIES.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({arguments}) RETURNS {result} RETURN {body}")
    if grid == "h3":
        spark.udf.register("grid_cell", _h3_cell())
        rest = "(shiftleft(1L, 3 * (15 - resolution)) - 1)"
        kept = f"(conv(cell, 16, 10)::BIGINT & ~(shiftleft(15L, 52) | {rest})) | shiftleft(resolution::BIGINT, 52) | {rest}"
        parent = f"if((shiftright(conv(cell, 16, 10)::BIGINT, 52) & 15) >= resolution, lower(hex({kept})), null)"
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION grid_parent(cell STRING, resolution INT) RETURNS STRING RETURN {parent}")
    elif grid == "planar":
        spark.udf.register("grid_cell", _planar_cell())
        spark.sql("DROP TEMPORARY FUNCTION IF EXISTS grid_parent")  # needs a cell's centre there, see HexGrid.parent
    else:
        raise ValueError(f"not a grid: {grid!r}")


def _h3_cell():
    @F.pandas_udf(T.StringType())
    def grid_cell(lat: pd.Series, lon: pd.Series, resolution: pd.Series) -> pd.Series:
        out = pd.Series([None] * len(lat), dtype=object)
        there = (lat + lon).notna() & ((lat + lon).abs() < float("inf")) & resolution.notna()
        for r in resolution[there].unique():
            own = there & (resolution == r)
            out[own] = [f"{x:015x}" for x in h3.points_to_cells(lat[own].to_numpy(), lon[own].to_numpy(), int(r)).tolist()]
        return out

    return grid_cell


def _planar_cell():
    @F.pandas_udf(T.StringType())
    def grid_cell(lat: pd.Series, lon: pd.Series, resolution: pd.Series) -> pd.Series:
        out = []
        for a, o, r in zip(lat, lon, resolution):
            if pd.isna(a) or pd.isna(o) or pd.isna(r):
                out.append(None)
                continue
            size = HexGrid.edge(int(r))
            q, s = o * 3**0.5 / 3 / size - a / 3 / size, a * 2 / 3 / size
            at = [int(v // 1) for v in (q + 0.5, s + 0.5, -q - s + 0.5)]
            off = [abs(at[0] - q), abs(at[1] - s), abs(at[2] + q + s)]
            if off[0] > off[1] and off[0] > off[2]:
                at[0] = -at[1] - at[2]
            elif off[1] > off[2]:
                at[1] = -at[0] - at[2]
            out.append(f"{int(r)}:{at[0]}:{at[1]}")
        return pd.Series(out, dtype=object)

    return grid_cell
