"""Lines on the sphere: native expressions where they do, Arrow functions for overlap and simplification."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from fleetlens.functions.scalars import EARTH_M, distance_m

POINT = "struct<lon:double,lat:double>"


def point(lon, lat) -> Column:
    """A point; null if a coordinate is."""
    return F.when(lon.isNotNull() & lat.isNotNull(), F.struct(lon.cast("double").alias("lon"), lat.cast("double").alias("lat")))


def from_wkt(wkt: Column) -> Column:
    """The points of a LINESTRING or POINT text."""
    inner = F.regexp_extract(wkt, r"\(\s*([^()]*?)\s*\)", 1)
    pair = lambda p: F.struct(
        F.element_at(F.split(F.trim(p), r"\s+"), 1).cast("double").alias("lon"),
        F.element_at(F.split(F.trim(p), r"\s+"), 2).cast("double").alias("lat"),
    )
    return F.when(inner != "", F.transform(F.split(inner, ","), pair))


def to_wkt(line: Column) -> Column:
    body = F.array_join(F.transform(line, lambda p: F.concat_ws(" ", p["lon"].cast("string"), p["lat"].cast("string"))), ", ")
    return F.when(line.isNotNull(), F.concat(F.lit("LINESTRING("), body, F.lit(")")))


def length_m(line: Column) -> Column:
    """Metres along a line."""
    n = F.size(line)
    leg = lambda i: distance_m(
        F.element_at(line, i)["lat"], F.element_at(line, i)["lon"], F.element_at(line, i + 1)["lat"], F.element_at(line, i + 1)["lon"]
    )
    steps = F.when(n > 1, F.transform(F.sequence(F.lit(1), F.greatest(n - 1, F.lit(1))), leg)).otherwise(F.array(F.lit(0.0)))
    return F.when(line.isNotNull(), F.aggregate(steps, F.lit(0.0), lambda t, x: t + x))


def box(line: Column) -> Column:
    """The bounds of a line."""
    of = lambda f, fn: fn(F.transform(line, lambda p: p[f]))
    return F.struct(
        of("lon", F.array_min).alias("lon_min"), of("lat", F.array_min).alias("lat_min"),
        of("lon", F.array_max).alias("lon_max"), of("lat", F.array_max).alias("lat_max"),
    )


def boxes_meet(a: Column, b: Column) -> Column:
    return (
        (a["lon_min"] <= b["lon_max"]) & (b["lon_min"] <= a["lon_max"]) & (a["lat_min"] <= b["lat_max"]) & (b["lat_min"] <= a["lat_max"])
    )


def widened(bounds: Column, metres: float) -> Column:
    """Bounds with a margin on every side."""
    up = np.degrees(metres / EARTH_M)
    side = F.lit(float(up)) / F.cos(F.radians(F.greatest(F.abs(bounds["lat_min"]), F.abs(bounds["lat_max"]))))
    return F.struct(
        (bounds["lon_min"] - side).alias("lon_min"), (bounds["lat_min"] - float(up)).alias("lat_min"),
        (bounds["lon_max"] + side).alias("lon_max"), (bounds["lat_max"] + float(up)).alias("lat_max"),
    )


def _metres(line, lat0: float, lon0: float) -> np.ndarray:
    """Local plane coordinates."""
    xy = np.array([(p["lon"], p["lat"]) for p in line], float).reshape(-1, 2)
    k = np.radians(1.0) * EARTH_M
    return np.column_stack([(xy[:, 0] - lon0) * k * np.cos(np.radians(lat0)), (xy[:, 1] - lat0) * k])


#: Pairs of segments that are measured at a time.
PAIRS = 1 << 16


def _within(c2, c1, c0, low, high) -> tuple[np.ndarray, np.ndarray]:
    """Where c2 t^2 + c1 t + c0 <= 0 within low..high, for arrays; from 1 to 0 where nowhere. c2 is not negative."""
    with np.errstate(divide="ignore", invalid="ignore"):
        root = np.sqrt(np.maximum(c1 * c1 - 4 * c2 * c0, 0))
        at = -c0 / c1
        flat, level = c2 < 1e-12, np.abs(c1) < 1e-12
        start = np.where(flat, np.where(level | (c1 > 0), low, np.maximum(low, at)), np.maximum(low, (-c1 - root) / (2 * c2)))
        end = np.where(flat, np.where(level | (c1 < 0), high, np.minimum(high, at)), np.minimum(high, (-c1 + root) / (2 * c2)))
    none = np.where(flat, level & (c0 > 0), c1 * c1 < 4 * c2 * c0) | ~(start <= end)
    return np.where(none, 1.0, start), np.where(none, 0.0, end)


def _near_parts(p: np.ndarray, q: np.ndarray, a: np.ndarray, b: np.ndarray, r: float) -> tuple[np.ndarray, np.ndarray]:
    """The part of each segment p-q, as a range of 0..1, that lies within r of each segment a-b, as matrices; from 1 to 0
    where none does."""
    return _parts(p[:, None, :], (q - p)[:, None, :], a[None, :, :], (b - a)[None, :, :], r)


def _parts(p: np.ndarray, u: np.ndarray, a: np.ndarray, v: np.ndarray, r: float) -> tuple[np.ndarray, np.ndarray]:
    """As _near_parts(), of segments from p by u and from a by v, one by one. The set is convex, so that the ranges for
    the round ends and the band between them are one."""
    dot = lambda x, y: (x * y).sum(axis=-1)
    uu, vv = dot(u, u), dot(v, v)
    first, last = np.full(np.broadcast_shapes(uu.shape, vv.shape), 2.0), np.full(np.broadcast_shapes(uu.shape, vv.shape), -1.0)

    def take(start: np.ndarray, end: np.ndarray) -> None:
        some = start <= end
        first[some], last[some] = np.minimum(first, start)[some], np.maximum(last, end)[some]

    for end in (a, a + v):  # the round ends
        w = p - end
        take(*_within(uu + 0 * vv, 2 * dot(u, w), dot(w, w) - r * r, 0.0, 1.0))
    with np.errstate(divide="ignore", invalid="ignore"):
        f0, f1 = dot(p - a, v) / vv, dot(u + 0 * v, v) / vv
        lean = np.abs(f1) >= 1e-12
        t0, t1 = -f0 / f1, (1 - f0) / f1
        low = np.where(lean, np.maximum(0, np.minimum(t0, t1)), np.where((f0 >= 0) & (f0 <= 1), 0.0, 1.0))
        high = np.where(lean, np.minimum(1, np.maximum(t0, t1)), np.where((f0 >= 0) & (f0 <= 1), 1.0, 0.0))
        w0, w1 = (p - a) - f0[..., None] * v, u - f1[..., None] * v
        start, end = _within(dot(w1, w1), 2 * dot(w1, w0), dot(w0, w0) - r * r, low, high)
    band = (vv > 0) & (low <= high)
    take(np.where(band, start, 1.0), np.where(band, end, 0.0))
    return np.where(last >= first, first, 1.0), np.where(last >= first, last, 0.0)


def _segments(line, other) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    lat0, lon0 = line[0]["lat"], line[0]["lon"]
    a, b = _metres(line, lat0, lon0), _metres(other, lat0, lon0)
    return (a[:-1], a[1:], b[:-1], b[1:]) if len(b) > 1 else (a[:-1], a[1:], b, b)


def overlap(line, other, r: float) -> float:
    """Metres of line that lie within r metres of other."""
    if line is None or other is None or len(line) < 2 or len(other) < 1:
        return 0.0
    p, q, a, b = _segments(line, other)
    total, step = 0.0, max(1, PAIRS // len(a))
    for k in range(0, len(p), step):
        start, end = _near_parts(p[k : k + step], q[k : k + step], a, b, r)
        order = np.argsort(start, axis=1)
        start, end = np.take_along_axis(start, order, 1), np.take_along_axis(end, order, 1)
        before = np.maximum.accumulate(np.concatenate([np.zeros((len(end), 1)), end[:, :-1]], axis=1), axis=1)
        covered = np.maximum(0, end - np.maximum(start, before)).sum(axis=1)
        total += float(covered @ np.hypot(*(q[k : k + step] - p[k : k + step]).T))
    return total


def near(line, other, r: float) -> bool | None:
    """Whether two lines come within r metres of each other; null if one is null or empty."""
    if line is None or other is None or not len(line) or not len(other):
        return None
    p, q, a, b = _segments(line if len(line) > 1 else [line[0], line[0]], other)
    step = max(1, PAIRS // len(a))
    for k in range(0, len(p), step):
        start, end = _near_parts(p[k : k + step], q[k : k + step], a, b, r)
        if (start <= end).any():
            return True
    return False


def simplify(line, tolerance: float):
    """Douglas-Peucker: no dropped point is farther than the tolerance (metres) from what stays."""
    if line is None or len(line) < 3:
        return line
    xy = _metres(line, line[0]["lat"], line[0]["lon"])
    stays, todo = np.zeros(len(xy), bool), [(0, len(xy) - 1)]
    stays[[0, -1]] = True
    while todo:
        s, e = todo.pop()
        if e - s < 2:
            continue
        v = xy[e] - xy[s]
        w = xy[s + 1 : e] - xy[s]
        t = np.clip((w @ v) / max(float(v @ v), 1e-12), 0, 1)
        far = np.hypot(*(w - t[:, None] * v).T)
        k = int(np.argmax(far))
        if far[k] > tolerance:
            stays[s + 1 + k] = True
            todo += [(s, s + 1 + k), (s + 1 + k, e)]
    return [p for p, keep in zip(line, stays) if keep]


def _points(lon: pd.Series, lat: pd.Series) -> tuple[np.ndarray, np.ndarray]:
    """(points, starts): the points of lines one after the other; a null line has none."""
    lon, lat = ([np.zeros(0) if x is None else x for x in c] for c in (lon, lat))
    starts = np.concatenate([[0], np.cumsum([len(x) for x in lon], dtype=np.int64)])
    return np.column_stack([np.concatenate([*c, np.zeros(0)]).astype(float) for c in (lon, lat)]), starts


def _pairs(one: tuple, other: tuple, r: float) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(row, segment, metres, start, end) for each segment of a row's line and each of its other line, some rows at a
    time; rows without points have none. A line of one point is a segment of no length."""
    (xy, at), (other_xy, other_at) = one, other
    n, m = np.diff(at), np.diff(other_at)
    some = np.flatnonzero((n > 0) & (m > 0))
    own, theirs = np.maximum(n - 1, 1), np.maximum(m - 1, 1)
    ends, k = np.cumsum(own[some] * theirs[some]), 0
    while k < len(some):
        done = ends[k - 1] if k else 0
        to = max(k + 1, int(np.searchsorted(ends, done + PAIRS, side="right")))
        rows, k = some[k:to], to
        most = max(1, PAIRS // int(theirs[rows].max()))  # segments at a time, should one row have many
        row = np.repeat(rows, own[rows])
        first = at[row] + np.arange(len(row)) - np.repeat(np.cumsum(own[rows]) - own[rows], own[rows])
        for x in range(0, len(row), most if len(rows) == 1 else len(row)):
            seg = slice(x, x + most) if len(rows) == 1 else slice(None)
            of, start = row[seg], first[seg]
            times = theirs[of]
            pair = np.repeat(np.arange(len(of)), times)
            b = other_at[of][pair] + np.arange(len(pair)) - np.repeat(np.cumsum(times) - times, times)
            origin = xy[at[of]]
            scale = np.radians(1.0) * EARTH_M * np.column_stack([np.cos(np.radians(origin[:, 1])), np.ones(len(of))])
            p = (xy[start] - origin) * scale
            u = (xy[np.minimum(start + 1, at[of + 1] - 1)] - origin) * scale - p
            a = (other_xy[b] - origin[pair]) * scale[pair]
            v = (other_xy[np.minimum(b + 1, other_at[of + 1][pair] - 1)] - origin[pair]) * scale[pair] - a
            low, high = _parts(p[pair], u[pair], a, v, r)
            yield of[pair], pair, np.hypot(*u.T)[pair], low, high


def overlaps(one: tuple, other: tuple, r: float) -> np.ndarray:
    """overlap() of each row of lines, as _points() gives them."""
    out = np.zeros(len(one[1]) - 1)
    for row, segment, metres, start, end in _pairs(one, other, r):
        order = np.lexsort((start, segment))
        row, metres, shift = row[order], metres[order], 2.0 * segment[order]  # segments apart, for one pass over all
        start, end = start[order] + shift, end[order] + shift
        before = np.maximum(np.maximum.accumulate(np.concatenate([[0.0], end[:-1]])), shift)
        covered = np.maximum(0, end - np.maximum(start, before))
        out += np.bincount(row, covered * metres, len(out))
    return out


def nears(one: tuple, other: tuple, r: float) -> np.ndarray:
    """near() of each row of lines, as _points() gives them; null where one is null or empty."""
    out = np.zeros(len(one[1]) - 1, bool)
    for row, _, _, start, end in _pairs(one, other, r):
        out[row[start <= end]] = True
    known = (np.diff(one[1]) > 0) & (np.diff(other[1]) > 0)
    return np.where(known, out, None)


def _coordinates(*lines: Column) -> list[Column]:
    of = lambda line, field: F.transform(line, lambda p: p[field])
    return [of(x, field) for x in lines for field in ("lon", "lat")]


def overlap_m(line: Column, other: Column, r: float) -> Column:
    @F.pandas_udf("double")
    def run(lon: pd.Series, lat: pd.Series, other_lon: pd.Series, other_lat: pd.Series) -> pd.Series:
        return pd.Series(overlaps(_points(lon, lat), _points(other_lon, other_lat), r), dtype=float)

    return run(*_coordinates(line, other))


def within_m(line: Column, other: Column, r: float) -> Column:
    """Whether two lines come within r metres of each other."""

    @F.pandas_udf("boolean")
    def run(lon: pd.Series, lat: pd.Series, other_lon: pd.Series, other_lat: pd.Series) -> pd.Series:
        return pd.Series(nears(_points(lon, lat), _points(other_lon, other_lat), r), dtype=object)

    return run(*_coordinates(line, other))


def simplified(line: Column, tolerance: float) -> Column:
    @F.pandas_udf(f"array<{POINT}>")
    def run(a: pd.Series) -> pd.Series:
        return pd.Series([None if x is None else [dict(p) for p in simplify(list(x), tolerance)] for x in a])

    return run(line)
