"""The hexagonal index against published ids and its own geometry."""

import numpy as np
import pandas as pd
import pytest

from fleetlens.functions import h3

# Published examples of points and their cells.
KNOWN = [
    (37.3615593, -122.0553238, 5, "85283473fffffff"),
    (37.3615593, -122.0553238, 7, "87283472bffffff"),
    (37.7752702151959, -122.418307270836, 9, "8928308280fffff"),
    (37.769377, -122.388903, 9, "89283082e73ffff"),
    (40.689167, -74.044444, 10, "8a2a1072b59ffff"),
]
#: How many cells there are at the coarsest resolutions: two and ten times the powers of seven.
COUNTS = [2 + 120 * 7**r for r in range(4)]


def everywhere(n, seed=1):
    p = np.random.default_rng(seed).normal(size=(n, 3))
    return h3.lat_lon(p / np.linalg.norm(p, axis=1, keepdims=True))


def pentagons(resolution):
    t = h3.tables()
    return [int(h3.encoded(np.array([t.home[p]]), np.array([2 + 0j]), resolution)[0]) for p in np.flatnonzero(t.pentagon)]


def centre(cells):
    face, z, _, _ = h3.located(np.asarray(cells, np.int64))
    return h3.on_sphere(face, z)


def test_published_ids():
    for lat, lon, resolution, cell in KNOWN:
        assert f"{h3.points_to_cells([lat], [lon], resolution)[0]:015x}" == cell
    lat, lon = h3.lat_lon(centre([int("8a2a1072b59ffff", 16)]))
    assert abs(lat[0] - 40.6894218437) < 1e-9 and abs(lon[0] + 74.0444313999) < 1e-9


def test_base_cells():
    t = h3.tables()
    assert len(t.home) == 122 and np.flatnonzero(t.pentagon).tolist() == [4, 14, 24, 38, 49, 58, 63, 72, 83, 97, 107, 117]
    assert (t.base >= 0).all()


@pytest.mark.parametrize("resolution", range(16))
def test_centres_lie_in_their_cells(resolution):
    lat, lon = everywhere(4000, resolution)
    near = []  # many points around pentagons
    draw = np.random.default_rng(resolution)
    for p in centre(pentagons(resolution)):
        near.append(p + draw.normal(size=(150, 3)) * 0.9 * 7 ** (-resolution / 2) * 0.3)
    more = np.concatenate(near)
    la, lo = h3.lat_lon(more / np.linalg.norm(more, axis=1, keepdims=True))
    lat, lon = np.concatenate([lat, la]), np.concatenate([lon, lo])
    cells = h3.points_to_cells(lat, lon, resolution)
    middle = centre(cells)
    again = h3.points_to_cells(*h3.lat_lon(middle), resolution)
    assert (again == cells).all()
    # a point is about as near to its cell's centre as a cell is wide
    p = np.stack([np.cos(np.radians(lat)) * np.cos(np.radians(lon)), np.cos(np.radians(lat)) * np.sin(np.radians(lon)), np.sin(np.radians(lat))], axis=1)
    assert (np.linalg.norm(p - middle, axis=1) < 0.45 * 7 ** (-resolution / 2)).all()
    of_pentagon = h3.tables().pentagon[cells >> 45 & 127]
    for c in cells[of_pentagon].tolist():
        digits = [c >> 3 * (15 - r) & 7 for r in range(1, resolution + 1)]
        assert next((d for d in digits if d), 0) != 1  # the missing sector


@pytest.mark.parametrize("resolution", [0, 1, 2, 3])
def test_all_cells_and_their_neighbours(resolution):
    start = pentagons(resolution)[0]
    seen, ring, near = {start}, [start], {}
    while ring:
        for c in ring:
            near[c] = h3.neighbours(c)
        ring = sorted({n for c in ring for n in near[c]} - seen)
        seen |= set(ring)
    assert len(seen) == COUNTS[resolution]
    assert all(c in near[n] for c in near for n in near[c])
    five = {c for c in near if len(near[c]) == 5}
    assert five == set(pentagons(resolution)) and all(len(near[c]) == 6 for c in near if c not in five)


def test_disks():
    cell = int("8928308280fffff", 16)
    walked, ring = {cell}, {cell}
    for _ in range(6):
        ring = {n for c in ring for n in h3.neighbours(c)} - walked
        walked |= ring
    assert set(h3.disk(cell, 6).tolist()) == walked and len(h3.disk(cell, 100)) == 3 * 100 * 101 + 1
    for p in pentagons(4)[:3]:
        assert len(h3.disk(p, 1)) == 6 and len(h3.disk(p, 3)) == 1 + 5 * (1 + 2 + 3)


@pytest.mark.parametrize("resolution", [2, 5, 8, 9])
def test_outlines(resolution):
    lat, lon = everywhere(300, 7)
    cells = [*np.unique(h3.points_to_cells(lat, lon, resolution)).tolist(), *pentagons(resolution)]
    sizes = set()
    for c in cells:
        la, lo = (np.radians(x) for x in h3.outline(c))
        corners = np.stack([np.cos(la) * np.cos(lo), np.cos(la) * np.sin(lo), np.sin(la)], axis=1)
        middle = centre([c])[0]
        sizes.add(len(corners))
        turn = np.einsum("ij,ij->i", np.cross(corners - middle, np.roll(corners, -1, axis=0) - middle), np.tile(middle, (len(corners), 1)))
        assert (turn > 0).all()  # counter-clockwise around the centre
        inward = corners * 0.98 + middle * 0.02
        inward /= np.linalg.norm(inward, axis=1, keepdims=True)
        assert (h3.points_to_cells(*h3.lat_lon(inward), resolution) == c).all()
    assert {5, 6} <= sizes if resolution % 2 == 0 else {10, 6} <= sizes


def test_columns(spark):
    from pyspark.sql import functions as F

    grid = h3.H3Grid()
    lat, lon = everywhere(400, 3)
    la, lo = h3.lat_lon(np.concatenate([centre(pentagons(9)) * 1.0] * 3) + np.random.default_rng(2).normal(size=(36, 3)) * 1e-3)
    points = [(float(a), float(b)) for a, b in zip([*lat, *la, 90.0, -90.0, 0.0], [*lon, *lo, 0.0, 180.0, -180.0])]
    df = spark.createDataFrame([*points, (None, 1.0), (1.0, None), (float("nan"), 1.0)], "lat double, lon double")
    for resolution in (0, 8, 9, 10, 15):
        got = [r.c for r in df.select(grid.cell(F.col("lat"), F.col("lon"), resolution).alias("c")).collect()]
        want = [f"{x:015x}" for x in h3.points_to_cells(*map(np.array, zip(*points)), resolution)]
        assert got == [*want, None, None, None]
    some = df.select(grid.cell(F.col("lat"), F.col("lon"), 10).alias("c")).limit(50)
    for r in some.select("c", grid.parent(F.col("c"), 8).alias("p"), grid.parent(F.col("c"), 11).alias("none"), grid.boundary(F.col("c")).alias("b"), F.size(grid.disk(F.col("c"), 2)).alias("n"), *[x.alias(n) for n, x in zip(("lat", "lon"), grid.centre(F.col("c")))]).collect():
        n = int(r.c, 16)
        assert r.p == f"{(n & ~(15 << 52) & ~((1 << 21) - 1)) | 8 << 52 | (1 << 21) - 1:015x}" and r.none is None
        assert r.b.startswith("POLYGON((") and r.n == 19
        assert f"{h3.points_to_cells([r.lat], [r.lon], 10)[0]:015x}" == r.c


def test_cells_come_in_batches_and_an_outline_once(spark, monkeypatch):
    from pyspark.sql import functions as F

    plan = spark.range(9).select(h3.H3Grid().cell(F.col("id"), F.col("id"), 10))._jdf.queryExecution().executedPlan().toString()
    assert "ArrowEvalPython" in plan and "transform(" not in plan
    made, outline = [], h3.outline
    monkeypatch.setattr(h3, "outline", lambda c: made.append(c) or outline(c))
    cells = [f"{x:015x}" for x in h3.points_to_cells(*everywhere(2, 5), 10)]
    got = h3._outlines.func(pd.Series([*cells, None] * 4, dtype=object)).tolist()
    assert sorted(made) == sorted(int(c, 16) for c in cells) and got == [*got[:2], None] * 4 and got[0].startswith("POLYGON((")
