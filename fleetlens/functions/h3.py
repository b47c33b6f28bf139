"""H3 cells: the public hexagonal index on an icosahedron, ids as its 15-digit lower-case hexadecimal strings.

A face's plane is the complex plane, in units of the coarsest cells, with axis I at 0 and J at 120 degrees; its corners are
2, 2 w^2 and 2 w^4 for w = exp(i pi / 3). Finer cells are the lattice a + b w^2 after multiplication by 2 - w^2 at odd and
by 3 + w^2 at even resolutions. Neighbouring faces are unfolded into each other by a turn of 60 degree steps about two
shared corners, which maps every lattice onto itself; so all that is tabled, base cells, their turns on each face and the
five faces around a pentagon, follows from the twenty face centres and axes.

parent() is a native column. Cells, of many points at once, and outlines and disks, many values for each cell, are worked out
in Arrow batches.
"""

from __future__ import annotations

import math
from functools import cache
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed values of the index: latitude, longitude of each face's centre, and the azimuth of its axis I, in radians.
FACES = (
    (0.803582649718989942, 1.248397419617396099, 5.619958268523939882),
    (1.307747883455638156, 2.536945009877921159, 5.760339081714187279),
    (1.054751253523952054, -1.347517358900396623, 0.780213654393430055),
    (0.600191595538186799, -0.450603909469755746, 0.430469363979999913),
    (0.491715428198773866, 0.401988202911306943, 6.130269123335111400),
    (0.172745327415618701, 1.678146885280433686, 2.692877706530642877),
    (0.605929321571350690, 2.953923329812411617, 2.982963003477243874),
    (0.427370518328979641, -1.888876200336285401, 3.532912002790141181),
    (-0.079066118549212831, -0.733429513380867741, 3.494305004259568154),
    (-0.230961644455383637, 0.506495587332349035, 3.003214169499538391),
    (0.079066118549212831, 2.408163140208925497, 5.930472956509811562),
    (0.230961644455383637, -2.635097066257444203, 0.138378484090254847),
    (-0.172745327415618701, -1.463445768309359553, 0.448714947059150361),
    (-0.605929321571350690, -0.187669323777381622, 0.158629650112549365),
    (-0.427370518328979641, 1.252716453253507838, 5.891865957979238535),
    (-0.600191595538186799, 2.690988744120037492, 2.711123289609793325),
    (-0.491715428198773866, -2.739604450678486295, 3.294508837434268316),
    (-0.803582649718989942, -1.893195233972397139, 3.804819692245439833),
    (-1.307747883455638156, -0.604647643711872080, 3.664438879055192436),
    (-1.054751253523952054, 1.794075294689396615, 2.361378999196363184),
)
#: Length of a plane's unit where the sphere has radius one, and the turn of odd resolutions.
UNIT, TURN = 0.38196601125010500003, 0.333473172251832115336090755351601070065900389
# Faces that base cells on an edge or a corner belong to.
EDGE_HOMES = {"IJ": (0, 1, 2, 3, 4, 10, 11, 12, 13, 14), "JK": (0, 1, 2, 3, 4, 15, 16, 17, 18, 19), "IK": (5, 6, 7, 8, 9, 15, 16, 17, 18, 19)}
PENTAGON_HOMES = (0, 5, 6, 7, 8, 9, 10, 11, 12, 13, 14, 19)
FINEST = 15

W = np.exp(1j * np.pi / 3) ** np.arange(6)
CORNERS = (2 * W[0], 2 * W[2], 2 * W[4])
#: Directions of the edges IJ, JK and IK, which are one unit off the centre, and the corners that they join.
EDGES = ((W[1], 0, 1), (W[3], 1, 2), (W[5], 0, 2))
#: Steps of the seven digits as (a, b); a digit's turn by 60 degrees to the left.
STEPS = ((0, 0), (-1, -1), (0, 1), (-1, 0), (1, 0), (0, -1), (1, 1))
LEFT = (0, 5, 3, 1, 6, 4, 2)
DIGIT = {s: d for d, s in enumerate(STEPS)}
EPS = 1e-9


def scale(resolution: int) -> complex:
    """What a plane's points are multiplied with to give lattice points."""
    return complex(7 ** (resolution / 2) * np.exp(-1j * TURN * (resolution % 2)))


def frame(face: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A face's centre, its axis I, and the direction a quarter turn to the left of it."""
    lat, lon, azimuth = FACES[face]
    north = np.array([-math.sin(lat) * math.cos(lon), -math.sin(lat) * math.sin(lon), math.cos(lat)])
    east = np.array([-math.sin(lon), math.cos(lon), 0.0])
    toward = lambda a: math.cos(a) * north + math.sin(a) * east
    return np.array([math.cos(lat) * math.cos(lon), math.cos(lat) * math.sin(lon), math.sin(lat)]), toward(azimuth), toward(azimuth - math.pi / 2)


FRAMES = np.array([frame(f) for f in range(len(FACES))])


def on_sphere(face, z) -> np.ndarray:
    """Unit vectors of points of faces' planes."""
    f, z = np.asarray(face), np.asarray(z)
    p = FRAMES[f, 0] + UNIT * (z.real[..., None] * FRAMES[f, 1] + z.imag[..., None] * FRAMES[f, 2])
    return p / np.linalg.norm(p, axis=-1, keepdims=True)


class Tables(NamedTuple):
    #: For each face and edge: the face behind it, and turn and shift of the plane: z there is W[turn] * z + shift.
    behind: np.ndarray
    turns: np.ndarray
    shifts: np.ndarray
    #: For each base cell: its face, its place (a, b) there, and whether it is a pentagon.
    home: np.ndarray
    place: np.ndarray
    pentagon: np.ndarray
    #: For each face and place (a + 2) * 5 + b + 2: base cell, turns to its face, and kind: 0 hexagon, 1 pentagon,
    #: 2 pentagon on the face beside its missing sector. -1 where no cell is.
    base: np.ndarray
    turned: np.ndarray
    kind: np.ndarray
    #: For each pentagon base cell and sector, 60 degrees each, of its own plane: face, turn and shift.
    sectors: dict


def _near(a, b) -> bool:
    return abs(a - b) < 1e-6


@cache
def tables() -> Tables:
    n = len(FACES)
    corners = [[on_sphere(f, c) for c in CORNERS] for f in range(n)]
    same = lambda p, q: np.dot(p, q) > 1 - 1e-6
    behind, turns, shifts = np.zeros((n, 3), int), np.zeros((n, 3), int), np.zeros((n, 3), complex)
    for f in range(n):
        for e, (_, s, t) in enumerate(EDGES):
            for g in range(n):
                at = [[k for k in range(3) if same(corners[g][k], corners[f][c])] for c in (s, t)]
                if g != f and all(at):
                    (gs, gt) = CORNERS[at[0][0]], CORNERS[at[1][0]]
                    turn = int(round(np.angle((gt - gs) / (CORNERS[t] - CORNERS[s])) / (np.pi / 3))) % 6
                    behind[f, e], turns[f, e], shifts[f, e] = g, turn, gs - W[turn] * CORNERS[s]
    cells = [(f, 0, 0) for f in range(n)] + [(f, *s) for f in range(n) for s in ((1, 0), (0, 1), (-1, -1))]
    for name, place in (("IJ", (1, 1)), ("JK", (-1, 0)), ("IK", (0, -1))):
        cells += [(f, *place) for f in EDGE_HOMES[name]]
    cells += [(f, 2, 0) for f in PENTAGON_HOMES]
    points = [on_sphere(f, a + b * W[2]) for f, a, b in cells]
    order = sorted(range(len(cells)), key=lambda k: -points[k][2])  # from north to south
    cells, points = [cells[k] for k in order], np.array([points[k] for k in order])
    home, place = np.array([c[0] for c in cells]), np.array([c[1:] for c in cells])
    pentagon = (place == (2, 0)).all(axis=1)
    base, turned, kind = (np.full((n, 25), v) for v in (-1, 0, 0))
    for f in range(n):
        for a in range(-2, 3):
            for b in range(-2, 3):
                z, g, turn = a + b * W[2], f, 0
                for _ in range(2):
                    out = [(z * np.conj(d)).real for d, *_ in EDGES]
                    e = int(np.argmax(out))
                    if out[e] > 1 + 1e-6:
                        g, turn, z = behind[g, e], turn + turns[g, e], W[turns[g, e]] * z + shifts[g, e]
                found = int(np.argmax(points @ on_sphere(g, z)))
                if not same(points[found], on_sphere(g, z)) or max((z * np.conj(d)).real for d, *_ in EDGES) > 1 + 1e-6:
                    continue
                at = (a + 2) * 5 + b + 2
                h, own = home[found], place[found][0] + place[found][1] * W[2]
                if pentagon[found]:
                    base[f, at] = found
                elif h == g and _near(z, own):
                    base[f, at], turned[f, at] = found, turn % 6
                else:
                    for e in range(3):
                        if behind[g, e] == h and _near(W[turns[g, e]] * z + shifts[g, e], own):
                            base[f, at], turned[f, at] = found, (turn + turns[g, e]) % 6
    sectors = {}
    for p in np.flatnonzero(pentagon):
        # from the pentagon's own face, at 180 degrees, across IJ to 120, 60 and 0 degrees; and across IK to 240
        chain = {3: (home[p], 0, 0j)}
        for step, first in ((-1, 0), (1, 2)):
            at, sector = chain[3], 3
            while sector != (0 if step < 0 else 4):
                g, turn, shift = at
                here = W[turn] * 2 + shift  # the pentagon on g
                border = W[turn] * np.exp(1j * (sector + step / 2) * np.pi / 3)  # between the sectors
                ends = [(k, CORNERS[x], CORNERS[y]) for k, (_, s, t) in enumerate(EDGES) for x, y in ((s, t), (t, s))]
                e = next(k for k, x, y in ends if _near(x, here) and _near((y - x) / abs(y - x), border))
                at = (behind[g, e], (turn + turns[g, e]) % 6, W[turns[g, e]] * shift + shifts[g, e])
                sector += step
                chain[sector] = at
        sectors[int(p)] = chain
        for sector, (g, turn, shift) in chain.items():
            here = W[turn] * 2 + shift
            b = int(round(here.imag / W[2].imag))
            at = (int(round((here - b * W[2]).real)) + 2) * 5 + b + 2
            base[g, at], turned[g, at], kind[g, at] = p, -turn % 6, 2 if sector == 4 else 1
    return Tables(behind, turns, shifts, home, place, pentagon, base, turned, kind, sectors)


# lattices ------------------------------------------------------------------------------------------------------------


def rounded(z: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The lattice points (a, b) that are nearest."""
    r = z.imag / W[2].imag
    q = z.real - z.imag / math.sqrt(3)  # at 60 degrees: z = q + r w
    s = -q - r
    iq, ir, is_ = np.rint(q), np.rint(r), np.rint(s)
    dq, dr, ds = abs(iq - q), abs(ir - r), abs(is_ - s)
    iq, ir = np.where((dq > dr) & (dq > ds), -ir - is_, iq), np.where((dq <= dr) | (dq <= ds), np.where(dr > ds, -iq - is_, ir), ir)
    return (iq + ir).astype(np.int64), ir.astype(np.int64)


def settled(face: np.ndarray, z: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Points on the faces that they lie on, where they are beyond the edges of the given ones."""
    t, face, z = tables(), face.copy(), z.copy()
    for _ in range(4):
        out = np.stack([(z * np.conj(d)).real for d, *_ in EDGES])
        e = np.argmax(out, axis=0)
        over = np.take_along_axis(out, e[None], 0)[0] > 1 + EPS
        if not over.any():
            break
        f, k = face[over], e[over]
        z[over] = W[t.turns[f, k]] * z[over] + t.shifts[f, k]
        face[over] = t.behind[f, k]
    return face, z


def encoded(face: np.ndarray, z: np.ndarray, resolution: int) -> np.ndarray:
    """Ids of the cells of points on faces' planes."""
    t = tables()
    a, b = rounded(z * scale(resolution))
    digits, level = np.zeros(len(a), np.int64), []
    lookup = np.full(9, -1)
    for (da, db), d in DIGIT.items():
        lookup[(da + 1) * 3 + db + 1] = d
    for r in range(resolution, 0, -1):
        if r % 2:
            pa, pb = (3 * a - b + 3) // 7, (a + 2 * b + 3) // 7
            da, db = a - 2 * pa - pb, b + pa - 3 * pb
        else:
            pa, pb = (2 * a + b + 3) // 7, (3 * b - a + 3) // 7
            da, db = a - 3 * pa + pb, b - pa - 2 * pb
        level.append(lookup[(da + 1) * 3 + db + 1])
        a, b = pa, pb
    at = (a + 2) * 5 + b + 2
    base, turned, kind = t.base[face, at], t.turned[face, at], t.kind[face, at]
    leading = np.zeros(len(a), np.int64)
    for d in level:  # from the finest up, so the coarsest that is not zero stays
        leading = np.where(d > 0, d, leading)
    turn_of = turned_digits()
    first = turn_of[turned, leading]
    turned = (turned + ((kind > 0) & (first == 1) | (kind == 2) & (first == 5))) % 6
    for r, d in zip(range(resolution, 0, -1), level):
        digits |= turn_of[turned, d] << (3 * (FINEST - r))
    rest = (1 << 3 * (FINEST - resolution)) - 1
    return (1 << 59) | (resolution << 52) | (base.astype(np.int64) << 45) | digits | rest


@cache
def turned_digits() -> np.ndarray:
    out = np.zeros((6, 7), np.int64)
    out[0] = np.arange(7)
    for k in range(1, 6):
        out[k] = np.array(LEFT)[out[k - 1]]
    return out


def located(cells: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(face, centre on its plane, resolution, pentagon base cell or -1) of cells, on the faces that the centres lie on.

    A cell of a pentagon's base cell lies in one of five sectors around it, which its plane has on one side of the
    missing one or the other.
    """
    t = tables()
    resolution, base = (cells >> 52) & 15, (cells >> 45) & 127
    z = t.place[base] @ np.array([1, W[2]]) * np.ones(len(cells), complex)
    centre = z.copy()
    of_pentagon = t.pentagon[base]
    leading, digits = np.zeros(len(cells), np.int64), []
    for r in range(1, FINEST + 1):
        d = np.where(r <= resolution, (cells >> (3 * (FINEST - r))) & 7, 0)
        digits.append(d)
        leading = np.where((leading == 0) & (d > 0), d, leading)
    right = np.where(of_pentagon & (leading == 5), 5, 0)  # to the missing sector's other side
    steps = np.array(STEPS) @ np.array([1, W[2]])
    for r, d in enumerate(digits, 1):
        z += steps[turned_digits()[right, d]] / scale(r)
    face = t.home[base]
    away = np.where(abs(z - centre) < 1e-12, -1, z - centre)
    sector = np.rint(np.angle(away) / (np.pi / 3)).astype(int) % 6
    for p in np.unique(base[of_pentagon]):
        own = base == p
        gap = own & (sector == 5)  # beyond the last sector on either side: it goes on at the other end
        z[gap] = centre[gap] + np.where(leading[gap] == 5, W[1], W[5]) * (z[gap] - centre[gap])
        sector[gap] = np.where(leading[gap] == 5, 0, 4)
        for s, (g, turn, shift) in t.sectors[int(p)].items():
            here = own & (sector == s)
            face[here], z[here] = g, W[turn] * z[here] + shift
    plain = ~of_pentagon
    face[plain], z[plain] = settled(face[plain], z[plain])
    return face, z, resolution, np.where(of_pentagon, base, -1)


def lat_lon(p: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return np.degrees(np.arcsin(np.clip(p[..., 2], -1, 1))), np.degrees(np.arctan2(p[..., 1], p[..., 0]))


def points_to_cells(lat: np.ndarray, lon: np.ndarray, resolution: int) -> np.ndarray:
    """Ids of the cells of points in degrees."""
    la, lo = np.radians(np.asarray(lat, float)), np.radians(np.asarray(lon, float))
    p = np.stack([np.cos(la) * np.cos(lo), np.cos(la) * np.sin(lo), np.sin(la)], axis=-1)
    face = np.argmax(p @ FRAMES[:, 0].T, axis=1)
    own = FRAMES[face]
    depth = (p * own[:, 0]).sum(axis=1) * UNIT
    return encoded(face, ((p * own[:, 1]).sum(axis=1) + 1j * (p * own[:, 2]).sum(axis=1)) / depth, resolution)


def neighbours(cell: int) -> list[int]:
    """The six cells around a cell, or five around a pentagon."""
    (face,), (z,), (resolution,), _ = located(np.array([cell]))
    around = z + W / scale(int(resolution))
    corner = next((c for c in CORNERS if _near(c, z)), None)
    if corner is not None:  # a pentagon: only those of each of its five faces, by its sectors
        p = int(cell >> 45 & 127)
        found = []
        for g, turn, shift in tables().sectors[p].values():
            here = W[turn] * 2 + shift
            own = here + W / scale(int(resolution))
            inside = [x for x in own if max((x * np.conj(d)).real for d, *_ in EDGES) <= 1 + EPS]
            found += encoded(np.full(len(inside), g), np.array(inside), int(resolution)).tolist()
        return sorted(set(found))
    return sorted(set(encoded(*settled(np.full(6, face), around), int(resolution)).tolist()) - {cell})


def disk(cell: int, k: int) -> np.ndarray:
    """Ids of all cells at most k steps away.

    Far from pentagons the disk is a hexagon of the unfolded plane; one that may reach a pentagon is walked ring by ring.
    """
    (face,), (z,), (resolution,), _ = located(np.array([cell]))
    s = scale(int(resolution))
    if min(abs(z - c) for c in CORNERS) * abs(s) <= k + 2:
        seen, ring = {cell}, {cell}
        for _ in range(k):
            ring = {n for c in ring for n in neighbours(c)} - seen
            seen |= ring
        return np.array(sorted(seen), np.int64)
    i, j = np.meshgrid(np.arange(-k, k + 1), np.arange(-k, k + 1), indexing="ij")
    near = abs(i - j) <= k
    around = z + (i[near] + j[near] * W[2]) / s
    return np.sort(encoded(*settled(np.full(len(around), face), around), int(resolution)))


def outline(cell: int) -> tuple[np.ndarray, np.ndarray]:
    """(lat, lon) of a cell's corners, counter-clockwise; at odd resolutions also of the places where its edges cross an
    edge of the icosahedron."""
    (face,), (z,), (resolution,), _ = located(np.array([cell]))
    s = scale(int(resolution))
    reach = np.exp(1j * np.pi / 6) * W / math.sqrt(3) / s
    if any(_near(c, z) for c in CORNERS):
        parts = []
        for g, turn, shift in (tables().sectors[int(cell >> 45 & 127)][k] for k in (0, 1, 2, 3, 4)):
            here = W[turn] * 2 + shift
            toward = -here / abs(here)
            turns = np.angle(reach / toward)
            own = sorted((x for x in range(6) if abs(turns[x]) < np.pi / 6 + 1e-6), key=lambda x: turns[x])
            pieces = [here + reach[x] for x in own]
            if resolution % 2:  # the place where the edge leaves this face
                last, nxt = own[-1], (own[-1] + 1) % 6
                pieces.append(_crossing(here + reach[last], here + reach[nxt]))
            parts += [on_sphere(g, p) for p in pieces]
        return lat_lon(_distinct(np.array(parts)))
    corners, points = z + reach, []
    faces, settled_z = settled(np.full(6, face), corners)
    inside = [max((c * np.conj(d)).real for d, *_ in EDGES) <= 1 + EPS for c in corners]
    for k in range(6):
        points.append(on_sphere(faces[k], settled_z[k]))
        if resolution % 2 and inside[k] != inside[(k + 1) % 6]:
            points.append(on_sphere(face, _crossing(corners[k], corners[(k + 1) % 6])))
    return lat_lon(_distinct(np.array(points)))


def _crossing(a: complex, b: complex) -> complex:
    """Where the way from a to b crosses the edge that lies between them."""
    for d, *_ in EDGES:
        x, y = (a * np.conj(d)).real - 1, (b * np.conj(d)).real - 1
        if min(x, y) <= EPS and max(x, y) > EPS:
            return a + (b - a) * x / (x - y)
    return b


def _distinct(points: np.ndarray) -> np.ndarray:
    """Points of a ring without those that repeat the one before."""
    apart = np.linalg.norm(points - np.roll(points, 1, axis=0), axis=1) > 1e-12
    return points[apart]


# columns -------------------------------------------------------------------------------------------------------------


def _let(value: Column, use) -> Column:
    """use(value), where the value is worked out once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _number(cell: Column) -> Column:
    return F.conv(cell, 16, 10).cast("long")


def _text(number: Column) -> Column:
    return F.lower(F.hex(number))


class H3Grid:
    """H3 cells behind the provider interface of fleetlens.functions.grid."""

    def cell(self, lat: Column, lon: Column, resolution: int) -> Column:
        """The id of the cell of a point in degrees; null if either is null or not a finite number."""
        if not 0 <= resolution <= FINEST:
            raise ValueError("resolutions go from 0 to 15")

        @F.pandas_udf(T.StringType())
        def cells(lat: pd.Series, lon: pd.Series) -> pd.Series:
            out = pd.Series([None] * len(lat), dtype=object)
            there = np.isfinite((lat + lon).to_numpy(float))
            if there.any():
                out[there] = [f"{x:015x}" for x in points_to_cells(lat[there], lon[there], resolution).tolist()]
            return out

        return cells(lat.cast("double"), lon.cast("double"))

    def parent(self, cell: Column, resolution: int) -> Column:
        """The cell of a coarser resolution whose digits a cell begins with; null for a finer one."""
        rest = (1 << 3 * (FINEST - resolution)) - 1
        kept = lambda n: n.bitwiseAND(F.lit(~((15 << 52) | rest) & ((1 << 63) - 1))) + F.lit((resolution << 52) | rest)
        return _let(_number(cell), lambda n: F.when(F.shiftright(n, 52).bitwiseAND(F.lit(15)) >= resolution, _text(kept(n))))

    def centre(self, cell: Column) -> tuple[Column, Column]:
        """(lat, lon)."""
        found = _centres(cell)
        return found["lat"], found["lon"]

    def boundary(self, cell: Column) -> Column:
        """The corners and the first again, as a WKT polygon of lon lat."""
        return _outlines(cell)

    def disk(self, cell: Column, k: int) -> Column:
        """All cells at most k steps away."""

        @F.pandas_udf(T.ArrayType(T.StringType()))
        def disks(cells: pd.Series) -> pd.Series:
            return cells.map(lambda c: [f"{x:015x}" for x in disk(int(c, 16), k).tolist()] if c else None)

        return disks(cell)


@F.pandas_udf(T.StructType([T.StructField("lat", T.DoubleType()), T.StructField("lon", T.DoubleType())]))
def _centres(cells: pd.Series) -> pd.DataFrame:
    out = pd.DataFrame({"lat": np.full(len(cells), np.nan), "lon": np.full(len(cells), np.nan)}, dtype="Float64")
    there = cells.notna().to_numpy()
    out[:] = None
    if there.any():
        face, z, _, _ = located(np.array([int(c, 16) for c in cells[there]], np.int64))
        lat, lon = lat_lon(on_sphere(face, z))
        out.loc[there, "lat"], out.loc[there, "lon"] = lat, lon
    return out


@F.pandas_udf(T.StringType())
def _outlines(cells: pd.Series) -> pd.Series:
    def polygon(c: str) -> str:
        lat, lon = outline(int(c, 16))
        return "POLYGON((" + ", ".join(f"{x:.12f} {y:.12f}" for x, y in zip([*lon, lon[0]], [*lat, lat[0]])) + "))"

    known = {c: polygon(c) for c in cells.unique() if c}  # rows of one cell follow each other
    return cells.map(known.get)
