"""The H3 queries in SQL for DuckDB: points to faces, faces to lattices, lattices to digits, one step of the hierarchy for
each table expression."""

from __future__ import annotations

import math

from fleetlens.functions.h3 import DIGIT, FINEST, FRAMES, UNIT, scale, tables, turned_digits
from fleetlens.functions.scalars import EARTH_M, ROUTE_MODES

SQRT3 = f"{math.sqrt(3)!r}::DOUBLE"


def _doubles(row) -> str:
    return ", ".join(f"{float(x)!r}::DOUBLE" for x in row)


def constants() -> str:
    """Faces with their three directions, and base cells by face and place."""
    t = tables()
    faces = ", ".join(f"({f}, {_doubles([*c, *u, *v])})" for f, (c, u, v) in enumerate(FRAMES))
    known = ", ".join(
        f"({f}, {at // 5 - 2}, {at % 5 - 2}, {t.base[f, at]}, {t.turned[f, at]}, {t.kind[f, at]})" for f in range(len(FRAMES)) for at in range(25)
    )
    return f"""hex_faces(f, cx, cy, cz, ux, uy, uz, wx, wy, wz) AS (VALUES {faces}),
hex_base(f, a, b, base, turned, kind) AS (VALUES {known}),
hex_points AS (
  SELECT latitude, longitude, cos(radians(latitude)) * cos(radians(longitude)) AS px, cos(radians(latitude)) * sin(radians(longitude)) AS py, sin(radians(latitude)) AS pz
  FROM (SELECT DISTINCT latitude, longitude FROM vp WHERE latitude IS NOT NULL AND longitude IS NOT NULL)
), hex_near AS (
  SELECT latitude, longitude, f, (px * ux + py * uy + pz * uz) / (px * cx + py * cy + pz * cz) / {UNIT!r}::DOUBLE AS x,
    (px * wx + py * wy + pz * wz) / (px * cx + py * cy + pz * cz) / {UNIT!r}::DOUBLE AS y
  FROM hex_points, hex_faces QUALIFY row_number() OVER (PARTITION BY latitude, longitude ORDER BY px * cx + py * cy + pz * cz DESC) = 1
)"""


def lattice(name: str, resolution: int) -> str:
    """The lattice point (a, b) that is nearest to each of hex_near."""
    s = scale(resolution)
    x, y = f"(x * {s.real!r}::DOUBLE - y * {s.imag!r}::DOUBLE)", f"(x * {s.imag!r}::DOUBLE + y * {s.real!r}::DOUBLE)"
    return f"""{name}_q AS (SELECT latitude, longitude, f, {x} - {y} / {SQRT3} AS q, {y} * 2 / {SQRT3} AS r FROM hex_near),
{name}_w AS (SELECT *, round_even(q, 0) AS i, round_even(r, 0) AS j, round_even(-q - r, 0) AS k FROM {name}_q),
{name} AS (SELECT latitude, longitude, f, (i2 + j2)::BIGINT AS a, j2::BIGINT AS b FROM (
  SELECT *, CASE WHEN abs(i - q) > abs(j - r) AND abs(i - q) > abs(k + q + r) THEN -j - k ELSE i END AS i2,
    CASE WHEN abs(i - q) > abs(j - r) AND abs(i - q) > abs(k + q + r) THEN j WHEN abs(j - r) > abs(k + q + r) THEN -i - k ELSE j END AS j2
  FROM {name}_w))"""


def ids(name: str, source: str, columns: str, resolution: int) -> str:
    """source with columns, f, a and b as `name` with columns and the id."""
    digits = [DIGIT.get((k // 3 - 1, k % 3 - 1), 0) for k in range(9)]
    steps, last = [], f"{name}_{resolution}"
    steps.append(f"{last} AS (SELECT {columns}, f, a, b, []::BIGINT[] AS d FROM {source})")
    for r in range(resolution, 0, -1):
        if r % 2:
            up, da, db = ("3 * a - b", "a + 2 * b"), "a - 2 * pa - pb", "b + pa - 3 * pb"
        else:
            up, da, db = ("2 * a + b", "3 * b - a"), "a - 3 * pa + pb", "b - pa - 2 * pb"
        pa, pb = (f"floor(({u} + 3) / 7.0::DOUBLE)::BIGINT" for u in up)
        now = f"{name}_{r - 1}"
        steps.append(
            f"{now} AS (SELECT {columns}, f, pa AS a, pb AS b, list_prepend({digits}[({da} + 1) * 3 + ({db} + 1) + 1], d) AS d FROM (SELECT *, {pa} AS pa, {pb} AS pb FROM {last}))"
        )
        last = now
    turns = turned_digits().ravel().tolist()
    rest = 3 * (FINEST - resolution)
    head = (1 << 59) + (resolution << 52) + (1 << rest) - 1
    steps.append(f"""{name}_based AS (
  SELECT {columns}, base, turned, kind, d, {turns}[turned * 7 + coalesce(list_filter(d, lambda x: x > 0)[1], 0) + 1] AS first_digit FROM {last} JOIN hex_base USING (f, a, b)
), {name} AS (
  SELECT {columns}, lower(hex(({head} + base::BIGINT * {1 << 45} + {1 << rest} * list_sum(list_transform(d, lambda x, i: list_extract({turns}, whole_turn * 7 + x + 1) * pow(8, {resolution} - i)))::BIGINT)::BIGINT)) AS cell
  FROM (SELECT *, (turned + CASE WHEN kind > 0 AND first_digit = 1 OR kind = 2 AND first_digit = 5 THEN 1 ELSE 0 END) % 6 AS whole_turn FROM {name}_based)
)""")
    return ",\n".join(steps)


def outlines(resolution: int) -> str:
    """hex_shape: corners of the coarse cells, all of which lie inside a face."""
    s = scale(resolution)
    corners = [complex(math.cos(math.pi / 6 + k * math.pi / 3), math.sin(math.pi / 6 + k * math.pi / 3)) / math.sqrt(3) / s for k in range(6)]
    listed = ", ".join(f"({c.real!r}::DOUBLE, {c.imag!r}::DOUBLE)" for c in corners)
    unit, a, b = 1 / s, "(a0 - b0 / 2.0::DOUBLE)", f"(b0 * {SQRT3} / 2)"
    return f"""hex_corners(dx, dy) AS (VALUES {listed}), hex_flat AS (
  SELECT cell, f0 AS f, {a} * {unit.real!r}::DOUBLE - {b} * {unit.imag!r}::DOUBLE + dx AS p, {a} * {unit.imag!r}::DOUBLE + {b} * {unit.real!r}::DOUBLE + dy AS q
  FROM (SELECT DISTINCT cell, f0, a0, b0 FROM hex_coarse), hex_corners
), hex_solid AS (
  SELECT cell, cx + {UNIT!r}::DOUBLE * (p * ux + q * wx) AS x, cy + {UNIT!r}::DOUBLE * (p * uy + q * wy) AS y, cz + {UNIT!r}::DOUBLE * (p * uz + q * wz) AS z
  FROM hex_flat JOIN hex_faces USING (f)
), hex_shape AS (
  SELECT cell, degrees(atan2(z, sqrt(x * x + y * y))) AS lat, degrees(atan2(y, x)) AS lon FROM hex_solid
)"""


def rings(resolution: int, k: int) -> str:
    """hex_ring: cells within k steps of the coarse cells, and how many of these they are near to."""
    at = f"""hex_ring_at AS (
  SELECT f0 AS f, a0 + i AS a, b0 + j AS b, count(*)::BIGINT AS near FROM (SELECT DISTINCT cell, f0, a0, b0 FROM hex_coarse), range(-{k}, {k + 1}) AS u(i), range(-{k}, {k + 1}) AS w(j)
  WHERE abs(i - j) <= {k} GROUP BY 1, 2, 3
)"""
    return at + ",\n" + ids("hex_ring", "hex_ring_at", "near", resolution)


def views(coarse: int, fine: int) -> str:
    """Ids of all positions' points at two resolutions, and the lattice points of the coarse ones."""
    kept = "coarse_kept AS (SELECT *, f AS f0, a AS a0, b AS b0 FROM coarse_at)"
    found = ids("hex_coarse", "coarse_kept", "latitude, longitude, f0, a0, b0", coarse)
    return ",\n".join([constants(), lattice("coarse_at", coarse), kept, found, lattice("fine_at", fine), ids("hex_fine", "fine_at", "latitude, longitude", fine)])


COARSE, FINE, STEPS = 8, 10, 100
PARENT = f"lower(hex((('0x' || cell)::BIGINT & ~{(15 << 52) | (1 << 21) - 1}::BIGINT) + {(COARSE << 52) + (1 << 21) - 1}::BIGINT))"
SELECTS: dict[str, tuple[str, str, str]] = {  # name: (more tables, SQL, columns of doubles)
    "h3_cells": (
        "",
        f"""SELECT record_id, h.cell, c.cell AS coarse, {PARENT.replace("cell", "h.cell")} AS parent FROM vp
        LEFT JOIN hex_fine h USING (latitude, longitude) LEFT JOIN hex_coarse c USING (latitude, longitude)""",
        "",
    ),
    "sql_functions": (
        "",
        f"""SELECT record_id, h.cell, {PARENT.replace("cell", "h.cell")} AS parent, away AS distance_m,
          CASE WHEN away IS NOT NULL THEN greatest(away - 5000, 0) END AS beyond_m, CASE record_id::BIGINT % 13 {" ".join(f"WHEN {k} THEN '{v}'" for k, v in ROUTE_MODES.items())} END AS mode,
          (speed - 50) / 50 AS change
        FROM (SELECT *, 2.0 * {EARTH_M}::DOUBLE * asin(sqrt(pow(sin((radians(-36.85::DOUBLE) - radians(latitude)) / 2), 2)
          + cos(radians(latitude)) * cos(radians(-36.85::DOUBLE)) * pow(sin((radians(174.76::DOUBLE) - radians(longitude)) / 2), 2))) AS away FROM vp)
        LEFT JOIN hex_fine h USING (latitude, longitude)""",
        "distance_m beyond_m change",
    ),
    "h3_boundary": (
        outlines(COARSE),
        "SELECT cell, count(*)::INTEGER AS corners, min(lon) AS lon_min, min(lat) AS lat_min, max(lon) AS lon_max, max(lat) AS lat_max FROM hex_shape GROUP BY cell",
        "lon_min lat_min lon_max lat_max",
    ),
    "h3_disk": (rings(COARSE, STEPS), "SELECT cell, near FROM hex_ring", ""),
    "agg_position_h3_day": (
        "",
        """SELECT service_date, cell, route_mode, count(*)::BIGINT AS position_count, sum(update_interval_seconds)::BIGINT AS unmonitored_duration_seconds,
          sum(position_delta_m) AS unmonitored_distance_m FROM vehicle JOIN hex_fine USING (latitude, longitude) WHERE is_unmonitored_movement GROUP BY ALL""",
        "unmonitored_distance_m",
    ),
    "agg_speed_h3_hour": (
        "",
        """SELECT cell, route_mode, service_date, hour(timestamp_utc)::BIGINT AS hour_utc, dayname(service_date) AS day_of_week, avg(speed_kmh) AS avg_speed_kmh,
          count(vehicle_id)::BIGINT AS position_count FROM vehicle JOIN hex_coarse USING (latitude, longitude) WHERE route_mode = 'bus' GROUP BY ALL""",
        "avg_speed_kmh",
    ),
}

LAST_28 = "OVER (PARTITION BY {} ORDER BY service_date ROWS BETWEEN 27 PRECEDING AND CURRENT ROW)"
SELECTS["mdl_unmonitored_h3_daily"] = (
    "",
    f"""SELECT *, avg(unmonitored_distance_m) {LAST_28.format("cell, route_mode")} AS rolling_28_day_avg_distance_m, 6::INTEGER AS corners
    FROM ({SELECTS["agg_position_h3_day"][1]})""",
    "unmonitored_distance_m rolling_28_day_avg_distance_m",
)
SELECTS["mdl_speed_h3_hourly"] = (
    "",
    f"""SELECT *, (avg_speed_kmh - avg_speed_kmh_28_day_rolling) / nullif(avg_speed_kmh_28_day_rolling, 0) AS pct_change_from_28_day_avg FROM (
      SELECT *, avg(avg_speed_kmh) {LAST_28.format("cell, hour_utc, route_mode")} AS avg_speed_kmh_28_day_rolling FROM ({SELECTS["agg_speed_h3_hour"][1]}))""",
    "avg_speed_kmh avg_speed_kmh_28_day_rolling pct_change_from_28_day_avg",
)
