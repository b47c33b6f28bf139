"""Scalar expressions with the semantics that the transit models need. All of them are native columns."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_M = 6_371_010.0

# Transport modes by their code in feeds.
ROUTE_MODES = {
    0: "tram", 1: "subway", 2: "rail", 3: "bus", 4: "ferry", 5: "cable_tram", 6: "aerial_lift", 7: "funicular",
    11: "trolleybus", 12: "monorail",
}


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def at_least_zero(x) -> Column:
    """The larger of x and 0; null for null, unlike greatest()."""
    return F.when(_c(x).isNotNull(), F.greatest(_c(x), F.lit(0)))


def greatest_or_null(*xs) -> Column:
    """The greatest; null if any is null."""
    any_null = reduce(lambda a, b: a | b, [_c(x).isNull() for x in xs])
    return F.when(~any_null, F.greatest(*[_c(x) for x in xs]))


def ratio(a, b) -> Column:
    """a / b, null where b is 0 or null."""
    return F.try_divide(_c(a), _c(b))


def seconds_between(later, earlier) -> Column:
    """Whole seconds from earlier to later, cut towards zero."""
    return F.timestamp_diff("SECOND", _c(earlier), _c(later))


def distance_m(lat1, lon1, lat2, lon2, radius: float = EARTH_M) -> Column:
    """Great-circle metres by the haversine formula; null if a coordinate is."""
    p1, p2 = F.radians(_c(lat1)), F.radians(_c(lat2))
    a = F.pow(F.sin((p2 - p1) / 2), F.lit(2.0)) + F.cos(p1) * F.cos(p2) * F.pow(
        F.sin((F.radians(_c(lon2)) - F.radians(_c(lon1))) / 2), F.lit(2.0)
    )
    return F.lit(2.0 * radius) * F.asin(F.sqrt(F.when(a > 1, F.lit(1.0)).otherwise(a)))  # least() would skip a null


def route_mode(code) -> Column:
    """The mode's name; null for other codes."""
    table = F.create_map(*[F.lit(x) for kv in ROUTE_MODES.items() for x in kv])
    return F.try_element_at(table, _c(code).cast("int"))


def local_time(ts, zone) -> Column:
    """The wall clock of an instant in a zone."""
    zone = _c(zone) if isinstance(zone, Column) else F.lit(zone)
    return F.convert_timezone(F.lit("UTC"), zone, _c(ts).cast("timestamp_ntz"))


def service_date(local, boundary_hour) -> Column:
    """The date of a wall clock whose day starts at the boundary hour."""
    hour = boundary_hour if isinstance(boundary_hour, Column) else F.lit(boundary_hour)
    return F.to_date(_c(local) - F.make_dt_interval(F.lit(0), hour.cast("int")))


def clock_to_utc(day, clock, zone: str) -> Column:
    """The instant of "HH:MM:SS", which may pass 24 hours, on the wall clock of a day; null if blank.

    In the hour that a zone repeats in autumn the standard, later reading is taken.
    """
    c = _c(clock)
    part = F.split(F.trim(c), ":")
    seconds = part[0].cast("int") * 3600 + part[1].cast("int") * 60 + part[2].cast("int")
    wall = _c(day).cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), seconds.cast("decimal(18,6)"))
    first = F.convert_timezone(F.lit(zone), F.lit("UTC"), wall)
    later = first + F.expr("interval 1 hour")
    same = F.convert_timezone(F.lit("UTC"), F.lit(zone), later) == wall
    return F.when(c.isNotNull() & (F.trim(c) != ""), F.when(same, later).otherwise(first).cast("timestamp"))


def hash_id(*columns, length: int = 16) -> Column:
    """The first hex digits of an md5 over columns as text. Nulls and boundaries between values count."""
    parts = [F.coalesce(_c(c).cast("string"), F.lit("∅")) for c in columns]
    return F.substring(F.md5(F.concat_ws("\u001f", *parts)), 1, length)


def epoch_to_timestamp(seconds) -> Column:
    """Seconds since 1970, of any type, as an instant; null if it is no number."""
    return F.timestamp_seconds(_c(seconds).try_cast("double"))


def whole_number(x) -> Column:
    """A long; null for fractions and for what is no number."""
    d = _c(x).try_cast("double")
    return F.when(d % 1 == 0, d.cast("long"))


def rounded(x, digits: int) -> Column:
    """Half to even."""
    return F.bround(_c(x).try_cast("double"), digits)


def labelled(x, labels: dict[int, str]) -> Column:
    """The label of a code; null for any other value."""
    table = F.create_map(*[F.lit(v) for kv in labels.items() for v in kv])
    return F.try_element_at(table, whole_number(x).cast("int"))


def second(ts) -> Column:
    """An instant cut to the second; null if it can't be read."""
    return F.date_trunc("SECOND", _c(ts).try_cast("timestamp"))
