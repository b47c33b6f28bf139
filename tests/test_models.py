"""The traps of the models, on rows made by hand."""

import datetime as dt

import pytest
from conftest import rows
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from fleetlens.functions import rolling, scalars
from fleetlens.functions.grid import HexGrid
from fleetlens.plans import models as m
from fleetlens.plans import serving as s


def ts(text):
    return dt.datetime.fromisoformat(text)


@pytest.fixture(scope="module")
def region(spark):
    return spark.createDataFrame([("nz", "Pacific/Auckland", 4)], "region_prefix string, timezone string, svc_boundary_hour long")


@pytest.fixture(scope="module")
def dims(spark):
    routes = spark.createDataFrame([("R1", 3, "bus"), ("R2", 2, "rail")], "route_id string, route_type long, route_mode string")
    return routes, spark.createDataFrame([("T1", 0)], "trip_id string, direction_id long")


PINGS = "record_id string, vehicle_id string, timestamp timestamp, latitude double, longitude double, speed double, bearing double, occupancy_status string, route_id string, trip_id string"


def ping(n, vehicle, at, lat, lon, route="R1"):
    return (str(n), vehicle, ts(at), lat, lon, 10.0, 0.0, None, route, "T1")


def test_unmonitored_needs_gap_and_distance(spark, region, dims):
    degree = 1 / 111194.9
    at = "2024-01-01T00:{}+00:00"
    pings = [
        ping(1, "v", at.format("00:00"), 0.0, 0.0), ping(2, "v", at.format("01:00"), 10 * degree, 0.0),
        ping(3, "v", at.format("03:01"), 70 * degree, 0.0), ping(4, "v", at.format("06:40"), 70 * degree, 0.0), ping(5, "v", at.format("16:40"), None, 0.0),
    ]
    got = m.fct_vehicle_position(spark.createDataFrame(pings, PINGS), *dims, region).orderBy("record_id").collect()
    assert [r.update_interval_seconds for r in got] == [None, 60, 121, 219, 600]
    assert [r.is_unmonitored_movement for r in got] == [None, False, True, False, None]
    assert round(got[2].position_delta_m) == 60 and got[4].position_delta_m is None
    detail = m.mdl_unmonitored_detail(m.fct_vehicle_position(spark.createDataFrame(pings, PINGS), *dims, region))
    assert [r.gap_seconds for r in detail.collect()] == [121]


def test_service_day_starts_at_the_boundary_hour(spark, region, dims):
    pings = [ping(1, "a", "2024-01-01T14:59:00+00:00", 0.0, 0.0), ping(2, "a", "2024-01-01T15:00:00+00:00", 0.0, 0.0)]  # 03:59 and 04:00 local
    got = m.fct_vehicle_position(spark.createDataFrame(pings, PINGS), *dims, region).orderBy("record_id").collect()
    assert [str(r.service_date) for r in got] == ["2024-01-01", "2024-01-02"]
    assert [r.hour_local for r in got] == [3, 4]


def test_mode_is_filled_by_day_or_forward(spark, region, dims):
    at = "2024-01-01T0{}:00:00+00:00"
    pings = spark.createDataFrame([ping(n, "a", at.format(n), 0.0, 0.0, r) for n, r in enumerate([None, "R2", None, "R1"])], PINGS)
    assert [r.route_mode for r in m.fct_vehicle_position(pings, *dims, region).collect()] == ["rail"] * 4
    got = m.v2_fct_vehicle_position(pings, dims[0], region).orderBy("record_id").collect()
    assert [r.route_mode for r in got] == [None, "rail", "rail", "bus"]


def test_feeds_tile_the_timeline(spark):
    feeds = spark.createDataFrame(
        [("a", "p", "1", 20240101, 20241231, ts("2024-01-01T00:00:00")), ("b", "p", "2", 20240101, 20241231, ts("2024-01-02T00:00:00")),
         ("c", "p", "3", 20240301, 20241231, ts("2024-02-01T00:00:00")), ("d", "p", "4", None, None, ts("2024-02-01T00:00:00"))],
        "feed_hash string, feed_publisher_name string, feed_version string, feed_start_date long, feed_end_date long, created_at timestamp",
    )
    got = {r.feed_hash: (str(r.effective_to_date), r.is_current) for r in m.dim_feed(feeds).collect()}
    assert got == {"b": ("2024-02-29", False), "c": ("None", True)}


def test_active_services(spark):
    days = ["monday", "tuesday", "wednesday", "thursday", "friday", "saturday", "sunday"]
    calendar = spark.createDataFrame(
        [("f", "A", *[1] * 7, 20240101, 20240131), ("f", "B", *[1] * 7, 20240101, 20240131), ("f", "old", *[1] * 7, 20230101, 20230131)],
        ["feed_hash", "service_id", *days, "start_date", "end_date"],
    )
    dates = spark.createDataFrame([("f", "B", 20240102, 2), ("f", "C", 20240102, 1)], "feed_hash string, service_id string, date long, exception_type long")
    assert rows(m.active_services(calendar, dates, 20240102, "tuesday")) == [("f", "A"), ("f", "C")]
    assert rows(m.active_services(calendar, dates, 20240103, "wednesday")) == [("f", "A"), ("f", "B")]


@pytest.mark.parametrize(
    "day, clock, want",
    [
        ("2024-01-01", "25:10:00", "2024-01-01T12:10:00"),  # thirteen hours ahead, past midnight
        ("2025-04-06", "02:30:00", "2025-04-05T14:30:00"),  # comes twice; the standard reading
        ("2025-04-06", "01:30:00", "2025-04-05T12:30:00"),
        ("2024-07-01", "08:00:00", "2024-06-30T20:00:00"),
        ("2024-07-01", " ", None), ("2024-07-01", None, None),
    ],
)
def test_clocks(spark, day, clock, want):
    df = spark.createDataFrame([(day, clock)], "d string, c string")
    got = df.select(scalars.clock_to_utc(F.col("d").cast("date"), "c", "Pacific/Auckland").cast("timestamp_ntz")).first()[0]
    assert got == (ts(want) if want else None)


UPDATES = (
    "trip_id string, start_date string, stop_id string, stop_sequence long, vehicle_id string, record_id string, entity_id string, schedule_relationship string, "
    "rt_timestamp timestamp, actual_arrival timestamp, actual_departure timestamp, arrival_delay long, departure_delay long, arrival_uncertainty long, departure_uncertainty long"
)
SCHEDULE = (
    "service_date long, service_date_dt date, feed_hash string, route_id string, direction_id long, trip_id string, stop_id string, stop_sequence long, "
    "scheduled_arrival timestamp, scheduled_departure timestamp, shape_dist_traveled double"
)


def update(rt, arrival=None, departure=None, late=None, unsure=None, vehicle="v", stop="s1", seq=1):
    at = lambda x: ts(f"2024-01-01T{x}+00:00") if x else None
    return ("t", "20240101", stop, seq, vehicle, "r", "e", "SCHEDULED", at(rt), at(arrival), at(departure), late, None, unsure, None)


@pytest.mark.parametrize(
    "given_, seen, ahead, on_time",
    [
        (update("10:00:00", "09:59:00", late=-60, unsure=0), True, False, True),
        (update("10:00:00", "09:59:00", late=-61, unsure=0), True, False, False),
        (update("10:00:00", "10:01:00", late=300, unsure=0), False, True, True),
        (update("10:00:00", "09:59:00", late=301, unsure=30), False, True, False),
        (update("10:00:00", "09:59:00"), False, False, False),  # without uncertainty neither observed nor predicted
        (update("10:00:00"), False, False, False),
    ],
)
def test_update_flags(spark, given_, seen, ahead, on_time):
    r = m.fct_trip_update(spark.createDataFrame([given_], UPDATES)).first()
    assert (r.is_observed, r.is_predicted, r.otp_flag) == (seen, ahead, on_time)


def schedule(spark):
    day = dt.date(2024, 1, 1)
    return spark.createDataFrame(
        [(20240101, day, "f", "R1", 0, "t", f"s{k}", k, None if k == 3 else ts(f"2024-01-01T10:0{k}:00+00:00"), ts(f"2024-01-01T10:0{k}:30+00:00"), 500.0 * k) for k in range(1, 5)],
        SCHEDULE,
    )


def test_trip_chain(spark):
    updates = spark.createDataFrame(
        [update("10:00:00", "10:01:10", late=10, unsure=0), update("10:00:30", None, "10:01:50", vehicle=None), update("10:02:00", None, None, vehicle=None),
         update("10:03:00", "10:02:20", late=20, unsure=0, stop="s2", seq=2), update("10:03:00", "10:02:20", stop="s2", seq=None)],
        UPDATES,
    )
    events = m.fct_trip_event(m.fct_trip_plan(schedule(spark), "Pacific/Auckland"), m.fct_trip_update(updates))
    got = {r.stop_sequence: r for r in events.collect()}
    assert len(got) == 4 and got[1].vehicle_id == "v" and got[1].arrival_delay_s == 10 and got[1].actual_departure is not None
    assert got[1].arrival_is_observed is False and got[1].is_observed is False  # the last update's flags, not departure's
    assert got[3].otp_flag is None and got[1].scheduled_hour_of_day == 23
    trip = m.fct_trip(events).first()
    assert (trip.planned_stop_count, trip.rt_stop_count, trip.rt_coverage_ratio, trip.otp_stop_ratio) == (4, 2, 0.5, 0.5)
    assert trip.planned_dwell_s == 90 and trip.planned_runtime_s == 150 and trip.trip_otp_flag is None and trip.vehicle_id == "v"
    dwell = {r.stop_sequence: r for r in m.fct_trip_dwell(events).collect()}
    assert dwell[1].rt_dwell_s == 40 and dwell[3].planned_dwell_s is None and dwell[2].dwell_s == 30
    seen = spark.createDataFrame([("t", ts("2024-01-01T10:01:50+00:00"), 20.0, "FULL"), ("t", ts("2024-01-01T10:02:20+00:00"), 40.0, None)], "trip_id string, timestamp timestamp, speed double, occupancy_status string")
    legs = {r.from_stop_sequence: r for r in m.fct_trip_segment(events, seen).collect()}
    assert sorted(legs) == [1, 2, 3] and legs[1].vp_avg_speed_kmh == 30.0 and legs[1].vp_occupancy_status == "FULL" and legs[1].rt_travel_s == 30
    assert legs[2].vp_avg_speed_kmh is None and legs[2].vp_count == 0 and legs[1].speed_kmh == 60.0


EVENTS = (
    "service_date long, service_date_dt date, feed_hash string, route_id string, direction_id long, trip_id string, stop_id string, stop_sequence long, "
    "vehicle_id string, scheduled_arrival timestamp, scheduled_departure timestamp, actual_arrival timestamp, actual_departure timestamp, "
    "rt_event_ts_utc timestamp, early_late_s long, otp_flag boolean, is_observed boolean, is_predicted boolean, schedule_relationship string"
)


def test_commonest_vehicle_of_many_trips(spark):
    """More trips than a task groups by hash; the first rows of a trip are counted before it turns to sorting, the others after."""
    fields = [f.split() for f in EVENTS.split(", ")]
    at = {"service_date": 20240101, "service_date_dt": dt.date(2024, 1, 1), "feed_hash": "f", "route_id": "R1", "direction_id": 0}
    stops = [at | {"trip_id": f"t{k}", "stop_id": str(n), "stop_sequence": n, "vehicle_id": v} for n, v in enumerate(("b", "a", "b", None, None, None, "c")) for k in range(300)]
    events = spark.createDataFrame([tuple(r.get(c) for c, _ in fields) for r in stops], EVENTS).coalesce(1)
    few = m.fct_trip(events.where("stop_sequence < 5")).groupBy("vehicle_id").count()
    assert rows(few) == [("b", 300)]  # as often as null, which comes last
    assert rows(m.fct_trip(events).groupBy("vehicle_id").count()) == [(None, 300)]


def test_rows_are_not_days(spark):
    df = spark.createDataFrame([("a", dt.date(2024, 1, 1), 1.0), ("a", dt.date(2024, 1, 2), 2.0), ("a", dt.date(2024, 2, 10), 6.0)], "k string, service_date date, x double")
    got = df.select("x", rolling.rolling_mean("x", ["k"]).alias("r"), rolling.rolling_mean("x", ["k"], by="days").alias("d")).orderBy("x").collect()
    assert [r.r for r in got] == [1.0, 1.5, 3.0] and [r.d for r in got] == [1.0, 1.5, 6.0]


def test_nulls_and_halves(spark):
    df = spark.createDataFrame([(None, 2.5, "3.5", 7), (-4, 3.5, "4", 3)], "a int, b double, c string, d int")
    got = df.select(
        scalars.at_least_zero("a"), scalars.rounded("b", 0), scalars.whole_number("c"), scalars.labelled("d", {3: "x"}), scalars.greatest_or_null("a", "b"),
    ).collect()
    assert [tuple(r) for r in got] == [(None, 2.0, None, None, None), (0, 4.0, 4, "x", 3.5)]


def test_alerts_hold_by_the_hour(spark):
    alerts = spark.createDataFrame([(ts("2024-01-05T01:59:00+00:00"), ts("2024-01-05T03:00:00+00:00")), (ts("2024-01-05T22:59:30+00:00"), None)], "period_start timestamp, period_end timestamp")
    none = spark.createDataFrame([], "vehicle_id string, timestamp timestamp")
    updates = spark.createDataFrame([], "rt_timestamp timestamp, arrival_delay long, departure_delay long")
    got = {r.hour_ts.hour: r.active_alerts for r in s.hourly_dashboard(spark, "2024-01-05", none, updates, alerts).select(F.col("hour_ts").cast("timestamp_ntz").alias("hour_ts"), "active_alerts").collect()}
    assert len(got) == 24 and {h for h, n in got.items() if n} == {1, 2, 3, 23}


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.floats(-80, 80), st.floats(-179, 179)), min_size=1, max_size=20))
def test_grid(spark, points):
    grid = HexGrid()
    df = spark.createDataFrame(points, "lat double, lon double").withColumn("c", grid.cell(F.col("lat"), F.col("lon"), 8))
    lat, lon = grid.centre(F.col("c"))
    got = df.select("c", grid.cell(lat, lon, 8).alias("again"), grid.boundary(F.col("c")).alias("b"), grid.disk(F.col("c"), 1).alias("d"), F.hypot(lat - F.col("lat"), lon - F.col("lon")).alias("off")).collect()
    for r in got:
        assert r.c == r.again and r.b.startswith("POLYGON((") and len(set(r.d)) == 7 and r.c in r.d and r.off <= grid.edge(8) * 1.000001


def test_distance(spark):
    df = spark.createDataFrame([(0.0, 0.0, 0.0, 1.0), (10.0, 20.0, 10.0, 20.0), (5.0, 6.0, 7.0, 8.0), (7.0, 8.0, 5.0, 6.0)], "a double, b double, c double, d double")
    got = [r[0] for r in df.select(scalars.distance_m("a", "b", "c", "d")).collect()]
    assert abs(got[0] - 111195.1) < 1 and got[1] == 0 and abs(got[2] - got[3]) < 1e-6
