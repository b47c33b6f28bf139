"""Dimensions, facts, aggregates and indicators as functions from DataFrames to DataFrames.

Every function takes the tables that it reads; catalogs, files and streams are the caller's. Windows have unique
orders, so that results are the same in every run.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetlens.functions import carry, rolling
from fleetlens.functions.grid import Grid, HexGrid
from fleetlens.functions.scalars import (
    at_least_zero, clock_to_utc, distance_m, local_time, ratio, route_mode, seconds_between, service_date,
)

GRID = HexGrid()
UNMONITORED_S, UNMONITORED_M = 120, 50.0
GAP_S, MOVED_M, FASTEST_KMH = 180, 30.0, 140.0
SPEED_CELL, POSITION_CELL = 8, 10


# dimensions ---------------------------------------------------------------------------------------------------------


def dim_feed(feeds: DataFrame) -> DataFrame:
    """One row for each feed that is the last ingested of its start date; it holds until the next one starts.

    The declared end date has no part in it, so that the dates of all feeds follow on each other.
    """
    start = F.to_date(F.col("feed_start_date").cast("string"), "yyyyMMdd")
    end = F.to_date(F.col("feed_end_date").cast("string"), "yyyyMMdd")
    versions = feeds.where("feed_start_date is not null").groupBy(
        "feed_hash", "feed_publisher_name", "feed_version",
        start.alias("feed_start_date_declared"), end.alias("feed_end_date_declared"),
    ).agg(F.min("created_at").alias("ingested_at_utc"))
    latest = Window.partitionBy("feed_start_date_declared").orderBy(F.desc("ingested_at_utc"), "feed_hash")
    until = F.date_sub(F.lead("feed_start_date_declared").over(Window.orderBy("feed_start_date_declared")), 1)  # a row for each start date
    return (
        versions.withColumn("nth", F.row_number().over(latest))
        .where("nth = 1")
        .withColumn("effective_from_date", F.col("feed_start_date_declared"))
        .withColumn("effective_to_date", until)
        .withColumn("is_current", F.col("effective_to_date").isNull())
        .drop("nth")
    )


def dim_route(routes: DataFrame, feeds: DataFrame) -> DataFrame:
    """The version of each route in the feed ingested last, of feeds in dim_feed only."""
    latest = Window.partitionBy("route_id").orderBy(F.desc("ingested_at_utc"), F.desc("feed_hash"))
    return (
        routes.join(feeds.select("feed_hash", "ingested_at_utc"), "feed_hash")
        .withColumn("nth", F.row_number().over(latest))
        .where("nth = 1")
        .withColumn("route_mode", route_mode("route_type"))
        .drop("nth")
    )


def latest_trips(trips: DataFrame, feeds: DataFrame) -> DataFrame:
    """One row for each trip_id, of the feed ingested last, so that joins on trip_id don't multiply rows."""
    latest = Window.partitionBy("trip_id").orderBy(F.desc_nulls_last("ingested_at_utc"), "feed_hash")
    ranked = trips.join(feeds.select("feed_hash", "ingested_at_utc"), "feed_hash", "left").withColumn("nth", F.row_number().over(latest))
    return ranked.where("nth = 1").drop("nth", "ingested_at_utc")


# schedule -----------------------------------------------------------------------------------------------------------


def applicable_feed(feeds: DataFrame, day: int) -> DataFrame:
    """The feed ingested last of those whose declared dates hold the day (yyyymmdd)."""
    held = feeds.where((F.col("feed_start_date") <= day) & (F.col("feed_end_date") >= day))
    return held.orderBy(F.desc("created_at"), "feed_hash").limit(1).select("feed_hash")


def active_services(calendar: DataFrame, exceptions: DataFrame, day: int, weekday: str) -> DataFrame:
    """(feed_hash, service_id): regular services of the weekday and added ones, less removed ones."""
    keys = ["feed_hash", "service_id"]
    regular = calendar.where((F.col("start_date") <= day) & (F.col("end_date") >= day) & (F.col(weekday) == 1)).select(*keys)
    of_day = exceptions.where(F.col("date") == day)
    added, removed = (of_day.where(F.col("exception_type") == t).select(*keys) for t in (1, 2))
    return regular.union(added).distinct().subtract(removed)


def daily_schedule(feed, services, trips, routes, stop_times, stops, day: str, zone: str) -> DataFrame:
    """One row for each stop time of a trip that runs on the day (yyyy-mm-dd), with instants for the clocks."""
    running = trips.join(feed, "feed_hash", "left_semi").join(services, ["feed_hash", "service_id"], "left_semi")
    named = running.join(routes.select("feed_hash", "route_id", "route_short_name", "route_type"), ["feed_hash", "route_id"], "left")
    at_stops = stop_times.join(feed, "feed_hash", "left_semi").join(stops, ["feed_hash", "stop_id"], "left")
    arrival, departure = (clock_to_utc(F.lit(day).cast("date"), c, zone) for c in ("arrival_time", "departure_time"))
    return at_stops.join(named, ["feed_hash", "trip_id"]).select(
        F.lit(int(day.replace("-", ""))).cast("long").alias("service_date"), F.lit(day).cast("date").alias("service_date_dt"),
        "feed_hash", "service_id", "route_id", "route_short_name", "route_type", "direction_id", "trip_id", "stop_id", "stop_code",
        "stop_name", "stop_sequence", F.col("arrival_time").alias("scheduled_arrival_time"),
        F.col("departure_time").alias("scheduled_departure_time"),
        arrival.alias("scheduled_arrival"), departure.alias("scheduled_departure"),
        F.unix_timestamp(arrival).alias("scheduled_arrival_s"), F.unix_timestamp(departure).alias("scheduled_departure_s"),
    )


# trip facts ---------------------------------------------------------------------------------------------------------


def fct_trip_plan(schedule: DataFrame, zone: str) -> DataFrame:
    at = F.coalesce("scheduled_arrival", "scheduled_departure")
    return schedule.select(
        "*", at.alias("event_ts_utc"), F.hour(local_time(at, zone)).cast("long").alias("hour_of_day"),
        F.dayofweek("service_date_dt").cast("long").alias("day_of_week"),
    )


def _on_time(early_late: Column) -> Column:
    return F.coalesce(early_late.between(-60, 300), F.lit(False))


def fct_trip_update(updates: DataFrame) -> DataFrame:
    """One row for each stop update, with what was observed, predicted and on time."""

    def flags(kind: str) -> tuple[Column, Column]:
        at, unsure = F.col(f"actual_{kind}"), F.col(f"{kind}_uncertainty")
        seen = at.isNotNull() & (at <= F.col("rt_timestamp")) & (F.coalesce(unsure, F.lit(1)) == 0)
        ahead = at.isNotNull() & ((at > F.col("rt_timestamp")) | (F.coalesce(unsure, F.lit(0)) > 0))
        return F.coalesce(seen, F.lit(False)), F.coalesce(ahead, F.lit(False))

    kinds = {k: flags(k) for k in ("arrival", "departure")}
    both = lambda n: F.when(F.col("actual_arrival").isNotNull(), kinds["arrival"][n]).when(
        F.col("actual_departure").isNotNull(), kinds["departure"][n]
    ).otherwise(F.lit(False))
    at = F.coalesce("actual_arrival", "actual_departure", "rt_timestamp")
    late = F.coalesce("arrival_delay", "departure_delay")
    return updates.where("trip_id is not null and stop_id is not null").select(
        *[c for c in updates.columns if c not in ("arrival_delay", "departure_delay")],
        F.col("arrival_delay").alias("arrival_delay_s"), F.col("departure_delay").alias("departure_delay_s"),
        *[kinds[k][n].alias(f"{k}_is_{w}") for k in kinds for n, w in enumerate(("observed", "predicted"))],
        both(0).alias("is_observed"), both(1).alias("is_predicted"), at.alias("event_ts_utc"),
        F.hour(at).cast("long").alias("hour_of_day"), F.dayofweek(at).cast("long").alias("day_of_week"),
        late.alias("early_late_s"), _on_time(late).alias("otp_flag"),
    )


LAST_KNOWN = (
    "vehicle_id", "entity_id", "record_id", "actual_arrival", "actual_departure", "arrival_delay_s", "arrival_uncertainty",
    "departure_delay_s", "departure_uncertainty", "schedule_relationship",
)
LAST_FLAGS = ("arrival_is_observed", "arrival_is_predicted", "departure_is_observed", "departure_is_predicted")


def fct_trip_event(plan: DataFrame, updates: DataFrame) -> DataFrame:
    """One row for each scheduled stop, with the last known value of each field of its updates."""
    keys = ["trip_id", "start_date", "stop_id", "stop_sequence"]
    # of updates at one time that with the largest id is the last
    known = [F.expr(f"max_by({c}, struct(rt_timestamp, record_id)) filter (where {c} is not null)").alias(c) for c in LAST_KNOWN]
    last = updates.groupBy(*keys).agg(
        F.max("rt_timestamp").alias("rt_timestamp"), *known, *[F.max_by(c, F.struct("rt_timestamp", "record_id")).alias(c) for c in LAST_FLAGS]
    )
    at = F.coalesce("actual_arrival", "actual_departure", "rt_timestamp")
    late = F.coalesce("arrival_delay_s", "departure_delay_s")
    rt = last.select(
        "*", at.alias("rt_event_ts_utc"), F.hour(at).cast("long").alias("rt_hour_of_day"), F.dayofweek(at).cast("long").alias("rt_day_of_week"),
        late.alias("early_late_s"), _on_time(late).alias("otp_flag"),
        F.coalesce("arrival_is_observed", "departure_is_observed", F.lit(False)).alias("is_observed"),
        F.coalesce("arrival_is_predicted", "departure_is_predicted", F.lit(False)).alias("is_predicted"),
    ).withColumnRenamed("start_date", "service_day")
    own = plan.withColumnsRenamed(
        {"event_ts_utc": "scheduled_event_ts_utc", "hour_of_day": "scheduled_hour_of_day", "day_of_week": "scheduled_day_of_week"}
    ).withColumn("service_day", F.col("service_date").cast("string"))
    return own.join(rt, ["trip_id", "service_day", "stop_id", "stop_sequence"], "left").drop("service_day")


def _named(events: DataFrame, *columns: str) -> DataFrame:
    """events with those of the columns that they lack, null."""
    return events.select("*", *[F.lit(None).cast("string").alias(c) for c in columns if c not in events.columns])


def _null_safe(a: DataFrame, b: DataFrame, keys: Sequence[str], plain: Sequence[str] = ()) -> DataFrame:
    """a with the columns of b, for keys that may be null. plain ones are never null in b, so rows dealt out by them stay there."""
    renamed = b.select(*[F.col(k).alias(f"__{k}") for k in keys], *[c for c in b.columns if c not in keys])
    on = None
    for k in keys:
        same = F.col(k) == F.col(f"__{k}") if k in plain else F.col(k).eqNullSafe(F.col(f"__{k}"))
        on = same if on is None else on & same
    return a.join(renamed, on, "left").drop(*[f"__{k}" for k in keys])


TRIP_KEYS = ["service_date_dt", "service_date", "feed_hash", "route_id", "direction_id", "trip_id"]


def fct_trip(events: DataFrame) -> DataFrame:
    """One row for each trip of a day: names, ends, run, dwell and travel times, coverage, punctuality, and its commonest
    vehicle, of equally common ones the smallest."""
    dwell = at_least_zero(seconds_between("scheduled_departure", "scheduled_arrival"))
    both = F.col("actual_arrival").isNotNull() & F.col("actual_departure").isNotNull()
    known = F.col("actual_arrival").isNotNull() | F.col("actual_departure").isNotNull()
    canceled = F.col("schedule_relationship").isin("CANCELED", "3")
    # text, as mode() counts equal structs apart once it spills to sorting; null comes after all ids
    vehicle = F.coalesce(F.concat(F.lit("0"), "vehicle_id"), F.lit("1"))
    events = _named(events, "route_short_name", "trip_headsign", "shape_id", "stop_name")
    at = F.struct("stop_sequence", "stop_id")
    ends = [f(f"stop_{c}", at).alias(f"{n}_stop_{c}") for n, f in (("first", F.min_by), ("last", F.max_by)) for c in ("id", "name")]
    total = events.groupBy(*TRIP_KEYS).agg(
        *[F.min(c).alias(c) for c in ("route_short_name", "trip_headsign", "shape_id")],
        *ends,
        F.min("scheduled_departure").alias("planned_first_departure"),
        F.max("scheduled_arrival").alias("planned_last_arrival"),
        F.min("actual_departure").alias("actual_first_departure"),
        F.max("actual_arrival").alias("actual_last_arrival"),
        F.sum(dwell).alias("planned_dwell_s"),
        F.sum(F.when(both, at_least_zero(seconds_between("actual_departure", "actual_arrival"))).otherwise(0)).alias("actual_dwell_s"),
        F.count("*").alias("planned_stop_count"),
        F.count_if(known).alias("rt_stop_count"),
        F.count_if(F.col("is_observed")).alias("observed_stop_count"),
        F.count_if(F.col("is_predicted")).alias("predicted_stop_count"),
        F.avg("early_late_s").alias("avg_early_late_s"),
        F.percentile_approx("early_late_s", 0.5, 10000).cast("long").alias("p50_early_late_s"),
        F.avg(F.when(F.col("otp_flag"), 1.0).otherwise(0.0)).alias("otp_stop_ratio"),
        F.max_by("otp_flag", at).alias("trip_otp_flag"),
        F.min("rt_event_ts_utc").alias("first_rt_event_ts_utc"),
        F.max("rt_event_ts_utc").alias("last_rt_event_ts_utc"),
        F.bool_or(canceled).alias("is_canceled"),
        F.bool_or(F.col("schedule_relationship") == "NO_DATA").alias("is_no_data"),
        F.bool_or("is_observed").alias("any_observed"),
        F.bool_or("is_predicted").alias("any_predicted"),
        F.mode(vehicle, True).alias("vehicle"),
    )
    run = lambda kind: seconds_between(f"{kind}_last_arrival", f"{kind}_first_departure")
    return (
        total.withColumn("vehicle_id", F.when(F.col("vehicle") != "1", F.expr("substring(vehicle, 2)")))
        .drop("vehicle")
        .withColumn("planned_runtime_s", run("planned"))
        .withColumn("actual_runtime_s", run("actual"))
        .withColumn("planned_travel_s", F.col("planned_runtime_s") - F.col("planned_dwell_s"))
        .withColumn("actual_travel_s", F.col("actual_runtime_s") - F.col("actual_dwell_s"))
        .withColumn("rt_coverage_ratio", ratio("rt_stop_count", "planned_stop_count"))
    )


def fct_trip_dwell(events: DataFrame) -> DataFrame:
    """One row for each stop event; the observed stay at the stop goes before the planned."""
    rt = seconds_between("actual_departure", "actual_arrival")
    planned = at_least_zero(seconds_between("scheduled_departure", "scheduled_arrival"))
    seen = F.col("arrival_is_observed") & F.col("departure_is_observed")
    return events.select(
        "service_date", "feed_hash", "route_id", "direction_id", "trip_id", "stop_id", "stop_sequence",
        planned.alias("planned_dwell_s"), rt.alias("rt_dwell_s"), F.coalesce(rt, planned).alias("dwell_s"), seen.alias("dwell_is_observed"),
        ((F.col("arrival_is_predicted") | F.col("departure_is_predicted")) & ~seen).alias("dwell_is_predicted"),
    )


NEXT = ("stop_id", "stop_name", "stop_sequence", "scheduled_arrival", "actual_arrival", "shape_dist_traveled", "arrival_is_observed")


def fct_trip_segment(events: DataFrame, positions: DataFrame) -> DataFrame:
    """One row for each stop and the next, with speeds and the positions reported on the way.

    positions is the position fact, or staged positions. Legs are dealt out to the days (UTC) that they touch and joined on trip and day, as
    trip ids recur day by day. Positions are dealt out by trip, so that legs that are, as those of fct_trip_event are, stay where they are.
    """
    events = _named(events, "stop_name")
    order = Window.partitionBy("trip_id", "service_date").orderBy("stop_sequence", "stop_id")
    legs = events.select("*", *[F.lead(c).over(order).alias(f"to_{c}") for c in NEXT]).where("to_stop_id is not null")
    planned = seconds_between("to_scheduled_arrival", "scheduled_departure")
    rt = seconds_between("to_actual_arrival", "actual_departure")
    length = at_least_zero(F.col("to_shape_dist_traveled") - F.col("shape_dist_traveled"))
    speed = lambda s: ratio(length * 3.6, F.nullif(F.col(s), F.lit(0)))
    legs = legs.select(
        "service_date", "feed_hash", "route_id", "direction_id", "trip_id",
        F.col("stop_id").alias("from_stop_id"), F.col("stop_name").alias("from_stop_name"), "to_stop_id", "to_stop_name",
        F.col("stop_sequence").alias("from_stop_sequence"), "to_stop_sequence",
        F.col("scheduled_departure").alias("from_scheduled_departure"), "to_scheduled_arrival",
        F.col("actual_departure").alias("from_actual_departure"), "to_actual_arrival",
        planned.alias("planned_travel_s"), rt.alias("rt_travel_s"), F.coalesce(rt, planned).alias("travel_s"), length.alias("segment_length_m"),
        F.coalesce("actual_departure", "scheduled_departure").alias("from_time"),
        F.coalesce("to_actual_arrival", "to_scheduled_arrival").alias("to_time"),
        (F.col("departure_is_observed") & F.col("to_arrival_is_observed")).alias("travel_is_observed"), "shape_dist_traveled", "to_shape_dist_traveled",
    ).distinct()
    length = at_least_zero(F.col("to_shape_dist_traveled") - F.col("shape_dist_traveled"))
    legs = legs.select("*", speed("planned_travel_s").alias("planned_speed_kmh"), speed("rt_travel_s").alias("rt_speed_kmh"), speed("travel_s").alias("speed_kmh"))
    keys = ["service_date", "trip_id", "from_stop_sequence", "to_stop_sequence", "from_time", "to_time"]
    days = F.explode(F.sequence(F.to_date("from_time"), F.to_date("to_time")))
    spans = legs.where("from_time <= to_time").select(*keys).distinct().withColumn("day", days)
    positions = positions.withColumnsRenamed({"timestamp": "timestamp_utc", "speed": "speed_kmh"})
    seen = positions.where("trip_id is not null").select("trip_id", F.to_date("timestamp_utc").alias("day"), "timestamp_utc", "speed_kmh", "occupancy_status")
    seen = seen.repartition("trip_id")
    met = spans.join(seen, ["trip_id", "day"]).where("timestamp_utc between from_time and to_time")
    by_status = met.groupBy(*keys, "occupancy_status").agg(
        F.sum("speed_kmh").alias("total"), F.count("speed_kmh").alias("known"), F.count("*").alias("n")
    )
    commonest = F.struct(-F.col("n"), F.col("occupancy_status").isNull(), "occupancy_status")
    reported = by_status.groupBy(*keys).agg(
        ratio(F.sum("total"), F.sum("known")).alias("vp_avg_speed_kmh"), F.sum("n").alias("vp_count"),
        F.min_by("occupancy_status", commonest).alias("vp_occupancy_status"),
    )
    out = _null_safe(legs, reported, keys, plain=["trip_id"])
    return out.drop("shape_dist_traveled", "to_shape_dist_traveled").withColumn("vp_count", F.coalesce("vp_count", F.lit(0)))


# vehicle facts ------------------------------------------------------------------------------------------------------


def fct_vehicle_position(
    positions: DataFrame, routes: DataFrame, trips: DataFrame, region: DataFrame,
    least_s: int = UNMONITORED_S, least_m: float = UNMONITORED_M, speed_factor: float = 1.0, earlier: DataFrame | None = None,
) -> DataFrame:
    """One row for each ping: what passed since the vehicle's last, and whether it moved without being seen.

    speed_factor scales the reported speed; 3.6 for metres a second. earlier has the last pings of days before those of
    positions, as carry.ends() gives them.
    """
    day = Window.partitionBy("vehicle_id", "service_date")
    positions = carry.neighbour(positions, "vehicle_id", "timestamp", "record_id", ("timestamp", "latitude", "longitude"), "last", known=earlier)
    routed = positions.join(routes.select("route_id", "route_type", "route_mode"), "route_id", "left")
    # pings without a trip find none, and are spread instead of meeting in one task
    spread = F.concat(F.lit("\u0000"), F.pmod(F.xxhash64("record_id"), F.lit(512)).cast("string"))
    base = routed.withColumn("__trip", F.coalesce("trip_id", spread)).join(
        trips.select(F.col("trip_id").alias("__trip"), "direction_id"), "__trip", "left"
    )
    return (
        base.crossJoin(F.broadcast(region.limit(1).select("timezone", "svc_boundary_hour", "region_prefix")))  # one row
        .withColumn("update_interval_seconds", seconds_between("timestamp", "last.timestamp"))
        .withColumn("position_delta_m", distance_m("latitude", "longitude", "last.latitude", "last.longitude"))
        .withColumn("prev_timestamp_utc", F.col("last.timestamp"))
        .withColumn("prev_latitude", F.col("last.latitude"))
        .withColumn("prev_longitude", F.when(F.col("last.latitude").isNotNull(), F.col("last.longitude")))
        .withColumn("datetime_local", local_time("timestamp", F.col("timezone")))
        .withColumn("service_date", service_date("datetime_local", F.col("svc_boundary_hour")))
        .withColumn("day_mode", F.max("route_mode").over(day))
        .select(
            F.col("timestamp").alias("timestamp_utc"), "record_id", "vehicle_id", "trip_id", "route_id", "direction_id",
            (F.col("speed") * speed_factor).alias("speed_kmh"), F.col("bearing").alias("bearing_deg"), "occupancy_status", "latitude", "longitude",
            "update_interval_seconds", "position_delta_m", "prev_timestamp_utc", "prev_latitude", "prev_longitude", "datetime_local",
            "service_date", F.hour("datetime_local").cast("long").alias("hour_local"), F.date_format("datetime_local", "EEEE").alias("dow_local"),
            F.col("day_mode").alias("route_mode"), "route_type",
            ((F.col("update_interval_seconds") > least_s) & (F.col("position_delta_m") > least_m)).alias("is_unmonitored_movement"),
        )
    )


def with_cell(positions: DataFrame, resolution: int, name: str, grid: Grid = GRID) -> DataFrame:
    return positions.withColumn(name, grid.cell(F.col("latitude"), F.col("longitude"), resolution))


def _unmonitored(positions: DataFrame, *keys: str) -> DataFrame:
    return positions.groupBy("service_date", *keys, "route_mode").agg(
        F.count("*").alias("position_count"), F.sum("update_interval_seconds").alias("unmonitored_duration_seconds"),
        F.sum("position_delta_m").alias("unmonitored_distance_m"),
    )


def agg_position_vehicle_day(positions: DataFrame) -> DataFrame:
    return _unmonitored(positions.where("is_unmonitored_movement"), "vehicle_id")


def agg_position_grid_day(positions: DataFrame, grid: Grid = GRID) -> DataFrame:
    seen = positions.where("is_unmonitored_movement and latitude is not null and longitude is not null")
    return _unmonitored(with_cell(seen, POSITION_CELL, "cell", grid), "cell")


def _speeds(positions: DataFrame, *keys: str) -> DataFrame:
    hour, name = F.hour("timestamp_utc").cast("long").alias("hour_utc"), F.date_format("service_date", "EEEE").alias("day_of_week")
    return positions.groupBy(*keys, "route_mode", "service_date", hour, name).agg(
        F.avg("speed_kmh").alias("avg_speed_kmh"), F.count("vehicle_id").alias("position_count")
    )


def agg_speed_route_hour(positions: DataFrame) -> DataFrame:
    return _speeds(positions.where("trip_id is not null and route_id is not null and direction_id is not null"), "route_id", "direction_id")


def agg_speed_grid_hour(positions: DataFrame, mode: str = "bus", grid: Grid = GRID) -> DataFrame:
    seen = positions.where((F.col("route_mode") == mode) & F.col("latitude").isNotNull() & F.col("longitude").isNotNull())
    return _speeds(with_cell(seen, SPEED_CELL, "cell", grid), "cell")


# indicators ---------------------------------------------------------------------------------------------------------


def _against_mean(df: DataFrame, keys: list[str], by: str, size: int, mean: str, change: str) -> DataFrame:
    return df.withColumn(mean, rolling.rolling_mean("avg_speed_kmh", keys, size=size, by=by)).withColumn(
        change, rolling.change_from("avg_speed_kmh", mean)
    )


def mdl_speed_grid_hourly(speeds: DataFrame) -> DataFrame:
    """Against the mean of this and the 27 rows before it, which need not be days."""
    return _against_mean(speeds, ["cell", "hour_utc", "route_mode"], "rows", 28, "avg_speed_kmh_28_day_rolling", "pct_change_from_28_day_avg")


def mdl_speed_route_hourly(speeds: DataFrame) -> DataFrame:
    keys = ["route_id", "direction_id", "route_mode", "hour_utc", "day_of_week"]
    return _against_mean(speeds, keys, "rows", 28, "avg_speed_kmh_rolling", "pct_change_from_rolling")


def mdl_unmonitored_vehicle_daily(days: DataFrame) -> DataFrame:
    keys = ["vehicle_id", "route_mode"]
    return days.withColumn("rolling_28_day_avg_distance_m", rolling.rolling_mean("unmonitored_distance_m", keys))


def mdl_unmonitored_grid_daily(days: DataFrame, grid: Grid = GRID) -> DataFrame:
    mean = rolling.rolling_mean("unmonitored_distance_m", ["cell", "route_mode"])
    return days.withColumn("rolling_28_day_avg_distance_m", mean).withColumn("cell_geometry", grid.boundary(F.col("cell")))


def mdl_unmonitored_detail(positions: DataFrame) -> DataFrame:
    """One row for each gap, at its end, with where and when it began."""
    return positions.where("is_unmonitored_movement and prev_latitude is not null").select(
        "vehicle_id", "route_id", "route_mode", "service_date", F.col("prev_timestamp_utc").alias("start_timestamp_utc"),
        F.col("timestamp_utc").alias("end_timestamp_utc"), F.col("prev_latitude").alias("start_latitude"),
        F.col("prev_longitude").alias("start_longitude"), F.col("latitude").alias("end_latitude"), F.col("longitude").alias("end_longitude"),
        F.col("update_interval_seconds").alias("gap_seconds"), F.col("position_delta_m").alias("distance_m"),
    )


# second version -----------------------------------------------------------------------------------------------------


def v2_fct_vehicle_position(positions: DataFrame, routes: DataFrame, region: DataFrame, grid: Grid = GRID) -> DataFrame:
    """One row for each ping, with its cell and the last mode known on the day; modes before the first stay null."""
    known = Window.partitionBy("vehicle_id", "service_date").orderBy("timestamp", "record_id").rowsBetween(Window.unboundedPreceding, 0)
    based = (
        positions.join(routes.select("route_id", "route_type", F.col("route_mode").alias("own_mode")), "route_id", "left")
        .crossJoin(F.broadcast(region.limit(1).select("timezone", "svc_boundary_hour")))  # one row
        .withColumn("datetime_local", local_time("timestamp", F.col("timezone")))
        .withColumn("service_date", service_date("datetime_local", F.col("svc_boundary_hour")))
    )
    return with_cell(based, POSITION_CELL, "cell", grid).select(
        F.col("timestamp").alias("timestamp_utc"), "record_id", "datetime_local", "service_date",
        F.hour("datetime_local").cast("long").alias("hour_local"), F.date_format("datetime_local", "EEEE").alias("dow_local"),
        "vehicle_id", "trip_id", "route_id", "speed", "latitude", "longitude", "cell", F.last("own_mode", ignorenulls=True).over(known).alias("route_mode"),
    )


def v2_fct_vehicle_segment(
    positions: DataFrame, gap_s: int = GAP_S, moved_m: float = MOVED_M, fastest_kmh: float = FASTEST_KMH
) -> DataFrame:
    """One row for each ping and the vehicle's next; doubtful ones are flagged, not dropped."""
    fields = ("timestamp_utc", "datetime_local", "latitude", "longitude", "cell")
    gap, moved = F.col("delta_seconds") > gap_s, F.coalesce(F.col("distance_m") > moved_m, F.lit(False))
    return (
        carry.neighbour(positions, "vehicle_id", "timestamp_utc", "record_id", fields, "after", after=True)
        .where("after is not null")
        .withColumn("delta_seconds", seconds_between("after.timestamp_utc", "timestamp_utc"))
        .withColumn("distance_m", distance_m("latitude", "longitude", "after.latitude", "after.longitude"))
        .withColumn("speed_kmh", F.when(F.col("delta_seconds") > 0, F.col("distance_m") / F.col("delta_seconds") * 3.6))
        .select(
            F.concat_ws("_", "vehicle_id", F.date_format("timestamp_utc", "yyyyMMddHHmmss")).alias("segment_id"),
            "vehicle_id", "trip_id", "route_id", "route_mode", "service_date", "hour_local", "dow_local", F.col("cell").alias("start_cell"),
            F.col("after.cell").alias("end_cell"), F.col("timestamp_utc").alias("start_timestamp_utc"),
            F.col("after.timestamp_utc").alias("end_timestamp_utc"), "delta_seconds", "distance_m", "speed_kmh", gap.alias("is_gap"),
            (gap & moved).alias("is_unmonitored_movement"), (F.col("delta_seconds") <= 0).alias("flag_nonpositive_gap"),
            F.coalesce(F.col("speed_kmh") > fastest_kmh, F.lit(False)).alias("flag_implausible_speed"),
        )
    )


def _v2_speeds(positions: DataFrame, first: list[str], keys: list[str]) -> DataFrame:
    """Vehicles are averaged first, so that those that report often don't count more."""
    each = positions.groupBy(*first, "vehicle_id").agg(F.avg("speed").alias("vehicle_speed"))
    at = lambda p: F.percentile_approx("vehicle_speed", p, 10000)
    return each.groupBy(*keys).agg(
        F.count("*").alias("vehicle_cnt"), F.avg("vehicle_speed").alias("avg_speed_kmh"), at(0.5).alias("p50_speed_kmh"),
        at(0.85).alias("p85_speed_kmh"), at(0.95).alias("p95_speed_kmh"), F.max("vehicle_speed").alias("max_speed_kmh"),
    )


def v2_agg_speed_grid_hour(positions: DataFrame, trips: DataFrame, grid: Grid = GRID) -> DataFrame:
    located = positions.where("cell is not null").withColumn("cell", grid.parent(F.col("cell"), SPEED_CELL)).join(
        trips.select("trip_id", "direction_id"), "trip_id", "left"
    )
    keys = ["service_date", "hour_local", "cell", "route_mode"]
    return _v2_speeds(located, [*keys, "route_id", "direction_id"], keys)


def v2_agg_speed_route_hour(positions: DataFrame, trips: DataFrame) -> DataFrame:
    known = positions.where("route_id is not null").join(trips.select("trip_id", "direction_id"), "trip_id", "left")
    keys = ["service_date", "hour_local", "route_id", "direction_id", "route_mode"]
    return _v2_speeds(known, keys, keys)


def _v2_unmonitored(segments: DataFrame, keys: list[str], *more: Column) -> DataFrame:
    gap, unseen = F.col("is_gap"), F.col("is_unmonitored_movement")
    return segments.groupBy(*keys).agg(
        F.count("*").alias("seg_cnt"), F.count_if(gap).alias("gap_seg_cnt"), ratio(F.count_if(gap), F.count("*")).alias("gap_seg_ratio"),
        F.sum(F.when(gap, F.col("delta_seconds")).otherwise(0)).alias("gap_seconds_total"),
        F.avg(F.when(gap, F.col("delta_seconds"))).alias("gap_seconds_avg"), F.count_if(unseen).alias("unmonitored_cnt"),
        F.sum(F.when(unseen, F.col("distance_m")).otherwise(0.0)).alias("unmonitored_total_m"),
        F.avg(F.when(unseen, F.col("distance_m"))).alias("unmonitored_avg_m"), F.max(F.when(unseen, F.col("distance_m"))).alias("unmonitored_max_m"),
        *more, F.countDistinct("route_id").alias("route_cnt"),
    )


def v2_agg_unmonitored_grid_day(segments: DataFrame) -> DataFrame:
    located = segments.where("start_cell is not null")
    return _v2_unmonitored(located, ["service_date", "start_cell", "route_mode"], F.countDistinct("vehicle_id").alias("vehicle_cnt"))


def v2_agg_unmonitored_vehicle_day(segments: DataFrame) -> DataFrame:
    return _v2_unmonitored(segments, ["service_date", "vehicle_id", "route_mode"])


def v2_mdl_speed_grid_hourly(speeds: DataFrame) -> DataFrame:
    return _against_mean(speeds, ["cell", "route_mode", "hour_local"], "days", 28, "avg_speed_kmh_rolling", "pct_change_from_rolling")


def v2_mdl_speed_route_hourly(speeds: DataFrame) -> DataFrame:
    keys = ["route_id", "direction_id", "route_mode", "hour_local"]
    return _against_mean(speeds, keys, "days", 28, "avg_speed_kmh_rolling", "pct_change_from_rolling")


def rolling_deviation(days: DataFrame, by: str = "rows") -> DataFrame:
    """Deviation and z-score against the last 28 rows, or days."""
    keys = ["vehicle_id", "route_mode"]
    return (
        days.withColumn("mean_m", rolling.rolling_mean("unmonitored_distance_m", keys, by=by))
        .withColumn("stddev_m", rolling.rolling_stddev("unmonitored_distance_m", keys, by=by))
        .withColumn("z", rolling.z_score("unmonitored_distance_m", "mean_m", "stddev_m"))
    )


# hours of vehicles --------------------------------------------------------------------------------------------------


def clean_segments(segments: DataFrame, since: str | None = None) -> DataFrame:
    """Segments without a doubtful flag, of service dates from `since` (yyyy-mm-dd) on, if it is given."""
    good = segments.where("not flag_nonpositive_gap and not flag_implausible_speed and not is_gap")
    return good.where(F.col("service_date") >= F.lit(since).cast("date")) if since else good


def agg_vehicle_hour(segments: DataFrame, *more: str) -> DataFrame:
    """Metres, seconds and the speed that follows from their sums; segments that go nowhere in time are left out. More
    keys, as route_id or start_cell, tell a vehicle's hours apart by them."""
    moved = segments.where("not flag_nonpositive_gap and distance_m is not null")
    return moved.groupBy("service_date", "hour_local", "vehicle_id", *more).agg(
        F.count("*").alias("seg_cnt"), F.sum("distance_m").alias("distance_m"), F.sum("delta_seconds").alias("seconds"),
        ratio(F.sum("distance_m") * 3.6, F.nullif(F.sum("delta_seconds"), F.lit(0))).alias("speed_kmh"),
    )


def agg_vehicle_day(hours: DataFrame) -> DataFrame:
    """Days from hours: sums are summed again and the speed follows from them."""
    return hours.groupBy("service_date", "vehicle_id").agg(
        F.sum("seg_cnt").alias("seg_cnt"), F.sum("distance_m").alias("distance_m"), F.sum("seconds").alias("seconds"),
        ratio(F.sum("distance_m") * 3.6, F.nullif(F.sum("seconds"), F.lit(0))).alias("speed_kmh"),
    )
