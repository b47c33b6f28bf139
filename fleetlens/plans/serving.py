"""Queries that dashboards, notebooks and diagnostics ask."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlens.functions.scalars import ratio

LATE_S = 300


def hourly_dashboard(
    spark: SparkSession, day: str, positions: DataFrame, updates: DataFrame, alerts: DataFrame
) -> DataFrame:
    """24 rows for the hours (UTC) of a day: vehicles, punctuality, updates, and alerts that hold in the hour.

    Alerts are dealt out to the hours that they overlap, so that the join is on equal hours.
    """
    start = F.lit(day).cast("timestamp")
    end = start + F.expr("interval 23 hours")
    hours = spark.range(1).select(F.explode(F.sequence(start, end, F.expr("interval 1 hour"))).alias("hour_ts"))
    of = lambda c: F.date_trunc("HOUR", F.col(c)).alias("hour_ts")
    on_day = lambda c: (F.col(c) >= start) & (F.col(c) < start + F.expr("interval 24 hours"))
    vehicles = positions.where(on_day("timestamp")).groupBy(of("timestamp")).agg(F.countDistinct("vehicle_id").alias("active_vehicles"))
    late = F.coalesce("arrival_delay", "departure_delay")
    punctual = updates.where(on_day("rt_timestamp")).groupBy(of("rt_timestamp")).agg(
        ratio(F.count_if(F.abs(late) <= LATE_S), F.nullif(F.count_if(late.isNotNull()), F.lit(0))).alias("on_time_pct"),
        F.avg(late).alias("avg_delay_seconds"), F.count("*").alias("updates_count"),
    )
    # an alert holds in an hour if it starts by its 59th minute and ends at its start or later
    first = F.greatest(F.date_trunc("HOUR", F.col("period_start") + F.expr("interval 59 minutes 59.999999 seconds") - F.expr("interval 59 minutes")), start)
    last = F.least(F.date_trunc("HOUR", F.coalesce("period_end", end)), end)
    held = (
        alerts.where((F.col("period_start") <= end + F.expr("interval 59 minutes")) & (F.col("period_end").isNull() | (F.col("period_end") >= start)))
        .withColumn("first", first).withColumn("last", last).where("first <= last")
        .select(F.explode(F.sequence("first", "last", F.expr("interval 1 hour"))).alias("hour_ts"))
        .groupBy("hour_ts").agg(F.count("*").alias("active_alerts"))
    )
    zero = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    return hours.join(vehicles, "hour_ts", "left").join(punctual, "hour_ts", "left").join(held, "hour_ts", "left").select(
        "hour_ts", zero("active_vehicles"), "on_time_pct", "avg_delay_seconds", zero("updates_count"), zero("active_alerts")
    )


def daily_kpis(updates: DataFrame, positions: DataFrame) -> DataFrame:
    """One row for each day (UTC) with updates: punctuality, delay, cancellations, vehicles.

    canceled_share is the canceled trips by all trips; cancellation_rate counts canceled updates by trips, as the
    dashboard does, and may exceed 1.
    """
    late = F.coalesce("arrival_delay", "departure_delay")
    canceled = F.col("schedule_relationship").isin("CANCELED", "3")
    days = updates.groupBy(F.to_date("rt_timestamp").alias("day")).agg(
        ratio(F.count_if(F.abs(late) <= LATE_S), F.nullif(F.count_if(late.isNotNull()), F.lit(0))).alias("on_time_share"),
        F.countDistinct("trip_id").alias("trips"), F.countDistinct(F.when(canceled, F.col("trip_id"))).alias("canceled_trips"),
        F.avg(late).alias("avg_delay_seconds"), F.count_if(canceled).alias("canceled_updates"), F.max("rt_timestamp").alias("last_update"),
    )
    vehicles = positions.groupBy(F.to_date("timestamp").alias("day")).agg(F.countDistinct("vehicle_id").alias("active_vehicles"))
    return days.join(vehicles, "day", "left").select(
        "day", "on_time_share", "trips", "canceled_trips", ratio("canceled_trips", "trips").alias("canceled_share"),
        "avg_delay_seconds", ratio("canceled_updates", "trips").alias("cancellation_rate"),
        F.coalesce("active_vehicles", F.lit(0)).alias("active_vehicles"), "last_update",
    )


def kpis_of(kpis: DataFrame, day: Column, days_back: int = 14) -> DataFrame:
    """The row of a day; without one, the latest of the days before."""
    return kpis.where((F.col("day") <= day) & (F.col("day") >= F.date_sub(day, days_back))).orderBy(F.desc("day")).limit(1)


def latest_unmonitored(detail: DataFrame, n: int = 200) -> DataFrame:
    return detail.orderBy(F.desc("end_timestamp_utc"), "vehicle_id", "start_timestamp_utc").limit(n)


def top_routes(speeds: DataFrame, n: int = 10) -> DataFrame:
    """The hours of the n routes with most positions."""
    top = speeds.groupBy("route_id").agg(F.sum("position_count").alias("total")).orderBy(F.desc("total"), "route_id").limit(n)
    return speeds.join(top, "route_id").select("route_id", "service_date", "hour_utc", "direction_id", "route_mode", "avg_speed_kmh", "position_count")


def latest_slice(speeds: DataFrame) -> DataFrame:
    """Cells of the last hour of the last date."""
    last = speeds.agg(F.max(F.struct("service_date", "hour_utc")).alias("m")).select("m.*")
    return speeds.join(F.broadcast(last), ["service_date", "hour_utc"])  # one row


#: Edges of shapes that are broadcast at most, about 200 bytes each; more are joined by shuffle.
BROADCAST_EDGES = 100_000


def trip_edges(edges: DataFrame, trips: DataFrame) -> DataFrame:
    """Road edges are found once for a shape and then given to its trips.

    Trips are dealt out before they become a row for each edge, so that no task makes the rows of a whole file; what is
    grouped by trip needs no other shuffle then.
    """
    few = F.broadcast if edges.count() <= BROADCAST_EDGES else (lambda df: df)
    parts = int(trips.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = trips.select("trip_id", "route_id", "shape_id").repartition(parts, "trip_id")
    return dealt.join(few(edges), "shape_id").select("trip_id", "route_id", "edge_id", "road_name", "overlap_m")


def route_edges(bridge: DataFrame) -> DataFrame:
    return bridge.groupBy("route_id", "edge_id").agg(
        F.min("road_name").alias("road_name"), F.countDistinct("trip_id").alias("trips_using_edge"), F.sum("overlap_m").alias("total_overlap_m")
    )


def edge_diagnostics(bridge: DataFrame) -> DataFrame:
    """Rows, distinct pairs, and the deciles of edges for each trip."""
    pairs = bridge.agg(F.count("*").alias("row_count"), F.countDistinct("trip_id", "edge_id").alias("pair_count"))
    each = bridge.groupBy("trip_id").agg(F.countDistinct("edge_id").alias("n"))
    at = F.array(*[F.lit(k / 10) for k in range(11)])
    deciles = each.agg(F.percentile_approx("n", at, 10000).alias("d"))
    one = pairs.crossJoin(F.broadcast(deciles))  # one row with one row
    return one.select("row_count", "pair_count", F.posexplode("d").alias("decile", "edges"))


def new_edges(bridge: DataFrame, stored: DataFrame) -> DataFrame:
    """Pairs that are not stored yet."""
    return bridge.select("trip_id", "edge_id", "overlap_m").join(stored, ["trip_id", "edge_id"], "left_anti")


def variants(edges: DataFrame, loose: float = 10.0, strict: float = 40.0) -> DataFrame:
    """Edges for each shape under two thresholds."""
    of = lambda name, least: edges.where(F.col("overlap_m") > least).groupBy("shape_id").agg(
        F.countDistinct("edge_id").alias("edges"), F.sum("overlap_m").alias("overlap_m")
    ).select(F.lit(name).alias("variant"), "shape_id", "edges", "overlap_m")
    return of("current", loose).union(of("strict", strict))


def manifest_candidates(manifest: DataFrame, dataset: str, status: str, n: int) -> DataFrame:
    """The latest objects with a status, 1 to 32 of them."""
    held = manifest.where((F.col("dataset") == dataset) & (F.col("status") == status))
    return held.orderBy(F.desc("capture_ts"), "object_uri").limit(min(max(n, 1), 32))
