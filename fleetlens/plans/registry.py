"""Named queries over the feed-shaped views of the star-schema tables.

A query's builder composes models; Catalyst sees one plan. Pings of the test tables are hours apart, so the queries take
thresholds that tell them apart instead of the defaults.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetlens.functions import geometry
from fleetlens.operators import conform, spatial, upsert
from fleetlens.plans import adapters as a
from fleetlens.plans import hexagons as h
from fleetlens.plans import models as m
from fleetlens.plans import rounds as r
from fleetlens.plans import serving as s
from fleetlens.plans import stores as t
from fleetlens.session import shared_path, stay_dealt

ZONE = "Pacific/Auckland"
QUERY_GAP_S, QUERY_MOVE_M = 26_000, 5_000.0
#: Rounding for comparisons. Means of values with two decimals often lie just half-way; the nudge takes them off it.
DIGITS, NUDGE = 6, 1e-8


class Views:
    """The tables and models for one folder, each built when first asked for."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def _of(self, view):
        return view(self.spark, self.sf_dir)

    positions = cached_property(lambda v: v._of(a.vehicle_positions))
    region = cached_property(lambda v: a.region_config(v.spark))
    dim_feed = cached_property(lambda v: m.dim_feed(v._of(a.feed_info)))
    dim_route = cached_property(lambda v: m.dim_route(v._of(a.routes), v.dim_feed))
    trips = cached_property(lambda v: m.latest_trips(v._of(a.trips), v.dim_feed))
    updates = cached_property(lambda v: v._of(a.trip_updates))
    plan = cached_property(lambda v: m.fct_trip_plan(v._of(a.daily_schedule), ZONE))
    trip_update = cached_property(lambda v: m.fct_trip_update(v.updates))

    @cached_property
    def trip_event(self) -> DataFrame:
        stay_dealt(self.spark)  # plan and updates are dealt out by trip, and so are positions for segments
        return m.fct_trip_event(self.plan, self.trip_update)

    vehicle = cached_property(
        lambda v: m.fct_vehicle_position(v.positions, v.dim_route, v.trips, v.region, QUERY_GAP_S, QUERY_MOVE_M)
    )
    vehicle_day = cached_property(lambda v: m.agg_position_vehicle_day(v.vehicle))
    grid_day = cached_property(lambda v: m.agg_position_grid_day(v.vehicle))
    route_hour = cached_property(lambda v: m.agg_speed_route_hour(v.vehicle))
    grid_hour = cached_property(lambda v: m.agg_speed_grid_hour(v.vehicle))
    detail = cached_property(lambda v: m.mdl_unmonitored_detail(v.vehicle))
    v2_position = cached_property(lambda v: m.v2_fct_vehicle_position(v.positions, v.dim_route, v.region))
    v2_segment = cached_property(lambda v: m.v2_fct_vehicle_segment(v.v2_position, QUERY_GAP_S, QUERY_MOVE_M, 1.0))
    v2_grid_hour = cached_property(lambda v: m.v2_agg_speed_grid_hour(v.v2_position, v.trips))
    v2_route_hour = cached_property(lambda v: m.v2_agg_speed_route_hour(v.v2_position, v.trips))
    services = cached_property(lambda v: m.active_services(v._of(a.calendar), v._of(a.calendar_dates), 20240102, "tuesday"))
    bridge = cached_property(lambda v: s.trip_edges(v._of(a.shape_edges), v._of(a.trips)))

    def daily_schedule(self) -> DataFrame:
        feed = m.applicable_feed(self._of(a.feed_info).where("feed_hash like 'AFRICA%'"), 20240102)
        return m.daily_schedule(
            feed, self.services, self._of(a.trips), self._of(a.routes), self._of(a.stop_times), self._of(a.stops), "2024-01-02", ZONE
        )

    def shape_roads(self) -> DataFrame:
        roads = self._of(a.road_lines).withColumn("length_m", geometry.length_m(F.col("line")))
        found = spatial.match_shapes(self._of(a.shape_lines), roads)
        return found.select("shape_id", "edge_id", F.round("overlap_m", 1).alias("overlap_m"))

    def conformed(self) -> DataFrame:
        """Every event twice, the second time later and without its speed."""
        first = a.table(self.spark, self.sf_dir, "events").select(
            F.col("event_id").alias("vehicle_id"), F.unix_timestamp(F.col("ts").cast("timestamp")).cast("string").alias("timestamp_s"),
            (F.col("event_id") % 6).cast("string").alias("occupancy_status"), F.col("value").alias("speed"),
            F.timestamp_seconds(F.lit(1704067200)).alias("updated_at"),
        )
        again = first.select(
            "vehicle_id", "timestamp_s", "occupancy_status", F.lit(None).cast("double").alias("speed"),
            F.timestamp_seconds(F.lit(1704067260)).alias("updated_at"),
        )
        return conform.conform(first.unionByName(again), QUERY_CONTRACT).drop("record_id")

    def upserted(self) -> DataFrame:
        """Even keys stored; the odd ones and every third key arrive with twice their values. Through a table on disk."""
        events = a.table(self.spark, self.sf_dir, "events").select(
            F.col("event_id").cast("string").alias("record_id"), F.col("ts").cast("timestamp").alias("timestamp"), F.col("value").alias("v")
        )
        stamp = lambda n: F.timestamp_seconds(F.lit(1704067200 + n))
        number = F.col("record_id").cast("long")
        target = events.where(number % 2 == 0).withColumn("created_at", stamp(0)).withColumn("updated_at", stamp(0))
        batch = events.where((number % 2 == 1) | (number % 3 == 0)).withColumn("v", F.col("v") * 2).withColumn("created_at", stamp(60)).withColumn("updated_at", stamp(60))
        path = shared_path(self.spark, "upsert")
        for part in (target, batch):
            upsert.upsert(self.spark, part, path)
        return self.spark.read.parquet(path).drop(upsert.DAY)


QUERY_CONTRACT = conform.Contract(
    name="vehicles",
    schema=T.StructType(
        [
            T.StructField("created_at", T.TimestampType()), T.StructField("updated_at", T.TimestampType()),
            T.StructField("record_id", T.StringType()), T.StructField("timestamp", T.TimestampType()),
            T.StructField("timestamp_s", T.LongType()), T.StructField("vehicle_id", T.StringType()),
            T.StructField("occupancy_status", T.StringType()), T.StructField("speed", T.DoubleType()),
            T.StructField("odometer", T.DoubleType()),
        ]
    ),
    volatile=("created_at", "updated_at", "speed"),
    not_null=("vehicle_id",),
    labels={"occupancy_status": {0: "EMPTY", 1: "MANY_SEATS_AVAILABLE", 2: "FEW_SEATS_AVAILABLE", 3: "STANDING_ROOM_ONLY"}},
    digits={"speed": 2},
)


BUILDERS: dict[str, Callable[[Views], DataFrame]] = {
    "dim_feed": lambda v: v.dim_feed,
    "dim_route": lambda v: v.dim_route,
    "active_services": lambda v: v.services,
    "daily_schedule": Views.daily_schedule,
    "fct_trip_plan": lambda v: v.plan,
    "fct_trip_update": lambda v: v.trip_update,
    "fct_trip_event": lambda v: v.trip_event,
    "fct_trip": lambda v: m.fct_trip(v.trip_event),
    "fct_trip_dwell": lambda v: m.fct_trip_dwell(v.trip_event),
    "fct_trip_segment": lambda v: m.fct_trip_segment(v.trip_event, v.vehicle),
    "fct_vehicle_position": lambda v: v.vehicle,
    "agg_position_vehicle_day": lambda v: v.vehicle_day,
    "agg_position_grid_day": lambda v: v.grid_day,
    "agg_speed_route_hour": lambda v: v.route_hour,
    "agg_speed_grid_hour": lambda v: v.grid_hour,
    "mdl_unmonitored_vehicle_daily": lambda v: m.mdl_unmonitored_vehicle_daily(v.vehicle_day),
    "mdl_unmonitored_grid_daily": lambda v: m.mdl_unmonitored_grid_daily(v.grid_day).drop("cell_geometry"),
    "mdl_unmonitored_detail": lambda v: v.detail,
    "mdl_speed_route_hourly": lambda v: m.mdl_speed_route_hourly(v.route_hour),
    "mdl_speed_grid_hourly": lambda v: m.mdl_speed_grid_hourly(v.grid_hour),
    "v2_fct_vehicle_position": lambda v: v.v2_position,
    "v2_fct_vehicle_segment": lambda v: v.v2_segment,
    "v2_agg_speed_grid_hour": lambda v: v.v2_grid_hour,
    "v2_agg_speed_route_hour": lambda v: v.v2_route_hour,
    "v2_agg_unmonitored_grid_day": lambda v: m.v2_agg_unmonitored_grid_day(v.v2_segment),
    "v2_agg_unmonitored_vehicle_day": lambda v: m.v2_agg_unmonitored_vehicle_day(v.v2_segment),
    "v2_mdl_speed_grid_hourly": lambda v: m.v2_mdl_speed_grid_hourly(v.v2_grid_hour),
    "v2_mdl_speed_route_hourly": lambda v: m.v2_mdl_speed_route_hourly(v.v2_route_hour),
    "rolling_stddev": lambda v: m.rolling_deviation(v.vehicle_day),
    "hourly_dashboard": lambda v: s.hourly_dashboard(v.spark, "2024-01-05", v.positions, v.updates, v._of(a.service_alerts)),
    "daily_kpis": lambda v: s.daily_kpis(v.updates, v.positions),
    "kpis_fallback": lambda v: s.kpis_of(s.daily_kpis(v.updates, v.positions), F.lit("2024-02-05").cast("date")),
    "unmonitored_latest": lambda v: s.latest_unmonitored(v.detail),
    "top_routes": lambda v: s.top_routes(v.route_hour),
    "latest_slice": lambda v: s.latest_slice(v.grid_hour),
    "agg_vehicle_hour": lambda v: m.agg_vehicle_hour(v.v2_segment),
    "agg_vehicle_day": lambda v: m.agg_vehicle_day(m.agg_vehicle_hour(v.v2_segment)),
    "shape_road_match": Views.shape_roads,
    "trip_edges": lambda v: v.bridge,
    "edge_route_rollup": lambda v: s.route_edges(v.bridge),
    "edge_diagnostics": lambda v: s.edge_diagnostics(v.bridge),
    "edge_incremental_antijoin": lambda v: s.new_edges(v.bridge, v.bridge.where("trip_id like '%7'").select("trip_id", "edge_id").distinct()),
    "shape_variant_union": lambda v: s.variants(v._of(a.shape_edges), 100.0, 200.0),
    "manifest_candidates": lambda v: s.manifest_candidates(v._of(a.manifest), "vehicle_positions", "pending", 40),
    "conform_dedup": Views.conformed,
    "record_id_hash": lambda v: a.table(v.spark, v.sf_dir, "orders").select(
        "o_orderkey", conform.record_id("o_orderkey", "o_custkey", "o_orderstatus").alias("record_id")
    ),
    "upsert_result": Views.upserted,
    "realtime_round_trip": lambda v: v._of(r.realtime_round_trip),
    "protobuf_round_trip": lambda v: v._of(r.protobuf_round_trip),
    "updates_round_trip": lambda v: v._of(r.updates_round_trip),
    "alerts_round_trip": lambda v: v._of(r.alerts_round_trip),
    "static_members": lambda v: v._of(r.static_members),
    "append_by_day": lambda v: v._of(r.append_by_day),
    "manifest_merge": lambda v: v._of(r.manifest_merge),
    "cell_boundary": lambda v: v._of(r.cell_boundary),
    "cell_disk": lambda v: v._of(r.cell_disk),
    "osm_roads": lambda v: v._of(r.osm_roads),
    "shape_road_strict": lambda v: v._of(r.shape_road_strict),
    "unmatched_roads": lambda v: v._of(r.unmatched_roads),
    "edge_statistics": lambda v: r.edge_statistics(v.bridge, v._of(a.shape_edges)),
    "recent_positions": lambda v: r.recent_positions(v.positions),
    "date_slice": lambda v: r.date_slice(v.grid_hour),
    "snapshot_difference": lambda v: v._of(t.snapshot_difference),
    "archive_store": lambda v: v._of(t.archive_store),
    "quarantine_rejects": lambda v: v._of(t.quarantine_rejects),
    "bucketed_join": lambda v: v._of(t.bucketed_join),
    "sql_functions": lambda v: v._of(t.sql_functions),
    "flatten_orders": lambda v: v._of(t.flatten_orders),
    "landed_hours": lambda v: v._of(t.landed_hours),
    "stream_ingest": lambda v: v._of(t.stream_ingest),
    "mapped_fields": lambda v: v._of(t.mapped_fields),
    "declared_table": lambda v: v._of(t.declared_table),
    "compacted_files": lambda v: v._of(t.compacted_files),
    "clustered_edges": lambda v: t.clustered_edges(v.bridge),
    "curated_merge": lambda v: v._of(t.curated_merge),
    "shape_statistics": lambda v: t.shape_statistics(v._of(a.shape_edges)),
    "schedule_head": lambda v: t.schedule_head(Views.daily_schedule(v)),
    "near_roads": lambda v: v._of(t.near_roads),
    "rolling_stddev_days": lambda v: m.rolling_deviation(v.vehicle_day, "days"),
    "agg_vehicle_route_hour": lambda v: m.agg_vehicle_hour(v.v2_segment, "route_id"),
    "agg_vehicle_cell_hour": lambda v: m.agg_vehicle_hour(v.v2_segment, "start_cell"),
    "clean_segments": lambda v: m.clean_segments(v.v2_segment, "2024-01-10").select("segment_id", "vehicle_id", "service_date", "delta_seconds"),
    "h3_cells": lambda v: v._of(h.h3_cells),
    "h3_boundary": lambda v: v._of(h.h3_boundary),
    "h3_disk": lambda v: v._of(h.h3_disk),
    "agg_position_h3_day": lambda v: h.agg_position_h3_day(v.vehicle),
    "agg_speed_h3_hour": lambda v: h.agg_speed_h3_hour(v.vehicle),
    "mdl_unmonitored_h3_daily": lambda v: h.mdl_unmonitored_h3_daily(v.vehicle),
    "mdl_speed_h3_hourly": lambda v: h.mdl_speed_h3_hourly(v.vehicle),
}


def finished(df: DataFrame) -> DataFrame:
    """Instants without a zone, and doubles rounded, so that other engines give equal values."""
    out = []
    for f in df.schema:
        if isinstance(f.dataType, T.TimestampType):
            out.append(F.col(f.name).cast("timestamp_ntz").alias(f.name))
        elif isinstance(f.dataType, T.DoubleType):
            out.append(F.round(F.col(f.name) + F.lit(NUDGE), DIGITS).alias(f.name))
        else:
            out.append(F.col(f.name))
    return df.select(*out)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: (lambda spark, sf_dir, b=build: finished(b(Views(spark, sf_dir)))) for name, build in BUILDERS.items()}
