"""Queries that send tables through sources, sinks and geometry and give back what comes out."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlens import contracts
from fleetlens.functions import geometry as g
from fleetlens.functions.grid import HexGrid
from fleetlens.functions.scalars import ratio
from fleetlens.operators import conform, spatial, upsert
from fleetlens.plans import adapters as a
from fleetlens.session import shared_path
from fleetlens.sources import realtime, static, wire

GRID = HexGrid()
CELL, COARSE, STEPS = 8, 6, 2


FILES = 16
#: Documents in a file at most: a file is read by one task as a whole.
FILE_DOCUMENTS = 20_000
#: Documents of a line each in a compressed file at most; about 80 MB of text.
FILE_LINES = 200_000


def position_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(entity) of each position, in the shape of the public feeds."""
    at = F.struct(F.col("latitude"), F.col("longitude"), F.col("speed"))
    trip = F.struct("trip_id", "route_id")
    vehicle = F.struct(
        F.struct(F.col("vehicle_id").alias("id")).alias("vehicle"), at.alias("position"), trip.alias("trip"),
        (F.col("record_id").cast("long") % 9).alias("occupancy_status"), F.unix_timestamp("timestamp").alias("timestamp"),
    )
    return a.vehicle_positions(spark, sf_dir).select(F.struct(F.col("record_id").alias("id"), vehicle.alias("vehicle")).alias("entity"))


def realtime_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every position as a JSON document, many documents in each of several files, read and conformed."""
    path = shared_path(spark, "documents")
    found = position_entities(spark, sf_dir).select(F.to_json(F.struct(F.array("entity").alias("entity"))).alias("value"))
    found.repartition(FILES).write.option("compression", "gzip").option("maxRecordsPerFile", FILE_DOCUMENTS).text(path)
    read = realtime.vehicle_positions(realtime.tolerant(spark, path))
    rows = conform.conform(read, contracts.contract("stg_vehicle_positions"))
    return rows.select("vehicle_id", "trip_id", "route_id", "timestamp", "timestamp_s", "latitude", "longitude", "speed", "occupancy_status")


def _messages(entities: DataFrame) -> DataFrame:
    """entities(entity) as protobuf messages (content, file_modification_time, file_name), a batch of rows in each."""

    def plain(x):
        return {k: plain(v) for k, v in x.items() if v is not None} if isinstance(x, dict) else [plain(v) for v in x] if isinstance(x, list) else x

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            header = {"gtfs_realtime_version": "2.0", "timestamp": 1704067200}
            message = wire.encode({"header": header, "entity": [plain(e) for e in b.column(0).to_pylist()]}, "FeedMessage")
            yield pa.RecordBatch.from_arrays([pa.array([message], pa.binary())], names=["content"])

    spark = entities.sparkSession
    path = shared_path(spark, "messages")
    entities.mapInArrow(run, "content binary").write.parquet(path)
    stored = spark.read.parquet(path)
    return stored.select("content", F.timestamp_seconds(F.lit(1704067200)).alias("file_modification_time"), F.lit("feed.pb").alias("file_name"))


def _of_messages(messages: DataFrame) -> DataFrame:
    found = realtime.parsed(messages, "protobuf").where("error is null")
    return realtime.entities(found.select("d.*", "file_modification_time", "file_name"))


def protobuf_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every position in protobuf messages, decoded and conformed; coordinates are single precision there."""
    read = realtime.vehicle_positions(_of_messages(_messages(position_entities(spark, sf_dir))))
    rows = conform.conform(read, contracts.contract("stg_vehicle_positions"))
    return rows.select("vehicle_id", "trip_id", "route_id", "timestamp", "latitude", "longitude", "speed")


def updates_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every trip update as a JSON document of a line, with names in camel case, in compressed files, read by Spark's own reader."""
    event = lambda kind: F.struct(
        F.unix_timestamp(f"actual_{kind}").alias("time"), F.col(f"{kind}_delay").alias("delay"), F.col(f"{kind}_uncertainty").alias("uncertainty")
    )
    stop = F.struct(F.col("stop_id").alias("stopId"), F.col("stop_sequence").alias("stopSequence"), *[event(k).alias(k) for k in ("arrival", "departure")])
    trip = F.struct(F.col("trip_id").alias("tripId"), F.col("start_date").alias("startDate"), F.col("schedule_relationship").alias("scheduleRelationship"))
    # the record's number travels in the label
    vehicle = F.struct(F.col("vehicle_id").alias("id"), F.col("record_id").alias("label"))
    update = F.struct(trip.alias("trip"), vehicle.alias("vehicle"), F.unix_timestamp("rt_timestamp").alias("timestamp"), F.array(stop).alias("stopTimeUpdate"))
    entity = F.struct(F.col("record_id").alias("id"), update.alias("tripUpdate"))
    path = shared_path(spark, "updates")
    found = a.trip_updates(spark, sf_dir).select(F.to_json(F.struct(F.struct(F.array(entity).alias("entity")).alias("response"))).alias("value"))
    found.write.option("compression", "gzip").option("maxRecordsPerFile", FILE_LINES).text(path)
    good = realtime.lines(spark, path).where("error is null").select("d.*", "file_modification_time", "file_name")
    read = realtime.trip_updates(realtime.entities(good))
    return read.select(
        F.col("vehicle_label").alias("record_id"), "trip_id", "start_date", "stop_id", "stop_sequence", "vehicle_id", "schedule_relationship", "timestamp_s",
        "actual_arrival_s", "arrival_delay", "arrival_uncertainty", "actual_departure_s", "departure_delay", "departure_uncertainty",
    )


def alerts_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every service alert in protobuf messages."""
    period = F.struct(F.unix_timestamp("period_start").alias("start"), F.unix_timestamp("period_end").alias("end"))
    number = F.col("alert_id").cast("long")
    subject = F.struct(F.concat(F.lit("R"), (number % 10).cast("string")).alias("route_id"))
    header = F.struct(F.array(F.struct(F.concat(F.lit("alert "), "alert_id").alias("text"))).alias("translation"))
    alert = F.struct(F.array(period).alias("active_period"), F.array(subject).alias("informed_entity"), (1 + number % 3).alias("cause"), header.alias("header_text"))
    entities = a.service_alerts(spark, sf_dir).select(F.struct(F.col("alert_id").alias("id"), alert.alias("alert")).alias("entity"))
    read = realtime.service_alerts(_of_messages(_messages(entities)))
    return read.select("alert_id", "period_start_s", "period_end_s", "route_id", "header", "cause")


def static_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stops in timetable archives of two members each, and how many tables a stop's archive has."""
    stops = a.stops(spark, sf_dir).select("stop_id", "stop_name", "stop_code", (F.col("stop_id").cast("long") % 8).alias("archive"))

    def pack(rows: pd.DataFrame) -> pd.DataFrame:
        out = io.BytesIO()
        with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
            z.writestr("feed/stops.txt", rows[["stop_id", "stop_name", "stop_code"]].to_csv(index=False))
            z.writestr("feed/agency.txt", f"agency_id,agency_name\n{rows['archive'].iloc[0]},Agency\n")
        return pd.DataFrame({"content": [out.getvalue()]})

    path = shared_path(spark, "archives")
    stops.groupBy("archive").applyInPandas(pack, "content binary").write.parquet(path)
    found = spark.read.parquet(path).select(F.md5("content").alias("feed_hash"), "content", F.timestamp_seconds(F.lit(1704067200)).alias("updated_at"))
    tables = static.tables(found)
    read = static.table(tables, "stops", "stop_id string, stop_name string, stop_code string")
    agency = static.table(tables, "agency", "agency_id string").select("feed_hash", F.col("agency_id").cast("long").alias("archive"))
    counts = tables.where("error is null").groupBy("feed_hash").agg(F.countDistinct("table").alias("tables"))
    return read.join(agency, "feed_hash").join(counts, "feed_hash").select("stop_id", "stop_name", "stop_code", "archive", "tables")


def append_by_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All positions appended twice to a table by day; rows and vehicles of each day."""
    path = shared_path(spark, "appended")
    for _ in range(2):
        upsert.append(a.vehicle_positions(spark, sf_dir), path, ["record_id", "vehicle_id", "timestamp", "created_at", "updated_at"])
    stored = spark.read.parquet(path)
    return stored.groupBy(F.col(upsert.DAY).alias("day")).agg(F.count("*").alias("row_count"), F.countDistinct("vehicle_id").alias("vehicles"))


def manifest_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every object is stored, and those of finished orders arrive again with another status."""
    path, at = shared_path(spark, "manifest"), lambda n: F.timestamp_seconds(F.lit(1704067200 + n))
    objects = a.manifest(spark, sf_dir).select("dataset", "object_uri", "status", at(0).alias("created_at"), at(0).alias("updated_at"))
    again = objects.where("status = 'done'").withColumns({"status": F.lit("archived"), "created_at": at(60), "updated_at": at(60)})
    for part in (objects, again):
        upsert.merge_untimed(spark, part, path, ["dataset", "object_uri"])
    return spark.read.parquet(path)


def _cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    cell = GRID.cell(F.col("latitude"), F.col("longitude"), CELL).alias("cell")
    return a.vehicle_positions(spark, sf_dir).select(cell).where("cell is not null").distinct()


def cell_boundary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cells of positions with their coarser cell, and the points and bounds of their outlines."""
    outline = g.from_wkt(GRID.boundary(F.col("cell")))
    shaped = _cells(spark, sf_dir).withColumn("line", outline).withColumn("bounds", g.box(F.col("line")))
    return shaped.select("cell", GRID.parent(F.col("cell"), COARSE).alias("parent"), F.size("line").alias("points"), "bounds.*")


def cell_disk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All cells at most two steps from a position's cell, with the number of position cells that they are near to."""
    return _cells(spark, sf_dir).select(F.explode(GRID.disk(F.col("cell"), STEPS)).alias("cell")).groupBy("cell").agg(F.count("*").alias("near"))


def _ways(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The roads with tags: a class by part, a name by brand."""
    kinds = F.array(*[F.lit(k) for k in (*spatial.DRIVEN, "footway", "steps")])
    tag = lambda k, v: F.struct(F.lit(k).alias("key"), v.alias("value"))
    part = a.table(spark, sf_dir, "part").select(F.col("p_partkey").cast("string").alias("edge_id"), "p_partkey", "p_brand")
    kind = F.get(kinds, (F.col("p_partkey") % (len(spatial.DRIVEN) + 2)).cast("int"))
    tags = F.array(tag("highway", kind), tag("name", F.col("p_brand")))
    return a.road_lines(spark, sf_dir).join(part, "edge_id").select(F.col("edge_id").alias("id"), tags.alias("tags"), g.to_wkt(F.col("line")).alias("geometry"))


def osm_roads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Driven roads that touch the southern half of the area."""
    found = spatial.osm_roads(_ways(spark, sf_dir), 174.0, -37.0, 175.0, a.SOUTH + 0.00325)
    return found.select("edge_id", "name", "highway", F.round("length_m", 1).alias("length_m"))


def shape_road_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Matches by the strict rules, with the names of the roads."""
    roads = spatial.osm_roads(_ways(spark, sf_dir), 174.0, -37.0, 175.0, -36.0)
    found = spatial.match_shapes(a.shape_lines(spark, sf_dir), roads, least_m=40.0, least_share=0.3, simplify_m=2.0)
    named = spatial.with_roads(found, roads)
    return named.select("shape_id", "edge_id", "road_name", "highway", F.round("overlap_m", 1).alias("overlap_m"), F.round("overlap_ratio", 3).alias("overlap_ratio"))


def unmatched_roads(spark: SparkSession, sf_dir: str) -> DataFrame:
    roads = a.road_lines(spark, sf_dir).withColumn("length_m", g.length_m(F.col("line")))
    return spatial.unmatched(roads, spatial.match_shapes(a.shape_lines(spark, sf_dir), roads)).select("edge_id")


def edge_statistics(bridge: DataFrame, edges: DataFrame) -> DataFrame:
    """Edges of trips: least, mean, most and exact median; rows, shapes and edges for each shape."""
    each = bridge.groupBy("trip_id").agg(F.countDistinct("edge_id").alias("n"))
    trips = each.agg(
        F.count("*").alias("trips"), F.min("n").alias("min_edges"), F.avg("n").alias("avg_edges"), F.max("n").alias("max_edges"),
        F.median("n").alias("median_edges"),
    )
    shapes = edges.agg(F.count("*").alias("shape_edge_rows"), F.countDistinct("shape_id").alias("shapes"))
    one = trips.crossJoin(F.broadcast(shapes))  # one row with one row
    return one.withColumn("avg_edges_per_shape", ratio("shape_edge_rows", "shapes"))


def recent_positions(positions: DataFrame, hours: int = 36) -> DataFrame:
    """Positions of the hours up to the last one, but for those of lost vehicles."""
    last = positions.agg(F.max("timestamp").alias("last"))
    held = positions.crossJoin(F.broadcast(last)).where(F.col("timestamp") > F.col("last") - F.make_dt_interval(F.lit(0), F.lit(hours)))  # one row
    return held.where(~F.col("occupancy_status").isin("error", "logout")).select("record_id", "vehicle_id", "timestamp")


def date_slice(speeds: DataFrame) -> DataFrame:
    """Cells of the last date, whatever the hour."""
    last = speeds.agg(F.max("service_date").alias("service_date"))
    return speeds.join(F.broadcast(last), "service_date")  # one row
