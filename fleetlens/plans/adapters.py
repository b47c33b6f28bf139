"""Feed-shaped views over the star-schema tables, so that every model can run on them.

Service dates, schedules and updates are derived from keys: vehicles are users, trips are order keys, of which those of
users have positions, and stops are order lines.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fleetlens.operators.spatial import spread


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def vehicle_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.get_json_object("props", "$.k").cast("int")
    lost = F.col("event_type") == "error"
    return table(spark, sf_dir, "events").select(
        F.col("event_id").cast("string").alias("record_id"),
        F.col("user_id").cast("string").alias("vehicle_id"),
        F.date_trunc("SECOND", F.col("ts").cast("timestamp")).alias("timestamp"),
        F.when(F.col("event_id") % 97 != 0, F.lit(-36.85) + k / F.lit(1000.0)).alias("latitude"),
        (F.lit(174.76) + (F.col("event_id") % 100) / F.lit(1000.0)).alias("longitude"),
        F.col("value").alias("speed"),
        (k * F.lit(3.6)).alias("bearing"),
        F.col("event_type").alias("occupancy_status"),
        F.when(~lost, F.concat(F.lit("R"), (F.col("user_id") % 10).cast("string"))).alias("route_id"),
        F.when(~lost, F.concat(F.lit("U"), F.col("user_id").cast("string"))).alias("trip_id"),
    )


def region_config(spark: SparkSession) -> DataFrame:
    """One region; its day starts at four."""
    return spark.range(1).select(
        F.lit("nz").alias("region_prefix"), F.lit("Region").alias("region_name"), F.lit("Authority").alias("transit_authority"),
        F.lit("Pacific/Auckland").alias("timezone"), F.lit(4).cast("long").alias("svc_boundary_hour"),
    )


def feed_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A feed for each region, and one that starts with the first and is older."""
    r = table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    rows = r.select(F.col("r_regionkey").alias("k"), F.col("r_name").alias("feed_hash"), F.lit(0).alias("older")).unionByName(
        r.where("r_regionkey = 0").select(F.col("r_regionkey").alias("k"), F.concat("r_name", F.lit("_OLD")).alias("feed_hash"), F.lit(1).alias("older"))
    )
    created = F.timestamp_seconds(F.lit(1704067200) + F.col("k") * 3600 - F.col("older") * 1800)
    return rows.select(
        "feed_hash",
        F.concat(F.lit("publisher "), F.col("k").cast("string")).alias("feed_publisher_name"),
        F.concat(F.lit("v"), F.col("k").cast("string")).alias("feed_version"),
        (F.lit(20240101) + F.col("k") * 5).cast("long").alias("feed_start_date"),
        F.lit(20241231).cast("long").alias("feed_end_date"),
        created.alias("created_at"),
    )


# Route types dealt out to routes in turn.
TYPES = (0, 1, 2, 3, 3, 3, 4, 12, 11, 99)


def routes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A route for each nation, in the feed of its region and in that of the first."""
    n, r = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    both = n.join(r, n.n_regionkey == r.r_regionkey).select("n_nationkey", "n_name", "r_name", "r_regionkey")
    first = n.crossJoin(F.broadcast(r.where("r_regionkey = 0"))).select("n_nationkey", "n_name", "r_name", "r_regionkey")
    kinds = F.array(*[F.lit(t) for t in TYPES])
    return both.unionByName(first).distinct().select(
        F.concat(F.lit("R"), F.col("n_nationkey").cast("string")).alias("route_id"),
        F.lit("A1").alias("agency_id"),
        F.substring("n_name", 1, 3).alias("route_short_name"),
        F.col("n_name").alias("route_long_name"),
        F.get(kinds, (F.col("n_nationkey") % len(TYPES)).cast("int")).cast("long").alias("route_type"),
        F.col("r_name").alias("feed_hash"),
    )


def trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    return c.select(
        F.concat(F.lit("U"), F.col("c_custkey").cast("string")).alias("trip_id"),
        F.concat(F.lit("R"), (F.col("c_custkey") % 10).cast("string")).alias("route_id"),
        F.concat(F.lit("S"), (F.col("c_custkey") % 4).cast("string")).alias("service_id"),
        (F.col("c_custkey") % 2).cast("long").alias("direction_id"),
        F.concat(F.lit("H"), (F.col("c_custkey") % 7).cast("string")).alias("shape_id"),
        F.lit("AFRICA").alias("feed_hash"),
    )


def _lines(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """Order lines with these columns, their trip and their planned time, dealt out by trip: what is asked of trips, or of their
    stops, goes by these partitions and is not shuffled again. The order's key travels in the trip's id."""
    trip = F.concat(F.lit("U"), F.col("l_orderkey").cast("string")).alias("trip_id")
    dealt = table(spark, sf_dir, "lineitem").select(trip, "l_linenumber", *columns).repartition("trip_id")
    at = F.timestamp_seconds(F.lit(1704067200) + F.col("l_linenumber").cast("long") * 345600)
    return dealt.withColumn("l_orderkey", F.substring("trip_id", 2, 20).cast("long")).withColumn("planned", at)


def _first_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first of the lines of each (key, line), by their order that with the least part."""
    return _lines(spark, sf_dir, "l_partkey").groupBy("trip_id", "l_orderkey", "l_linenumber", "planned").agg(F.min("l_partkey").alias("l_partkey"))


def daily_schedule(spark: SparkSession, sf_dir: str) -> DataFrame:
    blank = F.col("l_orderkey") % 13 == 0
    return _first_lines(spark, sf_dir).select(
        F.lit(20240101).cast("long").alias("service_date"),
        F.to_date(F.lit("2024-01-01")).alias("service_date_dt"),
        F.lit("AFRICA").alias("feed_hash"),
        F.concat(F.lit("R"), (F.col("l_orderkey") % 10).cast("string")).alias("route_id"),
        (F.col("l_orderkey") % 2).cast("long").alias("direction_id"),
        "trip_id",
        F.concat(F.lit("N"), (F.col("l_orderkey") % 10).cast("string")).alias("route_short_name"),
        F.concat(F.lit("to "), (F.col("l_orderkey") % 5).cast("string")).alias("trip_headsign"),
        F.concat(F.lit("H"), (F.col("l_orderkey") % 7).cast("string")).alias("shape_id"),
        F.col("l_partkey").cast("string").alias("stop_id"),
        F.concat(F.lit("Stop "), F.col("l_partkey").cast("string")).alias("stop_name"),
        F.col("l_linenumber").cast("long").alias("stop_sequence"),
        F.when(~blank, F.col("planned")).alias("scheduled_arrival"),
        F.timestamp_seconds(F.unix_timestamp("planned") + 30).alias("scheduled_departure"),
        (F.col("l_linenumber") * F.lit(500.0)).alias("shape_dist_traveled"),
    )


def trip_updates(spark: SparkSession, sf_dir: str) -> DataFrame:
    order = ["l_partkey", "l_suppkey", "l_extendedprice", "l_quantity", "l_discount", "l_tax", "l_shipdate", "l_returnflag", "l_linestatus"]
    line = Window.partitionBy("trip_id", "l_linenumber")
    nth, stop = F.row_number().over(line.orderBy(*order)), F.min("l_partkey").over(line)
    delay = ((F.col("l_quantity") - 25) * 12).cast("long")
    actual = F.timestamp_seconds(F.unix_timestamp("planned") + F.col("delay"))
    rt = F.timestamp_seconds(F.unix_timestamp("planned") + F.col("nth") * 60)
    unsure = F.when(F.col("l_linestatus") == "O", 0).when(F.col("l_tax") > 0.04, 30)
    return (
        _lines(spark, sf_dir, *order)
        .withColumn("nth", nth)
        .withColumn("stop", stop)
        .where("l_returnflag <> 'N'")
        .withColumn("delay", delay)
        .select(
            "trip_id",
            F.lit("20240101").alias("start_date"),
            F.col("stop").cast("string").alias("stop_id"),
            F.col("l_linenumber").cast("long").alias("stop_sequence"),
            F.col("l_suppkey").cast("string").alias("vehicle_id"),
            F.concat_ws("-", "l_orderkey", "l_linenumber", "nth").alias("record_id"),
            F.concat_ws("-", "l_orderkey", "l_linenumber").alias("entity_id"),
            F.when(F.col("l_returnflag") == "A", "SCHEDULED").when(F.col("l_suppkey") % 5 == 0, "CANCELED").otherwise("NO_DATA").alias("schedule_relationship"),
            rt.alias("rt_timestamp"),
            actual.alias("actual_arrival"),
            F.when(F.col("l_tax") > 0.01, F.timestamp_seconds(F.unix_timestamp("planned") + F.col("delay") + 40)).alias("actual_departure"),
            F.col("delay").alias("arrival_delay"),
            F.when(F.col("l_tax") > 0.01, F.col("delay") + 10).alias("departure_delay"),
            unsure.cast("long").alias("arrival_uncertainty"),
            F.when(F.col("l_tax") > 0.01, unsure).cast("long").alias("departure_uncertainty"),
        )
    )


def service_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    start = F.timestamp_seconds(F.lit(1704067200) + F.col("o_orderkey") * 1800 % 2592000)
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("string").alias("alert_id"),
        start.alias("period_start"),
        F.when(F.col("o_orderstatus") != "O", F.timestamp_seconds(F.unix_timestamp(start) + 7200)).alias("period_end"),
    )


def calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Services of trips: S0 and S1 on working days, S2 at weekends, S3 has ended; and one of each supplier, of which
    some run at weekends only, and some have ended."""
    k = F.col("c_custkey") % 4
    own = table(spark, sf_dir, "customer").select(k.alias("k")).distinct().select(
        F.concat(F.lit("S"), F.col("k").cast("string")).alias("service_id"), (F.col("k") != 2).alias("work"), (F.col("k") == 3).alias("ended")
    )
    s = F.col("s_suppkey")
    others = table(spark, sf_dir, "supplier").select(
        F.concat(F.lit("P"), s.cast("string")).alias("service_id"), (s % 3 != 0).alias("work"), (s % 4 == 3).alias("ended")
    )
    days = ["monday", "tuesday", "wednesday", "thursday", "friday"]
    year = F.when(F.col("ended"), 20230000).otherwise(20240000).cast("long")
    return own.unionByName(others).select(
        "service_id", *[F.col("work").cast("long").alias(d) for d in days], *[(~F.col("work")).cast("long").alias(d) for d in ("saturday", "sunday")],
        (year + 101).alias("start_date"), (year + 1231).alias("end_date"), F.lit("AFRICA").alias("feed_hash"),
    )


def calendar_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """On 2 January S1 and every fifth supplier's service do not run, S2 and every fifth one's do; S3 runs a day later."""
    at = lambda df, name, date, kind: df.select(name.alias("service_id"), F.lit(date).cast("long").alias("date"), kind.cast("long").alias("exception_type"))
    k = F.col("c_custkey") % 4
    own = table(spark, sf_dir, "customer").select(k.alias("k")).distinct().where("k > 0")
    trips = at(own, F.concat(F.lit("S"), F.col("k").cast("string")), 20240102, F.when(F.col("k") == 1, 2).otherwise(1))
    trips = trips.withColumn("date", F.when(F.col("service_id") == "S3", 20240103).otherwise(F.col("date")).cast("long"))
    s = F.col("s_suppkey")
    others = at(table(spark, sf_dir, "supplier").where((s % 5).isin(1, 2)), F.concat(F.lit("P"), s.cast("string")), 20240102, F.when(s % 5 == 1, 2).otherwise(1))
    return trips.unionByName(others).withColumn("feed_hash", F.lit("AFRICA"))


def stops(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("string").alias("stop_id"), F.col("p_size").cast("string").alias("stop_code"),
        F.col("p_name").alias("stop_name"), F.lit("AFRICA").alias("feed_hash"),
    )


def stop_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clocks run past midnight on long trips."""
    hour = F.lit(20) + F.col("l_linenumber")
    clock = F.format_string("%02d:%02d:00", hour.cast("int"), (F.col("l_orderkey") % 60).cast("int"))
    return _first_lines(spark, sf_dir).select(
        "trip_id",
        F.col("l_partkey").cast("string").alias("stop_id"),
        F.col("l_linenumber").cast("long").alias("stop_sequence"),
        F.when(F.col("l_orderkey") % 13 != 0, clock).alias("arrival_time"),
        clock.alias("departure_time"),
        F.lit("AFRICA").alias("feed_hash"),
    )


def shape_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Road edges that shapes run over."""
    return table(spark, sf_dir, "part").select(
        F.concat(F.lit("H"), (F.col("p_partkey") % 7).cast("string")).alias("shape_id"),
        F.concat(F.lit("E"), (F.col("p_partkey") % 50).cast("string")).alias("edge_id"),
        F.col("p_brand").alias("road_name"),
        F.col("p_size").cast("double").alias("overlap_m"),
    ).groupBy("shape_id", "edge_id").agg(F.min("road_name").alias("road_name"), F.sum("overlap_m").alias("overlap_m"))


def manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.lit("vehicle_positions").alias("dataset"),
        F.concat(F.lit("o/"), F.col("o_orderkey").cast("string")).alias("object_uri"),
        F.col("o_orderdate").cast("timestamp").alias("capture_ts"),
        F.when(F.col("o_orderstatus") == "O", "pending").when(F.col("o_orderstatus") == "F", "done").otherwise("failed").alias("status"),
    )


SOUTH, WEST = -36.9, 174.7


def shape_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A shape for each of 25 nations, due east, 30 metres or so apart."""
    lat = F.lit(SOUTH) + F.col("n_nationkey") * F.lit(0.0003)
    point = lambda i: F.struct((F.lit(WEST) + i * F.lit(0.002)).alias("lon"), lat.alias("lat"))
    return table(spark, sf_dir, "nation").select(
        F.concat(F.lit("N"), F.col("n_nationkey").cast("string")).alias("shape_id"), F.transform(F.sequence(F.lit(0), F.lit(25)), point).alias("line")
    )


def road_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A road for each part, due east, on a shape or beside it. Parts are dealt out, as lines cost more than rows of a file."""
    parts = spread(table(spark, sf_dir, "part").select("p_partkey", "p_size"), "p_partkey")
    k = F.col("p_partkey")
    lat = F.lit(SOUTH) + (k % 25) * F.lit(0.0003) + (k % 4) * F.lit(0.00003)
    west = F.lit(WEST) + F.lit(0.0001) + (k % 40) * F.lit(0.001)
    east = west + F.lit(0.0001) + (F.col("p_size") % 7) * F.lit(0.0005)
    ends = F.array(*[F.struct(lon.alias("lon"), lat.alias("lat")) for lon in (west, east)])
    # an array of one line, as what is asked of lines would else be worked out before the parts are dealt out
    return parts.select(k.cast("string").alias("edge_id"), F.explode(F.array(ends)).alias("line"))
