"""Roads and shapes: which road edges a shape runs along."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetlens.functions import geometry as g
from fleetlens.functions.scalars import ratio

#: Side of the tiles, in degrees, that both sides of the join are dealt out to.
TILE = 0.01
# Road classes that vehicles drive on.
DRIVEN = (
    "motorway", "trunk", "primary", "secondary", "tertiary", "unclassified", "residential", "service",
    "motorway_link", "trunk_link", "primary_link", "secondary_link", "tertiary_link", "living_street", "busway",
)
ROAD = ("name", "highway", "oneway", "maxspeed")


def tiles(bounds: Column, side: float = TILE) -> Column:
    """The tiles that bounds touch."""
    of = lambda f: F.floor(bounds[f] / side).cast("int")
    rows = F.sequence(of("lat_min"), of("lat_max"))
    return F.flatten(
        F.transform(rows, lambda y: F.transform(F.sequence(of("lon_min"), of("lon_max")), lambda x: F.struct(x.alias("x"), y.alias("y"))))
    )


def _dealt(lines: DataFrame, key: str, margin_m: float) -> DataFrame:
    """(key, bounds, tile): the bounds of the segments of lines(key, line) with a margin, and the tiles that they touch."""
    pieces = F.transform(F.sequence(F.lit(1), F.greatest(F.size("line") - 1, F.lit(1))), lambda i: F.slice("line", i, 2))
    bounds = g.widened(g.box(F.col("piece")), margin_m)
    bounded = lines.where(F.size("line") > 0).select(key, F.explode(pieces).alias("piece")).select(key, bounds.alias("bounds"))
    return bounded.select(key, "bounds", F.explode(tiles(F.col("bounds"))).alias("tile"))


def spread(df: DataFrame, key: str) -> DataFrame:
    """Rows that are costly to work on, dealt to as many tasks as a shuffle has, as a table may be one file."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), key)


def osm_roads(ways: DataFrame, lon_min: float, lat_min: float, lon_max: float, lat_max: float, kinds=DRIVEN) -> DataFrame:
    """Roads of ways(id, tags array<struct<key,value>>, geometry wkt) within bounds, with their tags as columns."""
    area = F.struct(*[F.lit(v).alias(n) for n, v in (("lon_min", lon_min), ("lat_min", lat_min), ("lon_max", lon_max), ("lat_max", lat_max))])
    tag = lambda k: F.col("tag")[k]
    return (
        ways.withColumn("tag", F.map_from_entries(F.array_distinct("tags")))
        .where(F.map_contains_key("tag", "highway") & tag("highway").isin(*kinds))
        .select("*", F.explode(F.array(g.from_wkt(F.col("geometry")))).alias("line"))  # read once, however often it is used
        .where(g.boxes_meet(g.box(F.col("line")), area))
        .select(
            F.col("id").cast("string").alias("edge_id"), tag("name").alias("name"), tag("highway").alias("highway"),
            tag("oneway").alias("oneway"), tag("maxspeed").alias("maxspeed"), g.length_m(F.col("line")).alias("length_m"), "line",
        )
    )


def match_shapes(
    shapes: DataFrame, roads: DataFrame, buffer_m: float = 6.0, margin_m: float = 25.0, least_m: float = 10.0,
    least_share: float = 0.15, simplify_m: float | None = None,
) -> DataFrame:
    """(shape_id, edge_id, edge_length_m, overlap_m, overlap_ratio) of shapes(shape_id, line) and roads(edge_id, length_m,
    line).

    The bounds of both sides' segments are dealt out to tiles and joined on them where they meet; the lines of the pairs
    found are fetched, and lengths within buffer_m of the shape measured, which is less than margin_m. Roads are dealt
    out by their ids once. simplify_m thins the shapes first, as the strict variant does.
    """
    thin = shapes if simplify_m is None else shapes.withColumn("line", g.simplified(F.col("line"), simplify_m))
    roads = spread(roads.select("edge_id", "length_m", "line"), "edge_id")
    beside = _dealt(roads, "edge_id", 0.0).withColumnRenamed("bounds", "road_bounds")
    met = beside.join(_dealt(thin, "shape_id", margin_m), "tile").where(g.boxes_meet(F.col("bounds"), F.col("road_bounds")))
    pairs = met.select("shape_id", "edge_id").distinct()
    left = thin.select("shape_id", F.col("line").alias("shape_line"), g.widened(g.box(F.col("line")), margin_m).alias("shape_bounds"))
    right = roads.select("edge_id", "length_m", F.col("line").alias("edge_line"), g.box(F.col("line")).alias("edge_bounds"))
    near = pairs.join(left, "shape_id").join(right, "edge_id").where(g.boxes_meet(F.col("shape_bounds"), F.col("edge_bounds")))
    measured = near.withColumn("overlap_m", g.overlap_m(F.col("edge_line"), F.col("shape_line"), buffer_m))
    return measured.where((F.col("overlap_m") > least_m) & (F.col("overlap_m") >= least_share * F.col("length_m"))).select(
        "shape_id", "edge_id", F.col("length_m").alias("edge_length_m"), "overlap_m", ratio("overlap_m", "length_m").alias("overlap_ratio")
    )


def with_roads(matched: DataFrame, roads: DataFrame) -> DataFrame:
    """Matches with the name and tags of their roads."""
    return matched.join(roads.select("edge_id", F.col("name").alias("road_name"), *ROAD[1:]), "edge_id")


def unmatched(roads: DataFrame, matched: DataFrame) -> DataFrame:
    """Roads that no shape runs along."""
    return roads.join(matched, "edge_id", "left_anti")
