"""Queries over H3 cells: positions by cell, aggregates by cell, outlines, and everything within a hundred steps."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlens.functions import geometry as g
from fleetlens.functions.h3 import H3Grid
from fleetlens.plans import adapters as a
from fleetlens.plans import models as m

GRID = H3Grid()
STEPS = 100


def h3_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fine cell of each position, the coarse one, and the one that the fine one's digits begin with."""
    at = lambda r: GRID.cell(F.col("latitude"), F.col("longitude"), r)
    found = a.vehicle_positions(spark, sf_dir).select("record_id", at(m.POSITION_CELL).alias("cell"), at(m.SPEED_CELL).alias("coarse"))
    return found.withColumn("parent", GRID.parent(F.col("cell"), m.SPEED_CELL))


def _cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    cell = GRID.cell(F.col("latitude"), F.col("longitude"), m.SPEED_CELL).alias("cell")
    return a.vehicle_positions(spark, sf_dir).where("latitude is not null").select(cell).distinct()


def h3_boundary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Corners and bounds of the cells of positions."""
    shaped = _cells(spark, sf_dir).withColumn("line", g.from_wkt(GRID.boundary(F.col("cell"))))
    shaped = shaped.withColumn("bounds", g.box(F.col("line")))
    return shaped.select("cell", (F.size("line") - 1).alias("corners"), "bounds.*")


def h3_disk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All cells at most STEPS steps from a position's cell, with the number of position cells that they are near to."""
    cells = _cells(spark, sf_dir)
    spread = cells.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "cell")  # a row becomes thousands
    return spread.select(F.explode(GRID.disk(F.col("cell"), STEPS)).alias("cell")).groupBy("cell").agg(F.count("*").alias("near"))


def agg_position_h3_day(vehicle: DataFrame) -> DataFrame:
    return m.agg_position_grid_day(vehicle, GRID)


def agg_speed_h3_hour(vehicle: DataFrame) -> DataFrame:
    return m.agg_speed_grid_hour(vehicle, grid=GRID)


def mdl_unmonitored_h3_daily(vehicle: DataFrame) -> DataFrame:
    """With the corners of each cell's outline in place of the outline."""
    found = m.mdl_unmonitored_grid_daily(agg_position_h3_day(vehicle), GRID)
    return found.withColumn("corners", F.size(g.from_wkt(F.col("cell_geometry"))) - 1).drop("cell_geometry")


def mdl_speed_h3_hourly(vehicle: DataFrame) -> DataFrame:
    return m.mdl_speed_grid_hourly(agg_speed_h3_hour(vehicle))
