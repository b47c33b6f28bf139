"""Snapshots, archives, quarantine, buckets, flattening and functions by name."""

import datetime as dt

import pytest
from conftest import rows
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetlens.functions import registered
from fleetlens.operators import conform, quarantine, upsert
from fleetlens.operators.flatten import flatten
from fleetlens.plans import stores
from fleetlens.sources import archive
from fleetlens.streaming import snapshots


def test_snapshots_over_a_restart(spark, tmp_path):
    schema = "k string, v int"
    at = {n: str(tmp_path / n) for n in ("in", "state", "out", "progress")}

    def run():
        snapshots.follow(spark, spark.readStream.schema(schema).parquet(at["in"]), ["k"], at["state"], at["out"], at["progress"]).awaitTermination()

    for part in ([("a", 1), ("b", 1), ("a", 2), (None, 1)], [("b", 2), ("c", 1), (None, 2)], [("a", 3), ("c", 2)]):
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(at["in"])
        run()
    run()  # nothing new
    got = spark.read.parquet(at["out"])
    assert rows(got.select("batch", "k")) == rows(spark.createDataFrame([(0, "a"), (0, "b"), (0, None), (1, "c"), (2, "a")], "batch int, k string"))
    # a batch that is repeated compares with the same keys, and only the last two states stay
    assert snapshots._states(spark, at["state"]) == [1, 2]
    assert rows(snapshots.difference(spark.createDataFrame([("x", 1)], schema), None, ["k"])) == [("x", 1)]


def test_archive_by_content(spark, tmp_path):
    day = lambda n: dt.datetime(2024, 1, n)
    found = spark.createDataFrame([(b"one", day(1)), (b"two", day(3)), (b"one", day(2))], "content binary, updated_at timestamp")
    path = str(tmp_path / "archive")
    assert archive.store(found, path) == 2 and archive.store(found, path) == 0
    assert archive.store(spark.createDataFrame([(b"three", day(2))], found.schema), path) == 1
    assert rows(archive.stored(spark, path).select("n_bytes", "updated_at")) == [(3, day(1)), (3, day(3)), (5, day(2))]
    assert [r.updated_at for r in archive.latest(spark, path).collect()] == [day(3)]
    (tmp_path / "archive" / "latest").rename(tmp_path / "archive" / "latest__old")  # cut off between the renames
    assert archive.latest(spark, path).count() == 1 and archive.store(found, path) == 0
    assert (tmp_path / "archive" / "latest").exists() and not (tmp_path / "archive" / "latest__old").exists()


def test_quarantine(spark, tmp_path):
    contract = conform.Contract(name="t", schema=T.StructType([T.StructField("a", T.StringType(), False), T.StructField("b", T.LongType()), T.StructField("c", T.LongType(), False)]))
    df = spark.createDataFrame([("x", 1, 1, "f1"), (None, 2, None, "f2"), ("y", None, 3, "f2"), ("z", 1, None, "f3"), ("w", 1, 1, None)], "a string, b long, c long, file string")
    good, bad = quarantine.split(df, contract)
    assert rows(good.select("a")) == [("w",), ("x",), ("y",)]
    assert rows(bad.select("file", "reject_reason")) == [("f2", "a is null; c is null"), ("f3", "c is null")]
    assert rows(quarantine.by_file(df, contract, "file").select("a")) == [("w",), ("x",)]
    path = str(tmp_path / "rejects")
    with pytest.raises(quarantine.Rejected, match="c is null"):
        quarantine.all_or_nothing(df, contract, path)
    assert spark.read.parquet(path).count() == 2
    assert quarantine.all_or_nothing(good, contract).count() == 3


def test_joins_on_buckets_do_not_shuffle(spark, tmp_path):
    spark.range(500).select(F.col("id").alias("o_orderkey"), (F.col("id") % 3).cast("string").alias("o_orderstatus")).createOrReplaceTempView("o")
    upsert.bucketed_table(spark.table("o"), "bucketed_orders", str(tmp_path / "o"), "o_orderkey")
    lines = spark.range(2000).select((F.col("id") % 600).alias("l_orderkey"), F.lit(1.0).alias("l_quantity"))
    upsert.bucketed_table(lines, "bucketed_lines", str(tmp_path / "l"), "l_orderkey")
    found = stores.bucketed_orders(spark.table("bucketed_orders"), spark.table("bucketed_lines"))
    assert found.agg(F.sum("n")).first()[0] == sum(1 for k in range(2000) if k % 600 < 500)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Exchange" not in plan.replace("BroadcastExchange", "")
    spark.sql("DROP TABLE bucketed_orders")
    spark.sql("DROP TABLE bucketed_lines")


def test_flatten(spark):
    schema = "id int, s struct<a: int, b: struct<c: string>>, xs array<struct<x: int, ys array<int>>>, zs array<string>, m map<string, int>"
    df = spark.createDataFrame([(1, (1, ("c",)), [(1, [1, 2]), (2, [])], ["p", "q"], {"k": 1}), (2, None, None, [], None)], schema)
    got = flatten(df)
    assert got.columns == ["id", "s.a", "s.b.c", "xs.x", "xs.ys", "zs", "m"]
    plain = rows(got.select("id", "`s.b.c`", "`xs.x`", "`xs.ys`", "zs"))
    assert plain == rows(spark.createDataFrame(
        [(1, "c", x, y, z) for x, y in ((1, 1), (1, 2), (2, None)) for z in ("p", "q")] + [(2, None, None, None, None)], "id int, c string, x int, y int, z string"))
    assert flatten(df.select("id", "zs"), keep=("zs",)).count() == 2
    with pytest.raises(ValueError, match="one path"):
        flatten(spark.createDataFrame([((1,), 2)], "s struct<a: int>, `s.a` int"))


def test_functions_by_name(spark):
    from fleetlens.functions.grid import HexGrid

    points = spark.createDataFrame([(-36.85, 174.76), (None, 1.0), (float("nan"), 1.0)], "lat double, lon double")
    registered.register(spark, "h3")
    one = lambda q: spark.sql(q, points=points).collect()
    assert [r[0] for r in one("SELECT grid_parent(grid_cell(lat, lon, 9), 8) FROM {points}")][0].startswith("88bb50")
    assert [r[0] for r in one("SELECT grid_cell(lat, lon, 9) FROM {points}")][1:] == [None, None]
    assert tuple(one("SELECT at_least_zero(-1D), at_least_zero(NULL), route_mode(3), percent_change(1D, 0D), distance_m(0D, 0D, NULL, 0D) FROM {points}")[0]) == (0.0, None, "bus", None, None)
    registered.register(spark, "planar")
    swapped = spark.sql("SELECT lat, lon, grid_cell(lat, lon, 8) AS c FROM {points}", points=points.limit(1))
    assert swapped.where(F.col("c") == HexGrid().cell(F.col("lat"), F.col("lon"), 8)).count() == 1
    with pytest.raises(ValueError, match="not a grid"):
        registered.register(spark, "other")
