"""What larger tables showed: rows that must not be lost, and work that has to be dealt out."""

import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F
from pyspark.sql.classic.dataframe import DataFrame

from fleetlens.functions import geometry as g
from fleetlens.llm import bitslice, scratch, simhash
from fleetlens.operators import spatial
from fleetlens.plans import registry, rounds, serving, stores
from fleetlens.sources import wire


def test_curated_merge_keeps_reports_of_one_second(spark, tmp_path):
    rows = [(n, dt.datetime(2024, 1, 1, 0, 0, 5, micro), 7, "click", 1.0, '{"k": 3}') for n, micro in ((1, 0), (2, 500), (3, 900))]
    schema = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"
    spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/events.parquet")
    got = stores.curated_merge(spark, str(tmp_path)).select("record_id", F.round("lng", 3)).collect()
    assert sorted(map(tuple, got)) == [("1", 174.761), ("2", 174.762), ("3", 175.763)]


def test_trip_edges_come_dealt_out_by_trip(spark):
    edges = spark.createDataFrame([(f"H{k % 2}", f"E{k}", "x", 1.0) for k in range(6)], "shape_id string, edge_id string, road_name string, overlap_m double")
    trips = spark.range(100).selectExpr("concat('U', id) trip_id", "'R' route_id", "concat('H', id % 2) shape_id").coalesce(1)
    bridge = serving.trip_edges(edges, trips)
    assert bridge.count() == 300
    per_task = bridge.groupBy(F.spark_partition_id()).count().collect()
    assert len(per_task) == 4 and max(r["count"] for r in per_task) < 150
    distinct = bridge.groupBy("trip_id").agg(F.countDistinct("edge_id"))._jdf.queryExecution().executedPlan().toString()
    assert distinct.count("Exchange hashpartitioning") + distinct.count("Exchange SinglePartition") <= 1


def _lines(seed):
    draw = np.random.default_rng(seed)
    out = []
    for n in (2, 1, 0, 5, 2, 3, 9, None, 2):
        out.append(None if n is None else [{"lon": 174.7 + x, "lat": -36.9 + y} for x, y in draw.uniform(0, 0.0004, (n, 2))])
    return out


@pytest.mark.parametrize("pairs", [g.PAIRS, 7])
def test_many_lines_at_once_as_one_by_one(monkeypatch, pairs):
    of = lambda lines: g._points(*[pd.Series([None if x is None else np.array([p[f] for p in x]) for x in lines], dtype=object) for f in ("lon", "lat")])
    a = [x for x in _lines(1) for _ in range(9)]
    b = _lines(2) * 9
    lengths, near = [g.overlap(x, y, 6.0) for x, y in zip(a, b)], [g.near(x, y, 6.0) for x, y in zip(a, b)]
    monkeypatch.setattr(g, "PAIRS", pairs)
    assert max(lengths) > 5 and np.allclose(g.overlaps(of(a), of(b), 6.0), lengths, atol=1e-6)
    assert g.nears(of(a), of(b), 6.0).tolist() == near and {True, False, None} <= set(near)


def test_roads_meet_only_shapes_beside_them(spark):
    point = lambda x, y: {"lon": 174.7 + x, "lat": -36.9 + y}
    schema = "line array<struct<lon:double,lat:double>>"
    shapes = spark.createDataFrame([(f"s{k}", [point(0, k * 0.0005), point(0.009, k * 0.0005)]) for k in range(10)], f"shape_id string, {schema}")
    roads = spark.createDataFrame([(f"r{k}", 0.0, [point(0, k * 0.0005), point(0.008, k * 0.0005)]) for k in range(10)], f"edge_id string, length_m double, {schema}")
    found = spatial.match_shapes(shapes, roads.coalesce(1))
    assert sorted((r.shape_id, r.edge_id) for r in found.collect()) == [(f"s{k}", f"r{k}") for k in range(10)]
    shapes, roads = spatial._dealt(shapes, "shape_id", 25.0), spatial._dealt(roads, "edge_id", 0.0)
    assert set(shapes.columns) >= {"bounds", "tile"} and shapes.join(roads.withColumnRenamed("bounds", "theirs"), "tile").count() > 10


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_rows_that_become_many_are_not_broadcast(spark, monkeypatch):
    fps = simhash.keep(spark.range(50).selectExpr("xxhash64(id) as fp"), "classes")
    assert "SortMergeJoin [k" in _plan(simhash.links(fps)).replace("cast(", "")
    kept = []
    monkeypatch.setattr(bitslice.Tables, "keep", lambda self, df, name: kept.append((name, _plan(df))) or scratch.keep(df, name))
    vectors = spark.createDataFrame([(n, [float(n), 1.0]) for n in range(60)], "vec_id long, embedding array<double>")
    assert bitslice.top_k(vectors).count() == 10
    found = dict(kept)["found"]
    assert "SortMergeJoin [lane" in found and "BroadcastHashJoin" not in found


def test_no_file_holds_all_documents(spark, tmp_path, monkeypatch):
    rows = [(n, dt.datetime(2024, 1, 1), 7, "click", 1.0, '{"k": 3}') for n in range(100)]
    schema = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{tmp_path}/in/events.parquet")
    monkeypatch.setattr(rounds, "FILE_DOCUMENTS", 3)
    monkeypatch.setattr(rounds, "shared_path", lambda _, name: str(tmp_path / name))
    assert rounds.realtime_round_trip(spark, str(tmp_path / "in")).count() == 100
    assert len(list((tmp_path / "documents").glob("part-*"))) >= 34


def test_messages_are_decoded_one_at_a_time(spark, monkeypatch):
    message = wire.encode({"header": {"gtfs_realtime_version": "2.0"}}, "FeedMessage")
    feeds, kept = spark.createDataFrame([(message, 1), (None, 2), (b"\x07", 3)], "content binary, n int"), []
    monkeypatch.setattr(DataFrame, "mapInPandas", lambda self, run, schema: kept.append(run) or self)
    wire.documents(feeds)
    parts = list(kept[0](iter([pd.DataFrame({"n": [1, 2, 3], "content": [message, None, b"\x07"]})])))
    assert [len(p) for p in parts] == [1, 1, 1] and [p["n"].iloc[0] for p in parts] == [1, 2, 3]
    assert "2.0" in parts[0]["document"].iloc[0] and parts[1]["document"].iloc[0] is None and parts[2]["error"].iloc[0]


def test_feeds_are_as_many_as_hours(spark, tmp_path, monkeypatch):
    rows = [(n, dt.datetime(2024, 1, 1, n % 2, n), n, "click", 1.0, '{"k": 3}') for n in range(40)]
    schema = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"
    spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/in/events.parquet")
    monkeypatch.setattr(stores, "shared_path", lambda _, name: str(tmp_path / name))
    got = stores.stream_ingest(spark, str(tmp_path / "in")).collect()
    assert sorted(int(r.vehicle_id) for r in got) == list(range(40)) and all(r.stamped for r in got)
    assert len(list((tmp_path / "feeds").glob("h=*"))) == 2


LINES = (
    "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, "
    "l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"
)


def _order_lines(spark, folder, n=40):
    rows = [(k // 4, k % 9, k % 5, k % 4, float(k % 50), 1.0, 0.0, 0.02, "AR"[k % 2], "OF"[k % 2], dt.datetime(2024, 1, 1)) for k in range(n)]
    spark.createDataFrame(rows, LINES).write.parquet(f"{folder}/lineitem.parquet")


@pytest.mark.parametrize("name", ["fct_trip_event", "fct_trip"])
def test_order_lines_are_shuffled_once_for_each_side(spark, tmp_path, name):
    _order_lines(spark, tmp_path)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = registry.queries()[name](spark, str(tmp_path))
        plan = _plan(df)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("Exchange hashpartitioning(trip_id") == 2 == plan.count("Exchange ")
    assert df.count() == (40 if name == "fct_trip_event" else 10)


def test_updates_travel_in_compressed_files_of_bounded_length(spark, tmp_path, monkeypatch):
    _order_lines(spark, tmp_path / "in")
    monkeypatch.setattr(rounds, "FILE_LINES", 3)
    monkeypatch.setattr(rounds, "shared_path", lambda _, name: str(tmp_path / name))
    assert rounds.updates_round_trip(spark, str(tmp_path / "in")).count() == 40
    files = list((tmp_path / "updates").glob("part-*"))
    assert len(files) >= 14 and all(f.name.endswith(".gz") for f in files)
