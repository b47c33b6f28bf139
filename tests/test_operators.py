"""Conforming, writers, sources, geometry and streams."""

import datetime as dt
import gzip
import io
import json
import zipfile

import pytest
from conftest import rows
from pyspark.sql import functions as F

from fleetlens import contracts
from fleetlens.functions import geometry as g
from fleetlens.functions.grid import HexGrid
from fleetlens.operators import conform, spatial, upsert
from fleetlens.sources import landing, realtime, static
from fleetlens.streaming import ingest


def document(vehicle, at, wrap=True, **more):
    entity = [{"id": "1", "vehicle": {"vehicle": {"id": vehicle}, "timestamp": at, "position": {"latitude": -36.1234567, "longitude": 174.5, "speed": 3.125}, "trip": {"tripId": "t", "routeId": "r"}, "occupancyStatus": 2, **more}}]
    return {"response": {"entity": entity}} if wrap else {"entity": entity}


def test_realtime_files(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps(document("v1", 1704067200)))
    (tmp_path / "b.json.gz").write_bytes(gzip.compress(json.dumps(document("v2", 1704067201, wrap=False)).encode()))
    (tmp_path / "c.json").write_text(json.dumps({"entity": []}))
    found = realtime.vehicle_positions(realtime.documents(spark, str(tmp_path)))
    got = conform.conform(found, contracts.contract("stg_vehicle_positions")).orderBy("vehicle_id").collect()
    assert [(r.vehicle_id, r.trip_id, r.occupancy_status, r.latitude, r.speed) for r in got] == [("v1", "t", "FEW_SEATS_AVAILABLE", -36.123457, 3.12), ("v2", "t", "FEW_SEATS_AVAILABLE", -36.123457, 3.12)]
    assert len({r.record_id for r in got}) == 2 and all(len(r.entity_id) == 16 for r in got)


def test_several_documents_in_a_file(spark, tmp_path):
    (tmp_path / "x.bin").write_bytes(gzip.compress((json.dumps(document("v1", 1)) + "\n" + json.dumps(document("v2", 2))).encode()))
    assert rows(realtime.vehicle_positions(realtime.tolerant(spark, str(tmp_path))).select("vehicle_id")) == [("v1",), ("v2",)]


def test_updates_and_alerts(spark, tmp_path):
    update = {"trip": {"trip_id": "t"}, "timestamp": 5, "stopTimeUpdate": [{"stopId": "a", "arrival": {"time": 7, "delay": 2}}, {"stop_id": "b"}]}
    alert = {"cause": "X", "headerText": {"translation": [{"text": "one"}, {"text": "two"}]}, "active_period": [{"start": 1}, {"start": 2}], "informed_entity": [{"route_id": "r"}]}
    (tmp_path / "a.json").write_text(json.dumps({"entity": [{"id": "1", "tripUpdate": update}, {"id": "2", "alert": alert}]}))
    found = realtime.documents(spark, str(tmp_path)).cache()
    assert rows(realtime.trip_updates(found).select("stop_id", "actual_arrival_s", "arrival_delay")) == [("a", 7, 2), ("b", None, None)]
    assert rows(realtime.service_alerts(found).select("header", "period_start_s", "route_id")) == [(h, p, "r") for h in ("one", "two") for p in (1, 2)]
    assert conform.conform(realtime.service_alerts(found), contracts.contract("stg_service_alerts")).count() == 4


def test_archives(spark, tmp_path):
    data = io.BytesIO()
    with zipfile.ZipFile(data, "w") as z:
        z.writestr("stops.txt", "stop_id,stop_name,stop_lat,stop_lon\nA,First,-36.5,174.5\nB,,x,\n")
        z.writestr("empty.txt", "")
        z.writestr("bad.txt", b"\xff\xfe\x00a,b\n\xff")
    for name in ("one.zip", "two.zip"):
        (tmp_path / name).write_bytes(data.getvalue())
    (tmp_path / "broken.zip").write_bytes(b"no")
    found = static.tables(static.archives(spark, str(tmp_path)))
    assert found.where("error is not null").count() == 2
    stops = conform.conform(static.table(found, "stops", "stop_id string, stop_name string, stop_lat string, stop_lon string"), contracts.contract("stg_stops"))
    assert rows(stops.select("stop_id", "stop_name", "stop_lat", "feed_hash")) == [("A", "First", -36.5, static.content_hash(data.getvalue())), ("B", None, None, static.content_hash(data.getvalue()))]
    with pytest.raises(Exception, match="stop_name is null"):
        conform.validated(stops, contracts.contract("stg_stops")).collect()
    stored = static.archives(spark, str(tmp_path)).select("feed_hash")
    assert static.new_archives(static.archives(spark, str(tmp_path)), stored).count() == 0


def test_every_contract_has_ddl(spark):
    every = contracts.contracts()
    assert len(every) == 17 and "PARTITIONED BY (dt)" in conform.ddl(every["stg_trip_updates"]) and "`feed_hash` string NOT NULL" in conform.ddl(every["stg_stops"])


def test_first_known_value_of_each_column(spark):
    df = spark.createDataFrame([("a", 1, None, dt.datetime(2024, 1, 2)), ("a", 2, "x", dt.datetime(2024, 1, 3)), ("a", 3, "y", dt.datetime(2024, 1, 1)), ("b", None, None, None)], "record_id string, n int, s string, updated_at timestamp").withColumn("created_at", F.col("updated_at"))
    got = {r.record_id: r for r in conform.deduplicated(df).collect()}
    assert (got["a"].n, got["a"].s, got["a"].created_at.day, got["a"].updated_at.day) == (3, "y", 1, 3) and got["b"].n is None


def test_ids_tell_nulls_and_boundaries(spark):
    df = spark.createDataFrame([("a", "bc"), ("ab", "c"), ("abc", None), (None, "abc"), ("abc", "")], "x string, y string")
    assert df.select(conform.record_id("x", "y")).distinct().count() == 5


def stored(spark, path):
    return {r.record_id: (r.v, r.created_at.day) for r in spark.read.parquet(path).collect()}


def test_upsert(spark, tmp_path):
    schema = "record_id string, timestamp timestamp, v int, created_at timestamp, updated_at timestamp"
    day = lambda n, h=0: dt.datetime(2024, 1, n, h)
    path = str(tmp_path / "t")
    first = spark.createDataFrame([("a", day(1), 1, day(1), day(1)), ("b", day(2), 1, day(1), day(1)), ("c", None, 1, day(1), day(1))], schema)
    upsert.upsert(spark, first, path)
    assert stored(spark, path) == {"a": (1, 1), "b": (1, 1)}
    again = spark.createDataFrame([("a", day(1, 5), 2, day(9), day(9)), ("a", day(1, 4), 3, day(9), day(8)), ("d", day(1), 4, day(9), day(9))], schema)
    for _ in range(2):
        upsert.upsert(spark, again, path)
    assert stored(spark, path) == {"a": (2, 1), "b": (1, 1), "d": (4, 9)}
    upsert.upsert(spark, spark.createDataFrame([("a", day(20), 7, day(9), day(9))], schema), path)  # another day: a second row
    assert spark.read.parquet(path).where("record_id = 'a'").count() == 2


def test_upsert_leaves_what_merged_gives(spark, tmp_path):
    schema = "record_id string, timestamp timestamp, v int, created_at timestamp, updated_at timestamp"
    day = lambda n: dt.datetime(2024, 1, n)
    path = str(tmp_path / "t")
    first = spark.createDataFrame([("a", day(2), 1, day(1), day(1)), ("b", day(1), 1, day(1), day(1)), ("c", day(9), 1, day(1), day(1))], schema)
    batch = spark.createDataFrame([("a", day(3), 2, day(9), day(9)), ("b", day(1), 2, day(9), day(9))], schema)
    upsert.upsert(spark, first, path)
    want = rows(upsert.merged(first, batch))
    for _ in range(2):
        upsert.upsert(spark, batch, path)
        assert rows(spark.read.parquet(path).drop("dt").select(*first.columns)) == want
    assert not (tmp_path / "t" / "dt=2024-01-02").exists() and not (tmp_path / "t__staged").exists()


def test_merge_by_other_keys_without_a_time(spark, tmp_path):
    schema = "dataset string, object_uri string, status string, created_at int, updated_at int"
    path = str(tmp_path / "m")
    upsert.merge_untimed(spark, spark.createDataFrame([("d", "x", "pending", 1, 1), ("d", "y", "pending", 1, 1), (None, "x", "done", 1, 1)], schema), path, ["dataset", "object_uri"])
    batch = spark.createDataFrame([("d", "x", "done", 2, 2), ("d", "x", "failed", 3, 3), ("e", "x", "pending", 2, 2), (None, "x", "lost", 2, 2)], schema)
    for _ in range(2):
        upsert.merge_untimed(spark, batch, path, ["dataset", "object_uri"])
    want = [("d", "x", "failed", 1, 3), ("d", "y", "pending", 1, 1), ("e", "x", "pending", 2, 2), (None, "x", "lost", 1, 2)]
    assert rows(spark.read.parquet(path)) == sorted(want, key=repr)


def test_append_and_clustered(spark, tmp_path):
    df = spark.createDataFrame([("a", dt.datetime(2024, 1, 1), 1)], "record_id string, timestamp timestamp, extra int")
    for _ in range(2):
        upsert.append(df, str(tmp_path / "t"), ["record_id", "timestamp", "created_at", "updated_at"])
    got = spark.read.parquet(str(tmp_path / "t"))
    assert got.count() == 2 and "extra" not in got.columns and got.where("created_at is null").count() == 0
    upsert.clustered_table(spark.range(100), str(tmp_path / "c"), "id")
    assert spark.read.parquet(str(tmp_path / "c")).count() == 100
    assert rows(upsert.new_only(spark.range(4), spark.range(2), ["id"])) == [(2,), (3,)]


def line(*points):
    return [{"lon": x / 111194.9, "lat": y / 111194.9} for x, y in points]


@pytest.mark.parametrize(
    "a, b, want",
    [
        (line((0, 0), (100, 0)), line((0, 3), (100, 3)), 100.0),
        (line((0, 0), (100, 0)), line((0, 10), (100, 10)), 0.0),
        (line((0, 0), (100, 0)), line((20, 0), (50, 0)), 42.0),  # six metres on each side
        (line((0, 0), (100, 0)), line((0, 0), (40, 0), (40, 100)), 46.0),
        (line((0, 0), (0, 0)), line((0, 0), (40, 0)), 0.0),
    ],
)
def test_overlap(a, b, want):
    assert abs(g.overlap(a, b, 6.0) - want) < 0.05


def test_near():
    a = line((0, 0), (100, 0))
    assert g.near(a, line((50, 5), (50, 90)), 6.0) and not g.near(a, line((50, 7), (50, 90)), 6.0)
    assert g.near(line((0, 0)), line((3, 4)), 5.01) and not g.near(line((0, 0)), line((3, 4)), 4.99) and g.near(a, None, 5.0) is None


def test_cells_of_a_disk(spark):
    got = spark.range(1).select(HexGrid().disk(F.lit("8:5:-3"), 100).alias("d"), HexGrid().disk(F.lit("8:5:-3"), 1).alias("one")).first()
    assert len(set(got.d)) == len(got.d) == 30_301
    assert set(got.one) == {"8:5:-3", "8:6:-3", "8:4:-3", "8:5:-2", "8:5:-4", "8:6:-4", "8:4:-2"}


def test_simplify():
    assert len(g.simplify(line((0, 0), (50, 2), (100, 0)), 7.0)) == 2
    assert len(g.simplify(line((0, 0), (50, 20), (100, 0)), 7.0)) == 3


def test_roads_of_shapes(spark):
    wkt = lambda *p: "LINESTRING(" + ", ".join(f"{x / 111194.9:.9f} {y / 111194.9:.9f}" for x, y in p) + ")"
    tags = lambda kind: [("highway", kind), ("name", "n")]
    ways = spark.createDataFrame(
        [(1, tags("primary"), wkt((0, 2), (3000, 2))), (2, tags("footway"), wkt((0, 0), (100, 0))), (3, tags("primary"), wkt((0, 500), (100, 500))), (4, [("name", "x")], wkt((0, 0), (9, 0)))],
        "id long, tags array<struct<key:string,value:string>>, geometry string",
    )
    roads = spatial.osm_roads(ways, -1, -1, 1, 1)
    assert rows(roads.select("edge_id", F.round("length_m"))) == [("1", 3000.0), ("3", 100.0)]
    shapes = spark.createDataFrame([("s", wkt((0, 0), (2000, 0)))], "shape_id string, w string").select("shape_id", g.from_wkt(F.col("w")).alias("line"))
    got = spatial.match_shapes(shapes, roads).collect()
    assert [(r.shape_id, r.edge_id) for r in got] == [("s", "1")] and abs(got[0].overlap_m - 2005.66) < 0.2
    assert spatial.match_shapes(shapes, roads, simplify_m=7.0, least_m=40.0).count() == 1
    assert rows(spatial.unmatched(roads, spark.createDataFrame(got)).select("edge_id")) == [("3",)]
    assert shapes.select(g.to_wkt(F.col("line"))).first()[0].startswith("LINESTRING(0.0 0.0")


def test_stream_merges_and_can_be_repeated(spark, tmp_path):
    folder, table = tmp_path / "in", str(tmp_path / "table")
    folder.mkdir()
    contract = contracts.contract("stg_vehicle_positions")
    (folder / "a.json").write_text(json.dumps(document("v1", 1704067200)))
    ingest.ingest(spark, "vehicle_positions", contract, str(folder), table, str(tmp_path / "cp")).awaitTermination()
    (folder / "b.json").write_text(json.dumps(document("v1", 1704067200)))
    (folder / "c.json").write_text(json.dumps(document("v2", 1704070000)))
    ingest.ingest(spark, "vehicle_positions", contract, str(folder), table, str(tmp_path / "cp")).awaitTermination()
    assert rows(spark.read.parquet(table).select("vehicle_id")) == [("v1",), ("v2",)]


def test_landing(spark, tmp_path):
    df = spark.createDataFrame([("a", dt.datetime(2024, 1, 2, 3)), ("b", dt.datetime(2024, 1, 3, 4))], "id string, created_at timestamp")
    path = str(tmp_path / "raw")
    landing.land(df, path)
    assert list((tmp_path / "raw").glob("year=2024/month=01/day=02/hour=03/*.json.gz"))
    assert rows(landing.landed(spark, path, "id string", "2024-01-02")) == [("a",)] and landing.landed(spark, path, "id string").count() == 2
    with pytest.raises(ValueError):
        landing.landed(spark, path, "id string", "2024-01-02' or true")
    for _ in range(3):
        spark.range(10).write.mode("append").parquet(str(tmp_path / "many"))
    landing.compact(spark, str(tmp_path / "many"), str(tmp_path / "few"))
    assert spark.read.parquet(str(tmp_path / "few")).count() == 30
    assert rows(landing.ask(spark, "select id from {t} where id = :x", {"x": "a' or true"}, t=df)) == []
