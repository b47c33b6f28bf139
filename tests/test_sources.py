"""Protobuf messages, documents that follow each other, merges with null keys, and rows carried over between days."""

import gzip
import json
import struct
import time

import numpy as np
import pytest
from conftest import rows
from pyspark.sql import Window
from pyspark.sql import functions as F

from fleetlens.functions import carry
from fleetlens.operators import upsert
from fleetlens.sources import realtime, wire

FEED = {
    "header": {"gtfs_realtime_version": "2.0", "timestamp": 1704067200},
    "entity": [
        {"id": "1", "vehicle": {"vehicle": {"id": "v1"}, "position": {"latitude": -36.5, "longitude": 174.75, "speed": 3.5, "odometer": 1e9}, "timestamp": 5}},
        {"id": "2", "trip_update": {"trip": {"trip_id": "t", "direction_id": 1}, "stop_time_update": [{"stop_sequence": 300, "stop_id": "ä", "arrival": {"delay": -60, "time": 7}}, {"stop_id": "b"}]}},
        {"id": "3", "alert": {"active_period": [{"start": 1, "end": 2}], "cause": 3, "header_text": {"translation": [{"text": "one"}]}}},
    ],
}


def test_wire_format():
    assert wire.encode({"text": "hi"}, "Translation") == b"\x0a\x02hi"
    assert wire.encode({"delay": -1, "time": 300}, "StopTimeEvent") == b"\x08" + b"\xff" * 9 + b"\x01" + b"\x10\xac\x02"
    assert wire.encode({"latitude": 1.0}, "Position") == b"\x0d" + struct.pack("<f", 1.0)
    assert wire.decode(wire.encode(FEED, "FeedMessage"), "FeedMessage") == FEED
    # unknown fields of every wire type are skipped, split messages are merged
    odd = b"\x98\x06\x01" + b"\x9a\x06\x02ab" + b"\x99\x06" + b"x" * 8 + b"\x9d\x06" + b"x" * 4
    assert wire.decode(odd + wire.encode(FEED, "FeedMessage") + odd, "FeedMessage") == FEED
    for bad in (b"\x08", b"\x0a\x05hi", b"\x0b", b"\xff" * 11, b"\x0d\x00"):
        with pytest.raises((wire.WireError, struct.error)):
            wire.decode(bad, "FeedMessage")


def test_scalars_and_packed_numbers():
    kinds = {k: (name, name, k > 13) for k, name in enumerate(wire.KINDS, 1)}
    descriptor = {"M": {**kinds, 20: ("many", "int", True), 21: ("halves", "float", True), 22: ("signed", "sint", True)}}
    value = {
        "int": -5, "uint": 1 << 63, "sint": -3, "bool": True, "enum": 4, "double": 0.1, "fixed64": 9, "sfixed64": -9, "float": 0.5, "fixed32": 8,
        "sfixed32": -8, "string": "x", "bytes": b"\x00\xff", "many": [1, -1], "halves": [0.5, 1.5], "signed": [-2, 2],
    }
    assert wire.decode(wire.encode(value, "M", descriptor), "M", descriptor) == value
    packed = b"\xa2\x01\x03\x01\xac\x02" + b"\xaa\x01\x08" + struct.pack("<ff", 0.5, 1.5)
    assert wire.decode(packed, "M", descriptor) == {"many": [1, 300], "halves": [0.5, 1.5]}


def test_compiled_descriptors():
    field = lambda name, number, kind, label=1, of=None: {"name": name, "number": number, "label": label, "type": kind, "type_name": of}
    inner = {"name": "Inner", "field": [field("n", 1, 17)]}
    outer = {"name": "Outer", "field": [field("id", 1, 9), field("inner", 2, 11, 3, ".p.Outer.Inner")], "nested_type": [inner]}
    compiled = wire.encode({"file": [{"package": "p", "message_type": [outer]}]}, "FileDescriptorSet", wire.META)
    found = wire.of_descriptor_set(compiled)
    assert found == {"p.Outer": {1: ("id", "string", False), 2: ("inner", "p.Outer.Inner", True)}, "p.Outer.Inner": {1: ("n", "sint", False)}}
    value = {"id": "a", "inner": [{"n": -7}, {"n": 7}]}
    assert wire.decode(wire.encode(value, "p.Outer", found), "p.Outer", found) == value


def test_feeds_in_bytes(spark, tmp_path):
    (tmp_path / "a.pb").write_bytes(wire.encode(FEED, "FeedMessage"))
    (tmp_path / "b.pb").write_bytes(gzip.compress(b"")[:5])
    found = realtime.tolerant(spark, str(tmp_path), "protobuf")
    assert rows(realtime.vehicle_positions(found).select("vehicle_id", "latitude", "longitude", "speed", "timestamp_s")) == [("v1", -36.5, 174.75, 3.5, 5)]
    assert rows(realtime.trip_updates(found).select("stop_id", "stop_sequence", "actual_arrival_s", "arrival_delay")) == [("b", None, None, None), ("ä", 300, 7, -60)]
    assert rows(realtime.service_alerts(found).select("header", "cause", "period_end_s")) == [("one", "3", 2)]
    assert [r.file_name for r in realtime.rejected(spark, str(tmp_path), "protobuf").collect()] == ["b.pb"]
    with pytest.raises(ValueError, match="not a format"):
        realtime.tolerant(spark, str(tmp_path), "xml")


def test_documents_that_follow_each_other():
    draw = np.random.default_rng(1)
    texts = ["", "a", '"', "\\", "{", "}]", "[{", "é\n", "\\\"", " "]

    def made(depth):
        kind = int(draw.integers(0, 4)) if depth else 3
        if kind == 0:
            return {str(draw.choice(texts)): made(depth - 1) for _ in range(int(draw.integers(0, 3)))}
        return [made(depth - 1) for _ in range(int(draw.integers(0, 3)))] if kind == 1 else str(draw.choice(texts)) if kind == 3 else int(draw.integers(0, 99))

    for _ in range(200):
        given = [{"k": made(3)} if draw.random() < 0.7 else [made(3)] for _ in range(int(draw.integers(0, 6)))]
        data = str(draw.choice([" \n", ""])).join(json.dumps(x, ensure_ascii=bool(draw.integers(0, 2))) for x in given).encode()
        assert [json.loads(x) for x in realtime.split_documents(data)] == given
    assert list(realtime.split_documents(b'{"a":1} oops {"b":2}}{"c":"')) == [b'{"a":1}', b"oops ", b'{"b":2}', b"}", b'{"c":"']

    def seconds(n):
        data, began = b'{"entity": [{"id": "x"}]}\n' * n, time.perf_counter()
        assert sum(1 for _ in realtime.split_documents(data)) == n
        return time.perf_counter() - began

    seconds(1000)
    assert seconds(80_000) < 16 * max(0.05, seconds(10_000))


def test_bad_documents_are_rows(spark, tmp_path):
    good = lambda v: json.dumps({"entity": [{"id": "1", "vehicle": {"vehicle": {"id": v}, "timestamp": 1}}]})
    (tmp_path / "a.json").write_text(good("v1") + "\n{broken: }\n" + good("v2") + " trailing")
    (tmp_path / "b.gz").write_bytes(gzip.compress(good("v3").encode())[:-6])  # cut off
    (tmp_path / "c.json").write_bytes(b"")
    found = realtime.tolerant(spark, str(tmp_path))
    assert rows(realtime.vehicle_positions(found).select("vehicle_id")) == [("v1",), ("v2",)]
    bad = realtime.rejected(spark, str(tmp_path)).collect()
    assert sorted(r.file_name for r in bad)[:2] == ["a.json", "a.json"] and {r.file_name for r in bad} == {"a.json", "b.gz"}
    (tmp_path / "lines").mkdir()
    (tmp_path / "lines" / "x.json").write_text(good("v1") + "\n{broken\n" + good("v2") + "\n")
    read = realtime.lines(spark, str(tmp_path / "lines"))
    assert [r.error for r in read.where("error is not null").collect()] == ["{broken"] and read.where("error is null").count() == 2


MERGED = "record_id string, timestamp timestamp, v double, created_at timestamp, updated_at timestamp"


def test_null_keys_are_never_equal(spark, tmp_path):
    at = lambda n: __import__("datetime").datetime(2024, 1, 1, 0, 0, n)
    first = spark.createDataFrame([(None, at(1), float(k), at(1), at(1)) for k in range(5)] + [("a", at(1), 9.0, at(1), at(1))], MERGED)
    again = spark.createDataFrame([(None, at(2), 7.0, at(2), at(2))] * 2 + [("a", at(2), 8.0, at(2), at(2)), ("a", at(2), 6.0, at(2), at(1))], MERGED)
    path = str(tmp_path / "timed")
    upsert.upsert(spark, first, path)
    upsert.upsert(spark, again, path)
    want = [("a", 8.0)] + [(None, float(k)) for k in range(5)] + [(None, 7.0)] * 2
    assert rows(spark.read.parquet(path).select("record_id", "v")) == sorted(want, key=repr)
    assert spark.read.parquet(path).where("record_id = 'a'").first().created_at == at(1)


def test_rows_carried_between_days(spark):
    draw = np.random.default_rng(3)
    made = [(str(v) if v else None, int(t) * 7919 % (86_400 * 9), k, float(k)) for k, (v, t) in enumerate(draw.integers(0, 9, (400, 2)) * (1, 97_331))]
    df = spark.createDataFrame(made, "v string, s long, id long, x double").select("v", F.timestamp_seconds("s").alias("t"), "id", "x")
    whole = Window.partitionBy("v").orderBy("t", "id")
    for after, step in ((False, F.lag), (True, F.lead)):
        got = carry.neighbour(df, "v", "t", "id", ("t", "x"), "near", after=after)
        want = df.withColumn("near", F.when(F.col("v").isNotNull(), step(F.struct("t", "x")).over(whole)))
        assert rows(got.select("id", "near")) == rows(want.select("id", "near"))
    # the second days with what is kept of the first
    cut = "t < timestamp'1970-01-05'"
    known = carry.ends(df.where(cut), "v", "t", "id", ("t", "x"))
    got = carry.neighbour(df.where(f"not {cut}"), "v", "t", "id", ("t", "x"), "near", known=known)
    all_ = carry.neighbour(df, "v", "t", "id", ("t", "x"), "near").where(f"not {cut}")
    assert rows(got.select("id", "near")) == rows(all_.select("id", "near"))


def test_archives_named_by_hash_and_equal_landings(spark, tmp_path):
    from fleetlens.sources import landing, static

    (tmp_path / "zips").mkdir()
    for name in ("abc.zip", "def.zip", "other.txt"):
        (tmp_path / "zips" / name).write_bytes(b"same")
    assert rows(static.archives(spark, str(tmp_path / "zips"), named=True).select("feed_hash")) == [("abc",), ("def",)]
    assert static.archives(spark, str(tmp_path / "zips")).count() == 1
    # the same rows give the same bytes, as nothing of the time of writing gets into a file
    df = spark.createDataFrame([("a", __import__("datetime").datetime(2024, 1, 2, 3))], "id string, created_at timestamp").coalesce(1)
    found = []
    for name in ("one", "two"):
        landing.land(df, str(tmp_path / name))
        found.append([p.read_bytes() for p in (tmp_path / name).rglob("*.json.gz")])
        time.sleep(1.1)
    assert len(found[0]) == 1 and found[0] == found[1]
