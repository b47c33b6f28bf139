"""Realtime feeds: one JSON document in each file, plain or gzip, with entities under one of two wrappers."""

from __future__ import annotations

import gzip
import re
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlens.sources import wire

#: Documents that a task passes on at a time.
DOCUMENTS = 1_000
TRIP = (
    "struct<trip_id:string,tripId:string,route_id:string,routeId:string,direction_id:bigint,directionId:bigint,start_date:string,"
    "startDate:string,start_time:string,startTime:string,schedule_relationship:string,scheduleRelationship:string>"
)
VEHICLE = "struct<id:string,label:string,license_plate:string,licensePlate:string>"
EVENT = "struct<time:bigint,delay:bigint,uncertainty:bigint>"
STOP = f"struct<stop_id:string,stopId:string,stop_sequence:bigint,stopSequence:bigint,arrival:{EVENT},departure:{EVENT}>"
UPDATE = (
    f"struct<trip:{TRIP},vehicle:{VEHICLE},delay:bigint,timestamp:bigint,stop_time_update:array<{STOP}>,stopTimeUpdate:array<{STOP}>>"
)
POSITION = (
    f"struct<vehicle:{VEHICLE},position:struct<latitude:double,longitude:double,bearing:double,speed:double,odometer:double>,trip:{TRIP},"
    "occupancy_status:string,occupancyStatus:string,timestamp:bigint>"
)
TEXTS = "struct<translation:array<struct<text:string>>>"
ALERT = (
    f"struct<cause:string,effect:string,severity_level:string,severityLevel:string,timestamp:bigint,header_text:{TEXTS},headerText:{TEXTS},"
    f"description_text:{TEXTS},descriptionText:{TEXTS},url:{TEXTS},effect_detail:{TEXTS},effectDetail:{TEXTS},"
    "active_period:array<struct<start:bigint,end:bigint>>,activePeriod:array<struct<start:bigint,end:bigint>>,"
    "informed_entity:array<struct<route_id:string,routeId:string,agency_id:string,agencyId:string,stop_id:string,stopId:string,direction_id:bigint,trip:struct<trip_id:string,tripId:string>>>,"
    "informedEntity:array<struct<route_id:string,routeId:string,agency_id:string,agencyId:string,stop_id:string,stopId:string,direction_id:bigint,trip:struct<trip_id:string,tripId:string>>>>"
)
ENTITY = f"struct<id:string,vehicle:{POSITION},trip_update:{UPDATE},tripUpdate:{UPDATE},alert:{ALERT}>"
DOCUMENT = f"response struct<entity:array<{ENTITY}>>, entity array<{ENTITY}>"


def documents(spark: SparkSession, path: str) -> DataFrame:
    """(entity, created_at, updated_at, cache_blob): the entities of JSON files. Files that hold no list have none."""
    raw = spark.read.schema(DOCUMENT).option("multiLine", True).json(path)
    return entities(raw.select("*", "_metadata.file_modification_time", "_metadata.file_name"))


def entities(raw: DataFrame) -> DataFrame:
    at = F.date_trunc("SECOND", "file_modification_time")
    listed = F.coalesce("response.entity", "entity")
    return raw.select(F.explode(listed).alias("entity"), at.alias("created_at"), at.alias("updated_at"), F.col("file_name").alias("cache_blob"))


SPECIAL = re.compile(rb'["{}\[\]]')
TEXT_END = re.compile(rb'(?:[^"\\]|\\.)*+"', re.S)
SPACE = re.compile(rb"[\s\x1e]*+")


def split_documents(data: bytes) -> Iterator[bytes]:
    """The JSON documents that follow each other in a file, with or without white space between them.

    Ends are found by the depth of brackets outside of texts, in one pass. What stands between documents, or is not
    closed, comes as a piece of its own, which is no document.
    """
    at = 0
    while (at := SPACE.match(data, at).end()) < len(data):
        start, depth, at = at, 0, at
        while True:
            found = SPECIAL.search(data, at)
            if found is None:
                at = len(data)
                break
            kind, at = found.group(), found.end()
            if kind == b'"':
                end = TEXT_END.match(data, at)
                at = end.end() if end else len(data)
            elif kind in b"{[":
                if depth == 0 and found.start() > start:  # something else stands before the document
                    at = found.start()
                    break
                depth += 1
            else:
                depth -= 1
                if depth <= 0:
                    break
        yield data[start:at]


def _unpacked(data: bytes) -> bytes:
    """A file's content, whatever its name says; one that only looks like gzip stays as it is."""
    if data[:2] == b"\x1f\x8b":
        try:
            return gzip.decompress(data)
        except (OSError, EOFError, zlib.error):
            pass
    return data


def pieces(spark: SparkSession, path: str, kind: str = "json") -> DataFrame:
    """(d, error, file_modification_time, file_name): every document of the files, and an error for what is none.

    Files may be gzip whatever their names, and JSON files may hold any number of documents. kind is json or protobuf;
    another raises. Files are spread over tasks; one is read as a whole, so compressed files should be small. For large
    plain files with a document in each line there is lines(), which splits files.
    """
    if kind not in ("json", "protobuf"):
        raise ValueError(f"not a format of realtime feeds: {kind!r}")
    files = spark.read.format("binaryFile").load(path).select("content", F.col("modificationTime").alias("file_modification_time"), "path")
    return parsed(files, kind).withColumn("file_name", F.element_at(F.split("path", "/"), -1)).drop("path")


def parsed(files: DataFrame, kind: str = "json") -> DataFrame:
    """files(content, ...) with (d, error) instead of the content."""
    if kind == "protobuf":
        texts = wire.documents(files)
    else:
        others = [c for c in files.columns if c != "content"]

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for b in batches:
                for content, *rest in zip(b["content"], *(b[c] for c in others)):
                    found = [x.decode("utf-8", "replace") for x in split_documents(_unpacked(bytes(content)))]
                    for k in range(0, len(found), DOCUMENTS):
                        part = found[k : k + DOCUMENTS]
                        yield pd.DataFrame({**{c: [x] * len(part) for c, x in zip(others, rest)}, "document": part, "error": None})

        schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in files.schema.fields if f.name != "content")
        texts = files.select(*others, "content").mapInPandas(run, f"{schema}, document string, error string")
    return _read(texts)


def _read(texts: DataFrame) -> DataFrame:
    d = F.from_json("document", f"{DOCUMENT}, _corrupt string", {"columnNameOfCorruptRecord": "_corrupt"})
    read = texts.withColumn("d", d).withColumn("error", F.coalesce("error", "d._corrupt"))
    return read.drop("document").withColumn("d", F.when(F.col("error").isNull(), F.col("d").dropFields("_corrupt")))


def lines(spark: SparkSession, path: str) -> DataFrame:
    """As pieces(), for files with one document in each line: plain ones of any size are split."""
    texts = spark.read.text(path).select(F.col("value").alias("document"), "_metadata.file_modification_time", "_metadata.file_name")
    return _read(texts.where(r"document rlike '\\S'").withColumn("error", F.lit(None).cast("string")))


def tolerant(spark: SparkSession, path: str, kind: str = "json") -> DataFrame:
    """As documents(), for files whose name doesn't tell whether they are gzip, or that hold several documents, or
    protobuf messages. What is no document is left out; rejected() has it."""
    return entities(pieces(spark, path, kind).where("error is null").select("d.*", "file_modification_time", "file_name"))


def rejected(spark: SparkSession, path: str, kind: str = "json") -> DataFrame:
    """(file_name, error) of what is no document."""
    return pieces(spark, path, kind).where("error is not null").select("file_name", "error")


def _either(at: str, *names: str) -> Column:
    return F.coalesce(*[F.col(f"{at}.{n}") for n in names])


def _trip(at: str) -> list[Column]:
    return [
        _either(at, "trip_id", "tripId").alias("trip_id"), _either(at, "route_id", "routeId").alias("route_id"),
        _either(at, "direction_id", "directionId").alias("direction_id"), _either(at, "start_date", "startDate").alias("start_date"),
        _either(at, "start_time", "startTime").alias("start_time"),
        _either(at, "schedule_relationship", "scheduleRelationship").alias("schedule_relationship"),
    ]


def _vehicle(at: str) -> list[Column]:
    return [
        F.col(f"{at}.id").alias("vehicle_id"), F.col(f"{at}.label").alias("vehicle_label"),
        _either(at, "license_plate", "licensePlate").alias("vehicle_license_plate"),
    ]


META = ("created_at", "updated_at")


def vehicle_positions(found: DataFrame) -> DataFrame:
    v = "entity.vehicle"
    return found.where("entity.vehicle is not null").select(
        *META, F.col(f"{v}.timestamp").alias("timestamp_s"), *_vehicle(f"{v}.vehicle"),
        *[F.col(f"{v}.position.{c}").alias(c) for c in ("latitude", "longitude", "bearing", "speed", "odometer")],
        _either(v, "occupancy_status", "occupancyStatus").alias("occupancy_status"), *_trip(f"{v}.trip"),
    )


def trip_updates(found: DataFrame) -> DataFrame:
    """One row for each stop of an update; an update without stops has one."""
    u = found.select(*META, F.coalesce("entity.trip_update", "entity.tripUpdate").alias("u")).where("u is not null")
    s = u.select(*META, "u", F.explode_outer(_either("u", "stop_time_update", "stopTimeUpdate")).alias("s"))
    event = lambda kind: [
        F.col(f"s.{kind}.time").alias(f"actual_{kind}_s"), F.col(f"s.{kind}.delay").alias(f"{kind}_delay"),
        F.col(f"s.{kind}.uncertainty").alias(f"{kind}_uncertainty"),
    ]
    return s.select(
        *META, F.col("u.timestamp").alias("timestamp_s"), *_trip("u.trip"), F.col("u.delay").alias("delay"),
        _either("s", "stop_sequence", "stopSequence").alias("stop_sequence"), _either("s", "stop_id", "stopId").alias("stop_id"),
        *event("arrival"), *event("departure"), *_vehicle("u.vehicle"),
    )


def service_alerts(found: DataFrame) -> DataFrame:
    """One row for each text, period and subject of an alert, in all combinations."""
    a = found.select(*META, F.col("entity.id").alias("alert_id"), F.col("entity.alert").alias("a")).where("a is not null")
    for name, fields in (("p", ("active_period", "activePeriod")), ("i", ("informed_entity", "informedEntity"))):
        a = a.select("*", F.explode_outer(_either("a", *fields)).alias(name))
    for name, fields in (("header", ("header_text", "headerText")), ("description", ("description_text", "descriptionText")), ("url", ("url",)), ("effect_detail", ("effect_detail", "effectDetail"))):
        a = a.select("*", F.explode_outer(F.coalesce(*[F.col(f"a.{f}.translation.text") for f in fields])).alias(name))
    return a.select(
        *META, "alert_id", F.col("a.timestamp").alias("timestamp_s"), "header", "description", "url", F.col("a.cause").alias("cause"),
        F.col("a.effect").alias("effect"), "effect_detail", _either("a", "severity_level", "severityLevel").alias("severity_level"),
        F.col("p.start").alias("period_start_s"), F.col("p.end").alias("period_end_s"), _either("i", "route_id", "routeId").alias("route_id"),
        _either("i", "agency_id", "agencyId").alias("agency_id"), _either("i.trip", "trip_id", "tripId").alias("trip_id"),
        _either("i", "stop_id", "stopId").alias("stop_id"), F.col("i.direction_id").alias("direction_id"),
    )


READERS = {"vehicle_positions": vehicle_positions, "trip_updates": trip_updates, "service_alerts": service_alerts}
