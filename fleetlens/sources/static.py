"""Static timetable archives: ZIP files of CSV tables, named by the hash of their content."""

from __future__ import annotations

import csv
import hashlib
import io
import json
import struct
import zipfile
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ROWS = 5_000


def archives(spark: SparkSession, path: str, named: bool = False) -> DataFrame:
    """(feed_hash, content, updated_at) of ZIP files; of equal ones the first. Where files are named by their hash already,
    `named` takes it from the name, and contents are not hashed again."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.zip").load(path)
    return (
        files.select((F.regexp_extract("path", r"([^/]+)[.]zip$", 1) if named else F.md5("content")).alias("feed_hash"), "content", F.date_trunc("SECOND", "modificationTime").alias("updated_at"), "path")
        .withColumn("least", F.expr("min(path) over (partition by feed_hash)"))
        .where("path = least")
        .drop("path", "least")
    )


MEMBER = "feed_hash string, updated_at timestamp, member string, method int, crc long, data binary, error string"


def members(found: DataFrame) -> DataFrame:
    """A row for each member of archives(): its bytes as they are stored, cut out by the archive's directory.

    Nothing is decompressed here. An archive without a directory is one row with its error.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [f.split()[0] for f in MEMBER.split(", ")]
        for b in batches:
            for digest, content, at in zip(b["feed_hash"], b["content"], b["updated_at"]):
                data = bytes(content)
                try:
                    listed = zipfile.ZipFile(io.BytesIO(data)).infolist()
                except (zipfile.BadZipFile, ValueError) as e:
                    yield pd.DataFrame([(digest, at, None, None, None, None, str(e))], columns=names)
                    continue
                for m in listed:
                    if not m.is_dir():
                        # the local header has lengths of its own name and extra field
                        name, extra = struct.unpack("<HH", data[m.header_offset + 26 : m.header_offset + 30].ljust(4, b"\0"))
                        start = m.header_offset + 30 + name + extra
                        out = (digest, at, m.filename, m.compress_type, m.CRC, data[start : start + m.compress_size], None)
                        yield pd.DataFrame([out], columns=names)

    return found.select("feed_hash", "content", "updated_at").mapInPandas(run, MEMBER)


def _unpacked(method: int, crc: int, data: bytes) -> bytes:
    if method not in (zipfile.ZIP_STORED, zipfile.ZIP_DEFLATED):
        raise ValueError(f"compression method {method}")
    out = data if method == zipfile.ZIP_STORED else zlib.decompress(data, -15)
    if zlib.crc32(out) != crc:
        raise ValueError("a checksum differs")
    return out


def tables(found: DataFrame) -> DataFrame:
    """(feed_hash, updated_at, table, row, error): every row as a JSON object. A member that can't be read is one row
    with its error; the others are kept.

    Members are dealt to tasks one by one, so a large one doesn't wait for the rest of its archive.
    """
    names = ["feed_hash", "updated_at", "table", "row", "error"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for digest, at, member, method, crc, data, error in b.itertuples(index=False):
                if error is not None:
                    yield pd.DataFrame([(digest, at, None, None, error)], columns=names)
                    continue
                table, out = member.rpartition("/")[2].removesuffix(".txt").removesuffix(".csv"), []
                try:
                    text = io.TextIOWrapper(io.BytesIO(_unpacked(int(method), int(crc), bytes(data))), encoding="utf-8-sig", newline="")
                    for row in csv.DictReader(text):
                        kept = {k.strip(): v for k, v in row.items() if k and v not in (None, "")}
                        out.append((digest, at, table, json.dumps(kept), None))
                        if len(out) >= ROWS:
                            yield pd.DataFrame(out, columns=names)
                            out = []
                except (ValueError, csv.Error, zlib.error) as e:
                    out.append((digest, at, table, None, str(e)))
                if out:
                    yield pd.DataFrame(out, columns=names)

    spark = found.sparkSession
    dealt = members(found).repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "feed_hash", "member")
    return dealt.mapInPandas(run, "feed_hash string, updated_at timestamp, table string, row string, error string")


def table(rows: DataFrame, name: str, ddl: str) -> DataFrame:
    """One table of tables(): its columns as text, by a schema like "stop_id string, stop_lat string"."""
    own = rows.where((F.col("table") == name) & F.col("row").isNotNull())
    return own.select("feed_hash", F.col("updated_at").alias("created_at"), "updated_at", F.from_json("row", ddl).alias("r")).select(
        "feed_hash", "created_at", "updated_at", "r.*"
    )


def new_archives(found: DataFrame, stored: DataFrame) -> DataFrame:
    """Archives whose hash is not stored yet, so that a second run adds nothing."""
    return found.join(stored.select("feed_hash").distinct(), "feed_hash", "left_anti")


def content_hash(data: bytes) -> str:
    return hashlib.md5(data).hexdigest()
