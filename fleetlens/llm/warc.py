"""WARC archives of individually compressed records with an embedded Zstandard dictionary.

An archive is a .warc.zst stream: a leading skippable frame (magic 0x184D2A5D) that holds the dictionary, then one
Zstandard frame for each record. The archives are written by Spark's own text writer, so that they land in any store
that Spark reaches and only committed tasks leave files; its line separator is an empty skippable frame (whose eight
bytes are all ASCII), which every Zstandard reader passes over. A task starts a new archive where one would grow beyond
ARCHIVE_BYTES, so that writers and readers hold no more than that, or one record.
"""

from __future__ import annotations

import base64
import hashlib
import io
import struct
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlens.llm.scratch import drop, keep, new_path, small_batches

DICTIONARY_MAGIC = b"\x5d\x2a\x4d\x18"
EMPTY_FRAME = "P*M\x18\x00\x00\x00\x00"
DICTIONARY_BYTES = 64 << 10
ARCHIVE_BYTES = 32 << 20
SAMPLE_RECORDS = 512
SAMPLE_BYTES = 8 << 20
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2024-01-01T00:00:00Z"
RECORDS = "page_id long, url string, record_type string, payload_bytes long, payload_digest string, refers_to long, payload binary"


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _urn(page_id: int | None, digest: str) -> str:
    """Pages that repeat an id with another payload have records of their own."""
    return f"<urn:x-page:{'' if page_id is None else page_id}:{digest}>"


def _page(urn: str) -> int | None:
    number = urn.removeprefix("<urn:x-page:").partition(":")[0]
    return int(number) if number else None


def record(page_id, url, payload: bytes, digest: str, revisit: bool, refers_to, date: str = DATE) -> bytes:
    """One WARC/1.1 record. A revisit has the HTTP header of the page, with its full length, and no payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: {_urn(page_id, digest)}",
        f"WARC-Date: {date}",
        "Content-Type: application/http; msgtype=response",
        f"WARC-Payload-Digest: sha1:{digest}",
    ]
    if url is not None:
        lines.append("WARC-Target-URI: " + url.replace("%", "%25").replace("\r", "%0D").replace("\n", "%0A"))
    if revisit:
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {_urn(refers_to, digest)}"]
    lines.append(f"Content-Length: {len(block)}")
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(archive: bytes) -> Iterator[tuple]:
    """The records of one archive, as the columns of RECORDS. Digest and length of a response are its bytes' own."""
    dictionary, at = None, 0
    if archive[:4] == DICTIONARY_MAGIC:
        (size,) = struct.unpack_from("<I", archive, 4)
        at = 8 + size
        dictionary = zstandard.ZstdCompressionDict(zstandard.ZstdDecompressor().decompress(archive[8:at]))
    source = io.BytesIO(archive)
    source.seek(at)
    frames = zstandard.ZstdDecompressor(dict_data=dictionary).stream_reader(source, read_across_frames=True)
    stream = io.BufferedReader(frames, 1 << 16)
    while line := stream.readline():
        if line != b"WARC/1.1\r\n":
            raise ValueError(f"not a WARC record: {line[:40]!r}")
        head = {}
        while (line := stream.readline()) != b"\r\n":
            name, _, value = line.decode().rstrip("\r\n").partition(": ")
            head[name] = value
        length = int(head["Content-Length"])
        block = stream.read(length)
        if len(block) != length or stream.read(4) != b"\r\n\r\n":
            raise ValueError("a record is cut short")
        http, _, payload = block.partition(b"\r\n\r\n")
        kind, digest = head["WARC-Type"], head["WARC-Payload-Digest"].removeprefix("sha1:")
        if kind == "response":
            size, payload = len(payload), payload
            if payload_digest(payload) != digest:
                raise ValueError(f"{head['WARC-Record-ID']}: the payload does not match its digest")
        else:
            size, payload = int(http.rpartition(b"Content-Length: ")[2]), None
        url = head.get("WARC-Target-URI")
        if url is not None:
            url = url.replace("%0A", "\n").replace("%0D", "\r").replace("%25", "%")
        refers = _page(head["WARC-Refers-To"]) if kind == "revisit" else None
        yield _page(head["WARC-Record-ID"]), url, kind, size, digest, refers, payload


def train(records: list[bytes], size: int = DICTIONARY_BYTES) -> bytes:
    """A dictionary from sample records; empty if there are too few to learn from."""
    size = min(size, sum(map(len, records)) // 8)
    try:
        return zstandard.train_dictionary(size, records, k=512, d=8, level=9).as_bytes() if size >= 1024 else b""
    except zstandard.ZstdError:
        return b""


def _prepared(pages: DataFrame) -> DataFrame:
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    return pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), payload.alias("payload"))


def _sample(prepared: DataFrame, records: int, most_bytes: int) -> list[bytes]:
    """At most so many records, of the pages with the smallest hashes of their ids, and at most so many bytes."""
    ids = [r[0] for r in prepared.select("page_id").orderBy(F.xxhash64("page_id"), "page_id").limit(records).collect()]
    named = [i for i in ids if i is not None]
    some = prepared.where(F.col("page_id").isin(named) & (F.length("payload") <= most_bytes // 16))
    out, used = [], 0
    for r in some.orderBy(F.xxhash64("page_id"), "page_id").limit(records).toLocalIterator():
        body = bytes(r["payload"])
        out.append(record(r["page_id"], r["url"], body, payload_digest(body), False, None))
        used += len(body)
        if used >= most_bytes:
            break
    return out


def write_archives(
    pages: DataFrame, path: str, *, min_revisit_bytes: int = 0, level: int = 3, archive_bytes: int = ARCHIVE_BYTES,
    sample_records: int = SAMPLE_RECORDS, sample_bytes: int = SAMPLE_BYTES,
) -> None:
    """Write pages(page_id, url, html) to archives *.warc.zst under path, each of at most archive_bytes or one record.

    The payload is the html in UTF-8 (null: empty). Of pages with equal payloads of at least min_revisit_bytes, that
    with the smallest page_id is a response (rows that repeat this id too) and the others revisit it; smaller
    payloads are all responses. A null page_id is written as such, and is a response only where no equal payload has
    an id. The dictionary is trained on at most sample_records records and sample_bytes bytes. Rows that repeat page_id
    and payload repeat the record's id. Other columns are not read; an empty table writes no archive.
    """
    spark = pages.sparkSession
    small_batches(spark, 50)
    rows = _prepared(pages)
    dictionary = train(_sample(rows, sample_records, sample_bytes))
    keyed = rows.withColumn("sha1", F.sha1("payload")).withColumn("bytes", F.length("payload"))
    shared = keep(
        keyed.where(F.col("bytes") >= min_revisit_bytes)
        .groupBy("sha1", "bytes")
        .agg(F.min("page_id").alias("least"), F.count("*").alias("n"))
        .where("n > 1")
        .select("sha1", "bytes", "least"),
        "payloads",
    )
    joined = keyed.join(shared, ["sha1", "bytes"], "left").select(
        "page_id", "url", "payload", "least",
        F.expr("least is not null and not (page_id <=> least)").alias("revisit"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        zdict = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        if zdict:
            zdict.precompute_compress(level=level)
        packer = zstandard.ZstdCompressor(level=level, dict_data=zdict, write_checksum=True)
        leading = b""
        if dictionary:
            packed = zstandard.ZstdCompressor(level=9).compress(dictionary)
            leading = DICTIONARY_MAGIC + struct.pack("<I", len(packed)) + packed
        archive = io.BytesIO()
        archive.write(leading)

        def cut() -> pa.RecordBatch:
            out = pa.record_batch([pa.array([archive.getvalue()], pa.binary())], names=["archive"])
            archive.seek(len(leading))
            archive.truncate()
            return out

        for b in batches:
            for page_id, url, payload, least, revisit in zip(*b.columns):
                page_id, least, payload = page_id.as_py(), least.as_py(), payload.as_py()
                frame = packer.compress(record(page_id, url.as_py(), payload, payload_digest(payload), revisit.as_py(), least))
                if len(leading) < archive.tell() and archive.tell() + len(frame) > archive_bytes:
                    yield cut()
                archive.write(frame)
        if len(leading) < archive.tell():
            yield cut()

    # one row is one archive, and one file
    (
        joined.mapInArrow(run, "archive binary")
        .select(F.col("archive").cast("string").alias("value"))
        .write.option("lineSep", EMPTY_FRAME).option("compression", "none").option("maxRecordsPerFile", 1).text(path)
    )
    drop(shared)
    _name_archives(spark, path)


def _name_archives(spark: SparkSession, path: str) -> None:
    """Rename the writer's files, and delete those of partitions without records."""
    sc = spark.sparkContext
    folder = sc._jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(sc._jsc.hadoopConfiguration())
    for f in fs.listStatus(folder):
        name = f.getPath().getName()
        if name.startswith("part-") and f.getLen() == 0:
            fs.delete(f.getPath(), False)
        elif name.startswith("part-"):
            fs.rename(f.getPath(), sc._jvm.org.apache.hadoop.fs.Path(folder, name.removesuffix(".txt") + ".warc.zst"))


def read_archives(spark: SparkSession, path: str, *, payloads: bool = True) -> DataFrame:
    """The records of the archives under path, as RECORDS; without payloads that column is null."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for archive in b.column(0):
                some: list[tuple] = []
                held = 0
                for r in parse(archive.as_buffer().to_pybytes()):
                    some.append(r if payloads else (*r[:-1], None))
                    held += r[3] if payloads else 0
                    if len(some) >= 1000 or held > 16 << 20:
                        yield _batch(some)
                        some, held = [], 0
                if some:
                    yield _batch(some)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.zst").load(path)
    return files.select("content").mapInArrow(run, RECORDS)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.binary()]
    names = [f.split()[0] for f in RECORDS.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)


def round_trip(pages: DataFrame) -> DataFrame:
    """Archive pages in the shared folder and read the records back, without their payloads."""
    spark = pages.sparkSession
    path = new_path(spark, "warc")
    write_archives(pages, path)
    return read_archives(spark, path, payloads=False)
