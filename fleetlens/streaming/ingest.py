"""Polled feeds as streams: files are read in bounded batches, conformed, and merged into their table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from fleetlens.operators.conform import Contract, conform, validated
from fleetlens.operators.upsert import upsert
from fleetlens.sources import realtime

FILES_PER_BATCH = 120


def stream(spark: SparkSession, path: str, files: int = FILES_PER_BATCH, archive: str | None = None) -> DataFrame:
    """Documents of a folder as they come, oldest first; read ones move to the archive, if one is named."""
    reader = spark.readStream.schema(realtime.DOCUMENT).option("multiLine", True).option("maxFilesPerTrigger", files)
    if archive:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    return reader.json(path).select("*", "_metadata.file_modification_time", "_metadata.file_name")


def ingest(
    spark: SparkSession, kind: str, contract: Contract, path: str, table: str, checkpoint: str, archive: str | None = None, once: bool = True
) -> StreamingQuery:
    """Read, conform and merge a feed of one kind. A batch that is repeated after a failure merges to the same rows."""
    read = realtime.READERS[kind]

    def merge(batch: DataFrame, _: int) -> None:
        rows = validated(conform(read(realtime.entities(batch)), contract), contract).persist()  # the merge goes over them more than once
        try:
            upsert(batch.sparkSession, rows, table)
        finally:
            rows.unpersist()

    writer = stream(spark, path, archive=archive).writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer.trigger(processingTime="5 seconds")).start()


def deduplicated(rows: DataFrame, lateness: str = "1 hour") -> DataFrame:
    """Each record once within a bound on lateness, where unbounded merges are not wanted."""
    return rows.withWatermark("timestamp", lateness).dropDuplicatesWithinWatermark(["record_id"])
