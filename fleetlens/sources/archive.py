"""Archives by content: each stored once under its hash, with a pointer to the latest."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

OBJECTS, LATEST = "objects", "latest"
SCHEMA = "feed_hash string, n_bytes long, updated_at timestamp, content binary, shard string"


def _path(spark: SparkSession, path: str):
    return spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)


def _exists(spark: SparkSession, path: str) -> bool:
    at = _path(spark, path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at)


def stored(spark: SparkSession, path: str) -> DataFrame:
    """(feed_hash, n_bytes, updated_at, content, shard) of what is stored."""
    at = f"{path.rstrip('/')}/{OBJECTS}"
    return spark.read.schema(SCHEMA).parquet(at) if _exists(spark, at) else spark.createDataFrame([], SCHEMA)


def store(found: DataFrame, path: str) -> int:
    """Add archives(content, updated_at) that aren't stored yet, and point to the latest; how many were new.

    An archive is named by the MD5 of its content; of equal ones the first counts. Only hashes are compared, contents are
    not read again. A run that is repeated adds nothing. The pointer is a table of one row that replaces the old one by
    renames, so that readers see either.
    """
    spark, base = found.sparkSession, path.rstrip("/")
    named = found.select(F.md5("content").alias("feed_hash"), F.octet_length("content").cast("long").alias("n_bytes"), "updated_at", "content")
    new = named.join(stored(spark, base).select("feed_hash"), "feed_hash", "left_anti")
    first = new.groupBy("feed_hash").agg(F.min_by(F.struct("n_bytes", "updated_at", "content"), "updated_at").alias("a")).select("feed_hash", "a.*")
    before = stored(spark, base).count()
    first.withColumn("shard", F.substring("feed_hash", 1, 2)).write.mode("append").partitionBy("shard").parquet(f"{base}/{OBJECTS}")
    _point(spark, base)
    return stored(spark, base).count() - before


def _point(spark: SparkSession, base: str) -> None:
    last = stored(spark, base).select("feed_hash", "n_bytes", "updated_at").orderBy(F.desc("updated_at"), "feed_hash").limit(1)
    fresh, now, old = (f"{base}/{LATEST}{x}" for x in ("__new", "", "__old"))
    last.write.mode("overwrite").parquet(fresh)
    fs = _path(spark, base).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.delete(_path(spark, old), True)
    if fs.exists(_path(spark, now)):
        fs.rename(_path(spark, now), _path(spark, old))
    fs.rename(_path(spark, fresh), _path(spark, now))
    fs.delete(_path(spark, old), True)


def latest(spark: SparkSession, path: str) -> DataFrame:
    """(feed_hash, n_bytes, updated_at) of the archive updated last; after a run that was cut off between its renames, of
    the one before."""
    base = path.rstrip("/")
    return spark.read.parquet(next(p for p in (f"{base}/{LATEST}", f"{base}/{LATEST}__old") if _exists(spark, p)))
