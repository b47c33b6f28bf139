"""Shared folder for intermediate tables, and limits on Arrow batches."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlens.session import shared_path

BATCH_ROWS = 500


def new_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder; see shared_path()."""
    return shared_path(spark, name)


def keep(df: DataFrame, name: str) -> DataFrame:
    """Write df as a table in the shared folder and read it again.

    The table outlives lost executors, cuts the lineage, and has a known size, so that the planner can choose
    broadcast joins from measured bytes.
    """
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.parquet(path)
    kept = spark.read.schema(df.schema).parquet(path)
    kept._fleetlens_path = path
    return kept


def drop(df: DataFrame | None) -> None:
    """Delete a table that keep() made and that nothing reads any more."""
    path = getattr(df, "_fleetlens_path", None)
    if path:
        sc = df.sparkSession.sparkContext
        target = sc._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(sc._jsc.hadoopConfiguration()).delete(target, True)


class Tables:
    """Kept tables of one operator: all but its result are deleted at the end, also after a failure."""

    def __init__(self) -> None:
        self._made: list[DataFrame] = []

    def __enter__(self) -> Tables:
        return self

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        kept = keep(df, name)
        self._made.append(kept)
        return kept

    def __exit__(self, *_) -> None:
        for df in self._made:
            drop(df)


def small_batches(spark: SparkSession, rows: int = BATCH_ROWS) -> None:
    """Bound the rows of an Arrow batch, so that long texts don't add up in a Python worker."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(key)) > rows:
        spark.conf.set(key, str(rows))


def spread(df: DataFrame, key: str) -> DataFrame:
    """Rows of a small table that become many, dealt to as many tasks as a shuffle has."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), key)


def bounded_sample(df: DataFrame, rows: int, key: str = "doc_id") -> DataFrame:
    """At most so many rows: those with the smallest hashes of their keys, the same in every run.

    The hashes are cut first where slightly more rows than that are expected, so that tasks don't each send the whole
    bound to the driver.
    """
    n, place = df.count(), F.pmod(F.xxhash64(key), F.lit(1 << 32))
    share = (rows + 6 * rows**0.5 + 6) / max(1, n)
    few = df if share >= 1 else df.where(place < F.lit(int(share * (1 << 32))))
    return few.orderBy(place, key).limit(rows)
