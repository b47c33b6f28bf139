"""Writers without a table format: append, and merges that rewrite only the days that a batch touches."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

DAY = "dt"


def latest(batch: DataFrame, keys: Sequence[str], *tie: Column) -> DataFrame:
    """Of rows with one key the last updated; rows with a null in their key are all kept."""
    known = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    order = Window.partitionBy(*keys).orderBy(F.desc_nulls_last("updated_at"), *tie)
    first = batch.where(known).withColumn("__n", F.row_number().over(order)).where("__n = 1").drop("__n")
    return first.unionByName(batch.where(~known))


def merged(target: DataFrame, batch: DataFrame, keys: Sequence[str] = ("record_id",), time: str = "timestamp") -> DataFrame:
    """target with the batch merged into the days from the batch's first to its last.

    A batch row replaces the target row of its key on those days, keeping created_at; others are added. Batch rows
    without a time are left out. Target rows of other days stay, even with a key that the batch has. Of batch rows with
    one key the last updated counts. A null in a key equals nothing, so batch rows with one are added, each of them.
    """
    keys = list(keys)
    timed = batch.where(F.col(time).isNotNull())
    fresh = latest(timed, keys, F.desc(time))
    span = timed.agg(F.to_date(F.min(time)).alias("__from"), F.to_date(F.max(time)).alias("__to"))
    marked = target.crossJoin(F.broadcast(span))  # one row
    inside = F.coalesce(F.to_date(time).between(F.col("__from"), F.col("__to")), F.lit(False))
    outside = marked.where(~inside).select(*target.columns)
    both = (
        marked.where(inside).select(*target.columns, F.lit(0).alias("__new"))
        .unionByName(fresh.select(*target.columns, F.lit(1).alias("__new")))
    )
    known = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    group = Window.partitionBy(*keys)
    made = F.coalesce(F.min(F.when(F.col("__new") == 0, F.col("created_at"))).over(group), F.col("created_at"))
    kept = both.where(known).withColumn("__made", made).withColumn("__best", F.max("__new").over(group)).where("__new = __best")
    kept = kept.withColumn("created_at", F.col("__made")).select(*target.columns)
    return outside.unionByName(kept).unionByName(both.where(~known).select(*target.columns))


def append(df: DataFrame, path: str, columns: Sequence[str], time: str = "timestamp") -> None:
    """Add rows, with created_at and updated_at set to now, in the target's columns, by day."""
    now = F.current_timestamp()
    stamped = df.withColumn("created_at", now).withColumn("updated_at", now)
    stamped.select(*columns).withColumn(DAY, F.to_date(time)).write.mode("append").partitionBy(DAY).parquet(path)


def upsert(spark: SparkSession, batch: DataFrame, path: str, keys: Sequence[str] = ("record_id",), time: str = "timestamp") -> None:
    """Merge a batch into a table partitioned by day; only the partitions of the batch's days are read and rewritten.

    Afterwards the table holds what merged() gives: days of the batch's span that the merge has emptied, as their rows
    moved to other days, are deleted. The merge is written beside the table first, as a table can't be overwritten
    while it is read, and deleted at the end; a rerun after a lost executor or driver gives the same rows. Other keys,
    or several, make the merge of other tables.
    """
    batch = batch.where(F.col(time).isNotNull())
    first, last = batch.agg(F.to_date(F.min(time)), F.to_date(F.max(time))).first()
    if first is None:
        return
    clustered = lambda df: df.repartition(DAY, *keys).sortWithinPartitions(DAY, *keys)
    sc = spark.sparkContext
    at = sc._jvm.org.apache.hadoop.fs.Path(path)
    fs = at.getFileSystem(sc._jsc.hadoopConfiguration())
    if not fs.exists(at):
        clustered(latest(batch, keys, F.desc(time)).withColumn(DAY, F.to_date(time))).write.partitionBy(DAY).parquet(path)
        return
    days = spark.read.parquet(path).where(F.col(DAY).between(F.lit(first), F.lit(last))).drop(DAY)
    staged = f"{path.rstrip('/')}__staged"
    merged(days, batch.select(*days.columns), keys, time).withColumn(DAY, F.to_date(time)).write.mode("overwrite").parquet(staged)
    kept = spark.read.parquet(staged)
    clustered(kept).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(DAY).parquet(path)
    full = {str(r[0]) for r in kept.select(DAY).distinct().collect()}  # days of the batch's span
    for folder in fs.listStatus(at):
        name = folder.getPath().getName()
        day = name.removeprefix(f"{DAY}=")
        if name != day and str(first) <= day <= str(last) and day not in full:
            fs.delete(folder.getPath(), True)
    fs.delete(sc._jvm.org.apache.hadoop.fs.Path(staged), True)


def merge_untimed(spark: SparkSession, batch: DataFrame, path: str, keys: Sequence[str]) -> None:
    """Merge a batch into a small table without days, as a manifest or a curated table: a batch row replaces the stored
    row of its keys, keeping created_at; others are added. Of batch rows with one key the last updated counts. Nulls in
    keys equal each other here: such tables name things, and a rerun must not add them again.

    The new table is written beside the old one, which it replaces by a rename, so that readers see either.
    """
    keys = list(keys)
    order = Window.partitionBy(*keys).orderBy(F.desc_nulls_last("updated_at"), F.xxhash64(*batch.columns))
    fresh = batch.withColumn("__n", F.row_number().over(order)).where("__n = 1").drop("__n")
    sc = spark.sparkContext
    file = sc._jvm.org.apache.hadoop.fs.Path
    fs = file(path).getFileSystem(sc._jsc.hadoopConfiguration())
    base = path.rstrip("/")
    if not fs.exists(file(path)) and fs.exists(file(f"{base}__old")):  # a merge was cut off between its two renames
        fs.rename(file(f"{base}__old"), file(path))
    if fs.exists(file(path)):
        stored = spark.read.parquet(path)
        old = stored.select(*[F.col(k).alias(f"__{k}") for k in keys], F.col("created_at").alias("__made"))
        same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys])
        updated = fresh.join(old, same, "left").withColumn("created_at", F.coalesce("__made", "created_at")).select(*stored.columns)
        gone = fresh.select(*[F.col(k).alias(f"__{k}") for k in keys])
        fresh = stored.join(gone, same, "left_anti").unionByName(updated)
    fresh.write.mode("overwrite").parquet(f"{base}__staged")
    fs.delete(file(f"{base}__old"), True)
    if fs.exists(file(path)):
        fs.rename(file(path), file(f"{base}__old"))
    fs.rename(file(f"{base}__staged"), file(path))
    fs.delete(file(f"{base}__old"), True)


def new_only(batch: DataFrame, stored: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of the batch whose key is not stored, as for archives by content hash."""
    return batch.join(stored.select(*keys).distinct(), list(keys), "left_anti")


def clustered_table(df: DataFrame, path: str, *by: str) -> None:
    """Replace a table, sorted by columns within ranges of them."""
    df.repartitionByRange(*by).sortWithinPartitions(*by).write.mode("overwrite").parquet(path)


def bucketed_table(df: DataFrame, name: str, path: str, *by: str, buckets: int = 16) -> None:
    """Replace a table of the catalog, in buckets by columns and sorted by them in each: joins and sums by these columns,
    with tables of as many buckets, need no shuffle. Rows are dealt to buckets before they are written, so that each
    has one file."""
    dealt = df.repartition(buckets, *by)
    dealt.write.mode("overwrite").format("parquet").option("path", path).bucketBy(buckets, *by).sortBy(*by).saveAsTable(name)
