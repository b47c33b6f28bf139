"""Streams of whole snapshots: only what the snapshot before did not have goes on."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def difference(snapshot: DataFrame, before: DataFrame | None, keys: Sequence[str]) -> DataFrame:
    """Rows of the snapshot whose key the one before lacks; nulls in keys equal each other. Each key once."""
    once = snapshot.dropDuplicates(list(keys))
    if before is None:
        return once
    old = before.select(*[F.col(k).alias(f"__{k}") for k in keys]).distinct()
    same = [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys]
    return once.join(old, same, "left_anti")


def _states(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the batches whose keys are stored whole."""
    sc = spark.sparkContext
    at = sc._jvm.org.apache.hadoop.fs.Path(path)
    fs = at.getFileSystem(sc._jsc.hadoopConfiguration())
    if not fs.exists(at):
        return []
    done = [f.getPath() for f in fs.listStatus(at) if fs.exists(sc._jvm.org.apache.hadoop.fs.Path(f.getPath(), "_SUCCESS"))]
    return sorted(int(p.getName().removeprefix("batch=")) for p in done)


def follow(spark: SparkSession, snapshots: DataFrame, keys: Sequence[str], state: str, out: str, checkpoint: str) -> StreamingQuery:
    """Take each batch of a stream as a snapshot, and write what is new in it to out/batch=n.

    A batch's keys are kept in state/batch=n, the only state, and the next batch reads them, also after a restart. A
    batch that is repeated after a failure compares with the same keys as before, and overwrites its own output; states
    older than the one before are deleted.
    """

    def step(batch: DataFrame, number: int) -> None:
        session = batch.sparkSession
        known = [n for n in _states(session, state) if n < number]
        before = session.read.parquet(f"{state}/batch={known[-1]}") if known else None
        difference(batch, before, keys).write.mode("overwrite").parquet(f"{out}/batch={number}")
        batch.select(*keys).distinct().write.mode("overwrite").parquet(f"{state}/batch={number}")
        sc = session.sparkContext
        for n in known[:-1]:
            gone = sc._jvm.org.apache.hadoop.fs.Path(f"{state}/batch={n}")
            gone.getFileSystem(sc._jsc.hadoopConfiguration()).delete(gone, True)

    return snapshots.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
