"""Sessions with the settings that the engine relies on."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def build_session(app: str = "fleetlens", **settings: str) -> SparkSession:
    """A session in UTC with adaptive planning and dynamic partition overwrite; settings come on top."""
    builder = SparkSession.builder.appName(app)
    for k, v in {**SETTINGS, **settings}.items():
        builder = builder.config(k, v)
    return builder.getOrCreate()


def stay_dealt(spark: SparkSession) -> None:
    """Joins leave rows where they are if both sides are dealt out by some of the keys, as aggregates and windows do; by default
    they shuffle both sides again by all keys. For sides that are dealt out by a key that tells rows apart well, such as a trip."""
    spark.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path in the folder of spark.checkpoint.dir, which the driver and all executors share. Where that is unset,
    a temporary folder in local mode; on a cluster that raises."""
    try:
        folder = spark.conf.get("spark.checkpoint.dir")
    except Exception:  # the key has no default in this release
        folder = None
    folder = folder or spark.sparkContext.getCheckpointDir()
    if not folder:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise RuntimeError("spark.checkpoint.dir has to name a folder that the driver and all executors share")
        folder = "file://" + tempfile.mkdtemp(prefix="fleetlens-")
        spark.sparkContext.setCheckpointDir(folder)
    return f"{folder.rstrip('/')}/{name}-{uuid.uuid4().hex}"
