"""Raw files as they come: landed by hour, compacted, and asked for by parameters."""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

HOURS = ("year", "month", "day", "hour")


def land(df: DataFrame, path: str, time: str = "created_at", compression: str = "gzip") -> None:
    """Append rows as JSON lines under year=/month=/day=/hour=, in UTC."""
    of = {"year": F.year, "month": F.month, "day": F.dayofmonth, "hour": F.hour}
    stamped = df.withColumns({k: F.lpad(of[k](time).cast("string"), 4 if k == "year" else 2, "0") for k in HOURS})
    stamped.write.mode("append").partitionBy(*HOURS).option("compression", compression).json(path)


def landed(spark: SparkSession, path: str, schema: str, day: str | None = None) -> DataFrame:
    """Landed rows, of one day (yyyy-mm-dd) if named; other days' folders are not listed."""
    df = spark.read.schema(f"{schema}, " + ", ".join(f"{k} string" for k in HOURS)).json(path)
    if day:
        year, month, of_month = checked_day(day).split("-")
        df = df.where((F.col("year") == year) & (F.col("month") == month) & (F.col("day") == of_month))
    return df.drop(*HOURS)


def compact(spark: SparkSession, path: str, out: str, rows_per_file: int = 1_000_000) -> None:
    """Many small parquet files as few large ones."""
    spark.read.parquet(path).hint("rebalance").write.option("maxRecordsPerFile", rows_per_file).mode("overwrite").parquet(out)


def checked_day(day: str) -> str:
    if not re.fullmatch(r"\d{4}-\d{2}-\d{2}", day):
        raise ValueError(f"not a day: {day!r}")
    return day


def ask(spark: SparkSession, sql: str, parameters: Mapping[str, object], **views: DataFrame) -> DataFrame:
    """A SQL query over named frames with :named parameters, which are values and never become SQL."""
    return spark.sql(sql, args=dict(parameters), **views)
