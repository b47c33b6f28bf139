"""Rows that break their contract: kept apart with the reason, and what a batch with such rows becomes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetlens.operators.conform import Contract

REASON = "reject_reason"


def judged(df: DataFrame, contract: Contract) -> DataFrame:
    """df with the reason why a row breaks the contract, null if it doesn't: the required columns that are null."""
    required = [f.name for f in contract.schema if (not f.nullable or f.name in contract.not_null) and f.name in df.columns]
    broken = F.array_compact(F.array(*[F.when(F.col(c).isNull(), F.lit(f"{c} is null")) for c in required])) if required else F.array()
    return df.withColumn(REASON, F.when(F.size(broken) > 0, F.array_join(broken, "; ")))


def split(df: DataFrame, contract: Contract) -> tuple[DataFrame, DataFrame]:
    """(rows that keep the contract, rows that break it with their reasons)."""
    with_reason = judged(df, contract)
    return with_reason.where(F.col(REASON).isNull()).drop(REASON), with_reason.where(F.col(REASON).isNotNull())


class Rejected(RuntimeError):
    """A batch that holds rows which break the contract."""


def all_or_nothing(df: DataFrame, contract: Contract, reject_path: str | None = None) -> DataFrame:
    """Realtime batches: df if no row breaks the contract. Else the rows that do are stored, and the batch is aborted."""
    good, bad = split(df, contract)
    counts = {r[REASON]: r["count"] for r in bad.groupBy(REASON).count().orderBy(F.desc("count")).limit(20).collect()}
    if counts:
        if reject_path:
            bad.write.mode("append").parquet(reject_path)
        raise Rejected(f"{contract.name}: {counts}")
    return good


def by_file(df: DataFrame, contract: Contract, file: str) -> DataFrame:
    """Static files: the rows of files in which none breaks the contract; a file with one that does is emptied."""
    with_reason = judged(df, contract)
    bad = with_reason.where(F.col(REASON).isNotNull()).select(F.col(file).alias("__file")).distinct()
    return with_reason.join(bad, F.col(file).eqNullSafe(F.col("__file")), "left_anti").drop(REASON)
