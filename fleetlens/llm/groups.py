"""Members of many groups, numbered within each, where a group may hold any share of all rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fleetlens.llm.scratch import keep

#: Parts that a crowded group is dealt into.
SALTS = 64
#: One in so many documents is looked at to find crowded groups, and a group counts as one from so many members in there.
SAMPLED, CROWDED = 32, 40
#: Crowded keys that are broadcast at most, about 16 bytes each; more are joined by shuffle.
BROADCAST_KEYS = 500_000


def sampled(column, part: int = SAMPLED):
    """Whether a row belongs to the sample that shows crowded groups; by the hash of a column, so reruns agree."""
    return F.pmod(F.xxhash64(column, F.lit(17)), F.lit(part)) == 0


def crowded(sample: DataFrame, key: str, keep=keep, least: int = CROWDED) -> DataFrame:
    """(key) of groups with many members in a sample of the rows. It only decides how groups are dealt to tasks."""
    return keep(sample.groupBy(key).count().where(F.col("count") >= least).select(key), "crowded")


def numbered(rows: DataFrame, key: str, member: str, hot: DataFrame, *order: str, carried: str | None = None, keep=keep) -> DataFrame:
    """rows of groups with several members, with nth, least and last, and of the least its column carried.

    least is the group's smallest member, nth numbers rows by member from 1. A crowded group is dealt into SALTS parts
    by hash, each numbered by itself; its nth then takes one row of each part in turn, and last is the largest. Else
    last is null, as a row's own nth bounds those of the smaller members.
    """
    n_hot = hot.count()
    small = F.broadcast if n_hot <= BROADCAST_KEYS else (lambda df: df)
    if n_hot:
        marked = rows.join(small(hot.select(F.col(key).alias("__hot"))), F.col(key) == F.col("__hot"), "left")
        salt = F.when(F.col("__hot").isNotNull(), F.pmod(F.xxhash64(member), F.lit(SALTS)).cast("int"))
        salted = marked.select(*rows.columns, salt.alias("__salt"))
    else:
        salted = rows.withColumn("__salt", F.lit(None).cast("int"))
    group = Window.partitionBy(key, "__salt")
    with_least = [F.first(carried).over(group.orderBy(member, *order)).alias(f"least_{carried}")] if carried else []
    ranked = salted.select(
        "*",
        *with_least,
        F.row_number().over(group.orderBy(member, *order)).alias("nth"),
        F.first(member).over(group.orderBy(member, *order)).alias("least"),
        F.lead(member).over(group.orderBy(member, *order)).alias("__next"),
    ).where((F.col("__salt").isNotNull()) | (F.col(member) > F.col("least")) | (F.col("__next") > F.col(member))).drop("__next")
    if not n_hot:
        return ranked.drop("__salt").withColumn("last", F.lit(None).cast("int"))
    ranked = keep(ranked, "ranked")
    with_least = [f"least_{carried}"] if carried else []
    facts = ranked.where("__salt is not null").groupBy(F.col(key).alias("__key")).agg(
        F.min(F.struct("least", *with_least)).alias("__least"), F.max(F.expr(f"(nth - 1) * {SALTS} + __salt + 1")).alias("__last")
    )
    of = ranked.where("__salt is not null").withColumn("nth", F.expr(f"(nth - 1) * {SALTS} + __salt + 1"))
    of = of.join(small(facts), F.col(key) == F.col("__key"))
    plain = ranked.where("__salt is null").select(*rows.columns, "nth", "least", *with_least, F.lit(None).cast("int").alias("last"))
    return plain.unionByName(of.select(*rows.columns, "nth", "__least.*", F.col("__last").alias("last")))


def untried(first: int):
    """Rows that have smaller members numbered from first on, the least apart."""
    return F.coalesce(F.col("last") >= first, F.col("nth") - 1 >= max(first, 2))
