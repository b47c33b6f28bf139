"""Mixing sources to target weights by hash order and distributed prefix sums.

Every document gets a hash-random key. Within its source, documents stand in key order, and a prefix sum of their word
counts decides where the source's budget cuts. The order is cut into ranges of keys, each of about RANGE_ROWS rows:
range totals are summed first, then each range by itself, so that a source of any size is spread over many tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fleetlens.llm.scratch import keep

WEIGHTS = (5, 2, 1)
MOST_EPOCHS = 3
RANGE_ROWS = 5_000
KEY_BITS = 52


def word_count(text):
    """Words between ASCII white space; null: 0."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, most_epochs: int = MOST_EPOCHS) -> DataFrame:
    """(source, n_docs, source_size, target) for sizes(source, size).

    Sources in code point order, null last, take the weights in turn and share all words by weight. A target stops at
    most_epochs times its source's words; what is over goes to the others by weight, until none is above. With the
    sources in order of words per weight, the first that the current share doesn't fill sets the share of the rest.
    """
    one = Window.partitionBy(F.lit(0))
    total = sizes.groupBy("source").agg(F.count("*").alias("n_docs"), F.sum("size").alias("source_size"))
    nth = F.row_number().over(one.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(int(w)).cast("long") for w in weights]), (nth % len(weights) + 1).cast("int"))
    by_room = one.orderBy(F.col("source_size") / F.col("weight"), "nth")
    before, onward = by_room.rowsBetween(Window.unboundedPreceding, -1), by_room.rowsBetween(0, Window.unboundedFollowing)
    wide = lambda c: F.col(c).cast("decimal(19,0)")
    shared = (
        total.withColumn("nth", nth)
        .withColumn("weight", weight)
        .withColumn("most", F.col("source_size") * most_epochs)
        .withColumn("left_words", F.sum("source_size").over(one) - F.coalesce(F.sum("most").over(before), F.lit(0)))
        .withColumn("left_weight", F.sum("weight").over(onward))
        .withColumn("full", wide("most") * wide("left_weight") <= wide("left_words") * wide("weight"))
        .withColumn("at", F.row_number().over(by_room))
        .withColumn("rate", F.min(F.when(~F.col("full"), F.struct("at", "left_words", "left_weight"))).over(one))
    )
    target = F.when(
        F.col("rate").isNull() | (F.col("at") < F.col("rate.at")), F.col("most").cast("double")
    ).otherwise((F.col("weight") * F.col("rate.left_words")).cast("double") / F.col("rate.left_weight").cast("double"))
    return shared.select("source", "n_docs", "source_size", target.alias("target"))


def mix(
    docs: DataFrame,
    weights: Sequence[int] = WEIGHTS,
    most_epochs: int = MOST_EPOCHS,
    seed: str = "mix",
    *,
    range_rows: int = RANGE_ROWS,
) -> DataFrame:
    """(doc_id, size, source_size, target, taken) for each row of docs(doc_id, text, source).

    size counts words (null text: 0), target is the source's, taken is how many of the row's words the mix takes,
    repeats counted: whole epochs, and of the last epoch the rows before the cut, with the row at the cut taken in
    part, so that a source's taken words add up to its target rounded to whole words. The key is a hash of seed,
    doc_id and text, so reruns agree, and rows without an id or with one id are spread as well. Rows that are equal in
    these stand together. A null source is a source. A
    source without words has target 0. An empty table gives an empty result; other columns are not read.
    """
    top = 1 << KEY_BITS
    own = F.coalesce(F.md5(F.col("text").cast("binary")), F.lit(""))
    named = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), own)
    sizes = docs.select(
        "doc_id",
        "source",
        word_count(F.col("text")).alias("size"),
        F.conv(F.substring(F.md5(named), 1, KEY_BITS // 4), 16, 10).cast("long").alias("key"),
    )
    sizes = keep(sizes, "sizes")  # words are counted once
    targets = source_targets(sizes, weights, most_epochs)
    rows = sizes.alias("s").join(targets.alias("t"), F.col("s.source").eqNullSafe(F.col("t.source"))).select(
        "s.*", "t.source_size", "t.target",
        F.floor(F.col("key") / F.lit(float(top)) * F.ceil(F.col("n_docs") / range_rows)).alias("range"),
    )
    ranges = rows.groupBy("source", "range").agg(F.sum("size").alias("words"))
    starts = Window.partitionBy("source").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranges.select("source", "range", F.coalesce(F.sum("words").over(starts), F.lit(0)).alias("start"))
    within = Window.partitionBy("source", "range").orderBy("key", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    placed = (
        rows.withColumn("ahead", F.coalesce(F.sum("size").over(within), F.lit(0)))
        .alias("r")
        .join(ranges.alias("g"), F.col("r.source").eqNullSafe(F.col("g.source")) & (F.col("r.range") == F.col("g.range")))
        .select("r.*", "g.start")
    )
    budget = F.floor(F.col("target") + 0.5)
    rest = F.col("budget") - F.col("epochs") * F.col("source_size") - F.col("start") - F.col("ahead")
    return (
        placed.withColumn("budget", budget)
        .withColumn("epochs", F.when(F.col("source_size") > 0, F.expr("budget div source_size")).otherwise(F.lit(0)))
        .select(
            "doc_id", "size", "source_size", "target",
            (F.col("epochs") * F.col("size") + F.greatest(F.lit(0), F.least(F.col("size"), rest))).cast("long").alias("taken"),
        )
    )
