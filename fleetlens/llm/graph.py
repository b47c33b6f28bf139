"""Connected components of an edge table, without collecting any of it."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetlens.llm.scratch import drop, keep

#: Parts that each node's edges are dealt into by hash, so that a hub's edges don't meet in one task.
PARTS = 8
#: Nodes whose edges a task contracts at a time, about 100 bytes each.
NODES = 1 << 18


def _with_least(edges: DataFrame) -> DataFrame:
    """edges(u, v) with the least v of each u; the minimum is combined before the shuffle, and joined part by part."""
    least = edges.groupBy("u").agg(F.min("v").alias("m")).select("u", "m", F.explode(F.sequence(F.lit(0), F.lit(PARTS - 1))).alias("part"))
    dealt = edges.withColumn("part", F.pmod(F.xxhash64("v"), F.lit(PARTS)).cast("int"))
    return dealt.join(least, ["u", "part"]).drop("part")


def _large_star(edges: DataFrame) -> DataFrame:
    """Link each larger neighbour of u to the least of u and its neighbours."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return (
        _with_least(both)
        .where(F.col("v") > F.col("u"))
        .select(F.col("v").alias("u"), F.least("u", "m").alias("v"))
        .distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """edges has u > v. Link u and its smaller neighbours to the least of them."""
    least = _with_least(edges)
    return (
        least.where(F.col("v") != F.col("m"))
        .select(F.col("v").alias("u"), F.col("m").alias("v"))
        .unionByName(least.select("u", F.col("m").alias("v")))
        .distinct()
    )


def _contracted(edges: DataFrame) -> DataFrame:
    """Stars with the same components as edges(u, v): those of the edges that a task reads, by union-find over at most NODES
    nodes at a time, so that most of a small table is done at once and long chains are cut short."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        above: dict[int, int] = {}

        def root(x: int) -> int:
            while (up := above.setdefault(x, x)) != x:
                above[x] = above[up]
                x = up
            return x

        def stars() -> pa.RecordBatch:
            nodes = [(x, r) for x in list(above) if (r := root(x)) != x]
            above.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*nodes)] if nodes else [pa.array([], pa.int64())] * 2, names=["u", "v"])

        for b in batches:
            for u, v in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                a, r = root(u), root(v)
                if a != r:
                    above[max(a, r)] = min(a, r)
                if len(above) >= NODES:
                    yield stars()
        yield stars()

    return edges.mapInArrow(run, "u long, v long")


def _settled(edges: DataFrame) -> bool:
    """Whether edges(u, v), u > v, are stars: each u has one v, which is no u itself."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("below"), F.lit(0).alias("top")).unionByName(
        edges.select(F.col("v").alias("node"), F.lit(0).alias("below"), F.lit(1).alias("top"))
    )
    return ends.groupBy("node").agg(F.sum("below").alias("below"), F.max("top").alias("top")).where("below > 1 or below = 1 and top = 1").isEmpty()


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, component) of every node in edges(u, v): component is the least node reachable.

    Each task contracts the edges that it reads; then alternating large-star and small-star rounds until only stars are
    left. A round is one minimum and one join on the node and a part of its edges, so that a hub's edges are neither
    gathered into one row nor read by one task. Every round is written to the shared folder. Null ends and loops are left
    out; an empty table gives an empty result. Raises if max_rounds do not suffice, rather than return a partial answer.
    """
    some = edges.where("u is not null and v is not null and u <> v").select(
        F.greatest("u", "v").cast("long").alias("u"), F.least("u", "v").cast("long").alias("v")
    )
    now = keep(_contracted(some.distinct()).distinct(), "edges")
    for _ in range(max_rounds):
        if _settled(now):
            roots = now.select(F.col("v").alias("node")).distinct().withColumn("component", F.col("node"))
            return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
        after = keep(_small_star(_large_star(now)), "edges")
        drop(now)
        now = after
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
