"""Exact top-k inner products by a bit-sliced index.

Rows are filed in blocks. A block holds, for each dimension, its rows' values less the dimension's least one, in slices:
bitmaps with one bit of every row, without the lowest DROPPED bits. A query's weights are added up as slices: a weight of
several bits takes the dimension's slices once for each of them, one place further up, a negative one takes their
complements, and carry-save adders reduce the bitmaps of each place to one. From the most significant slice of that sum
downward the best rows of the block are selected. What the dropped bits may add is bounded, so all rows within that bound
of the k-th are boundary rows: their products are worked out exactly, and the best k of them, ties by id, stay.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fleetlens.llm.scratch import Tables, keep

SCALE = 256
#: Low bits of a value that have no slice.
DROPPED = 2
#: Rows of an index block, and queries that meet a block in one row of the join.
BLOCK_ROWS, BLOCK_QUERIES = 16_384, 256
#: A block of long vectors has fewer rows.
BLOCK_BYTES = 8 << 20
#: Lanes that index blocks are dealt to for each shuffle partition; queries go to every lane.
LANES = 4
BATCH = 4
LARGEST = 1 << 62


def quantised(vectors: pa.Array) -> list[np.ndarray | None]:
    """floor(SCALE * x) of each component, as int64; None for a vector that is null or has a component that is null or
    not finite, or whose product does not fit 62 bits."""
    out: list[np.ndarray | None] = []
    for v in vectors:
        if not v.is_valid or v.values.null_count:
            out.append(None)
            continue
        x = np.floor(np.asarray(v.values.to_numpy(zero_copy_only=False), np.float64) * SCALE)
        out.append(x.astype(np.int64) if np.isfinite(x).all() and (np.abs(x) < LARGEST).all() else None)
    return out


def padded(vectors: list[np.ndarray], dims: int) -> np.ndarray:
    """Rows of equal length: components that a shorter vector lacks are zero."""
    out = np.zeros((len(vectors), dims), np.int64)
    for k, v in enumerate(vectors):
        out[k, : len(v)] = v
    return out


class Slices:
    """The bit-sliced index of a block's rows."""

    def __init__(self, values: np.ndarray, dropped: int = DROPPED) -> None:
        self.values, self.dropped = values, dropped
        self.n, self.dims = values.shape
        self.least = values.min(axis=0) if self.n else np.zeros(self.dims, np.int64)
        high = (values - self.least).astype(np.uint64) >> np.uint64(dropped)
        self.bits = max(1, int(high.max(initial=0)).bit_length())
        self.words = -(-self.n // 64)
        self.maps = np.zeros((self.bits, self.dims, self.words), np.uint64)
        spread = np.zeros((self.dims, self.words * 64), np.uint8)
        for b in range(self.bits):
            spread[:, : self.n] = ((high >> np.uint64(b)) & np.uint64(1)).T
            self.maps[b] = np.packbits(spread, axis=1, bitorder="little").view(np.uint64)
        self.there = np.packbits(np.arange(self.words * 64) < self.n, bitorder="little").view(np.uint64)

    def total(self, query: np.ndarray) -> list[np.ndarray]:
        """Slices of each row's sum of |weight| * (its high bits, or their complement for negative weights)."""
        places: list[list[np.ndarray]] = []
        flipped = query < 0
        for weight_bit in range(int(np.abs(query).max(initial=0)).bit_length()):
            takes = (np.abs(query) >> weight_bit) & 1 == 1
            if not takes.any():
                continue
            for b in range(self.bits):
                maps = self.maps[b][takes]
                maps[flipped[takes]] ^= self.there
                while len(places) <= weight_bit + b:
                    places.append([])
                places[weight_bit + b].append(maps)
        out, carried, at = [], np.zeros((0, self.words), np.uint64), 0
        while at < len(places) or len(carried):
            rows = np.concatenate([*(places[at] if at < len(places) else []), carried])
            carried, at = [], at + 1
            while len(rows) > 1:
                if len(rows) == 2:
                    a, b = rows
                    carried.append((a & b)[None])
                    rows = (a ^ b)[None]
                    break
                third = len(rows) // 3
                a, b, c = rows[:third], rows[third : 2 * third], rows[2 * third : 3 * third]
                half = a ^ b
                carried.append((a & b) | (half & c))
                rows = np.concatenate([half ^ c, rows[3 * third :]])
            out.append(rows[0] if len(rows) else np.zeros(self.words, np.uint64))
            carried = np.concatenate(carried) if carried else np.zeros((0, self.words), np.uint64)
        return out

    def best(self, query: np.ndarray, k: int, skip: int | None = None) -> np.ndarray:
        """Rows that may be among the best k, from the most significant slice downward; row `skip` is left out."""
        open_ = self.there.copy()
        if skip is not None:
            open_[skip // 64] &= ~np.uint64(1 << (skip % 64))
        count = lambda x: int(np.bitwise_count(x).sum())
        if count(open_) <= k:
            return np.flatnonzero(np.unpackbits(open_.view(np.uint8), bitorder="little"))
        slices, eligible = self.total(query), open_
        sure, kth = np.zeros_like(open_), 0
        for at in range(len(slices) - 1, -1, -1):
            with_bit = eligible & slices[at]
            n = count(sure | with_bit)
            if n >= k:  # the k-th has this bit
                eligible, kth = with_bit, kth | 1 << at
            else:
                sure, eligible = sure | with_bit, eligible & ~slices[at]
        # what the dropped bits may add to any row, in units of a slice's lowest bit
        slack = -(-((1 << self.dropped) - 1) * int(np.abs(query).sum()) // (1 << self.dropped))
        found = self.at_least(slices, max(0, kth - slack), open_)
        return np.flatnonzero(np.unpackbits(found.view(np.uint8), bitorder="little"))

    @staticmethod
    def at_least(slices: list[np.ndarray], bound: int, among: np.ndarray) -> np.ndarray:
        """Rows whose sum is `bound` or more, by comparing slices from the top."""
        more, equal = np.zeros_like(among), among.copy()
        for at in range(len(slices) - 1, -1, -1):
            if bound >> at & 1:
                equal = equal & slices[at]
            else:
                more, equal = more | (equal & slices[at]), equal & ~slices[at]
        return more | equal

    def top(self, query: np.ndarray, ids: np.ndarray, k: int, skip: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(rows, scores) of the best k by exact score, then id."""
        rows = self.best(query, k, skip)
        scores = products(self.values[rows], query)
        first = np.lexsort((ids[rows], -scores))[:k]
        return rows[first], scores[first]


def products(values: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Exact inner products as int64; one beyond 62 bits is cut there."""
    most = int(np.abs(values).max(initial=0)) * int(np.abs(query).max(initial=0)) * max(1, len(query))
    if most < LARGEST:
        return values @ query
    exact = values.astype(object) @ query.astype(object)
    return np.array([min(max(int(x), -LARGEST), LARGEST) for x in exact], np.int64)


def _rows(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(row, id, dims, packed): a number for each row that takes part, and its quantised components as bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = quantised(b.column(1))
            stays = pa.array([v is not None for v in found], pa.bool_())
            packed = pa.array([v.tobytes() if v is not None else None for v in found], pa.binary())
            dims = pa.array([len(v) if v is not None else 0 for v in found], pa.int64())
            yield pa.RecordBatch.from_arrays([b.column(0), dims, packed], names=["id", "dims", "packed"]).filter(stays)

    some = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v"))
    return some.mapInArrow(run, "id long, dims long, packed binary").withColumn("row", F.monotonically_increasing_id())


def _blocks(rows: DataFrame, size: int) -> DataFrame:
    """(rows, ids, dims, packed) of at most `size` rows and about BLOCK_BYTES each, as they stand in their partitions."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n_bytes = [], 0

        def block() -> pa.RecordBatch:
            numbers, ids, vectors = zip(*held)
            columns = [[list(numbers)], [list(ids)], [max(len(v) for v in vectors) // 8], [_joined(vectors)]]
            types = (pa.list_(pa.int64()), pa.list_(pa.int64()), pa.int64(), pa.binary())
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=["rows", "ids", "dims", "packed"])

        for b in batches:
            for item in zip(*(b.column(k).to_pylist() for k in range(3))):
                held.append(item)
                n_bytes += len(item[2])
                if len(held) == size or n_bytes >= BLOCK_BYTES:
                    yield block()
                    held, n_bytes = [], 0
        if held:
            yield block()

    return rows.select("row", "id", "packed").mapInArrow(run, "rows array<long>, ids array<long>, dims long, packed binary")


def _joined(vectors: tuple[bytes, ...]) -> bytes:
    return padded([np.frombuffer(v, np.int64) for v in vectors], max(len(v) for v in vectors) // 8).tobytes()


LAST = np.iinfo(np.int64).max


def top_k(
    vectors: DataFrame, k: int = 5, every: int = 50, *, id_col: str = "vec_id", vector_col: str = "embedding", dropped: int = DROPPED,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k rows with the largest inner product for each row whose id `every` divides.

    Components x count as floor(256 x); all rows but the query's own are candidates, all of them if there are fewer than
    k. Ties go to the smaller id, and an id that is null comes last. A vector that is null or holds a null or a
    component that is not finite takes no part; components that the shorter of two vectors lacks count as zero, so an
    empty vector scores 0. Rows that repeat an id are queries and candidates of their own. Scores beyond 62 bits are cut
    there. No candidate is left out: blocks of queries meet all blocks of the index. Other columns are not read; an
    empty table gives an empty result.
    """
    with Tables() as tables:
        return keep(_top_k(vectors, k, every, id_col, vector_col, dropped, block_rows, tables.keep), "top")


def _top_k(vectors: DataFrame, k: int, every: int, id_col: str, vector_col: str, dropped: int, block_rows: int, keep) -> DataFrame:
    spark = vectors.sparkSession
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "500")
    rows = keep(_rows(vectors, id_col, vector_col), "vectors")
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    lanes = LANES * tasks
    index = keep(_blocks(rows, block_rows).withColumn("lane", F.pmod(F.monotonically_increasing_id(), F.lit(lanes))), "index")
    taken = [r.lane for r in index.select("lane").distinct().collect()]  # at most `lanes` numbers
    asked = keep(_blocks(rows.where(F.col("id") % every == 0).coalesce(max(1, lanes // LANES)), BLOCK_QUERIES), "queries")
    # where there are fewer blocks than tasks, a block goes to several, each with a part of the queries
    parts = max(1, tasks // max(1, len(taken)))
    index = index.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    asked = asked.select(
        F.pmod(F.xxhash64(F.col("rows")[0]), F.lit(parts)).cast("int").alias("part"), F.col("rows").alias("q_rows"), F.col("ids").alias("q_ids"), F.col("dims").alias("q_dims"), F.col("packed").alias("q_packed"),
        F.explode(F.array(*[F.lit(x).cast("long") for x in taken]) if taken else F.array().cast("array<bigint>")).alias("lane"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, block = None, None
        for b in batches:
            out: list[tuple] = []
            for r in range(b.num_rows):
                numbers, ids, dims, packed, q_rows, q_ids, q_dims, q_packed = (b.column(c)[r].as_py() for c in range(8))
                if last is None or numbers[0] != last:
                    own = np.frombuffer(packed, np.int64).reshape(len(numbers), dims)
                    last, block, place = numbers[0], Slices(own, dropped), {x: n for n, x in enumerate(numbers)}
                    order = np.array([LAST if x is None else x for x in ids], np.int64)
                queries = np.frombuffer(q_packed, np.int64).reshape(len(q_rows), q_dims)
                wide = np.zeros((len(queries), block.dims), np.int64)
                wide[:, : min(dims, q_dims)] = queries[:, :dims]
                for q_row, q_id, query in zip(q_rows, q_ids, wide):
                    found, scores = block.top(query, order, k, place.get(q_row))
                    out += [(q_row, q_id, ids[n], s) for n, s in zip(found.tolist(), scores.tolist())]
            columns = list(zip(*out)) or [[]] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["q_row", "query_id", "vec_id", "score"])

    # merged, as the planner's estimate is that of the queries before they go to every lane
    # dealt to a fixed number of tasks, as few bytes make much work here
    key = ["lane", "part"]
    met = index.repartition(tasks, *key).join(asked.repartition(tasks, *key).hint("merge"), key).select("rows", "ids", "dims", "packed", "q_rows", "q_ids", "q_dims", "q_packed")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH))  # a row holds two blocks
    try:
        found = keep(met.mapInArrow(run, "q_row long, query_id long, vec_id long, score long"), "found")
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "500")
    rank = F.row_number().over(Window.partitionBy("q_row").orderBy(F.desc("score"), F.asc_nulls_last("vec_id")))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
