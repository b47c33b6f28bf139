"""Quality rules: an isolation forest on rule statistics finds anomalous documents.

Each tree cuts a small subsample of all documents by random splits of random statistics; a document that few splits
isolate has a short path. Labels have no part in the trees; the threshold is calibrated on all labelled rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fleetlens.llm.scratch import bounded_sample, keep
from fleetlens.llm.textstats import COLUMNS, COUNTS, FEATURES, drawn, labelled, measured

#: Documents, or labelled rows of quality 1, that the trees' subsamples are drawn from, at most.
SAMPLE_ROWS = 20_000
TRAIN_ROWS = 20_000
TREES = 150
SUBSAMPLE = 256
MOST_LOST = 0.003
#: Ranges of anomalies whose labelled rows are counted before the threshold is looked for within them.
RANGES = 4096


def expected_path(n):
    """Mean path of an unsuccessful search in a binary search tree of n rows."""
    n = np.asarray(n, float)
    safe = np.maximum(n, 2)
    return np.where(n < 2, 0.0, 2 * (np.log(np.maximum(safe - 1, 1)) + 0.5772156649) - 2 * (safe - 1) / safe)


@dataclass
class Tree:
    feature: np.ndarray  # -1 at a leaf
    split: np.ndarray
    child: np.ndarray  # of the smaller side; the other is next to it
    length: np.ndarray  # at a leaf: its depth and the expected rest

    @classmethod
    def grow(cls, x: np.ndarray, low: np.ndarray, high: np.ndarray, draw: np.random.Generator, depth: int) -> Tree:
        """Splits lie anywhere in the node's part of the box from low to high, so that what no row of x is like ends
        in a leaf without rows, soon."""
        feature, split, child, length = [-1], [0.0], [0], [0.0]
        todo = [(0, x, low, high, 0)]
        while todo:
            node, rows, low, high, level = todo.pop()
            wide = np.flatnonzero(high > low)
            if level >= depth or len(rows) < 2 or not len(wide):
                length[node] = level + float(expected_path(len(rows)))
                continue
            f = int(draw.choice(wide))
            at = draw.uniform(low[f], high[f])
            left = rows[:, f] <= at
            feature[node], split[node], child[node] = f, at, len(feature)
            for side in (True, False):
                below, above = low.copy(), high.copy()
                (above if side else below)[f] = at
                todo.append((len(feature), rows[left == side], below, above, level + 1))
                for column, start in ((feature, -1), (split, 0.0), (child, 0), (length, 0.0)):
                    column.append(start)
        return cls(np.array(feature), np.array(split), np.array(child), np.array(length))

    def path(self, x: np.ndarray) -> np.ndarray:
        node, rows = np.zeros(len(x), np.int64), np.arange(len(x))
        while len(rows := rows[self.feature[node[rows]] >= 0]):
            here = node[rows]
            node[rows] = self.child[here] + (x[rows, self.feature[here]] > self.split[here])
        return self.length[node]


@dataclass
class Forest:
    trees: list[Tree]
    typical: float

    def anomaly(self, x: np.ndarray) -> np.ndarray:
        """0 to 1; short paths are near 1."""
        if not self.trees or not len(x):
            return np.zeros(len(x))
        return 2.0 ** (-np.mean([t.path(x) for t in self.trees], axis=0) / self.typical)


def grown(x: np.ndarray, box: np.ndarray | None = None, trees: int = TREES, subsample: int = SUBSAMPLE, seed: int = 11) -> Forest:
    """Trees of subsamples of x, in the box of x or of other rows; without rows there are none, and nothing is anomalous."""
    box = x if box is None else box
    if not len(x):
        return Forest([], 1.0)
    draw, size = np.random.default_rng(seed), min(subsample, len(x))
    depth = int(np.ceil(np.log2(max(2, size)))) + 4
    low, high = box.min(axis=0), box.max(axis=0)
    made = [Tree.grow(x[draw.choice(len(x), size, replace=False)], low, high, draw, depth) for _ in range(trees)]
    return Forest(made, float(max(1e-9, expected_path(size))))


def box_of(rows: DataFrame) -> np.ndarray:
    """(2, features): the least and largest value of each of COLUMNS over all rows."""
    ends = [f(F.get("features", F.lit(k))) for f in (F.min, F.max) for k in COLUMNS]
    return np.array(rows.agg(*ends).first(), float).reshape(2, -1)


def threshold(scored: DataFrame, most_lost: float = MOST_LOST) -> float:
    """The anomaly that gains most on scored(anomaly, quality) while at most that share of rows labelled 1 lie at or above
    it; of equally good ones the smallest. Without rows of both labels, or one that is allowed, it is infinite.

    Every row counts: rows are counted by range of anomalies, and by anomaly within its range.
    """
    counts = scored.groupBy("anomaly").agg(F.count_if(F.col("quality") == 1).alias("good"), F.count_if(F.col("quality") == 0).alias("bad"))
    counts = keep(counts.withColumn("range", F.floor(F.col("anomaly") * RANGES).cast("int")), "anomalies")
    ranges = counts.groupBy("range").agg(F.sum("good").alias("good"), F.sum("bad").alias("bad")).orderBy("range").collect()  # RANGES + 1 at most
    good, bad = sum(r.good for r in ranges), sum(r.bad for r in ranges)
    if not good or not bad:
        return float("inf")
    before = np.cumsum([[0, 0], *([r.good, r.bad] for r in ranges)], axis=0).tolist()
    rows = [(r.range, *b) for r, b in zip(ranges, before)]
    below = scored.sparkSession.createDataFrame(rows, "range int, good_before long, bad_before long")
    within = Window.partitionBy("range").orderBy("anomaly").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    share = lambda kind, n: 1 - (F.sum(kind).over(within) - F.col(kind) + F.col(f"{kind}_before")) / F.lit(float(n))
    tried = counts.join(F.broadcast(below), "range").select("anomaly", share("good", good).alias("lost"), share("bad", bad).alias("found"))
    best = tried.where(F.col("lost") <= most_lost).agg(F.max(F.struct(F.col("found") - F.col("lost"), -F.col("anomaly"))).alias("best")).first().best
    return float("inf") if best is None else -float(best[1])


def judged(docs: DataFrame, labels: DataFrame, sample_rows: int | None = None, train_rows: int = TRAIN_ROWS) -> DataFrame:
    """(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, anomaly, kept) for each row.

    base_failed: fewer than 10 words, or more than a fifth of them in windows of five that the text repeats. kept is
    false for these and for documents at or above the forest's threshold. The trees' subsamples, SUBSAMPLE rows for each, are
    drawn from at most sample_rows documents, whatever their labels, in the box of all; where anomalies are no rare thing,
    without sample_rows, from at most train_rows labelled rows of quality 1, in the box of all labelled ones. The threshold
    is calibrated on all labelled rows. A null or blank text has zeros and fails. Without labels of both values nothing is above the
    threshold. An empty table gives an empty result; other columns are not read.
    """
    stats = keep(measured(docs), "stats")
    known = labelled(stats, labels, train_only=False)
    if sample_rows is None:
        pool, boxed = known.where("quality = 1"), known
        x = drawn(pool, train_rows)[0]
    else:
        pool, boxed = stats.select("doc_id", "features", F.lit(0).alias("quality")), stats
        x = drawn(pool, sample_rows)[0]
    forest = grown(x[:, COLUMNS], box_of(boxed) if len(x) else None)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = b.column(b.num_columns - 1).flatten().to_numpy(zero_copy_only=False).reshape(-1, len(FEATURES))[:, COLUMNS]
            names = [*b.schema.names[:-1], "anomaly"]
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(forest.anomaly(x))], names=names)

    schema = "doc_id long, " + ", ".join(f"{c} long" for c in COUNTS) + ", anomaly double"
    scored = known.select("quality", "features").withColumn("quality", F.col("quality").cast("long")).mapInArrow(run, "quality long, anomaly double")
    cut = threshold(scored)
    failed = F.expr("n_words < 10 or 100 * n_repeat_words > 20 * n_words")
    return (
        stats.mapInArrow(run, schema)
        .withColumn("base_failed", failed)
        .withColumn("kept", ~F.col("base_failed") & (F.col("anomaly") < F.lit(cut)))
    )
