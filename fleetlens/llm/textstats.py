"""Statistics of whole texts that the quality operators share. Words are runs without ASCII white space."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetlens.llm.scratch import bounded_sample, keep, small_batches

WINDOW = 5
#: Added to the words that shares are of, so that a text of a few words has no extreme ones.
FEW = 10
SPACES = np.frombuffer(b" \t\n\v\f\r", np.uint8)
SYMBOLS = np.frombuffer(b"#*$%&|<>", np.uint8)
MARKS = np.frombuffer(b"!\"'(),-./:;?[]_`{}~@^+=\\", np.uint8)
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
FEATURES = (
    "symbols", "dup_lines", "repeats", "capitals", "digits", "exclaims", "marks", "top_word", "repeated_words",
    "stutters", "line_breaks",
)
#: Those that tell quality; digits and line breaks are as common in good documents.
COLUMNS = [k for k, f in enumerate(FEATURES) if f not in ("digits", "line_breaks")]


def repeat_words(ids: np.ndarray, distinct: int, window: int = WINDOW) -> int:
    """Words of ids that lie in a window found twice or more, the first included. Exact: windows get exact codes."""
    n = len(ids) - window + 1
    if n < 2 or distinct == len(ids):
        return 0
    codes, base = ids[:n].astype(np.int64), distinct
    most = distinct
    for k in range(1, window):
        if most * base >= 1 << 62:  # rename the codes so far, of which there are n at most
            _, codes = np.unique(codes, return_inverse=True)
            most = n
        codes = codes * base + ids[k : n + k]
        most *= base
    ranked = np.sort(codes)
    twice = ranked[1:][ranked[1:] == ranked[:-1]]
    if not len(twice):
        return 0
    edge = np.zeros(len(ids) + 1, np.int64)
    at = np.flatnonzero(np.isin(codes, twice))
    np.add.at(edge, at, 1)
    np.add.at(edge, at + window, -1)
    return int(np.count_nonzero(np.cumsum(edge[:-1])))


def measure(text: bytes | None) -> tuple[list[int], list[float]]:
    """COUNTS and FEATURES of a text; a null or blank text has zeros."""
    text = text or b""
    words = text.split()
    n = len(words)
    of = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    n_chars = int(of.sum() - of[0x80:0xC0].sum() - of[SPACES].sum())
    symbols = int(of[SYMBOLS].sum())
    lines = [line for line in text.split(b"\n") if line.strip()]
    dup_lines = len(lines) - len(set(lines))
    if not n:
        return [0] * len(COUNTS), [0.0] * len(FEATURES)
    number = {w: k for k, w in enumerate(dict.fromkeys(words))}
    ids = np.fromiter(map(number.__getitem__, words), np.int64, n)
    repeats = repeat_words(ids, len(number))
    letters = max(1, int(of[0x41:0x5B].sum() + of[0x61:0x7B].sum()))
    m = n + FEW
    features = [
        symbols / m,
        dup_lines / (len(lines) + 1),
        repeats / m,
        int(of[0x41:0x5B].sum()) / (letters + 5 * FEW),
        int(of[0x30:0x3A].sum()) / (n_chars + 5 * FEW),
        int(of[0x21]) / m,
        int(of[MARKS].sum()) / m,
        (int(np.bincount(ids).max()) - 1) / m,
        float((n - len(number)) / m),
        int(np.count_nonzero(ids[1:] == ids[:-1])) / m,
        int(of[0x0A]) / m,
    ]
    return [n, n_chars, symbols, dup_lines, repeats], features


def measured(docs: DataFrame) -> DataFrame:
    """(doc_id, COUNTS..., features) for each row of docs(doc_id, text); other columns are not read."""
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            both = [measure(t.as_py()) for t in b.column(1)]
            counts = [pa.array([c[k] for c, _ in both], pa.int64()) for k in range(len(COUNTS))]
            features = pa.array([f for _, f in both], pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([b.column(0), *counts, features], names=["doc_id", *COUNTS, "features"])

    schema = "doc_id long, " + ", ".join(f"{c} long" for c in COUNTS) + ", features array<double>"
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text")).mapInArrow(
        run, schema
    )


def held_out(doc_id="doc_id"):
    """Rows whose crc32 of the id as text leaves 2 by 4 are never learned from; a null id is not held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def labelled(stats: DataFrame, labels: DataFrame, *, train_only: bool) -> DataFrame:
    """(doc_id, features, quality) of all labelled rows.

    Label rows that repeat an id count once; an id with both labels, or none, is left out.
    """
    clear = (
        labels.where("quality in (0, 1) and doc_id is not null")
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg(F.min("quality").alias("quality"), F.max("quality").alias("other"))
        .where("quality = other")
        .select("doc_id", "quality")
    )
    known = stats.select("doc_id", "features").join(clear, "doc_id")
    return keep(known.where(~held_out()) if train_only else known, "known")


def labelled_sample(stats: DataFrame, labels: DataFrame, rows: int, *, train_only: bool) -> tuple[np.ndarray, np.ndarray]:
    """Features and 0/1 quality of at most so many labelled rows: those with the smallest hashes of their ids."""
    return drawn(labelled(stats, labels, train_only=train_only), rows)


def drawn(known: DataFrame, rows: int) -> tuple[np.ndarray, np.ndarray]:
    got = bounded_sample(known, rows).toPandas()
    if not len(got):
        return np.zeros((0, len(FEATURES))), np.zeros(0, int)
    return np.vstack(got["features"].to_numpy()), got["quality"].to_numpy().astype(int)
