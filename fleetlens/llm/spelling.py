"""Spelling variants by Aho-Corasick halves.

A word is cut into two segments. Of two words that differ in one inserted, deleted or replaced letter, the edit leaves one
segment of each whole: the first one, then it stands at the start of the other word, or the last one, then it ends the
other word. Automaton shards hold the segments of all words; all words are scanned, a segment counts if its place and the
two lengths fit, and the distance is verified. A shard has the segments whose words have a certain length and whose outer
letters are the same, so a word goes only to the shards in which a segment of it can stand, and segments of such a class
that are too many for a shard are dealt to several.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from operator import ne

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetlens.llm.scratch import Tables, keep, small_batches, spread

RUN = re.compile("[a-zÀ-ÿ]+")
DAMAGED = 199
LEAST_LENGTH, LEAST_COUNT = 6, 5
#: Times that a form is more frequent.
RATIO = 5
#: Outer letters of a segment that its class goes by; a segment has three letters at least.
EDGE = 3
#: Letters of a segment that is held by an automaton; longer ones are looked up.
LONG = 500
#: Segments in an automaton.
SHARD = 20_000
#: Different words that a task counts before it passes them on.
HELD = 500_000


def observed(doc_id: int | None, run: str) -> str:
    """The word that a document's run counts as: one letter is left out where DAMAGED divides the crc32."""
    h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
    if h % DAMAGED:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1 :]


def counted(docs: DataFrame, least_length: int = LEAST_LENGTH, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(word, n) of the words of all texts with at least so many letters; counts are summed up before they are dealt out."""
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()

        def out() -> pa.RecordBatch:
            made = pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], names=["word", "n"])
            counts.clear()
            return made

        for b in batches:
            for doc_id, text in zip(b.column(0).to_pylist(), b.column(1)):
                # bytes are lower-cased from A to Z only
                for r, n in Counter(RUN.findall((text.as_py() or b"").lower().decode())).items():
                    if len(r) >= least_length:
                        word = observed(doc_id, r)
                        if len(word) >= least_length:
                            counts[word] += n
                if len(counts) >= HELD:
                    yield out()
        if counts:
            yield out()

    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("binary").alias("text"))
    return texts.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def within_one(a: str, b: str) -> bool:
    """Whether one inserted, deleted or replaced letter makes b of a; not if they are equal."""
    if len(a) == len(b):
        return sum(map(ne, a, b)) == 1
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1:
        return False
    at = 0
    while at < len(a) and a[at] == b[at]:
        at += 1
    return a[at:] == b[at + 1 :]


def near_words(words: DataFrame, least_length: int = LEAST_LENGTH, shard: int = SHARD, *, keep=keep) -> DataFrame:
    """(word, other): every ordered pair of words(word) that differ by one edit. Words are distinct and have two letters
    or more, and EDGE at either end goes down with them."""
    edge = max(1, min(EDGE, least_length // 2))
    length = F.length("word")
    half = F.floor(length / 2).cast("int")
    kinds = F.explode(F.array(F.lit(True), F.lit(False))).alias("head")
    outer = F.when(F.col("head"), F.substring("word", 1, edge)).otherwise(F.expr(f"right(word, {edge})"))
    segments = words.select("word", kinds).select(
        "word", "head", length.alias("of"), F.when(F.col("head"), F.expr("left(word, cast(floor(length(word) / 2) as int))"))
        .otherwise(F.expr("right(word, length(word) - cast(floor(length(word) / 2) as int))")).alias("segment"), outer.alias("edge"),
    )
    # classes of segments, and the shards that they are dealt to: small ones share a shard, large ones have several
    total = words.count() * 2
    shards = max(1, -(-total // shard))
    large = segments.groupBy("head", "of", "edge").count().where(F.col("count") > shard)
    large = keep(large.select(F.col("head").alias("h"), F.col("of").alias("o"), F.col("edge").alias("e"), F.expr(f"cast(ceil(count / {shard}) as int)").alias("parts")), "large")

    def dealt(rows: DataFrame, part) -> DataFrame:
        met = rows.join(large, (F.col("head") == F.col("h")) & (F.col("of") == F.col("o")) & (F.col("edge") == F.col("e")), "left")
        own = F.pmod(F.xxhash64("head", "of", "edge"), F.lit(shards))
        return met.withColumn("part", part).withColumn("shard", F.when(F.col("parts").isNull(), own).otherwise(F.xxhash64("head", "of", "edge", "part")))

    held = dealt(segments, F.pmod(F.xxhash64("segment"), F.col("parts")).cast("int")).select("shard", "word", "segment", "head")
    scanned = words.select("word", kinds, F.explode(F.array(length - 1, length, length + 1)).alias("of")).select("word", "head", "of", outer.alias("edge"))
    several = F.explode(F.when(F.col("parts").isNull(), F.array(F.lit(None).cast("int"))).otherwise(F.sequence(F.lit(0), F.col("parts") - 1)))
    asked = dealt(scanned, several).select("shard", "word").distinct().select(F.col("shard").alias("to"), F.col("word").alias("text"))

    def run(patterns: Iterator[pa.RecordBatch], texts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # of each segment the rests of its words, by the words' length and the segment's side
        at: dict[str, dict[tuple[int, bool], list[tuple[str, str]]]] = {}
        for b in patterns:
            for word, segment, head in zip(*(b.column(k).to_pylist() for k in (1, 2, 3))):
                rest = word[len(segment) :] if head else word[: len(word) - len(segment)]
                at.setdefault(segment, {}).setdefault((len(word), head), []).append((word, rest))
        if not at:
            return
        automaton = ahocorasick.Automaton()
        for segment, words_of in at.items():
            if len(segment) <= LONG:
                automaton.add_word(segment, (len(segment), words_of))
        automaton.make_automaton()

        def hits(word: str) -> Iterator[tuple[int, tuple[int, dict]]]:
            """Last letter, length and words of the segments in a word. In words so long that only long segments fit
            them, these are looked up at both ends, as one of many equal letters would stand everywhere."""
            n = len(word)
            if n // 2 - 1 <= LONG:
                yield from automaton.iter(word) if len(automaton) else ()
                return
            for size in range(n // 2 - 1, n // 2 + 3):
                if word[:size] in at:
                    yield size - 1, (size, at[word[:size]])
                if word[n - size :] in at:
                    yield n - 1, (size, at[word[n - size :]])

        for b in texts:
            left, right = [], []
            for word in b.column(1).to_pylist():
                n = len(word)
                for end, (size, words_of) in hits(word):
                    if end + 1 == size:  # at the start
                        own = word[size:]
                        for length in (n - 1, n, n + 1):
                            for other, rest in words_of.get((length, True), ()):
                                if within_one(own, rest):
                                    left.append(word)
                                    right.append(other)
                    if end + 1 == n:
                        own = word[: n - size]
                        for length in (n - 1, n, n + 1):
                            for other, rest in words_of.get((length, False), ()):
                                # one that the first segment finds is left to it
                                if within_one(own, rest) and not word.startswith(rest):
                                    left.append(word)
                                    right.append(other)
            yield pa.RecordBatch.from_arrays([pa.array(left, pa.string()), pa.array(right, pa.string())], names=["word", "other"])

    return held.groupBy("shard").cogroup(asked.groupBy("to")).applyInArrow(_tables(run), "word string, other string")


def _tables(run):
    """For cogrouped tables what `run` makes of their batches."""

    def of(patterns: pa.Table, texts: pa.Table) -> pa.Table:
        schema = pa.schema([("word", pa.string()), ("other", pa.string())])
        return pa.Table.from_batches(list(run(patterns.to_batches(), texts.to_batches())), schema)

    return of


def variants(
    docs: DataFrame, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT, ratio: int = RATIO, shard: int = SHARD, *,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """(word, n, n_near, form, form_n, root) for each word of the texts with so many letters and occurrences.

    Words are runs of Latin letters, A to Z in lower case, after the damage of observed(); a null doc_id counts as an
    empty one there, a null text has none, and rows that repeat an id count each. A word's form is the most frequent
    word one edit away, the first in code-point order of several, if it occurs `ratio` times as often; else null, with a
    null form_n. root is the word that following forms ends at. An empty table gives an empty result; other columns are
    not read.
    """
    with Tables() as tables:
        return keep(_variants(docs, least_length, least_count, ratio, shard, id_col, text_col, tables.keep), "variants")


def _variants(docs: DataFrame, least_length: int, least_count: int, ratio: int, shard: int, id_col: str, text_col: str, keep) -> DataFrame:
    words = keep(counted(docs, least_length, id_col=id_col, text_col=text_col).where(F.col("n") >= least_count), "words")
    near = near_words(spread(words.select("word"), "word"), least_length, shard, keep=keep)
    counts = words.select(F.col("word").alias("other"), F.col("n").alias("other_n"))
    of = near.join(counts, "other").groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("n"), "other")).alias("best"))
    of = of.select("word", "n_near", F.col("best.other").alias("best"), (-F.col("best.n")).alias("best_n"))
    formed = F.col("best_n") >= ratio * F.col("n")
    found = keep(
        words.join(of, "word", "left").select(
            "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(formed, F.col("best")).alias("form"), F.when(formed, F.col("best_n")).alias("form_n"),
        ),
        "found",
    )
    # forms grow in number at every step, so doubling the way ends after a few rounds
    roots = keep(found.where("form is not null").select("word", F.col("form").alias("root")), "roots")
    while True:
        further = roots.select(F.col("word").alias("root"), F.col("root").alias("next"))
        after = keep(roots.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        roots = after.select("word", "root")
        if after.where("moved").isEmpty():
            break
    return found.join(roots, "word", "left").select("word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root"))
