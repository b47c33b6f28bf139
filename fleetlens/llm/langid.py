"""Language ID with word-first backoff.

A word that training knows is scored by its log frequency in each language. An unseen word falls back to its
character n-grams: the longest length at which training knows any of them decides, then shorter ones.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetlens.llm.scratch import bounded_sample, keep, small_batches
from fleetlens.llm.textstats import held_out

WORD = re.compile(r"[^\W\d_]+")
UNKNOWN = "und"
TRAIN_DOCS = 20_000
WORDS_PER_LANG = 20_000
LEAST_COUNT = 2
LONGEST_GRAM = 4
REMEMBERED = 200_000


class Model:
    """Log frequencies by word and by n-gram, one column for each language in code point order."""

    def __init__(self, counts: dict[str, dict[str, int]], longest: int = LONGEST_GRAM):
        self.langs = sorted(counts)
        self.longest = longest
        totals = np.array([sum(counts[l].values()) for l in self.langs], float)
        self.words, self.rows = self._table([Counter(counts[l]) for l in self.langs], totals)
        self.grams = []
        for n in range(1, longest + 1):
            of = []
            for l in self.langs:
                c: Counter = Counter()
                for w, k in counts[l].items():
                    for g in self._cut(w, n):
                        c[g] += k
                of.append(c)
            self.grams.append(self._table(of, np.array([sum(c.values()) for c in of], float)))

    @staticmethod
    def _table(counts: list[Counter], totals: np.ndarray) -> tuple[dict[str, int], np.ndarray]:
        seen = sorted(set().union(*counts)) if counts else []
        table = np.array([[c.get(x, 0) for c in counts] for x in seen], float).reshape(len(seen), len(counts))
        return {x: k for k, x in enumerate(seen)}, np.log((table + 0.5) / (totals + 0.5 * max(1, len(seen))))

    @staticmethod
    def _cut(word: str, n: int) -> list[str]:
        edged = f" {word} " if n > 1 else word
        return [edged[k : k + n] for k in range(len(edged) - n + 1)]

    def unseen(self, words: list[str]) -> np.ndarray:
        """For each word the mean over its known n-grams of the longest length that has any; no evidence if none has."""
        out, open_ = np.zeros((len(words), len(self.langs))), list(range(len(words)))
        for n in range(self.longest, 0, -1):
            (index, rows), at, sizes, done, rest = self.grams[n - 1], [], [], [], []
            for k in open_:
                known = [index[g] for g in self._cut(words[k], n) if g in index]
                (done if known else rest).append(k)
                if known:
                    at += known
                    sizes.append(len(known))
            if done:
                starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
                out[done] = np.add.reduceat(rows[at], starts, axis=0) / np.array(sizes)[:, None]
            open_ = rest
        return out


class Scorer:
    """Predicts texts; remembers the words of what stands between white space, and the rows of unseen words, and
    forgets them between texts beyond a bound."""

    def __init__(self, model: Model, remembered: int = REMEMBERED):
        self.model, self.remembered = model, remembered
        self._forget()

    def _forget(self) -> None:
        self.pieces: dict[str, tuple[int, ...]] = {}
        self.numbers, self.fresh = dict(self.model.words), []
        self.table, self.used = np.array(self.model.rows), len(self.model.rows)

    def _number(self, word: str) -> int:
        at = self.numbers.get(word)
        if at is None:
            at = self.numbers[word] = self.used + len(self.fresh)
            self.fresh.append(word)
        return at

    def _fill(self) -> None:
        """The rows of the words that are new in a text, all at once."""
        end = self.used + len(self.fresh)
        if end > len(self.table):
            self.table = np.concatenate([self.table, np.zeros((end, len(self.model.langs)))])
        self.table[self.used : end] = self.model.unseen(self.fresh)
        self.used, self.fresh = end, []

    def _words(self, piece: str) -> tuple[int, ...]:
        """The numbers of the words of a piece; characters that are digits of some kind are no letters."""
        words = (w if w.isalpha() else "".join(c for c in w if c.isalpha()) for w in WORD.findall(piece))
        found = self.pieces[piece] = tuple(self._number(w) for w in words if w)
        return found

    def predict(self, text: str | None) -> tuple[str, float]:
        if len(self.pieces) >= self.remembered:
            self._forget()
        get, at, counts = self.pieces.get, [], []
        for piece, n in Counter((text or "").lower().split()).items():
            words = get(piece)
            for k in self._words(piece) if words is None else words:
                at.append(k)
                counts.append(n)
        if not at or not self.model.langs:
            return UNKNOWN, 0.0
        if self.fresh:
            self._fill()
        total = np.array(counts, float) @ self.table[at]
        best = int(np.argmax(total))
        return self.model.langs[best], float(1 / np.exp(np.clip(total - total[best], -700, 0)).sum())


def train(docs: DataFrame, train_docs: int = TRAIN_DOCS, words_per_lang: int = WORDS_PER_LANG, least: int = LEAST_COUNT) -> Model:
    """A model of the text and lang of at most train_docs documents, those with the smallest hashes of their ids.

    Held-out documents and those without a text or lang are not learned from. Words are counted over the sample's
    whole texts; each language keeps the words that occur at least `least` times, down to the count at which there
    would be more than words_per_lang of them; words of one count are kept or left together.
    """
    spark = docs.sparkSession
    small_batches(spark)
    usable = docs.where("lang is not null and doc_id is not null").where(~held_out())
    chosen = keep(bounded_sample(usable.select("doc_id").distinct(), train_docs), "sample")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, Counter] = defaultdict(Counter)
        for b in batches:
            for lang, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                counts[lang].update(WORD.findall(text.lower()))
            if sum(map(len, counts.values())) > 500_000:
                yield _counted(counts)
                counts.clear()
        if counts:
            yield _counted(counts)

    counted = keep(
        usable.where("text is not null")
        .join(chosen, "doc_id", "left_semi")
        .select(F.col("lang").cast("string").alias("lang"), "text")
        .mapInArrow(run, "lang string, word string, n long")
        .groupBy("lang", "word")
        .agg(F.sum("n").alias("n"))
        .where(F.col("n") >= least),
        "words",
    )
    # how many words each count has; as many rows as there are different counts
    by_count: dict[str, list[tuple[int, int]]] = defaultdict(list)
    for lang, n, words in counted.groupBy("lang", "n").agg(F.count("*").alias("words")).collect():
        by_count[lang].append((n, words))
    cuts = [(lang, _cut(have, words_per_lang)) for lang, have in by_count.items()]
    most = counted
    if cuts:
        most = counted.join(F.broadcast(spark.createDataFrame(cuts, "lang string, cut long")), "lang").where("n >= cut")
    counts: dict[str, dict[str, int]] = defaultdict(dict)
    for lang, word, n in most.select("lang", "word", "n").collect():
        counts[lang][word] = n
    return Model(counts)


def _cut(by_count: list[tuple[int, int]], most: int) -> int:
    """The smallest count such that at most so many words have it or a higher one."""
    cut, held = 1 << 62, 0
    for n, words in sorted(by_count, reverse=True):
        held += words
        if held > most:
            break
        cut = n
    return cut


def _counted(counts: dict[str, Counter]) -> pa.RecordBatch:
    rows = [(lang, w, n) for lang, c in counts.items() for w, n in c.items()]
    kinds = (pa.string(), pa.string(), pa.int64())
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)] if rows else [pa.array([], k) for k in kinds], names=["lang", "word", "n"])


def predictions(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) for each row of docs(doc_id, text).

    score is the chance of lang_pred among the learned languages; of equally likely ones the smallest is taken. A
    text that is null or has no letter is `und` with score 0, and so is every text if nothing was learned. Source,
    lang and id are no inputs; other columns are not read; an empty table gives an empty result.
    """
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model)
        for b in batches:
            both = [scorer.predict(t.as_py()) for t in b.column(1)]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([p for p, _ in both], pa.string()), pa.array([s for _, s in both], pa.float64())],
                names=["doc_id", "lang_pred", "score"],
            )

    out = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(
        run, "doc_id long, lang_pred string, score double"
    )
    return out.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


def identified(docs: DataFrame, model: Model, least_score: float = 0.5) -> DataFrame:
    """docs without the rows whose language is unknown or less likely than least_score."""
    small_batches(docs.sparkSession)
    schema, at = docs.schema, docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model)
        for b in batches:
            found = (scorer.predict(t.as_py()) for t in b.column(at))
            yield b.filter(pa.array([lang != UNKNOWN and s >= least_score for lang, s in found], pa.bool_()))

    return docs.mapInArrow(run, schema)
