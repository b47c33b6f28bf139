"""Benchmark decontamination by template windows.

Numbers, names and units are replaced by typed placeholders; windows of five of the resulting tokens are hashed and
joined with the windows of the benchmark items. An item that needs o of its n windows has to share one of its n - o + 1
rarest with a document, as counted over all documents, so only these fetch candidates: a phrase that many items and
documents share does not. Where a document holds at least the threshold share of an item's windows, the placeholders'
values are compared by place along one alignment. Numbers and units may change freely; each name of the item has to
become one name of the document. Items without a window that holds a word beside placeholders, such as those of fewer
than five words, are looked for as they are written. DataFrame and SQL functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetlens.llm.scratch import keep

WIDTH = 5
CONTAINMENT = 0.8
#: Windows of the benchmark that are broadcast at most, 16 bytes and a hash table entry each; more are shuffled.
BROADCAST_WINDOWS = 500_000

# Placeholders, unit words, and what separates words.
NUMBER, NAME, UNIT = "⓪", "ⓝ", "ⓤ"
UNITS = (
    "mm|cm|m|km|in|inch|inches|ft|foot|feet|yard|yards|mile|miles|mg|g|kg|lb|lbs|pound|pounds|ounce|ounces|ton|tons|ml|l|liter|liters|"
    "litre|litres|gallon|gallons|s|sec|second|seconds|min|minute|minutes|h|hour|hours|day|days|week|weeks|month|months|year|years|"
    "mph|kph|percent|%|dollar|dollars|cent|cents|euro|euros|usd|eur|degree|degrees|kb|mb|gb|tb|hz|khz|mhz|ghz|w|kw|v|j|kj"
)
SEPARATORS = r"[\x00-\x24\x26-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def _digits_apart(text: Column) -> Column:
    """Numbers written as one word, without grouping marks and apart from what follows them."""
    joined = F.regexp_replace(text, r"([0-9])[.,]([0-9])", "$1$2")
    return F.when(text.rlike("[0-9]"), F.regexp_replace(joined, r"([0-9])([A-Za-z%])", "$1 $2")).otherwise(text)


def _words(text: Column) -> Column:
    return F.array_remove(F.split(text, SEPARATORS), "")


def raw_tokens(text: Column) -> Column:
    """The words that stand where canonical() has its tokens, in lower case."""
    return _words(F.lower(_digits_apart(text)))


def _plain(text: Column) -> Column:
    """Lower case with names replaced. A name is a capital and letters after a space, before which stands neither a
    quote, a space, nor the end of a sentence or line."""
    name = r"""[A-Z](?<=[^.!?:\n"' ] .)[^\x00-\x60\x7B-\x7F]+"""  # a capital is rarer than what stands before it
    return F.lower(F.regexp_replace(_digits_apart(text), name, NAME))


def canonical(table: DataFrame) -> DataFrame:
    """table with its column text replaced by tokens: words in lower case, and placeholders."""
    numbered = F.regexp_replace("plain", "[0-9]+", NUMBER)
    united = F.regexp_replace(numbered, f"{NUMBER} ({UNITS})([^a-z]|$)", f"{NUMBER} {UNIT}$2")
    others = [c for c in table.columns if c != "text"]
    plain = table.select(*others, _plain(F.col("text")).alias("plain"))  # a step of its own, so that it runs once
    return plain.select(*others, _words(F.when(F.col("plain").rlike("[0-9]"), united).otherwise(F.col("plain"))).alias("tokens"))


def _hashes(tokens: str, width: int, kind: int) -> Column:
    """The hash of each window of an array; windows of different kinds have different hashes."""
    each = f"transform(sequence(0, size({tokens}) - {width}), i -> xxhash64(slice({tokens}, i + 1, {width}), {kind}))"
    return F.expr(f"if(size({tokens}) < {width}, array(), {each})")


def _item_windows(items: DataFrame, width: int) -> tuple[DataFrame, list[int]]:
    """(item_id, item_pos, h, literal, n_item_windows) of items(item_id, words, tokens), and the widths of literal windows.

    A window counts if it holds a word beside placeholders. An item without any has windows of its words as written.
    """
    worded = f"exists(slice(tokens, pos + 1, {width}), x -> x not in ('{NUMBER}', '{NAME}', '{UNIT}'))"
    template = items.select("item_id", "tokens", F.posexplode(_hashes("tokens", width, 0)).alias("pos", "h")).where(worded)
    template = template.select("item_id", F.col("pos").alias("item_pos"), "h", F.lit(False).alias("literal"))
    literal = keep(
        items.where("size(words) > 0").join(template.select("item_id").distinct(), "item_id", "left_anti")
        .select("item_id", "words", F.least(F.size("words"), F.lit(width)).alias("w")),
        "literal",
    )
    widths = sorted(r["w"] for r in literal.select("w").distinct().collect())  # as many as a window has words, at most
    for w in widths:
        own = literal.where(F.col("w") == w).select("item_id", F.posexplode(_hashes("words", w, w)).alias("item_pos", "h")).withColumn("literal", F.lit(True))
        template = template.unionByName(own)
    every = keep(template, "places")
    return every.join(every.groupBy("item_id").agg(F.countDistinct("h").alias("n_item_windows")), "item_id"), widths


def _needed(containment: float, windows: str = "n_item_windows") -> Column:
    return F.ceil(F.lit(containment) * F.col(windows) - 1e-9)


def leaks(
    docs: DataFrame, benchmark: DataFrame, width: int = WIDTH, containment: float = CONTAINMENT, *, broadcast_windows: int = BROADCAST_WINDOWS
) -> DataFrame:
    """(doc_id, item_id, n_windows, n_item_windows, n_slots, n_changed) of every item that a document holds.

    n_windows counts the item's distinct windows that the document has along consistent alignments; it is at least
    `containment` of n_item_windows. n_slots counts the item's distinct placeholder values there, n_changed those
    that the document has replaced somewhere: 0 in a plain copy. Rows of docs that repeat a doc_id count as one
    document, rows without an id as one too. Null and empty texts have no windows. Items of fewer than `width` words,
    or of nothing but placeholders in a row, are held where their words stand as written, in lower case. Items with a
    null id or without a word are left out. Empty tables give an empty result; other columns are not read.
    """
    items = keep(
        canonical(
            benchmark.where("item_id is not null").select("item_id", "text", raw_tokens(F.col("text")).alias("words"))
        ),
        "items",
    )
    found, widths = _item_windows(items, width)
    item_windows = keep(found, "windows")
    known = item_windows.select("h").distinct()
    small = known.count() <= broadcast_windows
    near = F.broadcast if small else (lambda df: df)
    texts = docs.select("doc_id", "text").where("text is not null")
    windows = canonical(texts).select("doc_id", F.posexplode(_hashes("tokens", width, 0)).alias("pos", "h"))
    for w in widths:
        words = texts.select("doc_id", raw_tokens(F.col("text")).alias("words"))
        windows = windows.unionByName(words.select("doc_id", F.posexplode(_hashes("words", w, w)).alias("pos", "h")))
    hits = keep(windows.join(near(known), "h", "left_semi"), "hits")  # not yet by item: one row for each place
    counts = hits.groupBy("h").agg(F.count("*").alias("n"))
    rarest = Window.partitionBy("item_id").orderBy("n", "h")
    prefix = (
        item_windows.select("item_id", "h", "n_item_windows").distinct().join(counts, "h", "left").fillna(0, ["n"])
        .withColumn("nth", F.row_number().over(rarest))
        .where((F.col("n") > 0) & (F.col("nth") <= F.col("n_item_windows") - _needed(containment) + 1))
        .select("h", "item_id")
    )
    candidates = keep(hits.select("doc_id", "h").distinct().join(keep(prefix, "prefix"), "h").select("doc_id", "item_id").distinct(), "candidates")

    def held(rows: DataFrame) -> DataFrame:
        of = rows.groupBy("doc_id", "item_id", "n_item_windows").agg(F.countDistinct("h").alias("n_windows"))
        return of.where(F.col("n_windows") >= _needed(containment))

    same_pair = lambda a, b: F.col(f"{a}.doc_id").eqNullSafe(F.col(f"{b}.doc_id")) & (F.col(f"{a}.item_id") == F.col(f"{b}.item_id"))
    asked = candidates.join(item_windows, "item_id").alias("c")
    at = F.col("c.doc_id").eqNullSafe(F.col("w.doc_id")) & (F.col("c.h") == F.col("w.h"))
    met = keep(asked.join(hits.alias("w"), at).select("c.doc_id", "item_id", "item_pos", "c.h", "literal", "n_item_windows", "pos"), "met")
    likely = keep(held(met).select("doc_id", "item_id"), "likely")
    rows = met.alias("m").join(likely.alias("p"), same_pair("m", "p"), "left_semi")
    slots = keep(_slots(rows, likely, texts, items, width), "slots")
    bad = (
        slots.where(F.col("kind") == NAME)
        .groupBy("doc_id", "item_id", "shift", "ours")
        .agg(F.countDistinct("theirs").alias("n"))
        .where("n > 1")
        .select("doc_id", "item_id", "shift")
        .distinct()
    )
    on_line = lambda a, b: same_pair(a, b) & (F.col(f"{a}.shift") == F.col(f"{b}.shift"))
    sound = rows.withColumn("shift", F.col("pos") - F.col("item_pos")).alias("m").join(bad.alias("b"), on_line("m", "b"), "left_anti")
    good_slots = slots.alias("s").join(bad.alias("b"), on_line("s", "b"), "left_anti")
    counted = good_slots.groupBy("doc_id", "item_id").agg(
        F.countDistinct("kind", "ours").alias("n_slots"),
        F.countDistinct(F.when(F.col("ours") != F.col("theirs"), F.struct("kind", "ours"))).alias("n_changed"),
    )
    return held(sound).alias("h").join(counted.alias("c"), same_pair("h", "c"), "left").select(
        "h.doc_id", "h.item_id", "n_windows", "n_item_windows",
        F.coalesce("n_slots", F.lit(0)).alias("n_slots"), F.coalesce("n_changed", F.lit(0)).alias("n_changed"),
    )


def _slots(rows: DataFrame, likely: DataFrame, texts: DataFrame, items: DataFrame, width: int) -> DataFrame:
    """(doc_id, item_id, shift, kind, ours, theirs): placeholder values of met windows, of the item and the document.

    Only documents that hold enough of an item are read again, for their words.
    """
    with_slots = items.select("item_id", F.posexplode("tokens").alias("item_pos", "kind"), "words").where(
        F.col("kind").rlike(f"[{NUMBER}{NAME}{UNIT}]")
    ).select("item_id", "item_pos", "kind", F.expr("words[item_pos]").alias("ours"))
    ids = likely.select("doc_id").distinct()
    places = rows.where(~F.col("literal")).select(
        "doc_id", "item_id", (F.col("pos") - F.col("item_pos")).alias("shift"), "item_pos"
    ).withColumn("item_pos", F.explode(F.sequence(F.col("item_pos"), F.col("item_pos") + width - 1))).distinct()
    asked = places.join(with_slots, ["item_id", "item_pos"]).withColumn("pos", F.col("shift") + F.col("item_pos"))
    words = (
        texts.alias("t")
        .join(ids.alias("i"), F.col("t.doc_id").eqNullSafe(F.col("i.doc_id")), "left_semi")
        .select("doc_id", F.posexplode(raw_tokens(F.col("text"))).alias("pos", "theirs"))
    )
    at = F.col("a.doc_id").eqNullSafe(F.col("w.doc_id")) & (F.col("a.pos") == F.col("w.pos"))
    return asked.alias("a").join(words.alias("w"), at).select("a.doc_id", "item_id", "shift", "kind", "ours", "theirs").distinct()


def cleaned(docs: DataFrame, benchmark: DataFrame, **how) -> DataFrame:
    """docs without the rows that hold a benchmark item. Rows without an id are judged by their text alone."""
    key = F.coalesce(F.col("doc_id").cast("string"), F.concat(F.lit("text:"), F.md5("text")))
    found = leaks(docs.select(key.alias("doc_id"), "text"), benchmark, **how)
    tainted = keep(found.select(F.col("doc_id").alias("__tainted")).distinct(), "tainted")
    return docs.join(tainted, key == F.col("__tainted"), "left_anti")
