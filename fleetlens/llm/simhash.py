"""SimHash near-duplicates by deletion-variant signatures.

A 64-bit fingerprint is cut into two 32-bit segments. Of two fingerprints that differ in at most three bits, one
segment differs in at most one. Each segment is therefore indexed as it is, and once with each of its bits blanked;
an equality join on these keys finds every link, and the exact distance verifies it. Equal fingerprints are
collapsed first, so that a group of copies of any size is one row of the index, and a fingerprint has a bounded
number of neighbours within three bits.

near_copies() does the same for a similarity of texts: its sketches are longer, are cut into more segments, and blank
only the bits of a segment that an edit is likely to turn; what meets is compared by sketch and then as texts. What the
sketches miss is found by an exact check on the shingles.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fleetlens.llm.graph import connected_components
from fleetlens.llm.groups import crowded, numbered, sampled
from fleetlens.llm.scratch import Tables, drop, keep, small_batches, spread
from fleetlens.llm.shingles import WordHashes, mixed, shingle_set, similarity

SEED = 42
MAX_BITS = 3
SEGMENT = 32
BLANKS = SEGMENT + 1
KEY_BITS = SEGMENT + 7
SHINGLE_WORDS = 3
HOT_SEGMENT = 2_000
CHUNK = 1 << 16


def fingerprint(text: bytes | None, words: int = SHINGLE_WORDS) -> int:
    """64 majority bits of the XXH64 values of the text's word shingles; zero for no words."""
    tokens = (text or b"").lower().split()
    if not tokens:
        return 0
    if len(tokens) <= words:
        shingles = [b" ".join(tokens)]
    else:
        shingles = list(map(b" ".join, zip(*(tokens[k:] for k in range(words)))))
    ones, hashed = np.zeros(64, np.int64), xxhash.xxh64_intdigest
    for at in range(0, len(shingles), CHUNK):
        part = shingles[at : at + CHUNK]
        values = np.fromiter((hashed(s, SEED) for s in part), np.uint64, len(part))
        bits = np.unpackbits(values.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int32)
    return int(np.packbits(ones * 2 > len(shingles), bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, words: int = SHINGLE_WORDS, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fp long) for each row; a null or blank text has fingerprint zero."""
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = [fingerprint(t.as_py(), words) for t in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fp, pa.int64())], names=["doc_id", "fp"])

    return docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("text")
    ).mapInArrow(run, "doc_id long, fp long")


def _keys(fps: DataFrame, hot: int) -> DataFrame:
    """fps(fp) as (k, fp): k is a segment's number and blanked bit, and the segment with that bit cleared.

    Keys of segments that many fps share are split: such fingerprints differ in at most three of the other segment's
    bits, so at least one of its four bytes is equal, and the key is taken once with each byte.
    """
    low = F.col("fp").bitwiseAND(F.lit(0xFFFFFFFF))
    high = F.shiftrightunsigned("fp", SEGMENT)
    halves = fps.select(
        "fp",
        F.explode(
            F.array(
                F.struct(F.lit(0).cast("long").alias("part"), low.alias("own"), high.alias("other")),
                F.struct(F.lit(1).cast("long").alias("part"), high.alias("own"), low.alias("other")),
            )
        ).alias("s"),
    ).select("fp", "s.*")
    # number: BLANKS for each part, the last of them blanks no bit
    number = F.expr(f"part * {BLANKS} + blank")
    blanked = F.expr(f"if(blank = {SEGMENT}, own, own & ~shiftleft(1L, blank))")
    key = F.shiftleft(number, SEGMENT).bitwiseOR(blanked)
    blank = F.explode(F.sequence(F.lit(0), F.lit(SEGMENT))).alias("blank")
    crowded = keep(
        halves.groupBy("part", "own")
        .count()
        .where(F.col("count") > hot)
        .select("part", "own", blank)
        .select(key.alias("k"), F.lit(True).alias("crowded"))
        .distinct(),
        "crowded",
    )
    keyed = halves.select("fp", "part", "own", "other", blank).select("fp", "other", key.alias("k"))
    split = F.expr(
        f"transform(sequence(0, 3), b -> k | shiftleft(1 + b * 256 + (shiftrightunsigned(other, 8 * b) & 255), {KEY_BITS}))"
    )
    return keyed.join(crowded, "k", "left").select(F.explode(F.when(F.col("crowded"), split).otherwise(F.array("k"))).alias("k"), "fp")


def links(fps: DataFrame, max_bits: int = MAX_BITS, hot: int = HOT_SEGMENT) -> DataFrame:
    """Every pair u < v of distinct fps(fp) that differ in at most max_bits bits (three at most)."""
    if not 0 <= max_bits <= MAX_BITS:
        raise ValueError("two segments find links of up to three bits")
    keys = _keys(fps, hot)
    # merged, as the planner's estimate is that of the rows before they become 66 keys each
    a, b = keys.alias("a"), keys.hint("merge").alias("b")
    bit = f"cast((shiftrightunsigned(a.k, {SEGMENT}) & 127) % {BLANKS} + if((shiftrightunsigned(a.k, {SEGMENT}) & 127) < {BLANKS}, 0, {SEGMENT}) as int)"
    whole = f"(shiftrightunsigned(a.k, {SEGMENT}) & 127) % {BLANKS} = {SEGMENT}"
    return (
        a.join(
            b,
            (F.col("a.k") == F.col("b.k"))
            & (F.col("a.fp") < F.col("b.fp"))
            & (F.bit_count(F.col("a.fp").bitwiseXOR(F.col("b.fp"))) <= max_bits)
            # a blanked key counts only if that bit differs, so that a pair comes up once for each segment
            & F.expr(f"({whole} or (shiftrightunsigned(a.fp ^ b.fp, {bit}) & 1) = 1)"),
        )
        .select(F.col("a.fp").alias("u"), F.col("b.fp").alias("v"))
        .distinct()
    )


def near_duplicates(
    docs: DataFrame, words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS, *, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(doc_id, fp, component_id): component_id is the smallest doc_id that links reach from the row's fingerprint.

    One row for each row of docs, repeats included. Null and blank texts share fingerprint zero and link like any
    other. A null doc_id keeps its row and never becomes a component_id, unless its whole group has no id. Other
    columns of docs are not read. An empty table gives an empty result.
    """
    rows = keep(fingerprints(docs, words, id_col=id_col, text_col=text_col), "fingerprints")
    classes = keep(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "classes")
    parts = connected_components(links(spread(classes.select("fp"), "fp"), max_bits))
    with_part = classes.join(parts, classes.fp == parts.node, "left").select(
        "fp", "least", F.coalesce("component", "fp").alias("component")
    )
    least = with_part.groupBy("component").agg(F.min("least").alias("component_id"))
    of_fp = with_part.join(least, "component").select("fp", "component_id")
    return rows.join(of_fp, "fp").select("doc_id", "fp", "component_id")


# near copies by similarity ------------------------------------------------------------------------------------------

SIMILARITY = 0.8
SEGMENTS, SEGMENT_BITS = 24, 24
BITS = SEGMENTS * SEGMENT_BITS
#: Bits of a segment that are blanked, one at a time: those with the narrowest majorities, which an edit turns first. Sketches only
#: have to bring large groups together, as an exact check follows; with 8 bits they took more disk than all the rest.
BLANKED = 2
#: Differing bits up to which candidates are compared as texts: 3.2 standard deviations above the mean at similarity 0.8.
MOST_DIFFERENT = 115
#: Candidate pairs that are broadcast at most, about 100 bytes each; more are joined by shuffle.
BROADCAST_PAIRS = 300_000
#: Shingles at most that are known as common, 8 bytes each in every task.
COMMON = 500_000
SALT = mixed(np.arange(1, BITS // 64 + 1, dtype=np.uint64))


def sketch(values: np.ndarray) -> bytes:
    """The majority bits of a set of 64-bit values, each spread to BITS bits, and the bits to blank in each segment."""
    ones = np.zeros(BITS, np.int64)
    for at in range(0, len(values), 255):  # so many fit a byte
        wide = mixed(values[at : at + 255, None] ^ SALT)
        ones += np.unpackbits(wide.view(np.uint8).reshape(len(wide), -1), axis=1, bitorder="little").sum(axis=0, dtype=np.uint8)
    margin = 2 * ones - len(values)
    narrow = np.argsort(np.abs(margin).reshape(SEGMENTS, SEGMENT_BITS), axis=1, kind="stable")[:, :BLANKED]
    return np.packbits(margin > 0, bitorder="little").tobytes() + narrow.astype(np.uint8).tobytes()


def _prints(texts: DataFrame) -> DataFrame:
    """(id, h, content, sketch) for each row of texts(id, h, text): a digest of its words, and a sketch unless it has
    none."""
    small_batches(texts.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for b in batches:
            content, sketches = [], []
            for t in b.column(2):
                words = (t.as_py() or b"").lower().split()
                content.append(xxhash.xxh3_128_digest(b" ".join(words)))
                own = shingle_set(np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words)))
                sketches.append(sketch(own) if len(own) else None)
            kinds = [pa.array(content, pa.binary()), pa.array(sketches, pa.binary())]
            yield pa.RecordBatch.from_arrays([*b.columns[:2], *kinds], names=["id", "h", "content", "sketch"])

    return texts.mapInArrow(run, "id long, h string, content binary, sketch binary")


def _wide_keys(classes: DataFrame) -> DataFrame:
    """classes(node, sketch) as (k, node): each segment as it is, and with one of its narrow bits blanked."""
    number = (np.arange(SEGMENTS, dtype=np.int64) * (SEGMENT_BITS + 1))[None, :, None]
    powers = 1 << np.arange(SEGMENT_BITS, dtype=np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            raw = np.frombuffer(b"".join(b.column(1).to_pylist()), np.uint8).reshape(b.num_rows, -1)
            bits = np.unpackbits(raw[:, : BITS // 8], axis=1, bitorder="little").reshape(-1, SEGMENTS, SEGMENT_BITS)
            whole = (bits @ powers)[:, :, None]
            blank = raw[:, BITS // 8 :].reshape(-1, SEGMENTS, BLANKED).astype(np.int64)
            exact = (number + SEGMENT_BITS << SEGMENT_BITS) | whole
            variants = (number + blank << SEGMENT_BITS) | (whole & ~(1 << blank))
            keys = np.concatenate([exact, variants], axis=2).reshape(b.num_rows, -1)
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys.ravel()), pa.array(np.repeat(b.column(0).to_numpy(), keys.shape[1]))], names=["k", "node"]
            )

    return classes.select("node", "sketch").mapInArrow(run, "k long, node long")


def _close(pairs: DataFrame, classes: DataFrame, most: int) -> DataFrame:
    """pairs(node, other) whose sketches differ in at most so many bits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            a, r = (np.frombuffer(b"".join(c.to_pylist()), np.uint8).reshape(b.num_rows, -1)[:, : BITS // 8] for c in b.columns[2:])
            near = np.bitwise_count(a ^ r).sum(axis=1, dtype=np.int64) <= most
            yield pa.RecordBatch.from_arrays(b.columns[:2], names=["node", "other"]).filter(pa.array(near))

    both = pairs.join(classes.select("node", "sketch"), "node").join(
        classes.select(F.col("node").alias("other"), F.col("sketch").alias("theirs")), "other"
    )
    return both.select("node", "other", "sketch", "theirs").mapInArrow(run, "node long, other long")


def _similar(pairs: DataFrame, texts: DataFrame, least: float) -> DataFrame:
    """pairs(node, other) whose texts share as many of their five-word shingles."""
    few = F.broadcast if pairs.count() <= BROADCAST_PAIRS else (lambda df: df)
    both = few(pairs).join(texts.select(F.col("node").alias("other"), F.col("text").alias("theirs")), "other").join(
        texts.select("node", "text"), "node"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for b in batches:
            same = [
                similarity(shingle_set(hashes.of(a.as_py())), shingle_set(hashes.of(r.as_py()))) >= least for a, r in zip(*b.columns[2:])
            ]
            yield pa.RecordBatch.from_arrays(b.columns[:2], names=["node", "other"]).filter(pa.array(same, pa.bool_()))

    return both.select("node", "other", "text", "theirs").mapInArrow(run, "node long, other long")


def _prefixes(named: DataFrame, least: float, common: np.ndarray) -> DataFrame:
    """(id, h, n, keys): of each of named(id, h, text) the first of its n shingles, so many that two texts of at least that similarity
    have one of them in common. Shingles of common (sorted) come last, then by value; any order that all texts share will do."""
    known = named.sparkSession.sparkContext.broadcast(common)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, often = WordHashes(), known.value
        for b in batches:
            keys, sizes = [], []
            for text in b.column(2):
                own = shingle_set(hashes.of(text.as_py()))
                if len(often):
                    is_common = often[np.minimum(np.searchsorted(often, own), len(often) - 1)] == own
                    own = np.concatenate([own[~is_common], own[is_common]])
                keys.append(own[: len(own) - math.ceil(least * len(own) - 1e-9) + 1])
                sizes.append(len(own))
            ends = np.cumsum([0, *map(len, keys)], dtype=np.int32)
            values = np.concatenate([*keys, np.zeros(0, np.uint64)]).view(np.int64)
            columns = [*b.columns[:2], pa.array(sizes, pa.int32()), pa.ListArray.from_arrays(pa.array(ends), pa.array(values))]
            yield pa.RecordBatch.from_arrays(columns, names=["id", "h", "n", "keys"])

    return named.select("id", "h", "text").mapInArrow(run, "id long, h string, n int, keys array<long>")


def _common(named: DataFrame) -> np.ndarray:
    """Shingles of several texts of a sample, sorted, at most COMMON. They only decide the order of shingles, not which
    pairs are found."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for b in batches:
            for text in b.column(0):
                yield pa.RecordBatch.from_arrays([pa.array(shingle_set(hashes.of(text.as_py())).view(np.int64))], names=["k"])

    some = named.where(sampled("id")).select("text").mapInArrow(run, "k long").groupBy("k").count()
    found = some.where(F.col("count") >= 4).orderBy(F.desc("count"), "k").limit(COMMON).select("k").toArrow()
    return np.sort(found.column(0).to_numpy().view(np.uint64))


def _missed(named: DataFrame, texts: DataFrame, least: float, keep) -> DataFrame:
    """Pairs(node, other) of texts(id, h, node, part), rows of named(id, h, text), in different parts that may be similar: all that are,
    whatever their sketches say. By the prefix filter: similar texts have one of their first shingles in common, are of like
    sizes, and have enough shingles left from the first that they share. After the first shingles of the one whose end earlier in the
    common order no more than ceil(least * n) - 1 of its own follow, so what they share of the first has to make up for the rest.
    """
    each = _prefixes(named, least, _common(named)).join(texts, ["id", "h"]).select("node", "part", "n", F.posexplode("keys").alias("at", "k"))
    same = Window.partitionBy("k")
    rows = each.select("*", F.min("part").over(same).alias("one"), F.max("part").over(same).alias("another")).where("one < another")
    rows = keep(rows.drop("one", "another"), "shared")
    a, b = rows.alias("a"), rows.alias("b")
    alike = f"least(a.n, b.n) >= {least} * greatest(a.n, b.n) - 1e-9"
    met = a.join(b, F.expr(f"a.k = b.k and a.node > b.node and a.part <> b.part and {alike}"))
    pairs = met.groupBy(F.col("a.node").alias("node"), F.col("b.node").alias("other")).agg(
        F.count("*").alias("common"), *[F.min(f"{x}.{c}").alias(f"{x}_{c}") for x in "ab" for c in ("n", "at")]
    )
    needed = f"{least / (1 + least)!r} * (a_n + b_n) - 1e-9"
    enough = f"least(a_n - a_at, b_n - b_at) >= {needed} and common + ceil({least} * greatest(a_n, b_n) - 1e-9) - 1 >= {needed}"
    return pairs.where(enough).select("node", "other")


def near_copies(docs: DataFrame, least: float = SIMILARITY, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, h, n, stays): whether the rows of docs with this id and this md5 of the text stand for their group.

    Texts of the same words, in lower case, are copies. Texts whose sets of five-word shingles have a Jaccard
    similarity of `least` or more are near copies; groups are what the links found connect. A group's row with the
    smallest id, then md5, stays; n counts the rows that are equal in both. Rows without an id take no part.

    Candidates are texts with a segment of their sketches in common, up to one bit out of its BLANKED least certain
    ones, whose sketches differ in at most MOST_DIFFERENT bits. Each text is compared with two that lead its buckets:
    that which it meets most often, and the smallest. Then, as long as links come up, each text with the smallest text
    of every other group in its buckets; so a group of copies makes few pairs, whatever its size, and no group that a
    bucket holds is passed over. Last, what sketches miss is found exactly: of texts that are in different groups, all
    that one of their first shingles lets be similar are compared (_missed()), so that no similar pair ends in two groups.
    Texts without a word are copies of each other only.
    """
    with Tables() as tables:
        return keep(_near_copies(docs, least, id_col, text_col, tables.keep), "copies")


def _near_copies(docs: DataFrame, least: float, id_col: str, text_col: str, keep) -> DataFrame:
    text = F.col(text_col).cast("binary")
    named = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.md5(text), F.lit("")).alias("h"), text.alias("text")).where(
        "id is not null"
    )
    prints = keep(_prints(named), "prints")
    rows = keep(prints.groupBy("id", "h").agg(F.count("*").alias("n")), "rows")
    # numbers in the order of the leading rows
    classes = prints.groupBy("content").agg(F.min(F.struct("id", "h")).alias("lead"), F.min("sketch").alias("sketch")).orderBy("lead")
    classes = keep(classes.select("lead.*", "sketch", F.monotonically_increasing_id().alias("node")), "classes")
    drop(prints)
    known = classes.where("sketch is not null").select("node", "sketch")
    members = keep(numbered(_wide_keys(spread(known, "node")), "k", "node", crowded(_wide_keys(known.where(sampled("node"))), "k", keep), keep=keep), "members")
    # of the leaders of a text's buckets that which it meets most often, and the smallest
    met = members.where("node > least").groupBy("node", F.col("least").alias("other")).agg(F.count("*").alias("n"))
    ends = met.groupBy("node").agg(F.max_by("other", F.struct("n", -F.col("other"))).alias("best"), F.min("other").alias("other"))
    ends = keep(ends, "ends")
    both = ends.select("node", F.explode(F.array_distinct(F.array("best", "other"))).alias("other"))
    tried = keep(both, "asked")
    drop(ends)
    best = keep(_close(tried, known, MOST_DIFFERENT), "best")

    def texts_of(pairs: DataFrame) -> DataFrame:
        needed = pairs.select("node").union(pairs.select("other")).distinct()
        wanted = keep(needed.join(classes, "node").join(rows, ["id", "h"]).select("id", "h", "node", "n"), "wanted")
        few = F.broadcast if wanted.count() <= BROADCAST_PAIRS else (lambda df: df)
        found = named.join(few(wanted), ["id", "h"])
        once = found.where("n = 1").select("node", "text")
        if not wanted.where("n > 1").isEmpty():
            once = once.unionByName(found.where("n > 1").select("node", "text").dropDuplicates(["node"]))
        texts = keep(once, "texts")
        drop(wanted)
        return texts

    def similar(pairs: DataFrame) -> DataFrame:
        """_similar() of pairs, whose texts are deleted when they are compared."""
        texts = texts_of(pairs)
        found = keep(_similar(pairs, texts, least), "found")
        for done in (texts, pairs):
            drop(done)
        return found

    links = similar(best)
    # groups that a bucket holds are tried against each other, by their smallest texts there, until no two join
    open_, rows_of = members.select("k", "node"), members
    while True:
        parts = _parts(links).select(F.col("node").alias("member"), F.col("component").alias("part"))
        known_as = open_.join(parts, F.col("node") == F.col("member"), "left").select("k", "node", F.coalesce("part", "node").alias("part"))
        named_as = keep(known_as, "grouped")
        drop(rows_of)
        several = named_as.groupBy("k").agg(F.min("part").alias("one"), F.max("part").alias("another")).where("one < another").select("k")
        several = keep(several, "several")
        rows_of = keep(named_as.join(several, "k", "left_semi"), "open")
        for done in (named_as, several):
            drop(done)
        open_ = rows_of
        leads = keep(open_.groupBy("k", "part").agg(F.min("node").alias("lead")), "leads")
        met = open_.join(leads.select("k", F.col("part").alias("theirs"), "lead"), "k").where("part <> theirs")
        pairs = met.select(F.greatest("node", "lead").alias("node"), F.least("node", "lead").alias("other")).distinct()
        fresh = keep(pairs.join(tried, ["node", "other"], "left_anti"), "asked")
        drop(leads)
        close = keep(_close(fresh, known, MOST_DIFFERENT), "pairs")
        if close.isEmpty():
            break
        found = similar(close)
        if found.isEmpty():
            break
        tried, links, open_ = tried.unionByName(fresh), keep(links.unionByName(found), "links"), open_.select("k", "node")
    drop(rows_of)
    # what sketches miss: pairs that share no bucket, whose sketches differ in more bits, or that were not compared
    parts = _parts(links).select(F.col("node").alias("member"), F.col("component").alias("part"))
    shown = classes.where("sketch is not null").join(parts, F.col("node") == F.col("member"), "left")
    rest = keep(_missed(named, shown.select("id", "h", "node", F.coalesce("part", "node").alias("part")), least, keep), "rest")
    if not rest.isEmpty():
        links = keep(links.unionByName(similar(rest)), "links")
    gone = _parts(links).where("node > component").select("node")
    stay = classes.join(gone, "node", "left_anti").select("id", "h", F.lit(True).alias("stays"))
    return rows.join(stay, ["id", "h"], "left").select("id", "h", "n", F.coalesce("stays", F.lit(False)).alias("stays"))


def _parts(links: DataFrame) -> DataFrame:
    return connected_components(links.select(F.col("node").alias("u"), F.col("other").alias("v")))


def one_of_each(docs: DataFrame, least: float = SIMILARITY, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs with one row of each group of copies and near copies, as near_copies() finds them.

    Rows are judged by id and text, so rows that repeat an id with other words are documents of their own. Of rows
    that are equal in both, that with the smallest hash of all its columns stays. Rows with a null id all stay, and
    stand for no others. Blank texts are copies of each other. An empty table gives an empty result.
    """
    found = near_copies(docs, least, id_col=id_col, text_col=text_col)
    h = F.coalesce(F.md5(F.col(text_col).cast("binary")), F.lit(""))
    key = lambda df: df.select(F.col("id").alias("__id"), F.col("h").alias("__h"))
    same = (F.col(id_col).cast("long") == F.col("__id")) & (h == F.col("__h"))
    single = docs.join(key(found.where("not stays or n > 1")), same, "left_anti")
    several = found.where("stays and n > 1")
    if several.isEmpty():
        return single
    rows = docs.withColumn("__row", F.struct(*[F.col(f"`{c}`") for c in docs.columns])).join(key(several), same)
    first = rows.groupBy("__id", "__h").agg(F.min_by("__row", F.xxhash64(F.to_json("__row"))).alias("__row"))
    return single.unionByName(first.select("__row.*"))
