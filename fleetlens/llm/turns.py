"""Conversation repair by error-correcting Earley parsing.

The grammar of roles is right-linear, START -> s OPEN | u REPLY | nothing, OPEN -> u REPLY, REPLY -> a NEXT, NEXT -> u REPLY
| nothing, with productions of weight for a row that is deleted, a row that gets another role, and a row that is put in.
The items of a chart's column are the symbols still to be parsed there; in a right-linear grammar an item needs no origin,
as its completions follow each other to the end of the input. Columns are filled from the last row to the first, and an
item retains the least cost of its rest. The least audit of that cost is then read off from the first row on: from an
item each letter leads to one item only, so that the least letter which keeps the cost is the right one, whatever follows.

A conversation may be of any length. Rows become codes of one letter, sorted by conversation and turn into ranges, and
each range is cut into segments. A segment is a matrix of least costs between items; matrices are combined over a
conversation in blocks, which gives each segment the column behind it; with that a segment tells for each item that it
may begin with how it ends, and these maps are combined in the same way. No task holds a conversation but for the hash
of its repaired text, which is one digest over all of it: there rows stream through one task in order.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import lru_cache

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fleetlens.llm.groups import BROADCAST_KEYS
from fleetlens.llm.scratch import Tables, keep, small_batches

# The items of a column: what is still to be parsed. For each the role initials it takes, and the item that follows.
START, OPEN, REPLY, NEXT = range(4)
GRAMMAR = ({"s": OPEN, "u": REPLY}, {"u": REPLY}, {"a": NEXT}, {"u": REPLY})
ENDS = (START, NEXT)
#: The role that a row put in, or given another role, gets at an item.
MADE = ("u", "u", "a", "u")
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
INF = 1 << 60
#: Codes in a segment, and segments or blocks that one task combines.
SEGMENT, BLOCK = 4096, 4096
#: Parts that a row's key of repeated texts is dealt into.
PARTS = 8
SPACE, END = r"[^ \t-\r]", r"[.!?][ \t-\r]*\z"
NAMES = {"u": "user", "a": "assistant"}

Column = tuple[int, int, int, int]


def closed(column: list[int]) -> Column:
    """The column with rows put in before its items, if that is cheaper."""
    for _ in range(3):  # REPLY, NEXT and REPLY again: more rows put in never pay
        for q in range(4):
            column[q] = min(column[q], INSERT + column[GRAMMAR[q][MADE[q]]])
    return tuple(min(c, INF) for c in column)


END_COLUMN = closed([0 if q in ENDS else INF for q in range(4)])


def moves(code: str, q: int) -> Iterator[tuple[str, int, int]]:
    """(letter, cost, item that follows) of the edits that take a row at an item: D, then K, then R.

    A code is the initial of the row's role, `s`, `u`, `a` or `o` for others, as a capital if the row is truncated, and `x` for
    a row that has to go.
    """
    yield "D", DELETE, q
    if code != "x":
        more = TRUNCATED if code.isupper() else 0
        if code.lower() in GRAMMAR[q]:
            yield "K", more, GRAMMAR[q][code.lower()]
        yield "R", more + REROLE, GRAMMAR[q][MADE[q]]


@lru_cache(maxsize=1 << 16)
def _before(code: str, column: Column) -> Column:
    return closed([min(cost + column[to] for _, cost, to in moves(code, q)) for q in range(4)])


def before(code: str, column: Column) -> Column:
    """The column before a row, by the one behind it; columns that differ by a constant are worked out once."""
    least = min(column)
    if least >= INF:
        return column
    found = _before(code, tuple(c - least if c < INF else INF for c in column))
    return tuple(c + least if c < INF else INF for c in found)


def columns(codes: str, behind: Column) -> list[Column]:
    """The columns before each code, and the one behind the last."""
    out = [behind]
    for code in reversed(codes):
        out.append(before(code, out[-1]))
    return out[::-1]


def walk(codes: str, chart: list[Column], q: int, last: bool) -> tuple[list[str], int]:
    """The least audit from item q through the codes, as edits for each code, and for the end after the last segment.

    An edit is the code's letter with those of the rows put in before it: `u` and `a` for rows put in, D, K, and `v` or
    `b` for a row that becomes a user's or an assistant's.
    """
    out = []
    for at, code in enumerate(codes):
        edit, here = "", chart[at]
        while True:
            options = {letter: (cost + chart[at + 1][to], to) for letter, cost, to in moves(code, q)}
            options["I"] = (INSERT + here[GRAMMAR[q][MADE[q]]], GRAMMAR[q][MADE[q]])
            letter = min(x for x, (cost, _) in options.items() if cost == here[q])
            made, q = MADE[q], options[letter][1]
            edit += made if letter == "I" else {"R": "v" if made == "u" else "b"}.get(letter, letter)
            if letter != "I":
                break
        out.append(edit)
    tail = ""
    while last and q not in ENDS:
        tail, q = tail + MADE[q], GRAMMAR[q][MADE[q]]
    return [*out, tail] if last else out, q


def parse(codes: str) -> tuple[int, list[str]]:
    """Least cost and edits of a whole conversation; the last edit is that of its end."""
    chart = columns(codes, END_COLUMN)
    return chart[0][START], walk(codes, chart, START, True)[0]


# damage --------------------------------------------------------------------------------------------------------------


def damaged(conversations: DataFrame) -> DataFrame:
    """The rows of conversations(conv_id, turn, role, text) after damage, with their number n of copies.

    The unsigned crc32 of `conv_id:turn` by 20: 0 drops a row, 1 empties its text, 2 takes out its `.`, `!` and `?`, 3
    repeats it, 4 gives it to the user. A null conv_id, turn, role or text counts as one space there; conv_id and turn
    stay null.
    """
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(space("conv_id"), F.lit(":"), space("turn")).cast("binary")) % 20
    return (
        conversations.select(
            F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
            space("role").alias("role"), space("text").alias("text"), kind.alias("kind"),
        )
        .where("kind <> 0")
        .select(
            "conv_id", "turn",
            F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
            F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
            F.when(F.col("kind") == 3, 2).otherwise(1).cast("long").alias("n"),
        )
    )


# segments ------------------------------------------------------------------------------------------------------------


def _marked(rows: DataFrame, keep) -> DataFrame:
    """Distinct rows with their number of copies n, and whether they are the first of their role and text."""
    digest = F.md5(F.concat_ws("\x00", F.hex("role"), "text").cast("binary")).alias("digest")
    once = keep(rows.groupBy("conv_id", "turn", "role", "text").agg(F.sum("n").alias("n")).select("*", digest), "turns")
    place = F.struct(F.col("turn").isNotNull(), "turn")
    again = (
        once.groupBy("conv_id", "digest").agg(F.min(place).alias("least"), F.max(place).alias("most"))
        .where("least <> most").select(F.col("conv_id").alias("c"), F.col("digest").alias("d"), F.col("least.turn").alias("of"))
    )
    again = keep(again, "again")
    if again.count() <= BROADCAST_KEYS:
        met = once.join(F.broadcast(again), F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("digest") == F.col("d")), "left")
    else:  # a text that stands in very many turns is dealt to several tasks
        parts = again.withColumn("p", F.explode(F.sequence(F.lit(0), F.lit(PARTS - 1))))
        part = F.pmod(F.xxhash64("turn"), F.lit(PARTS)).cast("int")
        met = once.withColumn("part", part).join(
            parts, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("digest") == F.col("d")) & (F.col("part") == F.col("p")), "left"
        )
    return met.select(*once.columns, (F.col("d").isNull() | F.col("turn").eqNullSafe(F.col("of"))).alias("first"))


def _codes(marked: DataFrame) -> DataFrame:
    """Codes of a row and of its further copies, and what the row counts for."""
    blank = ~F.col("text").rlike(SPACE)
    cut = ~F.col("text").rlike(END)
    letter = F.when(F.substring("role", 1, 1).isin("s", "u", "a"), F.substring("role", 1, 1)).otherwise("o")
    code = F.when(blank | ~F.col("first"), "x").when(cut, F.upper(letter)).otherwise(letter)
    of = lambda when, n: F.when(when, n).otherwise(F.lit(0)).cast("long")
    return marked.select(
        "*", code.alias("code"), letter.alias("initial"),
        of(blank, F.col("n")).alias("blank"),
        of(~blank, F.when(F.col("first"), F.col("n") - 1).otherwise(F.col("n"))).alias("duplicate"),
        of(~blank & F.col("first") & cut, F.lit(1)).alias("truncated"),
    )


def _placed(coded: DataFrame, partitions: int) -> DataFrame:
    """coded in ranges of conversation and turn, with seg, the number of the row's segment in order, and the place `at`
    of its first code there. A row of very many copies runs over several segments; its first code is in the first."""
    ranges = coded.repartitionByRange(partitions, F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), "role", "digest")
    ordered = ranges.sortWithinPartitions(F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), "role", "digest")
    return ordered.withColumn("part", F.spark_partition_id().cast("long"))


TYPES = {"long": pa.int64(), "array<long>": pa.list_(pa.int64()), "array<string>": pa.list_(pa.string()), "array<array<string>>": pa.list_(pa.list_(pa.string()))}
OUT = "conv_id long, role string, text string, seg long, at int, codes string, initials string"


def _segmented(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Numbers the segments of sorted rows: a segment ends with its conversation, or when it is full."""
    names = [f.split()[0] for f in OUT.split(", ")]
    conv, seg, held = object(), -1, 0
    for b in batches:
        out: list[tuple] = []
        part = b.column(b.schema.get_field_index("part"))[0].as_py() if b.num_rows else 0
        for c, role, text, n, code, initial in zip(*(b.column(b.schema.get_field_index(x)).to_pylist() for x in ("conv_id", "role", "text", "n", "code", "initial"))):
            left, first = n, True
            while left:
                if c != conv or held == SEGMENT:
                    conv, seg, held = c, seg + 1, 0
                take = min(left, SEGMENT - held)
                codes = (code if first else "x") + "x" * (take - 1)
                goes = not first or code == "x"  # texts of rows that go are not needed any more
                out.append((c, None if goes else role, None if goes else text, (part << 32) | seg, held, codes, initial * take))
                held, left, first = held + take, left - take, False
        if out:
            types = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int32(), pa.string(), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out), types)], names=names)


# combination over a conversation -------------------------------------------------------------------------------------


def _scanned(parts: DataFrame, value: str, join: Callable, unit: list[int], backward: bool, keep, size: int = 0) -> DataFrame:
    """(conv_id, seg, around): what `join` makes of the values before each part of a conversation, or behind it.

    parts(conv_id, seg, k, value) are numbered by k within a conversation. Up to BLOCK of them are combined by one
    task; of more, blocks are combined first.
    """
    size = size or BLOCK
    schema = "conv_id long, seg long, around array<long>"

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("k", ascending=not backward)
        so_far, out = list(rows["around"].iloc[0]), []
        for v in rows[value]:
            out.append(so_far)
            so_far = join(list(v), so_far)
        return pd.DataFrame({"conv_id": rows["conv_id"], "seg": rows["seg"], "around": out})

    def whole(rows: pd.DataFrame) -> pd.DataFrame:
        rows, made = rows.sort_values("k", ascending=not backward), None
        for v in rows[value]:
            made = list(v) if made is None else compose(list(v), made)
        return pd.DataFrame({"conv_id": rows["conv_id"].iloc[:1], "seg": rows["block"].iloc[:1], "k": rows["block"].iloc[:1], value: [made]})

    compose = _product if backward else _followed
    most = parts.agg(F.max("k")).first()[0]
    blocks = parts.withColumn("block", F.expr(f"k div {size}"))
    if most is None or most < size:
        first = blocks.withColumn("around", F.array(*[F.lit(x).cast("long") for x in unit]))
    else:
        total = keep(blocks.groupBy("conv_id", "block").applyInPandas(whole, f"conv_id long, seg long, k long, {value} array<long>"), "blocks")
        outer = _scanned(total, value, join, unit, backward, keep, size)
        first = blocks.join(outer.select(F.col("conv_id").alias("c"), F.col("seg").alias("block"), "around"), ["block"]).where(
            F.col("conv_id").eqNullSafe(F.col("c"))
        ).drop("c")
    return first.groupBy("conv_id", "block").applyInPandas(run, schema)


def _product(m: list[int], behind: list[int]) -> list[int]:
    """Least costs through a segment and what stands behind it, both as 16 costs between items."""
    return [min(min(m[4 * p + r] + behind[4 * r + q] for r in range(4)), INF) for p in range(4) for q in range(4)]


def _before_segment(m: list[int], column: list[int]) -> list[int]:
    return [min(min(m[4 * p + r] + column[r] for r in range(4)), INF) for p in range(4)]


def _followed(ends: list[int], items: list[int]) -> list[int]:
    """Items after a segment, by those before it."""
    return [ends[q] for q in items]


def _matrix(codes: str) -> list[int]:
    """Least costs between the items before a segment and those behind it."""
    ends = []
    for q in range(4):
        column = tuple(0 if r == q else INF for r in range(4))
        for code in reversed(codes):
            column = before(code, column)
        ends.append(column)
    return [ends[q][p] for p in range(4) for q in range(4)]


def _each(df: DataFrame, made: Callable, added: str) -> DataFrame:
    """df with columns that `made` gives for each row, a tuple for each."""
    names, types = [f.split()[0] for f in added.split(", ")], [TYPES[f.split()[1]] for f in added.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [made(r) for r in b.to_pylist()]
            more = [pa.array([x[k] for x in found], t) for k, t in enumerate(types)]
            yield pa.RecordBatch.from_arrays([*b.columns, *more], names=[*b.schema.names, *names])

    old = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in df.schema.fields)
    return df.mapInArrow(run, f"{old}, {added}")


def _parsed(segments: DataFrame, keep) -> DataFrame:
    """(conv_id, seg, k, cost, edits): each segment's part of the least audit; cost is the conversation's, at its first
    segment only."""
    single = segments.where("last and k = 0")

    def alone(r) -> tuple:
        cost, edits = parse(r["codes"])
        return cost, edits

    done = _each(single.select("conv_id", "seg", "k", "codes"), alone, "cost long, edits array<string>").drop("codes")
    several = keep(segments.where("not last or k > 0"), "several")
    if several.isEmpty():
        return done
    costs = keep(_each(several, lambda r: (_matrix(r["codes"]),), "m array<long>"), "matrices")
    behind = _scanned(costs.select("conv_id", "seg", "k", "m"), "m", _before_segment, list(END_COLUMN), True, keep)

    def through(r) -> tuple:
        chart = columns(r["codes"], tuple(r["around"]))
        ways = [walk(r["codes"], chart, q, r["last"]) if chart[0][q] < INF else ([], q) for q in range(4)]
        return [w[1] for w in ways], [w[0] for w in ways], list(chart[0])

    met = several.join(behind.select(F.col("conv_id").alias("c"), "seg", "around"), "seg").where(F.col("conv_id").eqNullSafe(F.col("c"))).drop("c")
    ways = keep(_each(met, through, "ends array<long>, ways array<array<string>>, chart array<long>"), "ways")
    begins = _scanned(ways.select("conv_id", "seg", "k", "ends"), "ends", _followed, [START] * 4, False, keep)
    found = ways.join(begins.select(F.col("conv_id").alias("c"), "seg", F.expr("around[0]").alias("q")), "seg").where(F.col("conv_id").eqNullSafe(F.col("c")))
    return done.unionByName(
        found.select("conv_id", "seg", "k", F.expr("if(k = 0, chart[q], null)").alias("cost"), F.expr("ways[cast(q as int)]").alias("edits"))
    )


# repair --------------------------------------------------------------------------------------------------------------


def _hashes(rows: DataFrame) -> DataFrame:
    """(conv, sha): the SHA-256 of each conversation's lines; rows(conv_id, seg, at, edit, role, text) stream in order,
    nothing but the digest is held."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, sha, lines = None, None, 0
        done: list[tuple] = []
        for b in batches:
            for c, edit, role, text in zip(*(b.column(k).to_pylist() for k in range(4))):
                if sha is None or c != conv:
                    if sha is not None:
                        done.append((conv, sha.hexdigest()))
                    conv, sha, lines = c, hashlib.sha256(), 0
                for letter in edit:
                    if letter == "D":
                        continue
                    name = NAMES.get({"v": "u", "b": "a"}.get(letter, letter), role)
                    line = f"{name}:" if letter in "ua" else f"{name}:{text}"
                    sha.update((f"\n{line}" if lines else line).encode())
                    lines += 1
            if done:
                yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in done], pa.int64()), pa.array([x[1] for x in done])], names=["conv", "sha"])
                done = []
        if sha is not None:
            yield pa.RecordBatch.from_arrays([pa.array([conv], pa.int64()), pa.array([sha.hexdigest()])], names=["conv", "sha"])

    ordered = rows.repartition(F.col("conv_id")).sortWithinPartitions("conv_id", "seg", "at")
    return ordered.select("conv_id", "edit", "role", "text").mapInArrow(run, "conv long, sha string")


def repaired(conversations: DataFrame) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256) for each conv_id, null included.

    Rows are damaged first, see damaged(), and taken by turn, nulls first; rows of one turn by role, then by a digest of
    their text. The first
    of a row's faults counts: blank, duplicate of an earlier role and text, truncated. Keeping a row costs nothing,
    another role 3, deleting 4 (blank and duplicate rows have to go), a row put in 3, a truncated row that stays 3. The
    cheapest edits that give role initials (s?(ua)+)? are the repair; of several that whose audit is least. gaps is
    null only if it doesn't fit 64 bits. An empty table gives an empty result; other columns are not read.
    """
    small_batches(conversations.sparkSession)
    with Tables() as tables:
        return keep(_repaired(conversations, tables.keep), "repaired")


def _repaired(conversations: DataFrame, keep) -> DataFrame:
    spark = conversations.sparkSession
    coded = keep(_codes(_marked(damaged(conversations), keep)), "coded")
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    placed = keep(_placed(coded, partitions).select("conv_id", "role", "text", "n", "code", "initial", "part").mapInArrow(_segmented, OUT), "placed")
    cells = F.array_sort(F.collect_list(F.struct("at", "codes", "initials")))  # SEGMENT of them at most
    segments = placed.groupBy("conv_id", "seg").agg(cells.alias("c")).select(
        "conv_id", "seg", F.expr("array_join(c.codes, '')").alias("codes"), F.expr("array_join(c.initials, '')").alias("initials")
    )
    segments = keep(segments, "segments")
    order = Window.partitionBy("conv_id").orderBy("seg")  # a narrow row for SEGMENT codes
    numbers = segments.select(
        F.col("conv_id").alias("c"), F.col("seg").alias("s"), (F.row_number().over(order) - 1).cast("long").alias("k"),
        F.lead("seg").over(order).isNull().alias("last"), F.lag(F.expr("right(initials, 1)")).over(order).alias("earlier"),
    )
    met = segments.join(numbers, (F.col("seg") == F.col("s")) & F.col("conv_id").eqNullSafe(F.col("c"))).drop("c", "s")
    segments = keep(met, "numbered")
    steps = F.expr("length(whole) - 1 - regexp_count(whole, '(?=su|ua|au)')")
    illegal = segments.withColumn("whole", F.concat(F.coalesce("earlier", F.lit("")), "initials")).groupBy("conv_id").agg(F.sum(steps).alias("illegal"))
    parsed = keep(_parsed(segments.drop("initials", "earlier"), keep), "parsed")
    audit = F.expr("array_join(transform(array_sort(collect_list(struct(seg, letters))), x -> x.letters), '')")
    letters = F.expr("translate(array_join(edits, ''), 'uavb', 'IIRR')").alias("letters")
    audits = parsed.select("conv_id", "seg", "cost", letters).groupBy("conv_id").agg(F.max("cost").alias("cost"), audit.alias("audit"))
    edits = parsed.select(F.col("conv_id").alias("c"), "seg", F.posexplode("edits").alias("at", "edit")).where("edit <> 'D'")
    texts = placed.where("text is not null").select("conv_id", F.col("seg").alias("s"), F.col("at").alias("a"), "role", "text")
    lines = edits.join(texts, (F.col("seg") == F.col("s")) & (F.col("at") == F.col("a")) & F.col("c").eqNullSafe(F.col("conv_id")), "left")
    hashes = _hashes(lines.select(F.col("c").alias("conv_id"), "seg", "at", "edit", "role", "text"))
    stats = coded.groupBy("conv_id").agg(
        F.sum("blank").alias("blank"), F.sum("duplicate").alias("duplicate"), F.sum("truncated").alias("truncated"),
        F.expr("cast(max(turn) as decimal(38,0)) - min(turn) + 1 - count(distinct turn)").alias("gaps"),
    )
    all_ids = conversations.select(F.col("conv_id").cast("long").alias("conv_id")).distinct()
    out = all_ids.alias("o")
    for part, name in ((stats, "p1"), (illegal, "p2"), (audits, "p3"), (hashes.withColumnRenamed("conv", "conv_id"), "p4")):
        own = part.withColumnRenamed("conv_id", name)
        out = out.join(own, F.col("conv_id").eqNullSafe(F.col(name)), "left")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c)
    return out.select(
        "conv_id", F.expr("try_cast(if(gaps is null, 0, gaps) as bigint)").alias("gaps"), zero("blank"), zero("duplicate"), zero("truncated"),
        zero("illegal"), zero("cost"), F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("sha", F.lit(hashlib.sha256(b"").hexdigest())).alias("repaired_sha256"),
    )
