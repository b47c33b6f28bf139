"""Conversation repair against a search over all edits, and awkward rows."""

import hashlib
import heapq
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest

from fleetlens.llm import turns

SCHEMA = "conv_id long, turn long, role string, text string, seg long, k long, digest string, n int"


def damage(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        h = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if h:
            text = "" if h == 1 else re.sub("[.!?]", "", text) if h == 2 else text
            out += [(conv, turn, "user" if h == 4 else role, text)] * (2 if h == 3 else 1)
    return out


def faults(rows):
    seen, out = set(), []
    for _, _, role, text in rows:
        solid = text.strip(" \t\n\v\f\r")
        out.append("blank" if not solid else "duplicate" if (role, text) in seen else "truncated" if solid[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def cheapest(rows, found):
    """The least (cost, audit) and its lines, by a search from the cheapest partial repair on; no grammar but the
    pattern of whole conversations."""
    heap, least, done = [(0, "", 0, "", ())], {}, set()
    while heap:
        cost, audit, at, initials, lines = heapq.heappop(heap)
        if (at, initials, audit) in done or cost > least.setdefault((at, initials), cost):
            continue
        done.add((at, initials, audit))
        if at == len(rows) and re.fullmatch("(s?(ua)+)?", initials):
            return cost, audit, lines
        if not re.fullmatch("s?(ua)*u?", initials) or len(initials) > len(rows) + 3:
            continue
        moves = [(3, "I", at, x[0], f"{x}:") for x in ("user", "assistant")]
        if at < len(rows):
            _, _, role, text = rows[at]
            moves.append((4, "D", at + 1, "", None))
            if found[at] not in ("blank", "duplicate"):
                more = 3 if found[at] == "truncated" else 0
                moves.append((more, "K", at + 1, role[:1] or "-", f"{role}:{text}"))
                moves += [(more + 3, "R", at + 1, x[0], f"{x}:{text}") for x in ("user", "assistant")]
        for c, letter, to, initial, line in moves:
            heapq.heappush(heap, (cost + c, audit + letter, to, initials + initial, lines if line is None else (*lines, line)))


def expected(given):
    """Rows of one turn have to be in the operator's order already."""
    convs = defaultdict(list)
    for r in given:
        convs[r[0]].append(r)
    out = {}
    for conv, own in convs.items():
        rows = sorted(damage(own), key=lambda r: (r[1] is not None, r[1] or 0))
        found = faults(rows)
        known = [r[1] for r in rows if r[1] is not None]
        initials = [r[2][:1] for r in rows]
        cost, audit, lines = cheapest(rows, found)
        out[conv] = (
            max(known) - min(known) + 1 - len(set(known)) if known else 0, found.count("blank"), found.count("duplicate"), found.count("truncated"),
            sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])), cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest(),
        )
    return out


def repaired(spark, given):
    df = spark.createDataFrame([(*r, 7, 8, "x", 9) for r in given], SCHEMA)
    return {r[0]: tuple(r)[1:] for r in turns.repaired(df).collect()}


def drawn(draw, convs, most):
    out = []
    for conv in convs:
        for turn in range(int(draw.integers(1, most))):
            role = str(draw.choice(["user", "assistant", "system", "tool", "u", ""], p=[0.35, 0.35, 0.15, 0.05, 0.05, 0.05]))
            text = str(draw.choice(["Yes.", "No!", "What? \n", "cut off", "", " \t", "Ünï. ", f"t{turn}."]))
            out.append((conv, turn, role, text))
    return out


def test_repairs_by_a_search_over_all_edits(spark):
    draw = np.random.default_rng(4)
    given = drawn(draw, range(150), 6)
    given += [(500, None, None, None), (501, None, "user", "a."), (501, 3, None, "b."), (501, 9, "assistant", None), (None, 1, "user", "a."), (None, 2, "user", "b.")]
    given += [(502, 5, "user", "x" * 300_000 + "."), (503, -(1 << 62), "user", "a."), (503, 1 << 62, "assistant", "b.")]
    gone = [(c, t, "user", "a.") for c in range(600, 700) for t in (0,) if zlib.crc32(f"{c}:{t}".encode()) % 20 == 0]
    assert gone  # conversations that the damage leaves nothing of
    given += gone
    assert repaired(spark, given) == expected(given)


def test_whole_strings_of_codes():
    """Charts by segments are those of the whole, and the least audit is found whatever follows."""
    draw = np.random.default_rng(6)
    for _ in range(300):
        codes = "".join(draw.choice(list("suaoSUAOx"), int(draw.integers(0, 6))))
        cost, edits = turns.parse(codes)

        def least(at, q, put_in=0, codes=codes):
            if at == len(codes):
                found = [(0, "")] if q in turns.ENDS else []
            else:
                found = [(c + rest, x + audit) for x, c, to in turns.moves(codes[at], q) for rest, audit in [least(at + 1, to)]]
            if put_in < 3:
                rest, audit = least(at, turns.GRAMMAR[q][turns.MADE[q]], put_in + 1)
                found.append((3 + rest, "I" + audit))
            return min(found, default=(turns.INF, ""))

        audit = "".join(edits).translate(str.maketrans("uavb", "IIRR"))
        assert (cost, audit) == least(0, turns.START)


@pytest.mark.parametrize("block", [4096, 2])
def test_a_long_conversation_in_segments_and_blocks(spark, monkeypatch, block):
    draw = np.random.default_rng(8)
    given = [(7, t, str(draw.choice(["user", "assistant", "system"])), f"row {t}" + str(draw.choice([".", "", "!"]))) for t in range(700)]
    given += [(7, 900, "user", "again.")] * 150 + [(8, 0, "user", "Hi."), (8, 1, "assistant", "Ho.")]
    whole = repaired(spark, given)
    monkeypatch.setattr(turns, "SEGMENT", 16)
    monkeypatch.setattr(turns, "BLOCK", block)
    assert repaired(spark, given) == whole
    rows = sorted(damage(given[:-2]), key=lambda r: r[1])
    codes = "".join("x" if f in ("blank", "duplicate") else r[2][0].upper() if f else r[2][0] for r, f in zip(rows, faults(rows)))
    assert whole[7][5] == turns.parse(codes)[0] and len(whole[7][6]) >= len(rows)


def test_no_conversation(spark):
    assert repaired(spark, []) == {}
