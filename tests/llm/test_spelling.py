"""Spelling variants against a comparison of all words."""

import re
import zlib
from collections import Counter

import numpy as np
import pytest

from fleetlens.llm import spelling

SCHEMA = "doc_id long, text string, word string, n int, shard long, root string"


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row = row, [i]
        for j, y in enumerate(b, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
    return row[-1]


def expected(given, least_length=6, least_count=5, ratio=5):
    counts = Counter()
    for doc_id, text in given:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            counts[run[: h % len(run)] + run[h % len(run) + 1 :] if h % 199 == 0 else run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= least_length and n >= least_count}
    near = {w: [v for v in words if abs(len(v) - len(w)) < 2 and distance(v, w) == 1] for w in words}
    form = {}
    for w, vs in near.items():
        best = min(vs, key=lambda v: (-words[v], v), default=None)
        if best and words[best] >= ratio * words[w]:
            form[w] = best

    def root(w):
        return root(form[w]) if w in form else w

    return sorted((w, n, len(near[w]), form.get(w), words.get(form.get(w)), root(w)) for w, n in words.items())


def found(spark, given, **how):
    df = spark.createDataFrame([(*r, "w", 1, 2, "r") for r in given], SCHEMA)
    return sorted(tuple(r) for r in spelling.variants(df, **how).select("word", "n", "n_near", "form", "form_n", "root").collect())


def texts(draw, docs):
    """Words with variants that are rarer and rarer, over all documents."""
    words = ["ééàüöß"] * 9 + ["aaaaaa"] * 40 + ["aaaaaaa"] * 7 + ["aaaaaaaa"] * 40 + ["Bananas"] * 9 + ["banana"] * 8 + ["Életter", "letter"] * 6
    for _ in range(30):
        word = "".join(draw.choice(list("abcdefgé"), int(draw.integers(5, 9))))
        for n in (200, 30, 5):
            words += [word] * n
            at, kind = int(draw.integers(0, len(word))), int(draw.integers(0, 3))
            word = word[:at] + ("" if kind == 0 else str(draw.choice(list("abcdefgé")))) + word[at + (kind < 2) :]
    draw.shuffle(words)
    return [(k, " ".join(words[k::docs])) for k in range(docs)]


@pytest.mark.parametrize("shard", [20_000, 7])
def test_all_words(spark, shard):
    """With small shards classes are dealt to several."""
    given = texts(np.random.default_rng(2), 40)
    want = expected(given)
    assert sum(r[3] is not None for r in want) > 20 and sum(r[3] is not None and r[5] != r[3] for r in want) > 5
    assert found(spark, given, shard=shard) == want


def test_awkward_texts(spark):
    given = [(1, None), (2, ""), (None, "wonder " * 6), (3, "x" * 70_000 + " wonders " * 40 + "×÷" * 5), (3, "Wonders-WONDERS1wonders"), (4, "a b c")]
    assert found(spark, given) == expected(given)
    assert found(spark, []) == [] and found(spark, [(1, None)]) == []
    assert found(spark, given, least_length=2, least_count=1, ratio=2) == expected(given, 2, 1, 2)


def test_within_one():
    draw = np.random.default_rng(9)
    for _ in range(3000):
        a, b = ("".join(draw.choice(list("ab"), int(draw.integers(0, 6)))) for _ in range(2))
        assert spelling.within_one(a, b) == (distance(a, b) == 1)
