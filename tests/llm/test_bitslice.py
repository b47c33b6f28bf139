"""Bit-sliced top-k against the products of all pairs."""

import numpy as np

from fleetlens.llm import bitslice

SCHEMA = "vec_id long, embedding array<float>, label int, row long, lane long, score long"


def expected(given, k=5, every=50):
    own = [(i, np.floor(256 * np.array(v, np.float64)).astype(object)) for i, v, *_ in given if v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for n, (i, q) in enumerate(own):
        if i is not None and i % every == 0:
            scores = [(-sum(int(a) * int(b) for a, b in zip(q, v)), j is None, j) for m, (j, v) in enumerate(own) if m != n]
            out += [(i, r + 1, j, -s) for r, (s, _, j) in enumerate(sorted(scores, key=lambda x: (x[0], x[1], x[2] or 0))[:k])]
    return sorted(out, key=repr)


def found(spark, given, **how):
    df = spark.createDataFrame([(i, v, 1, 2, 3, 4) for i, v in given], SCHEMA)
    return sorted((tuple(r) for r in bitslice.top_k(df, **how).collect()), key=repr)


def test_all_pairs(spark):
    draw = np.random.default_rng(3)
    f32 = lambda a: [float(np.float32(x)) for x in a]
    given = [(k, f32(draw.normal(0, 0.2, 12))) for k in range(700)]
    given += [(k, given[k % 30][1]) for k in range(700, 800)]  # ties
    assert found(spark, given) == expected(given)
    for dropped, block_rows in ((0, 37), (3, 64), (6, 100)):
        assert found(spark, given, k=3, every=40, dropped=dropped, block_rows=block_rows) == expected(given, 3, 40)


def test_awkward_vectors(spark):
    nan, inf = float("nan"), float("inf")
    given = [
        (0, [1.0, -2.0, 0.5]), (50, [0.25, 0.25]), (50, [0.25, 0.25]), (1, None), (2, []), (3, [None, 1.0]), (4, [nan, 1.0]), (5, [inf]),
        (None, [4.0, 4.0, 4.0]), (-100, [-1.0, 1.0, 1.0]), (100, []), (7, [2.0**20, -(2.0**20), 1.0]),
    ]
    assert found(spark, given) == expected(given)
    assert found(spark, []) == [] and found(spark, [(50, [1.0])]) == []


def test_slices():
    """Sums of slices are the products of the high bits, for weights of either sign."""
    draw = np.random.default_rng(1)
    values = draw.integers(-300, 300, (130, 9))
    index = bitslice.Slices(values, 2)
    high = (values - values.min(axis=0)) >> 2
    top = (1 << index.bits) - 1
    for _ in range(20):
        query = draw.integers(-40, 40, 9)
        total = np.zeros(index.words * 64, np.int64)
        for at, rows in enumerate(index.total(query)):
            total += np.unpackbits(rows.view(np.uint8), bitorder="little").astype(np.int64) << at
        assert (total[:130] == (np.where(query < 0, top - high, high) * np.abs(query)).sum(axis=1)).all()
        rows, scores = index.top(query, np.arange(130), 4)
        exact = values @ query
        assert rows.tolist() == np.lexsort((np.arange(130), -exact))[:4].tolist() and scores.tolist() == exact[rows].tolist()
