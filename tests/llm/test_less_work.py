"""The same results by fewer jobs and comparisons."""

import numpy as np

from fleetlens.llm import graph, passages


def test_components_of_a_small_table_settle_in_one_round(spark, monkeypatch):
    kept = []
    keep = graph.keep
    monkeypatch.setattr(graph, "keep", lambda df, name: kept.append(name) or keep(df, name))
    edges = spark.createDataFrame([(k, k + 1) for k in range(200)] + [(900, 300), (300, 500)], "u long, v long").coalesce(1)
    got = {r.node: r.component for r in graph.connected_components(edges).collect()}
    assert got == {k: 0 for k in range(201)} | {300: 300, 500: 300, 900: 300}
    assert len(kept) <= 2


def test_components_where_tasks_see_only_a_part(spark, monkeypatch):
    monkeypatch.setattr(graph, "NODES", 5)
    draw = np.random.default_rng(3)
    edges = [(int(x), int(x) + 1) for x in draw.permutation(120)]
    got = {r.node: r.component for r in graph.connected_components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {k: 0 for k in range(121)}


def test_thin_runs_are_left_out():
    same = np.array([1, 1, 0, 0, 1, 1, 1, 0, 1, 0, 0, 0, 1], bool)
    assert passages._runs(same, 1, 3) == [(4, 8)]
    assert passages._runs(same, 1) == [(0, 1), (4, 8), (12, 12)]
    assert passages._runs(same[:0], 1) == []


def test_word_counts_of_copies(spark):
    docs = [(1, "a b  c"), (2, "a b  c"), (2, "x"), (3, "a b c"), (4, "x"), (5, "a b  c"), (5, "a b  c")]
    got = sorted(
        (r.doc_id, r.other_id, r.n)
        for r in passages._copies(spark.createDataFrame(docs, "doc_id long, text string").selectExpr("doc_id", "cast(text as binary) text"), passages.keep).collect()
    )
    assert got == [(2, 1, 3), (4, 2, 1), (5, 1, 3)]


def test_queries_of_one_block_are_dealt_to_several_tasks(spark, monkeypatch):
    from fleetlens.llm import bitslice

    draw, tasks = np.random.default_rng(4), []
    vectors = [(k, [float(x) for x in draw.normal(size=8)]) for k in range(600)]
    keep = bitslice.Tables.keep

    def counted(self, df, name):
        kept = keep(self, df, name)
        if name == "found":
            tasks.append(len(kept.inputFiles()))
        return kept

    monkeypatch.setattr(bitslice.Tables, "keep", counted)
    monkeypatch.setattr(bitslice, "BLOCK_QUERIES", 10)
    df = spark.createDataFrame(vectors, "vec_id long, embedding array<double>").coalesce(1)
    got = {(r.query_id, r["rank"]): (r.vec_id, r.score) for r in bitslice.top_k(df, every=5).collect()}
    whole = np.floor(np.array([v for _, v in vectors]) * 256).astype(np.int64)
    for q in range(0, 600, 5):
        best = sorted((-int(whole[k] @ whole[q]), k) for k in range(600) if k != q)[:5]
        assert [got[q, n + 1] for n in range(5)] == [(k, -s) for s, k in best]
    assert tasks[0] > 1
