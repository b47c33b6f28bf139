"""The pipeline's stages follow on each other and keep clean documents."""

import numpy as np
import pytest

import corpus_pipeline


@pytest.fixture
def folder(spark, tmp_path):
    draw = np.random.default_rng(1)
    make = lambda n: " ".join("".join(draw.choice(list("abcdefgh"), 6)) for _ in range(n))
    item, passage = make(40), make(60)
    clean = [make(80) for _ in range(12)]
    texts = clean + [clean[0], clean[1].upper(), f"{make(90)} {passage}", f"{passage} {make(90)}", f"{make(30)} {item} {make(30)}", None, "", "12 34"]
    docs = [(k, t, "en", "s1" if k % 2 else None, len(t or "")) for k, t in enumerate(texts)]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(0, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    return str(tmp_path)


def test_pipeline(spark, folder):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language", "near_duplicates", "repeated_passages", "decontamination", "mixture"]
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, folder)
        if name != "mixture":
            assert out.columns == docs.columns
            docs = out
        seen[name] = {r.doc_id for r in out.select("doc_id").collect()}
    everything = set(range(20))
    assert seen["language"] == everything - {17, 18, 19}
    assert seen["near_duplicates"] == seen["language"] - {12, 13}
    assert seen["repeated_passages"] == seen["near_duplicates"]
    assert seen["decontamination"] == seen["repeated_passages"] - {16} == seen["mixture"]
    kept = {r.doc_id: r.text for r in docs.collect()}
    assert len(kept[15].split()) == 90 and len(kept[14].split()) == 150
    run = corpus_pipeline.run(spark, folder).collect()
    assert {r.doc_id for r in run} == seen["mixture"] and all(r.taken <= 3 * r.size for r in run)


def test_empty_tables_and_extra_columns(spark, tmp_path):
    schema = "doc_id long, text string, lang string, source string, n_chars long, ranges int, h string, node long, tokens string, key long"
    draw = np.random.default_rng(2)
    texts = [" ".join("".join(draw.choice(list("abcdefgh"), 6)) for _ in range(70)) for _ in range(6)]
    rows = [(k, t, "en", None, len(t), 1, "x", 2, "t", 3) for k, t in enumerate([*texts, texts[0]])]
    for name, some in (("empty", []), ("wide", rows)):
        folder = str(tmp_path / name)
        spark.createDataFrame(some, schema).write.parquet(f"{folder}/documents.parquet")
        spark.createDataFrame([], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
        docs = spark.read.parquet(f"{folder}/documents.parquet")
        for stage, run in corpus_pipeline.STAGES:
            out = run(spark, docs, folder)
            assert out.columns == docs.columns or stage == "mixture"
            docs = out
        assert docs.count() == (0 if name == "empty" else 6)
