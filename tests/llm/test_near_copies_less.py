"""near_copies() compares as texts only what shares enough shingles, and deletes tables that it has done with."""

import os

from fleetlens.llm import simhash


def test_few_shared_shingles_are_not_compared(spark, monkeypatch):
    line = " ".join(f"c{k}" for k in range(20))
    docs = [(n, " ".join(f"w{n}-{k}" for k in range(40)) + f" {line} " + " ".join(f"v{n}-{k}" for k in range(40))) for n in range(60)]
    docs.append((60, docs[0][1].replace("w0-20", "other")))
    folder = spark.conf.get("spark.checkpoint.dir").removeprefix("file://")
    before, left, compared = set(os.listdir(folder)), set(), []
    missed, similar = simhash._missed, simhash._similar

    def seen(*args):
        left.update(name.split("-")[0] for name in set(os.listdir(folder)) - before)
        return missed(*args)

    def counted(pairs, *args):
        compared.append(pairs.count())
        return similar(pairs, *args)

    monkeypatch.setattr(simhash, "_missed", seen)
    monkeypatch.setattr(simhash, "_similar", counted)
    stays = {r.id for r in simhash.near_copies(spark.createDataFrame(docs, "doc_id long, text string")).where("stays").collect()}
    assert stays == set(range(60)) and sum(compared) <= 3
    assert "classes" in left and not left & {"prints", "members", "texts", "wanted"}
