"""Exact top-k against brute force, and the pipeline stage by stage."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from riskloom.llm import topk, toxicity


def vectors(n, d, seed=3):
    rng = np.random.default_rng(seed)
    middles = rng.standard_normal((6, d))
    rows = [(k, (middles[k % 6] + 0.2 * rng.standard_normal(d)).tolist()) for k in range(n)]
    rows += [(n, None), (n + 1, [1.0, None] + [0.0] * (d - 2)), (n + 2, [math.nan] * d), (n + 3, [math.inf] * d)]
    rows += [(n + 4, [1.0, 2.0]), (50 * n, [1.5, 2.0]), (n + 6, []), (None, [0.0] * d)]
    rows += [(k, rows[0][1]) for k in range(2 * n, 2 * n + 9)] + [rows[3]]  # ties, and a repeated row
    return rows


def brute(rows, k):
    clean = {}
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            clean[i] = [math.floor(256 * x) for x in v]
    out = []
    for q, v in clean.items():
        if q % 50 == 0:
            scored = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in clean.items() if i != q and len(w) == len(v))
            out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scored[:k])]
    return sorted(out)


@pytest.mark.parametrize(("shard", "block"), [(8192, 2048), (40, 3)])
def test_top_k_equals_brute_force(spark, monkeypatch, shard, block):
    monkeypatch.setattr(topk, "SHARD_ROWS", shard)
    monkeypatch.setattr(topk, "BLOCK_QUERIES", block)
    monkeypatch.setattr(topk, "LEAF_ROWS", 8)
    rows = vectors(300, 12)
    frame = spark.createDataFrame([(*r, "x", "x") for r in rows], "vec_id long, embedding array<double>, score string, rank string")
    got = topk.top_k(frame, F.col("vec_id") % 50 == 0, k=5).collect()
    assert sorted(map(tuple, got)) == brute(rows, 5)


def test_fewer_candidates_than_k_and_large_components(spark):
    rows = [(0, [1e7, 3.0]), (1, [1e7, -2.0]), (2, [1e7, 2.0])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert sorted(map(tuple, topk.top_k(frame, F.col("vec_id") % 50 == 0).collect())) == brute(rows, 5)
    assert topk.top_k(frame.where("false"), F.col("vec_id") % 50 == 0).count() == 0
    assert topk.top_k(frame.where("vec_id = 0"), F.col("vec_id") % 50 == 0).count() == 0


def test_balls_are_left_out():
    rng = np.random.default_rng(1)
    rows = np.floor(rng.standard_normal((4000, 4)) * 20 + np.repeat(rng.standard_normal((8, 4)) * 900, 500, axis=0))
    tree = topk.build(np.arange(4000), rows)
    seen = []
    whole = topk.inner

    def counted(left, right):
        seen.append(len(right))
        return whole(left, right)

    topk.inner = counted
    try:
        found = topk.search(tree, np.array([-1]), rows[:1], np.array([-np.inf]), 5)
    finally:
        topk.inner = whole
    want = sorted((-int(s), i) for i, s in enumerate(rows @ rows[0]))[:5]
    assert sorted(zip(-found.score, found.vec_id)) == want
    assert sum(seen) < 1500


def words(rng, n):
    return " ".join(rng.choice("the of and river paper stone winter light garden".split()) + str(rng.randrange(400)) for _ in range(n))


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    rng = random.Random(12)
    docs, labels = [], []
    for k in range(160):
        text = words(rng, rng.randrange(20, 70)) + "."
        if k % 8 == 0:
            text = "zork " + text + " zorkish zorkful zork."
        elif k % 8 == 1:
            text = " ".join(w.upper() + "!!" for w in text.split())
        docs.append((k, text))
        labels.append((k, 0 if k % 8 == 1 else 1, 1 if k % 8 == 0 else 0))
    docs += [(500, docs[2][1]), (501, docs[2][1].replace(" ", "\n ")), (502, docs[3][1] + " tail"), (None, docs[4][1])]
    folder = str(tmp_path_factory.mktemp("corpus"))
    rows = [(i, t, "en", "src", len(t), "x", "x", "x") for i, t in docs]
    spark.createDataFrame(
        rows, "doc_id long, text string, lang string, source string, n_chars long, score string, key string, kept string"
    ).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return folder, docs


def test_pipeline_stages(spark, corpus, monkeypatch):
    monkeypatch.setattr(toxicity, "STEPS", 60)
    monkeypatch.setattr(toxicity, "BATCH", 64)
    folder, rows = corpus
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, by_stage = docs.columns, {}
    for name, step in corpus_pipeline.STAGES:
        docs = corpus_pipeline.stage(step(spark, docs, folder), name)
        by_stage[name] = docs
        if name != "packing":
            assert docs.columns == columns
    ids = {n: {r.doc_id for r in d.select("doc_id").collect()} for n, d in by_stage.items()}
    toxic, junk = set(range(0, 160, 8)), set(range(1, 160, 8))
    assert len(ids["toxicity"] & toxic) <= 3 and len(ids["toxicity"] - toxic) >= 135
    assert not ids["quality"] & junk and len(ids["quality"] - toxic) >= 115
    assert ids["exact_dedup"] == ids["quality"] - {500, 501, None}
    assert ids["near_dedup"] == ids["exact_dedup"] - {502}
    assert ids["packing"] == ids["near_dedup"]
    whole = corpus_pipeline.run(spark, folder)
    tokens = [d.select("doc_id", "doc_tokens").distinct() for d in (whole, by_stage["packing"])]
    assert sorted(map(tuple, tokens[0].collect())) == sorted(map(tuple, tokens[1].collect()))


def test_pipeline_of_an_empty_table(spark, corpus):
    folder, _ = corpus
    docs = spark.read.parquet(f"{folder}/documents.parquet").where("false")
    for name, step in corpus_pipeline.STAGES:
        docs = corpus_pipeline.stage(step(spark, docs, folder), name)
        assert docs.count() == 0
