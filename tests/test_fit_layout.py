"""The layout of a fit: rows gathered into few partitions, the split searched once, tree values looked up by outcome."""

from itertools import permutations
from math import prod

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskloom.operators import explain, learning, ranking
from riskloom.plans import training
from riskloom.plans.registry import Tables

SPEC = learning.ModelSpec(numeric=("a", "b"), categorical=("c",), trees=3, depth=3, min_rows=5)


@pytest.fixture
def people(spark):
    rows = spark.range(3000, numPartitions=40).selectExpr(
        "id AS SK_ID_CURR", "(id * 37) % 101 / 101D AS a", "if(id % 7 = 0, NULL, (id * 53) % 97 / 97D) AS b",
        "concat('k', id % 3) AS c", "CAST((id * 37) % 101 + (id * 11) % 40 > 100 AS INT) AS TARGET",
        "CASE WHEN id % 10 < 5 THEN 'train' WHEN id % 10 < 7 THEN 'valid' WHEN id % 10 < 8 THEN 'calib' ELSE 'test' END AS split")
    # repeated keys and a null one stay rows of their own
    odd = rows.filter("id < 20").unionByName(rows.limit(1).withColumn("SK_ID_CURR", F.lit(None).cast("long")))
    return rows.unionByName(odd)


def test_gathered_keeps_every_row_in_few_partitions(people):
    kept = people.persist()
    out = learning.gathered(kept, "SK_ID_CURR")
    try:
        assert kept.rdd.getNumPartitions() > learning.FIT_PARTITIONS
        assert out.rdd.getNumPartitions() == learning.FIT_PARTITIONS
        assert out.count() == people.count()
        assert out.exceptAll(people).count() == 0
    finally:
        out.unpersist()


def test_few_partitions_stay_as_they_are(people):
    few = people.coalesce(4).persist()
    try:
        assert learning.gathered(few, "SK_ID_CURR") is few
    finally:
        few.unpersist()


def test_a_fit_does_not_follow_the_partitions_before_it(people):
    def trees(df):
        return learning.train(df, SPEC, with_baseline=False).champion.stages[-1].toDebugString.split("\n", 1)[1]

    assert trees(people) == trees(people.repartition(23))


def test_one_scan_of_both_slices_gives_the_trees_of_the_union(people):
    df = people.coalesce(4).persist()
    train, valid = (df.filter(F.col("split") == s) for s in ("train", "valid"))
    levels = learning.frozen_levels(train, SPEC)
    both = df.filter(F.col("split").isin("train", "valid")).withColumn("_valid", F.col("split") == "valid")
    try:
        found = [learning.fit_champion(train, valid, SPEC, levels, both=b).stages[-1].toDebugString.split("\n", 1)[1] for b in (None, both)]
    finally:
        df.unpersist()
    assert found[0] == found[1]


def test_the_cut_search_reads_the_staged_keys(people, monkeypatch):
    seen = []
    search = ranking.cut_keys_by
    monkeypatch.setattr(ranking, "cut_keys_by", lambda df, *a: seen.append(df.inputFiles()) or search(df, *a))
    learning.stratified_split(people.drop("split"))
    assert seen and seen[0] and all("split-keys" in f for f in seen[0])


def test_applications_are_split_once_in_a_query(spark, tmp_path):
    t = Tables(spark, str(tmp_path))
    t._cache["clients"] = spark.range(20).selectExpr("id AS SK_ID_CURR", "CAST(id % 2 AS INT) AS TARGET")
    assert training.applications(t) is training.applications(t)


def test_leaf_shares_are_shapley_values():
    value, zero = 1.5, [0.25, 0.5, 0.8]
    d = len(zero)
    shares = explain.leaf_shares(value, zero)
    for outcome in range(1 << d):
        one = [outcome >> i & 1 for i in range(d)]

        def game(present):
            return value * prod(one[j] if j in present else zero[j] for j in range(d))

        for i in range(d):
            orders = list(permutations(range(d)))
            gains = [game(set(o[: o.index(i) + 1])) - game(set(o[: o.index(i)])) for o in orders]
            assert np.isclose(shares[i][outcome], sum(gains) / len(orders), atol=1e-12)
