import numpy as np
import pytest
from pyspark.sql import functions as F

from riskloom.functions import constants as K
from riskloom.operators import drift, gates, learning, sets


def normal(spark, n, shift, seed):
    x = np.random.default_rng(seed).normal(shift, 1, n)
    return spark.createDataFrame([(float(v),) for v in x], "x double"), x


def brute_psi(a, b, bins=10):
    cuts = np.unique(np.quantile(a, np.linspace(0, 1, bins + 1)))[1:-1]
    e = np.clip(np.bincount(np.digitize(a, cuts), minlength=len(cuts) + 1) / len(a), 1e-6, None)
    o = np.clip(np.bincount(np.digitize(b, cuts), minlength=len(cuts) + 1) / len(b), 1e-6, None)
    return ((o - e) * np.log(o / e)).sum()


def test_psi_matches_and_grows_with_the_shift(spark):
    ref, a = normal(spark, 2000, 0, 1)
    got = []
    for shift in (0, 0.2, 1.0):
        obs, b = normal(spark, 1500, shift, 2)
        row = drift.psi_of_two(ref, obs, ["x"]).first()
        assert row["psi"] == pytest.approx(brute_psi(a, b), abs=1e-10)
        got.append((row["psi"], row["verdict"]))
    assert got[0][0] < got[1][0] < got[2][0] and got[0][1] == "estável" and got[2][1] == "mudança relevante"


def test_psi_of_identical_tables_is_zero_and_bins_sum_to_one(spark):
    ref, _ = normal(spark, 1000, 0, 3)
    assert drift.psi_of_two(ref, ref, ["x"]).first()["psi"] == pytest.approx(0)
    cuts = drift.reference_cuts(ref, ["x"])
    bins = drift.psi_bins(ref.withColumn("s", F.lit(False)).union(ref.withColumn("s", F.lit(True))), cuts, F.col("s"))
    row = bins.agg(F.sum("pct_expected"), F.sum("pct_observed"), F.count("*")).first()
    assert row[0] == pytest.approx(1) and row[1] == pytest.approx(1) and row[2] == 10


def test_frozen_counts_give_the_same_report(spark):
    ref, _ = normal(spark, 800, 0, 5)
    obs, _ = normal(spark, 500, 0.5, 6)
    cuts = drift.reference_cuts(ref, ["x"])
    frozen = drift.frozen_counts(ref, cuts)
    assert len(frozen) <= 10
    a, b = drift.psi_against(obs, cuts, frozen).first(), drift.psi_of_two(ref, obs, ["x"]).first()
    assert a["psi"] == pytest.approx(b["psi"]) and a["n_observed"] == 500 and a["n_expected"] == 800


def test_verdicts_count_every_feature(spark):
    names = [f"f{k}" for k in range(40)]
    df = spark.range(400).select((F.col("id") % 2 == 0).alias("side"), *[((F.col("id") * (k + 3)) % 97).cast("double").alias(n) for k, n in enumerate(names)])
    table = drift.psi_between(df, names, F.col("side"), ~F.col("side"))
    assert sum(r["n"] for r in drift.verdict_counts(table).collect()) == 40
    assert drift.psi_between(df, names, F.col("side"), ~F.col("side"), top=7).count() == 7


def test_psi_notes(spark):
    ref = spark.createDataFrame([(1.0, None)] * 50, "c double, e double")
    out = {r["feature"]: r for r in drift.psi_of_two(ref, ref, ["c", "e"]).collect()}
    assert out["c"]["psi"] is None and out["c"]["note"] == K.NOTE_CONSTANT
    assert out["e"]["note"] == K.NOTE_NO_DATA and out["e"]["verdict"] is None


def feature_rows(spark, n=2000, columns=500):
    return spark.range(n).selectExpr("id AS SK_ID_CURR", "int(id % 2) AS TARGET", *[f"id AS F_{i}" for i in range(columns)])


def test_feature_table_gate(spark):
    assert "one_row_per_key" in gates.enforce(gates.table_checks(feature_rows(spark)))
    twice = feature_rows(spark, 1500, 400).union(feature_rows(spark, 10, 400))
    with pytest.raises(gates.GateError, match="one_row_per_key"):
        gates.enforce(gates.table_checks(twice))
    leaky = feature_rows(spark, 10, 3).drop("TARGET").withColumn("proba_x", F.lit(1))
    with pytest.raises(gates.GateError) as found:
        gates.enforce(gates.table_checks(leaky))
    for word in ("rows", "columns", "has_TARGET", "no_leaky_names"):
        assert word in str(found.value)


def runs(spark, *rows):
    return spark.createDataFrame(rows, "run_id string, tag string, trained_at int, sample int, status string, auc double")


def test_metric_gate_outcomes(spark):
    old = ("r1", "a", 1, None, None, 0.78)
    sample = ("r2", "b", 2, 3000, "aceita", 0.99)
    bad = ("r3", "c", 3, None, "rejeitada", 0.99)
    for auc, status in ((0.79, "melhorou"), (0.775, "piorou dentro do limiar"), (0.70, "regressao")):
        gate = gates.metric_gate(runs(spark, old, sample, bad, ("r4", "d", 4, None, "aceita", auc)), "r4")
        assert gate.first()["status"] == status
    with pytest.raises(gates.GateError):
        gates.enforce_metric(gate)
    assert gates.metric_gate(runs(spark, ("r4", "d", 4, None, None, 0.5)), "r4").first()["status"] == "linha_de_base"


def test_upsert_keeps_the_earlier_status(spark):
    log = runs(spark, ("r1", "a", 1, None, "rejeitada", 0.7), ("r2", "b", 2, None, "aceita", 0.8))
    entry = runs(spark, ("r9", "a", 9, None, None, 0.75), ("r8", "z", 9, None, None, 0.6))
    out = {r["tag"]: r for r in gates.upsert_runs(log, entry).collect()}
    assert set(out) == {"a", "b", "z"} and out["a"]["run_id"] == "r9" and out["a"]["status"] == "rejeitada"
    assert out["z"]["status"] == "aceita"


def test_split_is_exact_disjoint_and_reproducible(spark):
    df = spark.range(1000).selectExpr("id AS SK_ID_CURR", "int(id % 10 = 0) AS TARGET")
    out = learning.stratified_split(df)
    counts = {(r["split"], r["TARGET"]): r["count"] for r in out.groupBy("split", "TARGET").count().collect()}
    assert counts[("train", 0)] == 450 and counts[("train", 1)] == 50
    assert counts[("calib", 1)] in (9, 10, 11) and sum(counts.values()) == 1000
    again = learning.stratified_split(df.repartition(5))
    assert gates.split_integrity(out, again).first()["ok"]
    moved = again.withColumn("split", F.when(F.col("SK_ID_CURR") == 3, "zzz").otherwise(F.col("split")))
    assert not gates.split_integrity(out, moved).first()["ok"]


@pytest.mark.parametrize("n", [1, 9, 10, 90, 1500])
def test_split_cuts_are_whole_numbers(spark, n):
    df = spark.range(2 * n + 3).selectExpr("id", f"CASE WHEN id < {n} THEN 0 WHEN id < {2 * n} THEN 1 END AS y")
    got = {(r["y"], r["split"]): r["count"] for r in learning.stratified_split(df, "id", "y").groupBy("y", "split").count().collect()}
    ends = [n * p // 100 for p in (0, 50, 70, 80, 100)]
    for y in (0, 1):
        for name, a, b in zip(("train", "valid", "calib", "test"), ends, ends[1:]):
            assert got.get((y, name), 0) == b - a
    # rows without a label are a class of their own
    assert [got.get((None, s), 0) for s in ("train", "valid", "calib", "test")] == [1, 1, 0, 1]


def test_set_operations(spark):
    a, b = spark.range(5), spark.range(3, 8)
    got = {(r["id"], r["side"]) for r in sets.symmetric_difference(a, b, "id").collect()}
    assert got == {(0, "left"), (1, "left"), (2, "left"), (5, "right"), (6, "right"), (7, "right")}
    left = spark.createDataFrame([("f", 1.0)], "k string, v double")
    right = spark.createDataFrame([("g", 2.0)], "k string, v double")
    rows = {r["k"]: r["difference"] for r in sets.align_two(left, right, ["k"], "v").collect()}
    assert rows == {"f": -1.0, "g": 2.0}
