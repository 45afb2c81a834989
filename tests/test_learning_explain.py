import numpy as np
import pandas as pd
import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from riskloom.functions import constants as K
from riskloom.operators import evaluation, explain, learning
from riskloom.sources import readers, writers


@pytest.fixture(scope="module")
def applicants(spark):
    """Rows with a numeric and a categorical signal, nulls and a rare category."""
    rng = np.random.default_rng(3)
    n = 2500
    x, z = rng.normal(size=n), rng.normal(size=n)
    c = rng.choice(["a", "b", "c"], n, p=[0.5, 0.45, 0.05])
    p = 1 / (1 + np.exp(2.2 - 1.2 * x - (c == "b") * 1.0))
    y = (rng.random(n) < p).astype(int)
    rows = [
        (int(i), int(a), None if i % 9 == 0 else float(b), float(d), None if i % 17 == 0 else str(e))
        for i, (a, b, d, e) in enumerate(zip(y, x, z, c))
    ]
    df = spark.createDataFrame(rows, "SK_ID_CURR long, TARGET int, x double, z double, c string")
    return learning.stratified_split(df).cache()


@pytest.fixture(scope="module")
def bundle(applicants):
    spec = learning.ModelSpec(numeric=("x", "z"), categorical=("c",), trees=8, depth=3, step=0.3, min_rows=10)
    return learning.train(applicants, spec)


def test_scores_rank_calibrate_and_beat_chance(applicants, bundle):
    table = learning.score_table(applicants, bundle)
    assert table.columns == ["SK_ID_CURR", "split", "y_true", K.SCORE, K.RAW_SCORE, K.BASELINE_SCORE]
    assert table.filter("split = 'calib'").count() > 0 and table.filter(f"split = 'train' AND {K.BASELINE_SCORE} IS NOT NULL").count() == 0
    test = table.filter("split = 'test'")
    raw = evaluation.auc(test, "y_true", K.RAW_SCORE).first()["auc"]
    served = evaluation.auc(test, "y_true", K.SCORE).first()["auc"]
    assert raw > 0.65 and abs(raw - served) < 0.05
    brier = test.agg(evaluation.brier("y_true", K.SCORE).alias("s"), evaluation.brier("y_true", K.RAW_SCORE).alias("r")).first()
    assert brier["s"] < brier["r"]
    gap = applicants.count() - table.count()
    assert gap == 0


def test_all_three_scores_in_a_session_that_observed_a_table(spark, applicants, bundle):
    # an observation gives the session a member that cannot be serialized
    seen = Observation("rows")
    spark.range(3).observe(seen, F.count(F.lit(1)).alias("n")).collect()
    assert seen.get == {"n": 3}
    table = learning.score_table(applicants, bundle)
    assert len(table.collect()) == 2500
    linear = bundle.baseline.stages[-1]
    margin = linear.coefficients.toArray()
    shaped = learning.as_inputs(applicants, bundle.spec, bundle.levels, "mode")
    rows = bundle.baseline.transform(shaped).filter("split <> 'train'").select("SK_ID_CURR", "features").collect()
    want = {r[0]: 1 / (1 + np.exp(-(r[1].toArray() @ margin + linear.intercept))) for r in rows}
    got = {r["SK_ID_CURR"]: r[K.BASELINE_SCORE] for r in table.filter("split <> 'train'").collect()}
    assert got == pytest.approx(want, abs=1e-12) and len(got) > 1200
    assert not linear.hasSummary


def test_unseen_categories_bad_text_and_missing_columns_still_score(spark, bundle):
    rows = spark.createDataFrame([(1, "oops", "zz"), (2, "0.5", "a")], "SK_ID_CURR long, x string, c string")
    out = learning.predict(rows, bundle).collect()
    assert len(out) == 2 and all(0 <= r["probability_default"] <= 1 for r in out)
    assert {r["decision"] for r in out} <= {"APROVAR", "NEGAR"}


def test_tree_contributions_rebuild_the_probability(applicants, bundle):
    out = explain.tree_contributions(applicants, bundle)
    assert explain.consistency(out).first()["max_abs_error"] < 1e-10
    top = explain.top_contributions(out, 1)
    total = F.abs(explain.total("contributions") - explain.total("top_risk_drivers") - explain.total("top_protective_factors") - F.col("sum_other_features"))
    assert top.agg(F.max(total)).first()[0] < 1e-12


def brute_shapley(x, leaves, features):
    """Shapley values by averaging over all orders of the features."""
    from itertools import permutations

    def value(present):
        out = 0.0
        for leaf in leaves:
            v = leaf["value"]
            for f, (ratio, tests) in leaf["path"].items():
                v *= explain.satisfies(x[[f]], tests)[0] if f in present else ratio
            out += v
        return out

    orders = list(permutations(features))
    phi = np.zeros(len(x))
    for order in orders:
        seen = set()
        for f in order:
            before = value(seen)
            seen.add(f)
            phi[f] += value(seen) - before
    return phi / len(orders)


def test_tree_shapley_equals_the_definition():
    nodes = pd.DataFrame([
        {"treeID": 0, "id": 0, "prediction": 0.0, "rawCount": 100, "leftChild": 1, "rightChild": 2, "split": {"featureIndex": 0, "leftCategoriesOrThreshold": [0.5], "numCategories": -1}},
        {"treeID": 0, "id": 1, "prediction": 0.0, "rawCount": 60, "leftChild": 3, "rightChild": 4, "split": {"featureIndex": 1, "leftCategoriesOrThreshold": [1.0, 2.0], "numCategories": 4}},
        {"treeID": 0, "id": 2, "prediction": 0.0, "rawCount": 40, "leftChild": 5, "rightChild": 6, "split": {"featureIndex": 0, "leftCategoriesOrThreshold": [0.8], "numCategories": -1}},
        *[{"treeID": 0, "id": i, "prediction": v, "rawCount": n, "leftChild": -1, "rightChild": -1, "split": None} for i, v, n in ((3, 1.0, 20), (4, -2.0, 40), (5, 0.5, 10), (6, 3.0, 30))],
    ])
    leaves = explain.leaf_paths(nodes, [0.7])
    x = np.array([[0.2, 1.0, 9.0], [0.6, 0.0, 1.0], [0.9, 2.0, 0.0]])
    phi, base = explain.tree_shapley(x, leaves)
    for row, got in zip(x, phi):
        assert np.allclose(got, brute_shapley(row, leaves, [0, 1, 2]))
    assert base == pytest.approx(0.7 * (20 * 1.0 - 40 * 2.0 + 10 * 0.5 + 30 * 3.0) / 100)


def test_importance_sums_to_one_and_finds_the_signal(bundle):
    gain = {r["feature"]: r["importance"] for r in explain.gain_importance(bundle).collect()}
    splits = {r["feature"]: r["importance"] for r in explain.split_importance(bundle).collect()}
    assert sum(gain.values()) == pytest.approx(1) and max(gain, key=gain.get) == "x"
    assert set(splits) == {"x", "z", "c"} and splits["x"] > 0


def test_what_if_pairs_and_sweep(applicants, bundle):
    scorer = explain.bundle_scorer(bundle)
    out = explain.simulate(applicants, scorer, {"x": 3.0}, bundle.threshold)
    row = out.agg(F.count("*").alias("n"), F.avg("delta_probability").alias("d")).first()
    assert row["n"] == 2500 and row["d"] > 0
    same = explain.simulate(applicants, scorer, {}, bundle.threshold)
    assert same.agg(F.max(F.abs("delta_probability"))).first()[0] == 0
    with pytest.raises(ValueError):
        explain.sweep(applicants, scorer, "x", list(range(101)), 0.5)
    with pytest.raises(ValueError):
        explain.sweep(applicants, scorer, "nope", [1], 0.5)


def test_switch_points(spark):
    rows = [(1, 0.0, "a"), (1, 1.0, "a"), (1, 2.0, "b"), (1, 3.0, "a"), (2, 0.0, "a")]
    df = spark.createDataFrame(rows, "SK_ID_CURR long, value double, decision string")
    got = [(r["value"], r["from_decision"], r["to_decision"]) for r in explain.switch_points(df).orderBy("value").collect()]
    assert got == [(2.0, "a", "b"), (3.0, "b", "a")]


def test_narrative_text(spark):
    df = spark.createDataFrame(
        [(7, 0.123, "NEGAR", 1234.5, 3, "Cash loans", None)],
        "SK_ID_CURR long, probability_default double, decision string, a double, b int, c string, d double",
    )
    df = df.withColumn("contributions", F.array(*[
        F.struct(F.lit(n).alias("feature"), F.lit(v).alias("shap_value")) for n, v in (("a", 0.25), ("b", 0.2), ("c", 0.1), ("d", -0.5))
    ]))
    names = ["a", "b", "c", "d"]
    out = explain.top_contributions(df, 5, features=names)
    text = explain.narrate(out, 0.09, explain.shown_values(out, names)).first()["narrative"]
    assert text == (
        "Cliente 7: risco estimado de 12.3%, acima do corte de 9.0% → NEGAR. Principais fatores de risco: "
        "a = 1.234,50 (+0.250); b = 3 (+0.200); c = Cash loans (+0.100). Fatores favoráveis: d = ausente (-0.500)."
    )
    assert [r["value"] for r in out.first()["top_risk_drivers"]] == ["1.234,50", "3", "Cash loans"]


def test_csv_batch_keeps_extra_columns_and_refuses_unknown_headers(spark, applicants, bundle, tmp_path):
    batch = applicants.select("SK_ID_CURR", "x", "c", F.lit("keep me").alias("note")).limit(50)
    writers.write_csv(batch, str(tmp_path / "in"))
    writers.score_csv(spark, str(tmp_path / "in"), str(tmp_path / "out"), bundle)
    out = spark.read.option("header", True).csv(str(tmp_path / "out"))
    assert out.columns == ["SK_ID_CURR", "x", "c", "note", "probability_default", "decision", "score_band"]
    assert out.count() == 50 and out.filter("note = 'keep me'").count() == 50
    writers.write_csv(spark.range(3), str(tmp_path / "bad"))
    with pytest.raises(ValueError):
        readers.read_client_batch(spark, str(tmp_path / "bad"), ["x"])
