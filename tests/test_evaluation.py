import numpy as np
import pytest
from pyspark.sql import functions as F

from riskloom.functions import constants as K
from riskloom.operators import evaluation as E


def arrays(df, score="score"):
    pdf = df.select("y", score, "grp").toPandas()
    return pdf["y"].to_numpy(), pdf[score].to_numpy(), pdf["grp"].to_numpy()


def pair_auc(y, s):
    e, n = s[y == 1], s[y == 0]
    wins = (e[:, None] > n[None, :]).sum() + 0.5 * (e[:, None] == n[None, :]).sum()
    return wins / (len(e) * len(n))


@pytest.mark.parametrize("score", ["score", "raw"])
def test_auc_equals_pair_counting(scored, many_ranges, score):
    y, s, _ = arrays(scored, score)
    assert E.auc(scored, "y", score).first()["auc"] == pytest.approx(pair_auc(y, s), abs=1e-12)


def test_auc_by_group_and_one_class_group(spark, scored, many_ranges):
    y, s, g = arrays(scored)
    got = {r["grp"]: r["auc"] for r in E.auc(scored, "y", "score", ["grp"]).collect()}
    for name in "ABCDE":
        assert got[name] == pytest.approx(pair_auc(y[g == name], s[g == name]), abs=1e-12)
    lone = spark.createDataFrame([(0, 0.1, "Z"), (0, 0.3, "Z")], "y int, score double, grp string")
    assert E.auc(lone, "y", "score", ["grp"]).first()["auc"] is None


def test_confusion_partitions_the_rows_and_respects_the_rule(scored):
    y, s, _ = arrays(scored)
    r = E.confusion(scored, "y", "score", 0.3).first()
    assert r["tn"] + r["fp"] + r["fn"] + r["tp"] == len(y)
    assert r["tp"] == ((s >= 0.3) & (y == 1)).sum() and r["tn"] == ((s < 0.3) & (y == 0)).sum()


def test_rates_are_zero_on_empty_denominators(spark):
    df = spark.createDataFrame([(0, 0.1)], "y int, score double")
    r = E.confusion_report(df, "y", "score", 0.5).first()
    assert r["precision"] == 0.0 and r["recall"] == 0.0 and r["default_rate_denied"] == 0.0 and r["approval_rate"] == 1.0


@pytest.mark.parametrize("costs", [(1.0, 0.1), (5.0, 1.0), (1.0, 1.0), (20.0, 1.0)])
def test_sweep_minimum_is_the_business_threshold(scored, costs):
    y, s, _ = arrays(scored)
    best = E.best_threshold(scored, "y", "score", *costs).first()
    grid = np.linspace(0.01, 0.99, 99)
    cost = [costs[0] * ((s < t) & (y == 1)).sum() + costs[1] * ((s >= t) & (y == 0)).sum() for t in grid]
    assert best["threshold"] == grid[int(np.argmin(cost))]
    assert best["approval_rate"] == pytest.approx((s < best["threshold"]).mean())


def test_first_minimum_wins_on_a_constant_score(spark):
    df = spark.createDataFrame([(0, 0.5), (0, 0.5), (0, 0.5), (1, 0.5)], "y int, score double")
    assert E.best_threshold(df, "y", "score", 1.0, 1 / 3).first()["threshold"] == pytest.approx(0.01)


def test_threshold_falls_as_missed_events_cost_more(scored):
    rows = E.cost_sensitivity(scored, "y", "score", (1, 5, 10, 50)).orderBy("cost_ratio").collect()
    limits = [r["threshold"] for r in rows]
    assert limits == sorted(limits, reverse=True)


def test_analysis_agrees_with_sweep_when_frozen_is_on_the_grid(scored):
    frozen = E.grid()[30]
    r = E.threshold_analysis(scored, "y", "score", frozen).first()
    sweep = {x["threshold"]: x["cost"] for x in E.threshold_sweep(scored, "y", "score").collect()}
    assert r["frozen_cost"] == pytest.approx(sweep[frozen]) and r["best_cost"] == pytest.approx(min(sweep.values()))
    assert r["delta_cost"] <= 0


def test_ks_and_curves(scored, many_ranges):
    y, s, _ = arrays(scored, "raw")
    cuts = np.unique(s)
    gaps = [(s[y == 1] >= c).mean() - (s[y == 0] >= c).mean() for c in cuts]
    r = E.ks(scored, "y", "raw").first()
    assert r["ks"] == pytest.approx(max(gaps)) and r["ks_threshold"] == cuts[int(np.argmax(gaps))]
    curve = E.roc_curve(scored, "y", "raw", 300).orderBy("position").toPandas()
    assert len(curve) <= 300 and curve["fpr"].is_monotonic_increasing and curve["tpr"].is_monotonic_increasing
    assert curve.iloc[0]["tpr"] == 0 and curve.iloc[-1]["tpr"] == 1 and np.isnan(curve.iloc[0]["threshold"])


def test_deciles_partition_rows_and_fall_in_risk(scored, many_ranges):
    pdf = scored.toPandas().sort_values(["score", "id"], ascending=[False, True]).reset_index(drop=True)
    got = E.decile_table(scored, "y", "score", "id").orderBy("decile").toPandas()
    bounds = np.linspace(0, len(pdf), 11).astype(int)
    for d in range(10):
        part = pdf.iloc[bounds[d] : bounds[d + 1]]
        row = got.iloc[d]
        assert row["n"] == len(part) and row["events"] == part["y"].sum()
        assert row["min_score"] == part["score"].min() and row["max_score"] == part["score"].max()
    assert got["cum_event_pct"].iloc[-1] == pytest.approx(1.0)
    assert got["n"].sum() == 3000


def test_deciles_of_fewer_rows_than_groups(spark):
    df = spark.createDataFrame([(i, i % 2, i / 10) for i in range(4)], "id long, y int, score double")
    got = E.decile_table(df, "y", "score", "id").toPandas()
    assert got["n"].sum() == 4 and (got["n"] == 1).all()


@pytest.mark.parametrize("strategy", ["quantile", "width"])
def test_calibration_bins_match_digitize(scored, strategy):
    y, s, _ = arrays(scored, "raw")
    edges = (
        np.unique(np.quantile(s, np.linspace(0, 1, 11))) if strategy == "quantile" else np.linspace(s.min(), s.max(), 11)
    )
    idx = np.clip(np.digitize(s, edges[1:-1]), 0, len(edges) - 2)
    got = {r["bin"]: r for r in E.calibration_curve(scored, "y", "raw", 10, strategy).collect()}
    assert set(got) == set(idx.tolist())
    for b, r in got.items():
        assert r["n"] == (idx == b).sum() and r["gap"] == pytest.approx(s[idx == b].mean() - y[idx == b].mean())


def test_within_between_identity(scored, many_ranges):
    matrix = E.auc_matrix(scored, "y", "score", "grp", block=2)
    parts = E.auc_within_between(matrix).first()
    assert parts["auc_overall"] == pytest.approx(E.auc(scored, "y", "score").first()["auc"], abs=1e-12)
    rebuilt = parts["auc_within"] * parts["w_within"] + parts["auc_between"] * parts["w_between"]
    assert rebuilt == pytest.approx(parts["auc_overall"], abs=1e-12)
    assert matrix.count() == 25


def test_matrix_of_five_hundred_groups(spark, many_ranges):
    rng = np.random.default_rng(9)
    n = 6000
    g, y, x = rng.integers(0, 500, n), rng.integers(0, 2, n), rng.integers(0, 40, n) / 40
    y[g == 3] = 0  # a group without events has no row of its own
    df = spark.createDataFrame([(f"g{a}", int(b), float(c)) for a, b, c in zip(g, y, x)], "grp string, y int, s double")
    got = {(r.event_group, r.nonevent_group): (r.pairs, r.won) for r in E.auc_matrix(df, "y", "s", "grp", block=7).collect()}
    events, others = ([x[(g == k) & (y == v)] for k in range(500)] for v in (1, 0))
    want = {}
    for i in range(500):
        for j in range(500):
            if len(events[i]) and len(others[j]):
                e, o = events[i][:, None], others[j]
                want[f"g{i}", f"g{j}"] = (float(len(e) * len(o)), float((e > o).sum() + (e == o).sum() / 2))
    assert got == want
    assert not E.auc_matrix(df.limit(0), "y", "s", "grp").collect()


def test_group_quality_matches_direct_figures(scored):
    y, s, g = arrays(scored)
    for r in E.group_quality(scored, "y", "score", ["grp"], 0.3).collect():
        m = g == r["grp"]
        assert r["n"] == m.sum() and r["approval_rate"] == pytest.approx((s[m] < 0.3).mean())
        assert r["brier"] == pytest.approx(((s[m] - y[m]) ** 2).mean())
        assert r["calibration_gap"] == pytest.approx(s[m].mean() - y[m].mean())
    assert E.group_quality(scored.limit(10), "y", "score", ["grp"], 0.3, K.MIN_GROUP).count() == 0


def test_feature_profile_matches_brute_force(scored):
    df = scored.withColumn("f", F.when(F.col("id") % 3 != 0, F.col("raw") * 10))
    pdf = df.toPandas()
    for r in E.feature_profile(df, "y", "grp", ["f"]).collect():
        part = pdf[pdf["grp"] == r["grp"]]
        here = part["f"].notna()
        a = pair_auc(part.loc[here, "y"].to_numpy(), part.loc[here, "f"].to_numpy())
        absent = pair_auc(part["y"].to_numpy(), (~here).astype(float).to_numpy())
        assert r["auc_univariate"] == pytest.approx(max(a, 1 - a))
        assert r["auc_of_absence"] == pytest.approx(max(absent, 1 - absent))
        assert r["coverage"] == pytest.approx(here.mean())
        assert r["std_ratio"] == pytest.approx(part["f"].std(ddof=0) / pdf["f"].std(ddof=0))
