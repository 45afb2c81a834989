import numpy as np
import pytest
from pyspark.sql import functions as F

from riskloom.operators import evaluation as E
from riskloom.operators import gates
from riskloom.operators import resampling as R


def test_unit_draws_are_poisson_and_uncorrelated():
    key = np.random.default_rng(1).integers(0, 2147483647, 4000)
    w = R.cell_weights(key, np.ones(4000, dtype="int64"), np.ones(4000), np.arange(50), 42)
    assert w.mean() == pytest.approx(1.0, abs=0.01) and w.var() == pytest.approx(1.0, abs=0.02)
    assert abs(np.corrcoef(w[:, 0], w[:, 1])[0, 1]) < 0.05
    assert abs(np.corrcoef(w[:-1, 0], w[1:, 0])[0, 1]) < 0.05


@pytest.mark.parametrize("count", [1, 5, 200, 256, 257, 5000, 100_000])
def test_cell_draws_have_the_mean_and_variance_of_their_rows(count):
    key = np.random.default_rng(2).integers(0, 2147483647, 60)
    w = R.cell_weights(key, np.full(60, count), np.ones(60), np.arange(100), 1)
    assert w.mean() == pytest.approx(count, rel=0.03) and w.var() == pytest.approx(count, rel=0.15)


def test_draws_cover_every_row_of_a_cell_once():
    count = np.array([0, 1, 255, 256, 257, 100_000, 7])
    cell, unit, rows = R.draw_list(count)
    assert np.bincount(cell, rows, len(count)).tolist() == count.tolist()
    assert len({*zip(cell.tolist(), unit.tolist())}) == len(cell)


def test_a_cell_draws_the_same_beside_any_other_cells():
    key, count = np.array([11, 12, 13]), np.array([3, 1000, 256])
    whole = R.cell_weights(key, count, np.full(3, 0.7), np.arange(9), 5)
    for i in range(3):
        alone = R.cell_weights(key[i : i + 1], count[i : i + 1], np.full(1, 0.7), np.arange(9), 5)
        assert (alone[0] == whole[i]).all()


def test_poisson_quantile_follows_the_rate():
    u = np.random.default_rng(3).random((2, 20000))
    k = R.poisson_quantile(u, np.array([0.3, 7.0]))
    assert R.poisson_quantile(np.array([[0.0, 0.3678, 0.3679, 0.7357, 0.7358, 0.99]]), np.array([1.0])).tolist() == [[0, 0, 1, 1, 2, 4]]
    big = R.poisson_quantile(u, np.array([1e6, 40.0]))
    assert big[0].mean() == pytest.approx(1e6, rel=1e-4) and big[0].std() == pytest.approx(1000, rel=0.03)
    assert k[0].mean() == pytest.approx(0.3, abs=0.02) and k[1].mean() == pytest.approx(7.0, abs=0.1)


def test_interval_holds_the_point_and_is_reproducible(scored):
    a = R.auc_interval(scored, "y", "raw", replicas=60).first()
    b = R.auc_interval(scored.repartition(7), "y", "raw", replicas=60).first()
    assert a["ci_low"] < a["auc"] < a["ci_high"] and a["n_boot"] == 60
    assert (a["ci_low"], a["ci_high"]) == pytest.approx((b["ci_low"], b["ci_high"]), abs=1e-12)


def test_interval_does_not_depend_on_the_ranges(scored, monkeypatch):
    one = R.auc_interval(scored, "y", "score", ["grp"], 30).orderBy("grp").toPandas()
    monkeypatch.setattr(R.ranking, "CELLS_PER_RANGE", 20)
    many = R.auc_interval(scored, "y", "score", ["grp"], 30).orderBy("grp").toPandas()
    for c in ("auc", "ci_low", "ci_high"):
        assert np.allclose(one[c], many[c], atol=1e-12)


def test_interval_width_is_close_to_a_row_bootstrap_and_shrinks_with_rows(scored):
    pdf = scored.toPandas()
    y, s = pdf["y"].to_numpy(), pdf["raw"].to_numpy()
    rng = np.random.default_rng(0)

    def auc(y, s):
        r = np.argsort(np.argsort(s)) + 1
        e = y.sum()
        return (r[y == 1].sum() - e * (e + 1) / 2) / (e * (len(y) - e))

    draws = [rng.integers(0, len(y), len(y)) for _ in range(300)]
    lo, hi = np.quantile([auc(y[i], s[i]) for i in draws], [0.025, 0.975])
    whole = R.auc_interval(scored, "y", "raw", replicas=300).first()
    small = R.auc_interval(scored.filter("id < 600"), "y", "raw", replicas=100).first()
    assert whole["ci_width"] == pytest.approx(hi - lo, rel=0.35)
    assert small["ci_width"] > whole["ci_width"]


def test_one_class_gives_a_note(spark):
    df = spark.createDataFrame([(0, 0.1), (0, 0.4)], "y int, score double")
    r = R.auc_interval(df, "y", "score", replicas=5).first()
    assert r["auc"] is None and r["ci_low"] is None and r["note"] == "sem ambas as classes"


def test_degraded_group_is_found_and_normal_ones_are_not(scored):
    got = {r["grp"]: r for r in R.auc_differences(scored, "y", "raw", "grp", 120).collect()}
    assert got["A"]["worse_than_reference"] and got["A"]["p_value"] < 0.05 and got["A"]["diff"] < 0
    assert not any(got[g]["worse_than_reference"] for g in "BCDE")
    one = R.auc_difference_of_group(scored, "y", "raw", "grp", "A", 120).first()
    assert one["diff_ci_high"] == got["A"]["diff_ci_high"]


def test_difference_needs_two_usable_groups(scored):
    assert R.auc_differences(scored.filter("grp = 'A'"), "y", "raw", "grp", 5).count() == 0


def test_matched_cohort_of_the_same_mix_is_like_its_pool(scored):
    df = scored.withColumn("s", F.col("id") % 4)
    r = R.matched_cohort(df, "y", "raw", "grp", "A", ["B", "C"], ["s"], 60).first()
    pool = E.auc(df.filter("grp IN ('B', 'C')"), "y", "raw").first()["auc"]
    assert r["n_strata"] == 4 and r["coverage"] == 1.0
    assert r["auc_cohort"] == pytest.approx(pool, abs=0.03) and r["p_target_worse"] > 0.95


def test_weak_segments_new_and_old_rule(spark):
    rows = [("age", "<25", 0.60, True), ("age", "25-35", 0.71, False), ("gender", "F", 0.62, None), ("gender", "M", 0.75, None)]
    report = spark.createDataFrame(rows, "dimension string, group string, ci_high double, confirmed_weakness boolean")
    assert gates.weak_map(gates.weak_segments(report, 0.65)) == {"age": ["<25"], "gender": ["F"]}
    assert gates.weak_map(gates.weak_segments(report)) == {"age": ["<25"]}
