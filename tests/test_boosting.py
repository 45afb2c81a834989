"""Boosted trees with native missing values against plain numpy, and early stopping against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskloom.operators import boosting, evaluation, explain


def planted(n=4000, seed=5):
    """The label follows a number, a group of categories and the absence of a second number."""
    rng = np.random.default_rng(seed)
    x, z, noise = rng.normal(size=n), rng.normal(size=n), rng.normal(size=n)
    missing = rng.random(n) < 0.3
    c = rng.choice(list("abcdefgh"), n)
    # the average of z says nothing about a missing z
    logit = -2 + 0.8 * x + 2.2 * missing + 1.5 * np.isin(c, list("bdg")) - 0.3 * np.where(missing, 0, z)
    y = (rng.random(n) < 1 / (1 + np.exp(-logit))).astype(int)
    return [
        (int(i), int(y[i]), float(x[i]) if i % 11 else None, None if missing[i] else float(z[i]), float(noise[i]), str(c[i]) if i % 13 else None)
        for i in range(n)
    ]


@pytest.fixture(scope="module")
def rows(spark):
    df = spark.createDataFrame(planted(), "SK_ID_CURR long, TARGET int, x double, z double, noise double, c string")
    return df.repartition(5).cache()


SPEC = boosting.BoostSpec(
    numeric=("x", "z", "noise"), categorical=("c",), trees=12, leaves=9, depth=5, step=0.3, min_rows=30, stride=4, patience=5)


@pytest.fixture(scope="module")
def parts(rows):
    return rows.filter("SK_ID_CURR % 4 < 2"), rows.filter("SK_ID_CURR % 4 = 2"), rows.filter("SK_ID_CURR % 4 = 3")


@pytest.fixture(scope="module")
def model(parts):
    return boosting.fit(parts[0], parts[1], SPEC)


def plain_sums(bins, g, h, node_of, nodes, width):
    out = {}
    for node in nodes:
        part = [np.zeros((bins.shape[1], width)) for _ in range(3)]
        for i in np.flatnonzero(node_of == node):
            for c in range(bins.shape[1]):
                for a, v in zip(part, (g[i], h[i], 1)):
                    a[c, bins[i, c]] += v
        out[node] = tuple(part)
    return out


def test_trees_equal_a_plain_numpy_run(parts, model):
    train = sorted(parts[0].select("SK_ID_CURR", F.xxhash64("SK_ID_CURR").alias("t"), "TARGET", "x", "z", "noise", "c").collect())
    y = np.array([r.TARGET for r in train], float)
    bins = np.zeros((len(train), 4), np.uint8)
    for j, name in enumerate(SPEC.columns):
        for i, r in enumerate(train):
            if r[name] is not None:
                bins[i, j] = 1 + (sum(e < r[name] for e in model.edges[name]) if j < 3 else model.levels["c"].index(r[name]))
    weight = np.where(y == 1, len(y) / (2 * y.sum()), len(y) / (2 * (len(y) - y.sum())))
    margin = np.full(len(y), model.base)
    turn = np.array([r.t for r in train])
    for k, tree in enumerate(model.trees):
        p = boosting.sigmoid(margin)
        keep = boosting.kept_rows(turn, k, SPEC)
        g, h = np.where(keep, weight * (p - y), 0), np.where(keep, weight * p * (1 - p), 0)

        def sums(t, nodes):
            at = np.where(keep, t.nodes_of(bins), -1)
            return plain_sums(bins, g, h, at, nodes, 64)

        own = boosting.grow(sums, boosting.tree_columns(k, SPEC), SPEC)
        assert own.column == tree.column and own.left_bins == tree.left_bins and own.rows == tree.rows
        assert np.allclose(own.value, tree.value)
        margin += tree.margins(bins)


def brute_split(g, h, n, categorical, spec):
    """Every cut with both sides for the missing bin, or every set of categories."""
    best = 0.0
    used = [b for b in range(1, len(n)) if n[b]]
    sets = [set(s) for s in ([[b for i, b in enumerate(used) if m >> i & 1] for m in range(1, 2 ** len(used))] if categorical else [used[:k] for k in range(1, len(used) + 1)])]
    for s in sets:
        for left in (s, s | {0}):
            i = sorted(left)
            gl, hl, nl = g[i].sum(), h[i].sum(), n[i].sum()
            if nl >= spec.min_rows and n.sum() - nl >= spec.min_rows:
                gr, hr = g.sum() - gl, h.sum() - hl
                best = max(best, gl**2 / (hl + spec.ridge) + gr**2 / (hr + spec.ridge) - g.sum() ** 2 / (h.sum() + spec.ridge))
    return best


def test_splits_equal_brute_force():
    rng = np.random.default_rng(1)
    spec = boosting.BoostSpec(numeric=("a",), min_rows=3, ridge=1e-9)
    for _ in range(60):
        n = rng.integers(0, 9, 8).astype(float)
        h = n * rng.uniform(0.1, 0.25)
        g = np.where(n > 0, rng.normal(size=8), 0) * np.sqrt(n)
        gain, cut = boosting.split_of(g, h, n, False, spec)
        assert gain == pytest.approx(brute_split(g, h, n, False, spec), abs=1e-6)
        n[0] = g[0] = h[0] = 0  # with missing values the best set need not be a prefix
        assert boosting.split_of(g, h, n, True, spec)[0] == pytest.approx(brute_split(g, h, n, True, spec), abs=1e-6)


def test_native_missing_values_beat_the_mean(parts, model):
    train, valid, test = parts
    mean = train.agg(F.avg("z"), F.avg("x")).first()

    def filled(df):
        return df.withColumns({"z": F.coalesce("z", F.lit(mean[0])), "x": F.coalesce("x", F.lit(mean[1]))})

    def auc(df, m):
        return evaluation.auc(boosting.score(df, m), "TARGET", "proba_champion_raw").first()["auc"]

    imputed = boosting.fit(filled(train), filled(valid), SPEC)
    native = auc(test, model)
    assert native > 0.75 and native > auc(filled(test), imputed) + 0.01
    # a cut on z sends its missing values to a side of their own choice
    z = SPEC.columns.index("z")
    assert any(c == z for t in model.trees for c in t.column)


def test_early_stopping_equals_brute_force_over_prefixes(parts):
    spec = boosting.BoostSpec(numeric=("x", "noise"), trees=30, leaves=16, depth=6, step=0.9, min_rows=5, stride=4, patience=5)
    model = boosting.fit(parts[0], parts[1], spec)
    valid = parts[1]
    brute = []
    for k in range(1, len(model.trees) + 1):
        own = boosting.BoostedTrees(spec, model.edges, model.levels, model.base, model.trees[:k])
        brute.append(evaluation.auc(boosting.score(valid, own), "TARGET", "proba_champion_raw").first()["auc"])
    assert np.allclose(brute, model.valid_auc[: len(brute)])
    best, stopped = boosting.best_prefix(model.valid_auc, 5)
    assert stopped and len(model.trees) == best == int(np.argmax(brute)) + 1
    assert len(model.valid_auc) < 30  # growing ended early


def test_best_prefix():
    assert boosting.best_prefix([0.5, 0.7, 0.7, 0.6], 100) == (2, False)
    assert boosting.best_prefix([0.5, 0.6, 0.55, 0.55, 0.9], 2) == (2, True)


def test_contributions_and_importance_read_the_nodes(spark, parts, model):
    out = boosting.contributions(parts[2], model)
    assert explain.consistency(out).first()["max_abs_error"] < 1e-9
    same = out.join(boosting.score(parts[2], model).select("SK_ID_CURR", "proba_champion_raw"), "SK_ID_CURR")
    assert same.agg(F.max(F.abs(F.col("raw_probability") - F.col("proba_champion_raw")))).first()[0] < 1e-12
    found = {r.feature: (r.gain, r.splits) for r in boosting.importance(spark, model).collect()}
    assert min(found["x"][0], found["z"][0], found["c"][0]) > found["noise"][0]
    assert sum(s for _, s in found.values()) == sum(c >= 0 for t in model.trees for c in t.column)
    assert all(sum(c < 0 for c in t.column) <= SPEC.leaves for t in model.trees)


def test_odd_inputs_are_scored(spark, model, parts):
    odd = spark.createDataFrame(
        [(1, "oops", "zz", 1.0), (2, "0.5", None, float("nan")), (3, None, "a", None)], "SK_ID_CURR long, x string, c string, _bin_0 double")
    out = boosting.score(odd, model)
    assert out.columns == ["SK_ID_CURR", "x", "c", "_bin_0", "proba_champion_raw"]
    assert all(0 < r.proba_champion_raw < 1 for r in out.collect())
    one = boosting.fit(parts[0].filter("TARGET = 1"), parts[1], SPEC)
    assert one.trees == [] and {r[0] for r in boosting.score(odd, one).select("proba_champion_raw").collect()} == {0.5}
    assert boosting.fit(parts[0].limit(0), parts[1], SPEC).trees == []


def test_what_if_walks_only_trees_that_read_a_moved_column(parts, model):
    df = parts[2]
    index = boosting.trees_reading(model)
    assert sorted({k for trees in index.values() for k in trees}) == [k for k, t in enumerate(model.trees) if max(t.column) >= 0]
    got = {r.SK_ID_CURR: r for r in boosting.simulate(df, model, {"z": 2.0}, 0.5).collect()}
    before = {r.SK_ID_CURR: r.proba_champion_raw for r in boosting.score(df, model).collect()}
    after = {r.SK_ID_CURR: r.proba_champion_raw for r in boosting.score(df.withColumn("z", F.lit(2.0)), model).collect()}
    assert len(got) == len(before) == df.count()
    for key, r in got.items():
        assert r.base_probability == before[key] and r.changed_probability == pytest.approx(after[key], abs=1e-15)
        assert r.decision_changed == ((before[key] >= 0.5) != (after[key] >= 0.5))
        assert r.trees_walked in (0, len(index["z"]))
    # a change that leaves every bin where it is walks nothing
    same = boosting.simulate(df, model, {"z": F.col("z")}, 0.5)
    assert same.agg(F.sum("trees_walked"), F.max(F.abs("delta_probability"))).first()[:] == (0, 0.0)


def test_sweep_equals_the_whole_model_at_every_value(parts, model):
    df, values = parts[2].coalesce(2), [1.0, -2.0, 0.0, 0.0001, 9.0]
    got = boosting.sweep(df, model, "z", values, 0.5).collect()
    want = {}
    for v in values:
        for r in boosting.score(df.withColumn("z", F.lit(v)), model).collect():
            want[r.SK_ID_CURR, v] = r.proba_champion_raw
    assert {(r.SK_ID_CURR, r.value): r.probability_default for r in got} == pytest.approx(want, abs=1e-15)
    assert all((r.decision == "NEGAR") == (r.probability_default >= 0.5) for r in got)
    # beyond the first row of a task, a point walks at most the trees that read the column
    later = [r.trees_walked for r in got if r.value != -2.0]
    assert max(later) <= len(boosting.trees_reading(model)["z"])
    assert boosting.sweep(df.limit(0), model, "z", values, 0.5).count() == 0
    assert boosting.sweep(df, model, "z", [], 0.5).count() == 0
    with pytest.raises(ValueError):
        boosting.sweep(df, model, "z", range(101), 0.5)
    with pytest.raises(ValueError):
        boosting.sweep(df, model, "nowhere", [1.0], 0.5)
