"""Queries on all three trained scores, in a session that has observed a table as the publication of runs does."""

import os

import duckdb
import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F
from test_queries import check_queries, entry

from riskloom.sources import writers

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no driver tables here")


@pytest.fixture(scope="module")
def run(spark):
    seen = Observation("rows")
    spark.range(3).observe(seen, F.count(F.lit(1)).alias("n")).collect()
    assert seen.get == {"n": 3}
    return lambda name: entry.queries()[name](spark, DATA)


def equals_sql(df, name):
    con = duckdb.connect()
    for t in check_queries.TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{DATA}/{t}.parquet')")
    got = check_queries.canonical(df.columns, [tuple(r) for r in df.collect()])
    cur = con.execute(entry.oracle_sql()[name])
    return got == check_queries.canonical([d[0] for d in cur.description], cur.fetchall())


def test_shape_of_the_score_table(run):
    assert equals_sql(run("trained_score_table_shape"), "trained_score_table_shape")


def measured(rows, score, label="y_true"):
    """AUC over all pairs, largest gap of the two cumulative shares, Brier score."""
    good, bad = ([r[score] for r in rows if r[label] == y] for y in (0, 1))
    won = sum((b > g) + 0.5 * (b == g) for b in bad for g in good)
    gaps = [sum(b >= s for b in bad) / len(bad) - sum(g >= s for g in good) / len(good) for s in {*good, *bad}]
    brier = sum((r[score] - r[label]) ** 2 for r in rows) / len(rows)
    return {"auc": won / len(good) / len(bad), "ks": max(0.0, *gaps), "brier": brier}


MODELS = {"served": "proba_champion", "champion": "proba_champion_raw", "baseline": "proba_baseline"}


def test_metrics_of_the_run_by_brute_force(run):
    rows = run("trained_score_table").filter("split = 'test'").collect()
    got = {r["model"]: r for r in run("trained_run_metrics").collect()}
    assert set(got) == set(MODELS)
    for model, score in MODELS.items():
        want = measured(rows, score)
        assert {k: got[model][k] for k in want} == pytest.approx(want, abs=1e-12)
        assert (got[model]["n"], got[model]["n_events"]) == (len(rows), sum(r["y_true"] for r in rows))


def test_order_and_brier_after_calibration_by_brute_force(run):
    rows = run("trained_score_table").filter("split = 'test'").collect()
    served, raw = measured(rows, MODELS["served"]), measured(rows, MODELS["champion"])
    got = [r.asDict() for r in run("calibration_keeps_order").collect()]
    assert got == [{"auc_kept": abs(served["auc"] - raw["auc"]) < 0.05, "brier_fell": served["brier"] < raw["brier"]}]


def test_stored_scores_equal_live_ones(run):
    assert equals_sql(run("stored_and_live_scores_agree"), "stored_and_live_scores_agree")


def test_every_table_of_the_report_is_written(run):
    got = {r["report_table"]: r["n"] for r in run("report_pack").collect()}
    scores = run("trained_score_table").filter("split = 'test'").collect()
    assert set(got) == {
        "metrics", "roc", "ks", "deciles", "calibration", "calibration_raw", "sweep", "importance_gain",
        "importance_split", "importance_source", "segments"}
    assert (got["metrics"], got["sweep"], got["importance_gain"], got["importance_split"]) == (3, 99, 36, 36)
    assert got["deciles"] == min(10, len(scores))
    # a test slice this small has no segment of the least size
    assert min(n for name, n in got.items() if name != "segments") > 0


def test_contents_of_the_report_by_brute_force(spark, run, monkeypatch):
    def keep(*args):
        paths.update(whole(*args))
        return paths

    paths, whole = {}, writers.write_report
    monkeypatch.setattr(writers, "write_report", keep)
    run("report_pack")
    table = {name: [r.asDict() for r in spark.read.json(path).collect()] for name, path in paths.items()}
    scores = run("trained_score_table").collect()
    test, valid = ([r for r in scores if r["split"] == s] for s in ("test", "valid"))
    for r in table["metrics"]:
        want = measured(test, MODELS[r["model"]])
        assert {k: r[k] for k in want} == pytest.approx(want, abs=1e-12)
    falling = sorted(test, key=lambda r: (-r["proba_champion"], r["SK_ID_CURR"]))
    for r in table["deciles"]:
        part = falling[len(test) * (r["decile"] - 1) // 10:len(test) * r["decile"] // 10]
        assert (r["n"], r["events"]) == (len(part), sum(x["y_true"] for x in part))
        assert r["max_score"] == part[0]["proba_champion"]
    for r in table["sweep"]:
        denied = [x["y_true"] for x in valid if x["proba_champion"] >= r["threshold"]]
        assert (r["tp"], r["tp"] + r["fp"], r["n"]) == (sum(denied), len(denied), len(valid))
    assert {r.get("threshold") for r in table["roc"]} == {None, *(x["proba_champion"] for x in test)}
    assert sum(r["n"] for r in table["calibration"]) == sum(r["n"] for r in table["calibration_raw"]) == len(test)
    # a model fitted on this few rows may have no split, and then no importance
    by_feature = sum(r["importance_pct"] for r in table["importance_gain"])
    assert sum(r["importance_pct"] for r in table["importance_source"]) == pytest.approx(by_feature)
