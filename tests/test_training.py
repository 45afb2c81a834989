"""The training plans run at the settings of the whole job."""

import inspect
import os

import pytest

from riskloom.operators import learning
from riskloom.plans import catalogue, training
from riskloom.plans.registry import Tables

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no driver tables here")


def test_the_registered_model_has_the_full_settings_on_all_feature_columns(spark):
    t = Tables(spark, DATA)
    roles = {"SK_ID_CURR", "TARGET", "split", "y_true", "proba_champion", "proba_champion_raw", "proba_baseline"}
    assert set(learning.input_names(training.SPEC)) == set(t.clients.columns) - roles
    plain = learning.ModelSpec(numeric=training.SPEC.numeric, categorical=training.SPEC.categorical)
    assert training.SPEC == plain
    # no feature is changed by the label
    feature = training.applications(t).select("SK_ID_CURR", "EXT_SOURCE_2")
    assert feature.exceptAll(t.clients.select("SK_ID_CURR", "EXT_SOURCE_2")).isEmpty()


class Stop(Exception):
    pass


def test_the_ceiling_query_runs_the_whole_grid(spark, monkeypatch):
    def record(*args, **given):
        bound = inspect.signature(whole).bind(*args, **given)
        bound.apply_defaults()
        seen.update(bound.arguments)
        raise Stop

    seen, whole = {}, training.segment_ceiling
    monkeypatch.setattr(training, "trained", lambda t: None)
    monkeypatch.setattr(training, "applications", lambda t: None)
    monkeypatch.setattr(training, "segment_ceiling", record)
    with pytest.raises(Stop):
        catalogue.callables()["segment_ceiling_verdict"](spark, DATA)
    assert [limit for _, limit in seen["variants"]] == [25.0, 30.0]
    assert [g["min_rows"] for g in seen["grid"]] == [70, 40, 20]
    assert (seen["age_limit"], seen["replicas"], seen["min_rows"], seen["min_events"]) == (25.0, 500, 500, 50)


def test_every_variant_and_setting_gets_a_model(spark, monkeypatch):
    rows = [(i, i % 7 == 0, 20.0 + i % 15, ("train", "valid", "calib", "test")[i % 4]) for i in range(4000)]
    df = spark.createDataFrame(rows, "SK_ID_CURR long, e boolean, AGE_YEARS double, split string")
    df = df.selectExpr("SK_ID_CURR", "int(e) AS TARGET", "AGE_YEARS", "split", "(SK_ID_CURR * 7 % 13 + TARGET) / 20D AS s")

    def fit(segment, spec, **_):
        fitted.append((segment.agg({"AGE_YEARS": "max"}).first()[0], spec.depth, spec.min_rows))
        return learning.Bundle(spec, {}, None)

    fitted = []
    monkeypatch.setattr(learning, "train", fit)
    monkeypatch.setattr(learning, "score", lambda part, bundle: part.selectExpr(
        "TARGET", "s AS proba_champion", "s AS proba_champion_raw"))
    general = learning.Bundle(learning.ModelSpec(numeric=("s",)), {}, None)
    out = training.segment_ceiling(df, general, replicas=20, min_rows=300, min_events=40)
    settings = [(5, 70), (4, 40), (3, 20)]
    assert fitted == [(24.0, *s) for s in settings] + [(29.0, *s) for s in settings]
    got = out.select("variant", "setting", "kind").collect()
    assert len(got) == len(set(got)) == 2 * (1 + 6)


def test_the_report_pack_has_500_replicas(spark, monkeypatch):
    def record(*args):
        seen.append(inspect.signature(whole).bind(*args).arguments["replicas"])
        raise Stop

    seen, whole = [], training.resampling.segment_report
    monkeypatch.setattr(training.resampling, "segment_report", record)
    with pytest.raises(Stop):
        catalogue.callables()["report_pack"](spark, DATA)
    assert seen == [500]
