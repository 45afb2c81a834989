"""Physical plans: pruning, pushdown, no pairings, no global sort of a large side."""

import os

import pytest
from pyspark.sql import functions as F

from riskloom.operators import aggregation, evaluation, filters, ranking
from riskloom.operators import resampling as R
from riskloom.plans import catalogue, scenario
from riskloom.plans.registry import Tables

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no driver tables here")


def plan(df):
    df.sparkSession.conf.set("spark.sql.maxMetadataStringLength", "2000")
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def t(spark):
    return Tables(spark, DATA)


LAZY = [
    "default_rate_by_age_band", "portfolio_overview", "crosstab_default_rate", "two_level_roll_up", "feature_table",
    "threshold_sweep", "threshold_analysis", "exact_auc", "ks_statistic", "decile_table", "auc_within_between",
    "segment_report", "auc_difference_all_groups", "psi_many_features", "metric_regression_gate", "what_if_sweep",
    "portfolio_percentile", "held_alerts_batch", "absence_gaps_batch", "drivers_of_change",
]


@pytest.mark.parametrize("name", LAZY)
def test_no_query_pairs_rows_without_a_key(spark, name):
    text = plan(catalogue.callables()[name](spark, DATA))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_filters_and_columns_reach_the_scan(t):
    df = t.orders.filter(F.col("o_totalprice") >= 1000).groupBy("o_custkey").agg(F.count(F.lit(1)))
    text = plan(df)
    assert "GreaterThanOrEqual(o_totalprice,1000.0)" in text
    assert "ReadSchema: struct<o_custkey:bigint,o_totalprice:double>" in text


def test_filter_spec_on_a_written_client_table_is_pushed_down(spark, t, tmp_path):
    path = str(tmp_path / "clients")
    scenario.clients(t).write.parquet(path)
    spec = filters.ClientFilters(age_min=30, gender="F", thin_file=True)
    text = plan(spec.apply(spark.read.parquet(path), 0.09).select("SK_ID_CURR"))
    for part in ("GreaterThanOrEqual(AGE_YEARS,30.0)", "EqualTo(CODE_GENDER,F)", "IsNull(BUREAU_COUNT)"):
        assert part in text


def test_labelling_by_cut_keys_moves_no_rows(t):
    text = plan(ranking.octiles(t.loans, "raw", "id"))
    assert "Exchange" not in text and "Sort" not in text


def test_numeric_aggregation_shuffles_partial_results_only(t):
    text = plan(aggregation.aggregate_numeric(t.bureau_balance, "SK_ID_BUREAU", "BB", skip=()))
    assert text.count("Exchange hashpartitioning") == 1 and "partial_avg" in text


def test_cells_in_many_ranges_use_no_single_partition_over_them(t, many_ranges):
    text = plan(evaluation.auc(t.loans, "y", "raw", ["grp"]))
    assert "SinglePartition" not in text


def test_a_third_of_all_rows_in_one_score_and_one_group(spark, many_ranges):
    hot = spark.range(9000).selectExpr(
        "id", "int(id % 10 = 0) AS y", "if(id % 3 = 0, 0.5D, (id * 7919 % 8999) / 8999D) AS s", "if(id % 3 = 0, 'hot', string(id % 5)) AS g"
    )
    pdf = hot.toPandas()
    e, n = pdf[pdf.y == 1].s.to_numpy(), pdf[pdf.y == 0].s.to_numpy()
    want = ((e[:, None] > n[None, :]).sum() + 0.5 * (e[:, None] == n[None, :]).sum()) / (len(e) * len(n))
    assert evaluation.auc(hot, "y", "s").first()["auc"] == pytest.approx(want, abs=1e-12)
    table = evaluation.decile_table(hot, "y", "s", "id").toPandas()
    assert (table["n"] == 900).all()
    assert ranking.quantiles(hot, "s", [0.5]) == pytest.approx([float(pdf.s.quantile(0.5))])
    ci = R.auc_interval(hot, "y", "s", replicas=20).first()
    assert ci["ci_low"] < want < ci["ci_high"]
