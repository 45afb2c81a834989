"""A cross-section of the registered queries against DuckDB; tools/check_queries.py runs them all."""

import os
import sys

import duckdb
import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, os.path.join(ROOT, "tools"))

import __spark_entry__ as entry  # noqa: E402
import check_queries  # noqa: E402
from riskloom.plans import catalogue  # noqa: E402

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no driver tables here")
NAMES = [
    "default_rate_by_age_band", "sanitize_client_table", "external_score_stats", "payment_behaviour",
    "all_dimension_counts", "client_band_width", "filter_combined", "aggregate_categorical_history",
    "two_level_roll_up", "feature_table", "portfolio_overview_filtered", "numeric_summary", "crosstab_default_rate",
    "portfolio_percentile", "octiles_of_rank", "threshold_analysis", "decile_table", "auc_within_between",
    "segment_report", "auc_difference_all_groups", "psi_many_features", "metric_regression_gate", "upsert_run_log",
    "stratified_split", "what_if_simulation", "top_contributions_per_client", "verified_conversion",
    "stream_error_share", "stream_held_alerts", "weak_segments", "client_narratives", "bootstrap_auc_interval",
    "calibration_gap_by_group", "flag_inside_bands", "stored_and_live_scores_agree", "stratified_split_shares",
]


@pytest.fixture(scope="module")
def views():
    con = duckdb.connect()
    for t in check_queries.TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{DATA}/{t}.parquet')")
    return con


#: Cells of hundreds of equal rows: one draw rule must hold for them too.
LARGER = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", ["bootstrap_auc_interval", "calibration_gap_by_group"])
def test_resampling_equals_its_sql_on_larger_cells(spark, name):
    con = duckdb.connect()
    for t in check_queries.TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{LARGER}/{t}.parquet')")
    df = entry.queries()[name](spark, LARGER)
    got = check_queries.canonical(df.columns, [tuple(r) for r in df.collect()])
    cur = con.execute(entry.oracle_sql()[name])
    assert got == check_queries.canonical([d[0] for d in cur.description], cur.fetchall())


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_its_sql(spark, views, name):
    df = entry.queries()[name](spark, DATA)
    cols, got = check_queries.canonical(df.columns, [tuple(r) for r in df.collect()])
    cur = views.execute(entry.oracle_sql()[name])
    want_cols, want = check_queries.canonical([d[0] for d in cur.description], cur.fetchall())
    assert cols == want_cols and got == want


def test_every_oracle_has_a_query_and_names_are_plain():
    queries, oracles = entry.queries(), entry.oracle_sql()
    assert set(oracles) <= set(queries) and len(queries) > 200
    assert set(catalogue.QUERIES) <= set(queries) and set(catalogue.ORACLES) <= set(oracles)


def test_flagship_runs(spark):
    assert entry.entry(spark).count() > 0
