"""The wide build has all seven sources, and the two column digests name each of its columns."""

import os
import sys

import duckdb
import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, os.path.join(ROOT, "tools"))

import __spark_entry__ as entry  # noqa: E402
import check_queries  # noqa: E402
from riskloom.plans import queries_portfolio  # noqa: E402
from riskloom.plans.registry import Tables  # noqa: E402

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no driver tables here")


def test_pos_and_card_histories_with_windows_and_limit_use_are_in_the_build(spark):
    columns = set(queries_portfolio.whole_feature_table(Tables(spark, DATA)).columns)
    assert {"POS_COUNT", "CC_COUNT", "POS_R12_SK_DPD_MAX", "CC_R12_UTILIZATION_MEAN", "CC_DRAWING_RATIO_MAX"} <= columns


def test_every_column_of_the_build_is_compared_with_sql(spark):
    con = duckdb.connect()
    for t in check_queries.TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{DATA}/{t}.parquet')")
    compared = []
    for name in ("feature_table_every_column", "feature_table_other_columns"):
        df = entry.queries()[name](spark, DATA)
        rows = df.collect()
        cur = con.execute(entry.oracle_sql()[name])
        want = check_queries.canonical([d[0] for d in cur.description], cur.fetchall())
        assert check_queries.canonical(df.columns, [tuple(r) for r in rows]) == want
        compared += [r["column_name"] for r in rows]
    wide = queries_portfolio.whole_feature_table(Tables(spark, DATA))
    assert sorted(compared) == sorted(wide.columns)
