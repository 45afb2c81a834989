"""Exact quantiles by brackets and profiles merged from parts."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskloom.operators import portfolio, selection, sketches

PROBS = [0, 0.001, 0.1, 0.25, 0.5, 0.75, 0.999, 1]


@pytest.fixture(scope="module")
def wide(spark):
    """20,000 rows of 45 columns: even values, a hot value, few values, nulls, non-finite numbers, one column without any."""
    base = spark.range(20_000, numPartitions=6).withColumn("u", F.pmod(F.xxhash64("id"), F.lit(1 << 40)) / float(1 << 40))
    kinds = [
        lambda i: F.pow(F.col("u"), F.lit(1.0 + i)),
        lambda i: F.when(F.col("id") % 3 == 0, 0.5).otherwise(F.col("u") * (i + 1)),
        lambda i: (F.col("id") % (i + 2)).cast("double"),
        lambda i: F.when(F.col("id") % 5 != 0, F.col("u") - i),
        lambda i: F.when(F.col("id") % 7 == 0, float("nan")).when(F.col("id") % 7 == 1, float("-inf")).otherwise(F.col("u")),
    ]
    cols = [kinds[i % 5](i).alias(f"c{i}") for i in range(45)]
    return base.select("id", *cols, F.lit(None).cast("double").alias("none"), F.col("u").cast("decimal(18,6)").alias("odd name")).cache()


def columns(df):
    return [c for c in df.columns if c != "id"]


@pytest.mark.parametrize("ranges", [False, True])
def test_quantiles_of_47_columns_are_exact(wide, ranges, request):
    if ranges:
        request.getfixturevalue("many_ranges")
    names = columns(wide) if not ranges else columns(wide)[:6]
    got = selection.quantiles_of_columns(wide, names, PROBS)
    pdf = wide.toPandas()
    for c in names:
        x = pdf[c].astype(float).replace([np.inf, -np.inf], np.nan).dropna().to_numpy()
        if len(x):
            assert np.allclose(got[c], np.quantile(x, PROBS), rtol=0, atol=1e-12), c
        else:
            assert got[c] == []


def test_only_cells_near_the_positions_travel(wide):
    names = [f"c{i}" for i in range(0, 45, 5)]
    _rows, edges = selection.sketched_columns(wide, names, [0.25, 0.5, 0.75])
    cells = selection.bracket_cells(wide, edges)
    assert cells.count() < 0.08 * 20_000 * len(names)
    plan = cells._jdf.queryExecution().executedPlan().toString()
    before = plan[plan.index("Exchange hashpartitioning") :]
    assert plan.count("Exchange hashpartitioning") == 1 and "partial_count" in before


def test_a_sketch_that_misses_is_replaced_by_the_exact_path(wide):
    rows, edges = selection.sketched_columns(wide, ["c0"], [0.5])
    wrong = rows, {"c0": [2.0, 3.0]}
    got = selection.quantiles_of_columns(wide, ["c0"], [0.5], wrong)
    assert got["c0"][0] == pytest.approx(float(np.median(wide.toPandas()["c0"])))


def test_brackets_merge_and_end_at_the_largest_number():
    assert selection.brackets([0.0, 0.5, 3.0], [1.0, 2.0, 3.0]) == [0.0, np.nextafter(2.0, np.inf), 3.0, np.nextafter(3.0, np.inf)]
    assert selection.brackets([1.0], [float(np.finfo(float).max)]) == [1.0]


def test_summaries_of_an_empty_table_and_of_clashing_names(spark):
    empty = spark.createDataFrame([], "value double, feature double")
    rows = portfolio.numeric_summaries(empty, ["value", "feature"]).collect()
    assert [(r["n_total"], r["count"], r["p50"], r["missing_rate"]) for r in rows] == [(0, 0, None, 0.0)] * 2
    df = spark.range(9).selectExpr("double(id) AS value", "double(id) * 2 AS bucket", "double(id) * 3 AS feature", "double(id) AS part")
    rows = {r["column_name"]: r["p50"] for r in portfolio.numeric_summaries(df, df.columns).collect()}
    assert rows == {"value": 4.0, "bucket": 8.0, "feature": 12.0, "part": 4.0}


def test_profile_of_an_appended_file_is_merged_without_the_older_rows(spark, wide, tmp_path):
    path = str(tmp_path / "profile")
    df = wide.select("id", "c0", "c3", F.col("id").cast("string").alias("t"))
    for k in range(3):
        sketches.append_profile(df.filter(F.col("id") % 3 == k), path, F.lit(f"file {k}"))
    stored = sketches.stored_profile(spark, path)
    assert stored.count() == 12
    got = {r["column_name"]: r for r in sketches.merged_profile(stored).collect()}
    pdf = df.toPandas()
    for c in ("c0", "c3"):
        x = pdf[c].dropna()
        assert got[c]["n"] == len(x) and got[c]["n_null"] == 20_000 - len(x)
        assert got[c]["avg"] == pytest.approx(x.mean(), abs=1e-12) and got[c]["std"] == pytest.approx(x.std(), abs=1e-12)
        ranks = [(x <= q).mean() for q in got[c]["q"]]
        assert np.allclose(ranks, [0.25, 0.5, 0.75], atol=4 * sketches.RANK_ERROR)
    assert got["t"]["low_text"] == "0" and got["t"]["q"] is None
    assert abs(got["t"]["approx_unique"] - 20_000) < 0.07 * 20_000
