import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from riskloom.operators import ranking as R


def values(scored, c="raw"):
    return np.array([r[0] for r in scored.select(c).collect()])


@pytest.mark.parametrize("column", ["raw", "score"])
def test_running_sums_over_ranges_equal_a_plain_cumulative_sum(scored, many_ranges, column):
    cells = R.value_cells(scored, column)
    got = R.running_sums(cells, column, ["n"]).orderBy(column).toPandas()
    counts = pd.Series(values(scored, column)).value_counts().sort_index()
    assert got[column].tolist() == counts.index.tolist()
    assert got["below_n"].tolist() == (counts.cumsum() - counts).tolist()
    assert set(got["total_n"]) == {3000}


def test_running_sums_by_group(scored, many_ranges):
    cells = R.value_cells(scored, "score", ["grp"])
    got = R.running_sums(cells, "score", ["n"], ["grp"]).toPandas()
    for _g, part in got.groupby("grp"):
        part = part.sort_values("score")
        assert part["below_n"].tolist() == (part["n"].cumsum() - part["n"]).tolist()
        assert set(part["total_n"]) == {part["n"].sum()}


@pytest.mark.parametrize("column", ["raw", "score"])
def test_quantiles_are_exact(scored, many_ranges, column):
    probs = [0, 0.001, 0.25, 0.5, 0.777, 0.999, 1]
    assert np.allclose(R.quantiles(scored, column, probs), np.quantile(values(scored, column), probs), atol=1e-12)


def test_quantiles_skip_nulls_and_empty_input(spark, scored):
    with_nulls = scored.withColumn("x", F.when(F.col("id") % 2 == 0, F.col("raw")))
    want = np.median(values(scored.filter("id % 2 = 0")))
    assert R.quantiles(with_nulls, "x", [0.5])[0] == pytest.approx(want)
    assert R.quantiles(scored.filter("id < 0"), "raw", [0.5]) == []


def test_cut_keys_match_sorted_positions(scored, many_ranges):
    order = scored.select("score", "id").toPandas().sort_values(["score", "id"])
    positions = [0, 1, 299, 300, 1500, 2999]
    want = [(s, i) for s, i in order.iloc[positions].itertuples(index=False)]
    assert R.cut_keys(scored, "score", "id", positions) == want


def test_cut_keys_inside_one_hot_value(spark, many_ranges):
    df = spark.range(1000).withColumn("v", F.when(F.col("id") < 900, 0.5).otherwise(F.col("id") / 1000.0))
    assert R.cut_keys(df, "v", "id", [0, 450, 899, 900]) == [(0.5, 0), (0.5, 450), (0.5, 899), (0.9, 900)]


def test_octiles_equal_quantile_cut_of_the_first_rank(scored):
    pdf = scored.toPandas().sort_values("id")
    want = pd.qcut(pdf["raw"].rank(method="first"), 8, labels=False).tolist()
    got = R.octiles(scored, "raw", "id").orderBy("id").toPandas()["octile"].tolist()
    assert got == want


def test_sextiles_cover_everyone_evenly(scored):
    df, cuts = R.sextiles(scored.withColumn("age", F.col("raw") * 100), "age")
    counts = {r[0]: r[1] for r in df.groupBy("sextile").count().collect()}
    assert len(cuts) == 5 and len(counts) == 6
    assert max(counts.values()) - min(counts.values()) <= 1


def test_evenly_spaced_keeps_both_ends(spark):
    df = spark.range(1001).withColumn("n", F.lit(1001))
    kept = sorted(r[0] for r in df.filter(R.evenly_spaced(F.col("id"), F.col("n"), 300)).collect())
    assert kept == sorted({i * 1000 // 299 for i in range(300)})
    small = spark.range(50).withColumn("n", F.lit(50))
    assert small.filter(R.evenly_spaced(F.col("id"), F.col("n"), 300)).count() == 50


def test_share_at_or_below(scored, many_ranges):
    got = R.share_at_or_below(scored, "score").toPandas()
    v = values(scored, "score")
    for s, p in got.itertuples(index=False):
        assert p == pytest.approx((v <= s).mean())
