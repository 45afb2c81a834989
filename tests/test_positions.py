"""Keys at positions and pages for columns of any sortable type."""

import pytest
from pyspark.sql import functions as F

from riskloom.operators import portfolio, positions, ranking

KINDS = {
    "text": "concat('name ', string(pmod(xxhash64(id), 300)))",
    "prefix": "concat(repeat('x', 80), string(pmod(xxhash64(id), 900)))",
    "hot": "if(id % 3 = 0, 'same', concat('u', string(id)))",
    "money": "cast(pmod(xxhash64(id), 5000) / 100 as decimal(12,2))",
    "time": "timestamp '2024-03-31 00:30:00' + make_interval(0, 0, 0, 0, 0, int(pmod(xxhash64(id), 700)), 0.000001)",
    "plain_time": "cast('2024-01-01' as timestamp_ntz) + make_interval(0, 0, 0, int(pmod(xxhash64(id), 90)))",
    "day": "date_add(date '2024-01-01', int(pmod(xxhash64(id), 50)))",
    "number": "if(id % 50 = 0, double('nan'), double(pmod(xxhash64(id), 400)) / 7)",
    "flag": "id % 4 = 0",
}


@pytest.fixture(scope="module")
def listing(spark):
    shown = [f"if(id % 11 = 5, NULL, {sql}) AS `{name}`" for name, sql in KINDS.items()]
    return spark.range(1500, numPartitions=5).selectExpr("id", *shown, "id AS `_value`").cache()


@pytest.mark.parametrize("kind", KINDS)
def test_pages_of_any_type_equal_a_sorted_listing(listing, monkeypatch, kind):
    monkeypatch.setattr(ranking, "CELLS_PER_RANGE", 40)
    monkeypatch.setattr(positions, "SAMPLED", 60)
    monkeypatch.setattr(positions, "RANGES", 8)
    for up, number in ((True, 9), (False, 24), (True, 75)):
        order = F.asc_nulls_last(kind) if up else F.desc_nulls_last(kind)
        whole = [r["id"] for r in listing.orderBy(order, "id").select("id").collect()]
        got = [r["id"] for r in portfolio.page(listing, number, 20, kind, up, "id").collect()]
        assert got == whole[(number - 1) * 20 : number * 20]


def test_pages_with_repeated_keys_empty_tables_and_beyond_the_end(spark):
    df = spark.range(60).selectExpr("int(id / 20) AS v", "0 AS SK_ID_CURR")
    assert [r["v"] for r in portfolio.page(df, 3, 15, "v").collect()] == [1] * 10 + [2] * 5
    assert portfolio.page(df, 99, 15, "v").count() == 0
    assert portfolio.page(df.limit(0), 2, 15, "v").count() == 0
    nulls = spark.range(30).selectExpr("cast(null as string) AS v", "id AS SK_ID_CURR")
    assert [r["SK_ID_CURR"] for r in portfolio.page(nulls, 2, 10, "v", False).collect()] == list(range(10, 20))


def test_the_counting_scan_moves_partial_counts_only(listing):
    ranged = listing.select(F.size(F.filter(F.array(F.lit("name 5")), lambda e: e <= F.col("text"))).alias("r"), "text")
    plan = ranged.groupBy("r").agg(F.count(F.lit(1)))._jdf.queryExecution().executedPlan().toString()
    assert "partial_count" in plan and "Sort " not in plan
