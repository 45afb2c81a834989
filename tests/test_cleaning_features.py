import math

import pytest
from pyspark.sql import functions as F

from riskloom.functions import columns as C
from riskloom.functions import constants as K
from riskloom.operators import aggregation as A
from riskloom.operators import cleaning, features, filters, portfolio
from riskloom.plans import feature_table


def one(df, c):
    return [r[c] for r in df.collect()]


def test_cap_keeps_nulls_and_uses_the_exact_quantile(spark):
    df = spark.createDataFrame([(float(i) if i else None,) for i in range(1, 1001)] + [(None,)], "x double")
    out = one(cleaning.cap_upper_tail(df, "x", 0.999), "x")
    assert max(v for v in out if v is not None) == pytest.approx(999.001) and out.count(None) == 1


def test_years_round_half_to_even_without_minus_zero(spark):
    df = spark.createDataFrame([(-821.8125,), (0.0,), (None,), (-3652.5,)], "DAYS_BIRTH double")
    years = one(cleaning.add_years(df), "AGE_YEARS")
    assert years[0] == 2.2 and math.copysign(1, years[1]) == 1 and years[2] is None and years[3] == 10.0


def test_non_finite_and_sentinels(spark):
    df = spark.createDataFrame([(float("nan"), 365243), (float("inf"), 1), (2.0, None)], "a double, DAYS_EMPLOYED int")
    assert one(cleaning.nan_to_null(df), "a") == [None, None, 2.0]
    assert one(cleaning.null_values(df, {"DAYS_EMPLOYED": 365243, "absent": 1}), "DAYS_EMPLOYED") == [None, 1, None]


@pytest.mark.parametrize("raw,want", [("Cash loans (x)", "CASH_LOANS_X"), ("__a--b__", "A_B"), (" é ", "")])
def test_names_match_in_both_forms(spark, raw, want):
    df = spark.createDataFrame([(raw,)], "s string")
    assert C.clean_name(raw) == want == df.select(C.clean_name_column("s")).first()[0]


def test_colliding_category_names_are_refused(spark):
    with pytest.raises(ValueError):
        A.categorical_expressions({"c": ["a b", "a-b"]}, "P")


def test_ratios_and_recompute(spark):
    df = spark.createDataFrame([(100.0, 0.0), (100.0, 50.0), (None, 2.0)], "AMT_CREDIT double, AMT_INCOME_TOTAL double")
    assert one(features.add_ratios(df), "CREDIT_INCOME_RATIO") == [None, 2.0, None]
    stale = df.withColumn("CREDIT_INCOME_RATIO", F.lit(9.0))
    assert one(features.apply_changes(stale, {"AMT_CREDIT": 10.0}), "CREDIT_INCOME_RATIO") == [None, 0.2, 5.0]
    assert "CREDIT_INCOME_RATIO" not in features.recompute(df).columns


def test_score_stats_for_every_number_of_present_scores(spark):
    rows = [(None, None, None), (0.2, None, None), (0.2, 0.4, None), (0.2, 0.4, 0.6)]
    df = spark.createDataFrame(rows, "EXT_SOURCE_1 double, EXT_SOURCE_2 double, EXT_SOURCE_3 double")
    out = features.add_external_score_stats(df).collect()
    assert [r["N_EXT_SOURCE_PRESENT"] for r in out] == [0, 1, 2, 3]
    assert out[0]["EXT_SOURCE_MEAN"] is None and out[1]["EXT_SOURCE_STD"] is None
    assert out[2]["EXT_SOURCE_PROD"] is None and out[3]["EXT_SOURCE_PROD"] == pytest.approx(0.048)
    assert out[2]["EXT_SOURCE_STD"] == pytest.approx(0.1414213562) and out[3]["EXT_SOURCE_MAX"] == 0.6


def test_payment_flags_without_a_delay(spark):
    df = spark.createDataFrame(
        [(10.0, 10.0, None, -5), (0.0, 10.0, -2, -5), (5.0, 0.0, -9, -5)],
        "AMT_PAYMENT double, AMT_INSTALMENT double, DAYS_ENTRY_PAYMENT int, DAYS_INSTALMENT int")
    out = features.add_payment_behaviour(df).collect()
    assert [r["LATE_FLAG"] for r in out] == [0.0, 1.0, 0.0]
    assert [r["DPD"] for r in out] == [None, 3, 0] and [r["DBD"] for r in out] == [None, 0, 4]
    assert out[2]["PAYMENT_RATIO"] is None


def test_presence_flags(spark):
    df = spark.createDataFrame([(None, None), (2, 0), (1, 3)], "BUREAU_COUNT int, PREV_COUNT int")
    out = features.add_presence_flags(df).collect()
    assert [r["NO_HISTORY"] for r in out] == [1, 0, 0] and [r["N_SOURCES"] for r in out] == [0, 1, 2]
    assert out[1]["HAS_PREV"] == 0 and out[2]["HAS_POS"] == 0


def history(spark):
    rows = [(1, 10.0, "a", -5), (1, None, None, -400), (1, 4.0, "b", -10), (2, None, "a", -900), (3, 1.0, "c", -1)]
    return spark.createDataFrame(rows, "SK_ID_CURR long, amt double, kind string, DAYS_DECISION int")


def test_all_null_group_sums_to_zero_and_counts_zero(spark):
    out = {r["SK_ID_CURR"]: r for r in A.aggregate_numeric(history(spark), "SK_ID_CURR", "P").collect()}
    assert out[2]["P_AMT_SUM"] == 0.0 and out[2]["P_AMT_COUNT"] == 0 and out[2]["P_AMT_MEAN"] is None
    assert out[1]["P_COUNT"] == 3 and out[1]["P_AMT_MEAN"] == 7.0


def test_nulls_and_tail_share_one_bucket_and_known_keys_choose_the_top(spark):
    parents = spark.createDataFrame([(1,), (2,)], "SK_ID_CURR long")
    wide = A.aggregate_categorical(history(spark), "SK_ID_CURR", "P", ["kind"], 1, parents)
    out = {r["SK_ID_CURR"]: r for r in wide.collect()}
    assert set(out) == {1, 2} and out[1]["P_KIND_OUTROS_SUM"] == 2.0
    assert out[1]["P_KIND_A_MEAN"] == pytest.approx(1 / 3) and out[2]["P_KIND_A_MEAN"] == 1.0
    assert sum(v for k, v in out[1].asDict().items() if k.endswith("_MEAN")) == pytest.approx(1.0)


def test_single_pass_history_equals_separate_aggregates(spark):
    df = history(spark)
    wide = A.aggregate_history(df, "SK_ID_CURR", "P", ["kind"], ("DAYS_DECISION", 12)).orderBy("SK_ID_CURR")
    recent = A.aggregate_recent(df, "SK_ID_CURR", "P", "DAYS_DECISION", 12)
    base = df.select("SK_ID_CURR").distinct()
    apart = A.attach(base, [A.aggregate_numeric(df, "SK_ID_CURR", "P"), A.aggregate_categorical(df, "SK_ID_CURR", "P", ["kind"]), recent], "SK_ID_CURR")
    assert set(wide.columns) == set(apart.columns)
    assert wide.collect() == apart.select(*wide.columns).orderBy("SK_ID_CURR").collect()


def test_chunked_wide_aggregate_equals_one_pass(spark):
    df = history(spark)
    exprs = A.numeric_expressions(["amt", "DAYS_DECISION"], "P", K.NUMERIC_AGGREGATES)
    a = A.group_wide(df, "SK_ID_CURR", exprs).orderBy("SK_ID_CURR").collect()
    assert a == A.group_wide(df, "SK_ID_CURR", exprs, chunk=3).orderBy("SK_ID_CURR").collect()


def test_feature_table_keeps_one_row_per_client_and_nulls_without_history(spark):
    base = spark.createDataFrame([(1, 5.0), (9, 6.0)], "SK_ID_CURR long, AMT_INCOME_TOTAL double")
    loans = spark.createDataFrame([(1, 100, 3.0), (7, 200, 1.0)], "SK_ID_CURR long, SK_ID_BUREAU long, amt double")
    months = spark.createDataFrame([(100, 1.0), (100, 2.0), (200, 9.0)], "SK_ID_BUREAU long, q double")
    wide = feature_table.build(base, [feature_table.History(history(spark), "PREV", ("kind",), ("DAYS_DECISION", 12))], (loans, months))
    rows = {r["SK_ID_CURR"]: r for r in wide.collect()}
    assert set(rows) == {1, 9} and rows[9]["PREV_COUNT"] is None and rows[9]["NO_HISTORY"] == 1
    assert rows[1]["BUREAU_BB_Q_SUM_MEAN"] == 3.0 and rows[1]["PREV_R12_COUNT"] == 2 and rows[1]["N_SOURCES"] == 2


def test_bands_and_decisions(spark):
    df = spark.createDataFrame([(24.9, 0.04), (25.0, 0.05), (None, None), (65.0, 0.35)], "AGE_YEARS double, p double")
    assert one(df.select(C.age_band().alias("b")), "b") == ["<25", "25-35", "desconhecido", "65+"]
    assert one(df.select(C.score_band("p").alias("b")), "b") == ["A (<5%)", "B (5-10%)", "sem score", "E (35%+)"]
    assert one(df.select(C.decide("p", 0.05).alias("d")), "d") == ["APROVAR", "NEGAR", None, "NEGAR"]
    assert one(df.select(C.decide("p", 0.05, 0.04).alias("d")), "d") == ["REVISAR", "REVISAR", None, "NEGAR"]
    with pytest.raises(ValueError):
        C.dimension("nope")
    assert portfolio.dimension_catalogue(spark).count() == len(C.dimensions()) == 16


def test_band_width_doubles_only_in_weak_segments(spark):
    df = spark.createDataFrame([(20.0, 1), (40.0, None), (40.0, 1), (None, 1)], "AGE_YEARS double, BUREAU_COUNT int")
    weak = {"age_band": ["<25"], "thin_file": [K.THIN_FILE]}
    assert one(df.select(C.band_width(weak).alias("w")), "w") == [0.1, 0.1, 0.05, 0.05]


def test_filters_refuse_unknown_names_and_combine(spark):
    with pytest.raises(TypeError):
        filters.ClientFilters(age_mim=3)
    df = spark.createDataFrame([(1, 30.0, None), (2, 30.0, 4), (3, None, None)], "SK_ID_CURR long, AGE_YEARS double, BUREAU_COUNT int")
    assert one(filters.ClientFilters(age_min=30, thin_file=True).apply(df), "SK_ID_CURR") == [1]
    assert filters.ClientFilters().apply(df).count() == 3
    assert filters.split_values(" a, ,b ") == ["a", "b"] and filters.split_values(" , ") is None
    with pytest.raises(ValueError):
        filters.select_columns(df, "AGE_YEARS, nope", [])
    assert filters.select_columns(df, "AGE_YEARS", []).columns == ["SK_ID_CURR", "AGE_YEARS"]


def test_histogram_covers_every_value_and_constant_columns_are_empty(spark):
    df = spark.range(101).selectExpr("double(id) AS x", "int(id % 2) AS TARGET")
    out = portfolio.histogram(df, "x", 10).orderBy("bin").collect()
    assert sum(r["n"] for r in out) == 101 and out[-1]["n"] == 11 and len(out) == 10
    assert portfolio.histogram(df.withColumn("x", F.lit(1.0)), "x").count() == 0


def test_column_profile_chunks(spark):
    df = spark.range(50).selectExpr("id", "if(id % 5 = 0, NULL, id) AS x", "string(id) AS s")
    out = {r["column_name"]: r for r in portfolio.column_profile(df, 2).collect()}
    assert out["x"]["null_rate"] == 0.2 and abs(out["id"]["approx_unique"] - 50) <= 5 and out["s"]["column_type"] == "string"
    assert out["id"]["max_value"] == "49"


def test_deep_pages_equal_a_sorted_listing(spark):
    df = spark.range(400).selectExpr("id AS SK_ID_CURR", "if(id % 4 = 0, NULL, double(id % 7)) AS v")
    for ascending in (True, False):
        order = F.asc_nulls_last("v") if ascending else F.desc_nulls_last("v")
        whole = one(df.orderBy(order, "SK_ID_CURR"), "SK_ID_CURR")
        for number in (2, 9, 15, 16, 20):
            got = one(portfolio.page(df, number, 20, "v", ascending), "SK_ID_CURR")
            assert got == whole[(number - 1) * 20 : number * 20]


def test_sample_holds_the_smallest_hashes(spark):
    df = spark.range(2000)
    ordered = one(df.withColumn("u", C.hash_unit("id", seed=42)).orderBy("u", "id"), "id")
    for n in (0, 1, 300, 1999):
        assert sorted(one(cleaning.reproducible_sample(df, n, "id"), "id")) == sorted(ordered[:n])
    assert cleaning.reproducible_sample(df, 5000, "id").count() == 2000
