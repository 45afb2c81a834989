"""Queries for history aggregation, portfolio statistics, paging, catalogues and top-k."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.functions import constants as K
from riskloom.operators import aggregation, cleaning, features, filters, portfolio, ranking, selection, sketches
from riskloom.plans import feature_table
from riskloom.plans.queries_cleaning import DIMENSION_SQL, THRESHOLD, rounded
from riskloom.plans.registry import Tables, query
from riskloom.session import scratch_path
from riskloom.sources import readers, writers

APPROVED = "avg(CASE WHEN proba_champion < 0.09e0 THEN 1e0 WHEN proba_champion IS NULL THEN NULL ELSE 0e0 END)"

# ---------------------------------------------------------------- history aggregation


@query("aggregate_numeric_history", """
SELECT l_orderkey,
 round(avg(l_quantity), 7) AS mean_qty, coalesce(sum(l_quantity), 0) AS sum_qty, max(l_quantity) AS max_qty, min(l_quantity) AS min_qty, count(l_quantity) AS count_qty,
 round(avg(l_extendedprice), 6) AS mean_price, round(sum(l_extendedprice), 4) AS sum_price, max(l_discount) AS max_disc, min(l_tax) AS min_tax, count(*) AS n
FROM lineitem GROUP BY 1
""")
def _(t: Tables) -> DataFrame:
    wide = aggregation.aggregate_numeric(t.lineitem, "l_orderkey", "LI", skip=("l_partkey", "l_suppkey", "l_linenumber"))
    return wide.select(
        "l_orderkey", F.round("LI_L_QUANTITY_MEAN", 7).alias("mean_qty"), F.col("LI_L_QUANTITY_SUM").alias("sum_qty"),
        F.col("LI_L_QUANTITY_MAX").alias("max_qty"), F.col("LI_L_QUANTITY_MIN").alias("min_qty"),
        F.col("LI_L_QUANTITY_COUNT").alias("count_qty"), F.round("LI_L_EXTENDEDPRICE_MEAN", 6).alias("mean_price"),
        F.round("LI_L_EXTENDEDPRICE_SUM", 4).alias("sum_price"), F.col("LI_L_DISCOUNT_MAX").alias("max_disc"),
        F.col("LI_L_TAX_MIN").alias("min_tax"), F.col("LI_COUNT").alias("n"))


@query("aggregate_all_null_group", """
SELECT o_custkey, coalesce(sum(CASE WHEN o_orderstatus = 'F' THEN o_totalprice END), 0) > 0 AS any_sum,
 count(CASE WHEN o_orderstatus = 'F' THEN 1 END) AS n_values, round(avg(CASE WHEN o_orderstatus = 'F' THEN o_totalprice END), 6) AS mean_price FROM orders GROUP BY 1
""")
def _(t: Tables) -> DataFrame:
    df = t.orders.select("o_custkey", F.when(F.col("o_orderstatus") == "F", F.col("o_totalprice")).alias("p"))
    wide = aggregation.aggregate_numeric(df, "o_custkey", "X")
    return wide.select(
        "o_custkey", (F.col("X_P_SUM") > 0).alias("any_sum"), F.col("X_P_COUNT").alias("n_values"), F.round("X_P_MEAN", 6).alias("mean_price"))


@query("aggregate_categorical_history", """
WITH top AS (SELECT kind FROM bureau WHERE kind IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, kind LIMIT 2),
 lumped AS (SELECT "SK_ID_CURR" AS id, CASE WHEN active IS NULL THEN 'OUTROS' ELSE active END AS a,
                   CASE WHEN kind IN (SELECT kind FROM top) THEN 'TOP' ELSE 'OUTROS' END AS k FROM bureau)
SELECT id, CAST(count(CASE WHEN a = 'OUTROS' THEN 1 END) AS DOUBLE) AS unknown_active, round(avg(CASE WHEN a = 'F' THEN 1e0 ELSE 0e0 END), 9) AS final_share,
 CAST(count(CASE WHEN k = 'OUTROS' THEN 1 END) AS DOUBLE) AS other_kinds, round(avg(CASE WHEN k = 'OUTROS' THEN 1e0 ELSE 0e0 END), 9) AS other_share
FROM lumped GROUP BY id
""")
def _(t: Tables) -> DataFrame:
    active = aggregation.aggregate_categorical(t.bureau, "SK_ID_CURR", "B", ["active"])
    kinds = aggregation.aggregate_categorical(t.bureau, "SK_ID_CURR", "B", ["kind"], 2)
    both = active.join(kinds, "SK_ID_CURR")
    return rounded(both.select(
        F.col("SK_ID_CURR").alias("id"), F.col("B_ACTIVE_OUTROS_SUM").alias("unknown_active"),
        F.col("B_ACTIVE_F_MEAN").alias("final_share"), F.col("B_KIND_OUTROS_SUM").alias("other_kinds"),
        F.col("B_KIND_OUTROS_MEAN").alias("other_share")), 9)


@query("aggregate_recent_window", """
SELECT "SK_ID_CURR" AS id, round(avg(amt), 6) AS mean_amt, round(sum(amt), 4) AS sum_amt, count(*) AS n FROM bureau WHERE "DAYS_DECISION" >= -720 GROUP BY 1
""")
def _(t: Tables) -> DataFrame:
    wide = aggregation.aggregate_recent(t.bureau, "SK_ID_CURR", "PREV", "DAYS_DECISION", 24)
    return wide.select(
        F.col("SK_ID_CURR").alias("id"), F.round("PREV_R24_AMT_MEAN", 6).alias("mean_amt"),
        F.round("PREV_R24_AMT_SUM", 4).alias("sum_amt"), F.col("PREV_R24_COUNT").alias("n"))


@query("aggregate_history_single_pass", """
WITH all_rows AS (SELECT "SK_ID_CURR" AS id, round(avg(amt), 6) AS mean_amt, count(*) AS n, CAST(count(CASE WHEN active = 'P' THEN 1 END) AS DOUBLE) AS p FROM bureau GROUP BY 1),
 recent AS (SELECT "SK_ID_CURR" AS id, round(max(amt), 6) AS max_amt, count(*) AS n_recent, round(sum(amt), 4) AS sum_recent FROM bureau WHERE "DAYS_DECISION" >= -360 GROUP BY 1)
SELECT * FROM all_rows LEFT JOIN recent USING (id)
""")
def _(t: Tables) -> DataFrame:
    wide = aggregation.aggregate_history(t.bureau, "SK_ID_CURR", "PREV", ["active"], ("DAYS_DECISION", 12))
    return wide.select(
        F.col("SK_ID_CURR").alias("id"), F.round("PREV_AMT_MEAN", 6).alias("mean_amt"), F.col("PREV_COUNT").alias("n"),
        F.col("PREV_ACTIVE_P_SUM").alias("p"), F.round("PREV_R12_AMT_MAX", 6).alias("max_amt"),
        F.col("PREV_R12_COUNT").alias("n_recent"), F.round("PREV_R12_AMT_SUM", 4).alias("sum_recent"))


@query("two_level_roll_up", """
WITH g AS (SELECT "SK_ID_BUREAU", avg(qty) AS q_mean, sum(qty) AS q_sum, count(*) AS n, avg(CASE WHEN status = 'R' THEN 1e0 ELSE 0e0 END) AS r FROM bureau_balance GROUP BY 1)
SELECT b."SK_ID_CURR" AS id, count(*) AS n_loans, round(avg(g.q_mean), 7) AS mean_qty, coalesce(round(sum(g.q_sum), 4), 0e0) AS sum_qty,
 CAST(coalesce(sum(g.n), 0) AS BIGINT) AS n_balances, round(avg(g.r), 9) AS r_share, CAST(count(CASE WHEN active = 'O' THEN 1 END) AS DOUBLE) AS n_open
FROM bureau b LEFT JOIN g USING ("SK_ID_BUREAU") GROUP BY 1
""")
def _(t: Tables) -> DataFrame:
    parents = t.customer.select(F.col("c_custkey").alias("SK_ID_CURR"))
    wide = aggregation.roll_up(
        parents, t.bureau, t.bureau_balance, "SK_ID_CURR", "SK_ID_BUREAU", "BUREAU", "BB", ["active"], ["status"])
    return wide.select(
        F.col("SK_ID_CURR").alias("id"), F.col("BUREAU_COUNT").alias("n_loans"),
        F.round("BUREAU_BB_QTY_MEAN_MEAN", 7).alias("mean_qty"), F.round("BUREAU_BB_QTY_SUM_SUM", 4).alias("sum_qty"),
        F.col("BUREAU_BB_COUNT_SUM").alias("n_balances"), F.round("BUREAU_BB_STATUS_R_MEAN_MEAN", 9).alias("r_share"),
        F.col("BUREAU_ACTIVE_O_SUM").alias("n_open"))


@query("top_values_tail_lumped", """
WITH top AS (SELECT p_type FROM part GROUP BY 1 ORDER BY count(*) DESC, p_type LIMIT 15)
SELECT CASE WHEN p_type IN (SELECT p_type FROM top) THEN p_type ELSE 'OUTROS' END AS value, count(*) AS n FROM part GROUP BY 1
""")
def _(t: Tables) -> DataFrame:
    kept = aggregation.top_values(t.part, ["p_type"])["p_type"]
    return t.part.groupBy(aggregation.lump_tail("p_type", kept).alias("value")).agg(F.count(F.lit(1)).alias("n"))


# ---------------------------------------------------------------- portfolio statistics


def overview_sql(where: str) -> str:
    return f"""
    SELECT count(*) AS n_clients, count(CASE WHEN "TARGET" = 1 THEN 1 END) AS n_defaults, round(avg("TARGET"), 9) AS default_rate,
     round(avg(CASE WHEN "BUREAU_COUNT" IS NULL THEN 1e0 ELSE 0e0 END), 9) AS thin_file_rate, round(avg("AGE_YEARS"), 9) AS avg_age,
     round(median("AMT_INCOME_TOTAL"), 6) AS median_income, round(avg("AMT_CREDIT"), 6) AS avg_credit, round(avg("CREDIT_INCOME_RATIO"), 9) AS avg_credit_income_ratio,
     round(avg(CASE WHEN "EXT_SOURCE_1" IS NULL THEN 1e0 ELSE 0e0 END), 9) AS missing_ext_source_1_rate,
     round(avg(CASE WHEN "EXT_SOURCE_3" IS NULL THEN 1e0 ELSE 0e0 END), 9) AS missing_ext_source_3_rate,
     count(proba_champion) AS scored, round(avg(proba_champion), 9) AS avg_score, round({APPROVED}, 9) AS approval_rate, 0.09e0 AS threshold
    FROM clients WHERE {where}"""


def tidy_overview(df: DataFrame) -> DataFrame:
    return rounded(df, 9).withColumns({
        "median_income": F.round("median_income", 6), "avg_credit": F.round("avg_credit", 6)})


@query("portfolio_overview", overview_sql("TRUE"))
def _(t: Tables) -> DataFrame:
    return tidy_overview(portfolio.overview(t.clients, THRESHOLD))


@query("portfolio_overview_filtered", overview_sql(""" "CODE_GENDER" = 'F' AND "AGE_YEARS" >= 30 AND split = 'test'"""))
def _(t: Tables) -> DataFrame:
    spec = filters.ClientFilters(gender="F", age_min=30, split="test")
    return tidy_overview(portfolio.overview(spec.apply(t.clients, THRESHOLD), THRESHOLD))


@query("categorical_distribution", """
SELECT p_type AS value, count(*) AS n, round(avg(t), 9) AS default_rate, round(avg(s), 9) AS avg_score
FROM (SELECT p_type, CAST(p_size < 5 AS INTEGER) AS t, p_size / 100e0 AS s FROM part) GROUP BY 1
""")
def _(t: Tables) -> DataFrame:
    df = t.part.select("p_type", (F.col("p_size") < 5).cast("int").alias(K.TARGET), (F.col("p_size") / 100.0).alias(K.SCORE))
    return rounded(portfolio.categorical_distribution(df, "p_type"), 9)


@query("numeric_summary", """
SELECT count(*) AS n_total, count("EXT_SOURCE_1") AS count, round(avg("EXT_SOURCE_1"), 9) AS mean, round(stddev_samp("EXT_SOURCE_1"), 9) AS std,
 round(min("EXT_SOURCE_1"), 9) AS min, round(max("EXT_SOURCE_1"), 9) AS max, round(quantile_cont("EXT_SOURCE_1", 0.25), 9) AS p25,
 round(quantile_cont("EXT_SOURCE_1", 0.5), 9) AS p50, round(quantile_cont("EXT_SOURCE_1", 0.75), 9) AS p75,
 count(*) - count("EXT_SOURCE_1") AS missing, round((count(*) - count("EXT_SOURCE_1")) / CAST(count(*) AS DOUBLE), 9) AS missing_rate
FROM base_clients
""")
def _(t: Tables) -> DataFrame:
    return rounded(portfolio.numeric_summary(t.base_clients, "EXT_SOURCE_1"), 9)


WIDE = {
    "lineitem": ("l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"),
    "orders": ("o_orderkey", "o_custkey", "o_totalprice"),
}


def summary_sql(table: str, c: str) -> str:
    x = f"CAST({c} AS DOUBLE)"
    quartiles = ", ".join(f"round(quantile_cont({x}, {p}), 6) AS p{int(p * 100)}" for p in (0.25, 0.5, 0.75))
    return f"""SELECT '{table}' AS table_name, '{c}' AS column_name, count(*) AS n_total, count({c}) AS count, round(avg({x}), 6) AS mean,
     round(stddev_samp({x}), 6) AS std, min({x}) AS min, max({x}) AS max, {quartiles}, count(*) - count({c}) AS missing FROM {table}"""


@query("numeric_summaries_many_columns", " UNION ALL ".join(summary_sql(table, c) for table, names in WIDE.items() for c in names))
def _(t: Tables) -> DataFrame:
    parts = [portfolio.numeric_summaries(getattr(t, table), names).select(F.lit(table).alias("table_name"), "*") for table, names in WIDE.items()]
    return rounded(parts[0].unionByName(parts[1]).drop("missing_rate"), 6)


MERGED = ("l_orderkey", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_returnflag", "l_shipdate")


def merged_sql(c: str) -> str:
    number = c not in ("l_returnflag", "l_shipdate")
    x = f"CAST({c} AS DOUBLE)" if number else "CAST(NULL AS DOUBLE)"
    text = "CAST(NULL AS VARCHAR)" if number else f"CAST({c} AS VARCHAR)"
    return f"""SELECT '{c}' AS column_name, count(*) AS n_rows, count(*) - count({c}) AS n_null, round(avg({x}), 6) AS avg, round(stddev_samp({x}), 6) AS std,
     min({x}) AS low, max({x}) AS high, min({text}) AS low_text, max({text}) AS high_text, true AS distinct_within_error, {"true" if number else "CAST(NULL AS BOOLEAN)"} AS quartiles_within_error FROM lineitem"""


@query("merged_column_profile", " UNION ALL ".join(merged_sql(c) for c in MERGED))
def _(t: Tables) -> DataFrame:
    # the profile of one half is stored, that of the other appended; the sketches are then held against exact figures
    df = t.lineitem.select(*MERGED)
    path = scratch_path(t.spark, "column-profile")
    for half in (0, 1):
        sketches.append_profile(df.filter(F.col("l_orderkey") % 2 == half), path)
    profile = sketches.merged_profile(sketches.stored_profile(t.spark, path))
    exact = None
    for c in MERGED:
        n = df.agg(F.countDistinct(c).alias("exact")).select(F.lit(c).alias("column_name"), "exact")
        exact = n if exact is None else exact.unionByName(n)
    numbers = [c for c in MERGED if c not in ("l_returnflag", "l_shipdate")]
    around = selection.quantiles_of_columns(df, numbers, [p + s for p in portfolio.QUARTILES for s in (-0.01, 0.01)])
    limits = t.spark.createDataFrame([(c, v[0::2], v[1::2]) for c, v in around.items()], "column_name string, los array<double>, his array<double>")
    inside = F.forall(F.arrays_zip("q", "los", "his"), lambda z: (z["q"] >= z["los"]) & (z["q"] <= z["his"]))
    both = profile.join(exact, "column_name").join(limits, "column_name", "left")
    return rounded(both.select(
        "column_name", "n_rows", "n_null", "avg", "std", "low", "high", "low_text", "high_text",
        (F.abs(F.col("approx_unique") - F.col("exact")) <= 0.07 * F.col("exact")).alias("distinct_within_error"),
        inside.alias("quartiles_within_error")), 6)


@query("exact_quantiles_lineitem", """
SELECT count(l_extendedprice) AS n, round(quantile_cont(l_extendedprice, 0.01), 6) AS p01, round(quantile_cont(l_extendedprice, 0.5), 6) AS p50,
 round(quantile_cont(l_extendedprice, 0.999), 6) AS p999 FROM lineitem
""")
def _(t: Tables) -> DataFrame:
    q = ranking.quantile_table(t.lineitem, "l_extendedprice", [0.01, 0.5, 0.999])
    return rounded(q.select("n", q.q[0].alias("p01"), q.q[1].alias("p50"), q.q[2].alias("p999")), 6)


@query("exact_quantiles_by_group", """
SELECT l_returnflag, count(*) AS n, round(quantile_cont(l_extendedprice, 0.1), 6) AS p10, round(quantile_cont(l_extendedprice, 0.9), 6) AS p90 FROM lineitem GROUP BY 1
""")
def _(t: Tables) -> DataFrame:
    q = ranking.quantile_table(t.lineitem, "l_extendedprice", [0.1, 0.9], ["l_returnflag"])
    return rounded(q.select("l_returnflag", "n", q.q[0].alias("p10"), q.q[1].alias("p90")), 6)


def histogram_sql(bins: int, column: str, table: str, target: str) -> str:
    return f"""
    WITH r AS (SELECT min({column}) AS lo, (max({column}) - min({column})) / {bins} AS w FROM {table}),
     b AS (SELECT greatest(least(CAST(floor(({column} - lo) / w) AS INTEGER), {bins - 1}), 0) AS bin, {target} AS y, lo, w FROM {table}, r WHERE {column} IS NOT NULL)
    SELECT bin, round(lo + bin * w, 6) AS lower, round(lo + (bin + 1) * w, 6) AS upper, count(*) AS n,
     round(count(*) / CAST(sum(count(*)) OVER () AS DOUBLE), 9) AS pct, round(avg(y), 9) AS default_rate FROM b GROUP BY bin, lo, w"""


@query("histogram_with_default_rate", histogram_sql(20, '"AGE_YEARS"', "clients", '"TARGET"'))
def _(t: Tables) -> DataFrame:
    out = rounded(portfolio.histogram(t.clients, "AGE_YEARS", 20), 9)
    return out.withColumns({"lower": F.round("lower", 6), "upper": F.round("upper", 6)})


@query("density_by_class", """
WITH r AS (SELECT min("EXT_SOURCE_2") AS lo, (max("EXT_SOURCE_2") - min("EXT_SOURCE_2")) / 20 AS w FROM base_clients),
 b AS (SELECT "TARGET" AS target, greatest(least(CAST(floor(("EXT_SOURCE_2" - lo) / w) AS INTEGER), 19), 0) AS bin, w FROM base_clients, r)
SELECT target, bin, count(*) AS n, round(count(*) / CAST(sum(count(*)) OVER (PARTITION BY target) AS DOUBLE) / w, 9) AS density FROM b GROUP BY target, bin, w
""")
def _(t: Tables) -> DataFrame:
    return rounded(portfolio.density_by_class(t.base_clients, "EXT_SOURCE_2", 20).withColumnRenamed("TARGET", "target"), 9)


def crosstab_sql(rows: str, cols: str, min_count: int, value: str) -> str:
    return f"""SELECT CAST({DIMENSION_SQL[rows]} AS VARCHAR) AS row_value, CAST({DIMENSION_SQL[cols]} AS VARCHAR) AS col_value, count(*) AS n,
     round(avg("TARGET"), 9) AS default_rate, {value} AS value FROM clients GROUP BY 1, 2 HAVING count(*) >= {min_count}"""


@query("crosstab_default_rate", crosstab_sql("education", "age_band", 10, 'round(avg("TARGET"), 9)'))
def _(t: Tables) -> DataFrame:
    return rounded(portfolio.crosstab(t.clients, "education", "age_band", min_count=10), 9)


@query("crosstab_count", crosstab_sql("gender", "score_band", 30, "CAST(count(*) AS DOUBLE)"))
def _(t: Tables) -> DataFrame:
    return rounded(portfolio.crosstab(t.clients, "gender", "score_band", "count"), 9)


@query("crosstab_labels", f"""
WITH c AS ({crosstab_sql("gender", "score_band", 30, "0")})
SELECT CAST(sum(n) AS BIGINT) AS n_total, list_sort(list(DISTINCT row_value) FILTER (row_value IS NOT NULL)) AS row_values, list_sort(list(DISTINCT col_value) FILTER (col_value IS NOT NULL)) AS col_values FROM c
""")
def _(t: Tables) -> DataFrame:
    return portfolio.crosstab_labels(portfolio.crosstab(t.clients, "gender", "score_band"))


def profile_sql(table: str, columns: list[str]) -> str:
    return " UNION ALL ".join(
        f"""SELECT '{c}' AS column_name, count(*) - count("{c}") AS n_null, count(*) AS n_rows,
        round((count(*) - count("{c}")) / CAST(count(*) AS DOUBLE), 9) AS null_rate FROM {table}""" for c in columns)


PROFILED = ["SK_ID_CURR", "TARGET", "CODE_GENDER", "DAYS_BIRTH", "AMT_INCOME_TOTAL", "EXT_SOURCE_1", "EXT_SOURCE_2",
            "EXT_SOURCE_3", "BUREAU_COUNT", "PREV_COUNT", "OCCUPATION_TYPE", "POS_COUNT", "CC_COUNT"]


@query("column_profile", profile_sql("base_clients", PROFILED))
def _(t: Tables) -> DataFrame:
    # types, extremes and approximate distinct counts are covered by the unit tests
    return rounded(portfolio.column_profile(t.base_clients.select(*PROFILED), 5).select(
        "column_name", "n_null", "n_rows", "null_rate"), 9)


@query("column_extremes", """
SELECT 'l_quantity' AS column_name, 'double' AS column_type, CAST(min(l_quantity) AS VARCHAR) AS min_value, CAST(max(l_quantity) AS VARCHAR) AS max_value FROM lineitem
UNION ALL SELECT 'l_returnflag', 'string', min(l_returnflag), max(l_returnflag) FROM lineitem
UNION ALL SELECT 'l_partkey', 'bigint', CAST(min(l_partkey) AS VARCHAR), CAST(max(l_partkey) AS VARCHAR) FROM lineitem
""")
def _(t: Tables) -> DataFrame:
    return portfolio.column_profile(t.lineitem.select("l_quantity", "l_returnflag", "l_partkey")).select(
        "column_name", "column_type", "min_value", "max_value")


@query("column_moments", " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, round(avg({c}), 6) AS avg, round(stddev_samp({c}), 6) AS std FROM lineitem"
    for c in ("l_quantity", "l_extendedprice", "l_discount", "l_tax")))
def _(t: Tables) -> DataFrame:
    profile = portfolio.column_profile(t.lineitem.select("l_quantity", "l_extendedprice", "l_discount", "l_tax"))
    return rounded(profile.select("column_name", "avg", "std"), 6)


@query("missing_report", f"""
WITH p AS ({profile_sql("base_clients", PROFILED)})
SELECT column_name, null_rate, CAST(count(CASE WHEN null_rate > 0 THEN 1 END) OVER () AS BIGINT) AS columns_with_missing
FROM p ORDER BY null_rate DESC, column_name LIMIT 6
""")
def _(t: Tables) -> DataFrame:
    profile = portfolio.column_profile(t.base_clients.select(*PROFILED))
    return rounded(portfolio.missing_report(profile, 6).select("column_name", "null_rate", "columns_with_missing"), 9)


@query("missing_report_by_prefix", f"""
WITH p AS ({profile_sql("base_clients", PROFILED)})
SELECT column_name, null_rate FROM p WHERE column_name LIKE 'EXT#_%' ESCAPE '#' AND null_rate >= 0.1
""")
def _(t: Tables) -> DataFrame:
    profile = portfolio.column_profile(t.base_clients.select(*PROFILED))
    return rounded(portfolio.missing_report(profile, 30, "EXT_", 0.1).select("column_name", "null_rate"), 9)


@query("row_granularity", """
SELECT count(*) AS n_rows, count(DISTINCT l_orderkey) AS n_keys, count(*) = count(DISTINCT l_orderkey) AS one_row_per_key FROM lineitem
""")
def _(t: Tables) -> DataFrame:
    return portfolio.granularity(t.lineitem, "l_orderkey")


@query("normalised_value_counts", """
SELECT CAST("TARGET" AS VARCHAR) AS value, count(*) AS n, round(count(*) / CAST(sum(count(*)) OVER () AS DOUBLE), 9) AS share FROM base_clients GROUP BY 1
""")
def _(t: Tables) -> DataFrame:
    return rounded(portfolio.value_shares(t.base_clients, K.TARGET), 9)


@query("group_mean_sorted", """
SELECT "NAME_EDUCATION_TYPE" AS education, round(avg("TARGET"), 9) AS mean, count(*) AS n FROM base_clients GROUP BY 1
""")
def _(t: Tables) -> DataFrame:
    return rounded(portfolio.group_means(t.base_clients, "NAME_EDUCATION_TYPE").withColumnRenamed("NAME_EDUCATION_TYPE", "education"), 9)


@query("target_correlations", " UNION ALL ".join(
    f"""SELECT '{c}' AS column_name, round(corr("{c}", "TARGET"), 9) AS correlation, round(avg(CASE WHEN "{c}" IS NULL THEN 1e0 ELSE 0e0 END), 9) AS null_rate FROM base_clients"""
    for c in ("EXT_SOURCE_1", "EXT_SOURCE_2", "DAYS_BIRTH", "AMT_INCOME_TOTAL", "PREV_COUNT")))
def _(t: Tables) -> DataFrame:
    return rounded(portfolio.target_correlations(
        t.base_clients, ["EXT_SOURCE_1", "EXT_SOURCE_2", "DAYS_BIRTH", "AMT_INCOME_TOTAL", "PREV_COUNT"]), 9)


@query("decision_distribution", """
SELECT CASE WHEN proba_champion < 0.09e0 - 0.05e0 / 2 THEN 'APROVAR' WHEN proba_champion >= 0.09e0 + 0.05e0 / 2 THEN 'NEGAR' ELSE 'REVISAR' END AS decision,
 count(*) AS n, round(count(*) / CAST(sum(count(*)) OVER () AS DOUBLE), 9) AS pct FROM scores GROUP BY 1
""")
def _(t: Tables) -> DataFrame:
    return rounded(portfolio.decision_distribution(t.scores, THRESHOLD), 9)


@query("portfolio_percentile", """
SELECT "SK_ID_CURR" AS id, proba_champion AS score, round(cume_dist() OVER (ORDER BY proba_champion), 9) AS percentile FROM scores
""")
def _(t: Tables) -> DataFrame:
    out = portfolio.score_percentiles(t.scores)
    return out.select(F.col("SK_ID_CURR").alias("id"), F.col("proba_champion").alias("score"), F.round("percentile", 9).alias("percentile"))


IMPORTANCE = """i AS (SELECT CASE p_partkey % 4 WHEN 0 THEN 'BUREAU_BB_' WHEN 1 THEN 'PREV_' WHEN 2 THEN 'INST_' ELSE 'AMT_' END || p_brand AS feature,
 sum(p_size) AS importance FROM part GROUP BY 1)"""
SOURCE_CASE = """CASE WHEN feature LIKE 'BUREAU#_BB#_%' ESCAPE '#' THEN 'BUREAU_BALANCE' WHEN feature LIKE 'PREV#_%' ESCAPE '#' THEN 'PREV'
 WHEN feature LIKE 'INST#_%' ESCAPE '#' THEN 'INST' ELSE 'application' END"""


def importance_input(t: Tables) -> DataFrame:
    prefix = F.element_at(F.array(*[F.lit(p) for p in ("BUREAU_BB_", "PREV_", "INST_", "AMT_")]), (F.col("p_partkey") % 4 + 1).cast("int"))
    return t.part.groupBy(F.concat(prefix, "p_brand").alias("feature")).agg(F.sum("p_size").cast("double").alias("importance"))


@query("importance_ranking", f"""
WITH {IMPORTANCE} SELECT feature, CAST(importance AS DOUBLE) AS importance, round(importance / CAST(sum(importance) OVER () AS DOUBLE), 9) AS importance_pct,
 {SOURCE_CASE} AS source_table, CAST(row_number() OVER (ORDER BY importance DESC, feature) AS INTEGER) AS rank FROM i
""")
def _(t: Tables) -> DataFrame:
    return rounded(portfolio.importance_ranking(importance_input(t)), 9)


@query("importance_by_source", f"""
WITH {IMPORTANCE} SELECT {SOURCE_CASE} AS source_table, round(sum(importance) / CAST((SELECT sum(importance) FROM i) AS DOUBLE), 9) AS importance_pct, count(*) AS n_features FROM i GROUP BY 1
""")
def _(t: Tables) -> DataFrame:
    return rounded(portfolio.importance_by_source(portfolio.importance_ranking(importance_input(t))), 9)


@query("top_features", f"WITH {IMPORTANCE} SELECT feature, CAST(importance AS DOUBLE) AS importance FROM i ORDER BY importance DESC, feature LIMIT 20")
def _(t: Tables) -> DataFrame:
    return portfolio.importance_ranking(importance_input(t)).orderBy("rank").limit(20).select("feature", "importance")


# ---------------------------------------------------------------- paging


@query("sorted_page_descending", """
SELECT "SK_ID_CURR" AS id, proba_champion AS score FROM clients ORDER BY proba_champion DESC NULLS LAST, "SK_ID_CURR" LIMIT 50 OFFSET 100
""")
def _(t: Tables) -> DataFrame:
    return portfolio.page(t.clients, 3, 50, K.SCORE, ascending=False).select(F.col("SK_ID_CURR").alias("id"), F.col(K.SCORE).alias("score"))


@query("deep_sorted_page", """
SELECT o_orderkey AS id, o_totalprice AS price FROM orders ORDER BY o_totalprice DESC NULLS LAST, o_orderkey LIMIT 40 OFFSET 12000
""")
def _(t: Tables) -> DataFrame:
    listing = t.orders.select("o_orderkey", "o_totalprice")
    return portfolio.page(listing, 301, 40, "o_totalprice", ascending=False, key="o_orderkey").select(
        F.col("o_orderkey").alias("id"), F.col("o_totalprice").alias("price"))


@query("page_sorted_by_text", """
SELECT o_orderkey AS id, o_orderpriority AS priority FROM orders ORDER BY o_orderpriority ASC NULLS LAST, o_orderkey LIMIT 30 OFFSET 300
""")
def _(t: Tables) -> DataFrame:
    listing = t.orders.select("o_orderkey", "o_orderpriority")
    return portfolio.page(listing, 11, 30, "o_orderpriority", key="o_orderkey").select(
        F.col("o_orderkey").alias("id"), F.col("o_orderpriority").alias("priority"))


@query("deep_page_sorted_by_text", """
SELECT p.l_orderkey AS id, p.l_linenumber AS line, concat_ws('/', o_orderpriority, l_returnflag, l_shipdate) AS name FROM lineitem p JOIN orders ON l_orderkey = o_orderkey
ORDER BY name DESC, id * 10 + line LIMIT 50 OFFSET 25000
""")
def _(t: Tables) -> DataFrame:
    both = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
    name = F.concat_ws("/", "o_orderpriority", "l_returnflag", F.col("l_shipdate").cast("string"))
    listing = both.select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("key"), name.alias("name"), "l_orderkey", "l_linenumber")
    return portfolio.page(listing, 501, 50, "name", ascending=False, key="key").select(
        F.col("l_orderkey").alias("id"), F.col("l_linenumber").alias("line"), "name")


@query("deep_page_sorted_by_time", """
SELECT user_id, ts, value FROM events ORDER BY ts ASC NULLS LAST, event_id LIMIT 40 OFFSET 5000
""")
def _(t: Tables) -> DataFrame:
    return portfolio.page(t.events, 126, 40, "ts", key="event_id").select("user_id", "ts", "value")


@query("sorted_page_ascending", """
SELECT "SK_ID_CURR" AS id, "AGE_YEARS" AS age FROM clients WHERE "CODE_GENDER" = 'M' ORDER BY "AGE_YEARS" ASC NULLS LAST, "SK_ID_CURR" LIMIT 25 OFFSET 0
""")
def _(t: Tables) -> DataFrame:
    df = filters.ClientFilters(gender="M").apply(t.clients)
    return portfolio.page(df, 1, 25, "AGE_YEARS").select(F.col("SK_ID_CURR").alias("id"), F.col("AGE_YEARS").alias("age"))


@query("page_metadata", """
SELECT count(*) AS total, 3 AS page, 50 AS page_size, CAST(ceil(count(*) / 50e0) AS BIGINT) AS total_pages,
 3 < ceil(count(*) / 50e0) AS has_next, true AS has_prev FROM clients WHERE "AGE_YEARS" <= 40
""")
def _(t: Tables) -> DataFrame:
    return portfolio.page_meta(filters.ClientFilters(age_max=40).apply(t.clients), 3, 50)


# ---------------------------------------------------------------- positions


@query("octiles_of_rank", """
WITH r AS (SELECT "SK_ID_CURR" AS id, row_number() OVER (ORDER BY "EXT_SOURCE_MEAN", "SK_ID_CURR") AS r, count(*) OVER () AS n FROM clients WHERE "EXT_SOURCE_MEAN" IS NOT NULL)
SELECT id, CAST(greatest(ceil((r - 1) * 8 / CAST(n - 1 AS DOUBLE)), 1) - 1 AS INTEGER) AS octile FROM r
""")
def _(t: Tables) -> DataFrame:
    kept = t.clients.filter(F.col("EXT_SOURCE_MEAN").isNotNull())
    return ranking.octiles(kept, "EXT_SOURCE_MEAN", K.ID).select(F.col(K.ID).alias("id"), "octile")


@query("cumulative_value_shares", """
WITH c AS (SELECT l_quantity AS value, count(*) AS n FROM lineitem GROUP BY 1)
SELECT value, n, CAST(sum(n) OVER (ORDER BY value ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS upto FROM c
""")
def _(t: Tables) -> DataFrame:
    cells = ranking.value_cells(t.lineitem, "l_quantity")
    ranked = ranking.running_sums(cells, "l_quantity", ["n"])
    return ranked.select(F.col("l_quantity").alias("value"), "n", (F.col("below_n") + F.col("n")).alias("upto"))


@query("evenly_spaced_rows", """
WITH c AS (SELECT DISTINCT l_extendedprice AS price FROM lineitem), r AS (SELECT price, row_number() OVER (ORDER BY price) - 1 AS i, count(*) OVER () AS n FROM c)
SELECT price, i AS position FROM r WHERE n <= 300 OR i IN (SELECT CAST(floor(k * (n - 1) / 299) AS BIGINT) FROM range(300) x(k), (SELECT DISTINCT n FROM r))
""")
def _(t: Tables) -> DataFrame:
    cells = ranking.value_cells(t.lineitem, "l_extendedprice", one=F.lit(1).cast("long") * F.max(F.lit(1)))
    ranked = ranking.running_sums(cells, "l_extendedprice", ["one"])
    kept = ranked.filter(ranking.evenly_spaced(F.col("below_one"), F.col("total_one"), 300))
    return kept.select(F.col("l_extendedprice").alias("price"), F.col("below_one").alias("position"))


# ---------------------------------------------------------------- the whole feature table


def application_base(t: Tables) -> DataFrame:
    """Application columns alone: the history counts come from the build itself."""
    return t.base_clients.drop("BUREAU_COUNT", "PREV_COUNT", "INST_COUNT", "POS_COUNT", "CC_COUNT")


def whole_feature_table(t: Tables) -> DataFrame:
    previous = t.bureau.withColumnRenamed("SK_ID_BUREAU", "SK_ID_PREV").select(
        "SK_ID_CURR", "SK_ID_PREV", "amt", "active", "kind", "DAYS_DECISION")
    histories = [
        feature_table.History(previous, "PREV", ("active", "kind"), ("DAYS_DECISION", 24)),
        feature_table.History(
            t.instalments, "INST", (), ("DAYS_INSTALMENT", 12), prepare=features.add_payment_behaviour),
        feature_table.History(t.pos_cash, "POS", ("NAME_CONTRACT_STATUS",), ("MONTHS_BALANCE", 12)),
        feature_table.History(
            t.credit_card, "CC", ("NAME_CONTRACT_STATUS",), ("MONTHS_BALANCE", 12), prepare=features.add_limit_use),
    ]
    return feature_table.build(
        application_base(t), histories, (t.bureau.drop("DAYS_DECISION"), t.bureau_balance),
        bureau_categories=("active",), balance_categories=("status",),
        ids=t.customer.select(F.col("c_custkey").alias("SK_ID_CURR")))


@query("feature_table", """
WITH cap AS (SELECT quantile_cont("AMT_INCOME_TOTAL", 0.999) AS c FROM base_clients),
 p AS (SELECT "SK_ID_CURR", count(*) AS n, avg(amt) AS mean_amt, avg(CASE WHEN active = 'F' THEN 1e0 ELSE 0e0 END) AS f FROM bureau GROUP BY 1),
 pr AS (SELECT "SK_ID_CURR", count(*) AS n, max(amt) AS max_amt FROM bureau WHERE "DAYS_DECISION" >= -720 GROUP BY 1),
 i AS (SELECT "SK_ID_CURR", count(*) AS n, sum(CASE WHEN "DAYS_ENTRY_PAYMENT" > "DAYS_INSTALMENT" THEN 1 ELSE 0 END) AS late, max(greatest("DAYS_ENTRY_PAYMENT" - "DAYS_INSTALMENT", CASE WHEN "DAYS_ENTRY_PAYMENT" IS NOT NULL THEN 0 END)) AS dpd FROM instalments GROUP BY 1),
 g AS (SELECT "SK_ID_BUREAU", count(*) AS n, sum(qty) AS q FROM bureau_balance GROUP BY 1),
 b AS (SELECT "SK_ID_CURR", count(*) AS n, CAST(coalesce(sum(g.n), 0) AS BIGINT) AS n_bal, max(g.q) AS max_q FROM bureau LEFT JOIN g USING ("SK_ID_BUREAU") GROUP BY 1)
SELECT c."SK_ID_CURR" AS id, p.n AS prev_count, round(p.mean_amt, 6) AS prev_mean, round(p.f, 9) AS prev_f_share, pr.n AS prev_recent, round(pr.max_amt, 6) AS prev_recent_max,
 i.n AS inst_count, CAST(i.late AS BIGINT) AS n_late, CAST(i.dpd AS BIGINT) AS max_dpd, b.n AS bureau_count, b.n_bal AS n_balances, b.max_q AS max_balance_qty,
 round(c."AMT_CREDIT" / nullif(least(c."AMT_INCOME_TOTAL", CASE WHEN c."AMT_INCOME_TOTAL" IS NOT NULL THEN cap.c END), 0), 9) AS cir,
 CAST(b.n IS NOT NULL AS INTEGER) + CAST(p.n IS NOT NULL AS INTEGER) + CAST(i.n IS NOT NULL AS INTEGER) AS n_sources
FROM cap, base_clients c LEFT JOIN p USING ("SK_ID_CURR") LEFT JOIN pr USING ("SK_ID_CURR") LEFT JOIN i USING ("SK_ID_CURR") LEFT JOIN b USING ("SK_ID_CURR")
""")
def _(t: Tables) -> DataFrame:
    wide = whole_feature_table(t)
    return wide.select(
        F.col("SK_ID_CURR").alias("id"), F.col("PREV_COUNT").alias("prev_count"), F.round("PREV_AMT_MEAN", 6).alias("prev_mean"),
        F.round("PREV_ACTIVE_F_MEAN", 9).alias("prev_f_share"), F.col("PREV_R24_COUNT").alias("prev_recent"),
        F.round("PREV_R24_AMT_MAX", 6).alias("prev_recent_max"), F.col("INST_COUNT").alias("inst_count"),
        F.col("INST_LATE_FLAG_SUM").cast("long").alias("n_late"), F.col("INST_DPD_MAX").cast("long").alias("max_dpd"),
        F.col("BUREAU_COUNT").alias("bureau_count"), F.col("BUREAU_BB_COUNT_SUM").alias("n_balances"),
        F.col("BUREAU_BB_QTY_SUM_MAX").alias("max_balance_qty"), F.round("CREDIT_INCOME_RATIO", 9).alias("cir"),
        # of the three sources that the SQL counts; all five are in feature_table_other_columns
        (F.col("HAS_BUREAU") + F.col("HAS_PREV") + F.col("HAS_INST")).cast("int").alias("n_sources"))


def numeric_sql(prefix: str, columns: dict[str, str]) -> dict[str, str]:
    """Output column -> aggregate, for every column (name -> expression) under every function, and the row count."""
    out = {}
    for c, x in columns.items():
        for func, text in (("MEAN", "avg({0})"), ("SUM", "coalesce(sum({0}), 0)"), ("MAX", "max({0})"), ("MIN", "min({0})"), ("COUNT", "count({0})")):
            out[f"{prefix}_{c}_{func}"] = text.format(x)
    return out | {f"{prefix}_COUNT": "count(*)"}


def category_sql(prefix: str, c: str, x: str, values: dict[str, str]) -> dict[str, str]:
    """Hits per frequent value (label -> value) and for all others."""
    inside = ", ".join(f"'{v}'" for v in values.values())
    tests = {label: f"{x} = '{v}'" for label, v in values.items()} | {"OUTROS": f"coalesce({x} NOT IN ({inside}), true)"}
    out = {}
    for label, test in tests.items():
        hit = f"CASE WHEN {test} THEN 1e0 ELSE 0e0 END"
        out |= {f"{prefix}_{c}_{label}_SUM": f"sum({hit})", f"{prefix}_{c}_{label}_MEAN": f"avg({hit})"}
    return out


def wide_digest_sql() -> str:
    statuses = {v: v for v in "NRA"}
    active = category_sql("BUREAU", "ACTIVE", "active", {v: v for v in "OPF"})
    kinds = {"3_MEDIUM": "3-MEDIUM", "2_HIGH": "2-HIGH", "4_NOT_SPECIFIED": "4-NOT SPECIFIED", "5_LOW": "5-LOW", "1_URGENT": "1-URGENT"}
    previous = {"AMT": "amt", "DAYS_DECISION": '"DAYS_DECISION"'}
    delay = '("DAYS_ENTRY_PAYMENT" - "DAYS_INSTALMENT")'
    paid = {c: f'"{c}"' for c in ("AMT_INSTALMENT", "AMT_PAYMENT", "DAYS_ENTRY_PAYMENT", "DAYS_INSTALMENT")} | {
        "PAYMENT_RATIO": '"AMT_PAYMENT" / nullif("AMT_INSTALMENT", 0)', "PAYMENT_DIFF": '"AMT_INSTALMENT" - "AMT_PAYMENT"',
        "DPD": f"CASE WHEN {delay} IS NOT NULL THEN greatest({delay}, 0) END", "DBD": f"CASE WHEN {delay} IS NOT NULL THEN greatest(-{delay}, 0) END",
        "LATE_FLAG": f"CASE WHEN {delay} > 0 THEN 1e0 ELSE 0e0 END"}
    balance = numeric_sql("BB", {"QTY": "qty"}) | category_sql("BB", "STATUS", "status", statuses)
    loans = numeric_sql("BUREAU", {"AMT": "amt"} | {c: f'"{c}"' for c in balance}) | active
    parts = {
        "bur": (loans, 'bureau LEFT JOIN bal USING ("SK_ID_BUREAU")'),
        "prev": (numeric_sql("PREV", previous) | category_sql("PREV", "ACTIVE", "active", {v: v for v in "OPF"}) | category_sql("PREV", "KIND", "kind", kinds), "bureau"),
        "prev24": (numeric_sql("PREV_R24", previous), 'bureau WHERE "DAYS_DECISION" >= -720'),
        "inst": (numeric_sql("INST", paid), "instalments"),
        "inst12": (numeric_sql("INST_R12", paid), 'instalments WHERE "DAYS_INSTALMENT" >= -360'),
    }

    def listed(columns: dict[str, str]) -> str:
        return ", ".join(f'{x} AS "{c}"' for c, x in columns.items())

    ctes = [f'bal AS (SELECT "SK_ID_BUREAU", {listed(balance)} FROM bureau_balance GROUP BY 1)']
    ctes += [f'{name} AS (SELECT "SK_ID_CURR", {listed(columns)} FROM {source} GROUP BY 1)' for name, (columns, source) in parts.items()]
    rows = [
        f"""SELECT '{c}' AS column_name, count("{c}") AS n_filled, round(avg(CAST("{c}" AS DOUBLE)), 6) AS mean, round(min(CAST("{c}" AS DOUBLE)), 6) AS low, round(max(CAST("{c}" AS DOUBLE)), 6) AS high
        FROM {name} WHERE "SK_ID_CURR" IN (SELECT "SK_ID_CURR" FROM base_clients)"""
        for name, (columns, _source) in parts.items() for c in columns
    ]
    return f"WITH {', '.join(ctes)} {' UNION ALL '.join(rows)}"


HISTORY_PREFIXES = ("BUREAU", "PREV", "INST")


def column_digest(wide: DataFrame, names: list[str]) -> DataFrame:
    """Filled rows, mean, minimum and maximum per column; of a text column, those of its length."""
    text = set(cleaning.string_columns(wide))
    aggs = []
    for c in names:
        x = (F.length(c) if c in text else F.col(c)).cast("double")
        aggs.append(F.struct(F.lit(c).alias("column_name"), F.count(x).alias("n_filled"), F.round(F.avg(x), 6).alias("mean"),
                             F.round(F.min(x), 6).alias("low"), F.round(F.max(x), 6).alias("high")).alias(c))
    return wide.agg(*aggs).select(F.explode(F.array(*names)).alias("d")).select("d.*")


@query("feature_table_every_column", wide_digest_sql())
def _(t: Tables) -> DataFrame:
    wide = whole_feature_table(t)
    return column_digest(wide, [c for c in wide.columns if c.split("_")[0] in HISTORY_PREFIXES])


def other_digest_sql() -> str:
    """The same figures for all columns that ``wide_digest_sql`` does not state: POS, CC, base and derived ones."""
    pos = {c: f'"{c}"' for c in ("MONTHS_BALANCE", "CNT_INSTALMENT", "CNT_INSTALMENT_FUTURE", "SK_DPD")}
    amounts = ("AMT_BALANCE", "AMT_DRAWINGS_CURRENT", "AMT_CREDIT_LIMIT_ACTUAL")
    cards = {c: f'"{c}"' for c in ("MONTHS_BALANCE", *amounts, "SK_DPD")} | {
        "UTILIZATION": '"AMT_BALANCE" / nullif("AMT_CREDIT_LIMIT_ACTUAL", 0)',
        "DRAWING_RATIO": '"AMT_DRAWINGS_CURRENT" / nullif("AMT_CREDIT_LIMIT_ACTUAL", 0)'}
    status = "NAME_CONTRACT_STATUS"
    parts = {
        "pos": (numeric_sql("POS", pos) | category_sql("POS", status, f'"{status}"', {v: v for v in "OF"}), "pos_cash"),
        "pos12": (numeric_sql("POS_R12", pos), 'pos_cash WHERE "MONTHS_BALANCE" >= -12'),
        "cc": (numeric_sql("CC", cards) | category_sql("CC", status, f'"{status}"', {v: v for v in "NRA"}), "credit_card"),
        "cc12": (numeric_sql("CC_R12", cards), 'credit_card WHERE "MONTHS_BALANCE" >= -12'),
    }
    numbers = (
        "SK_ID_CURR TARGET DAYS_BIRTH DAYS_EMPLOYED DAYS_REGISTRATION DAYS_ID_PUBLISH DAYS_LAST_PHONE_CHANGE CNT_CHILDREN "
        "CNT_FAM_MEMBERS AMT_CREDIT AMT_ANNUITY AMT_GOODS_PRICE EXT_SOURCE_1 EXT_SOURCE_2 EXT_SOURCE_3").split()
    texts = (
        "CODE_GENDER NAME_EDUCATION_TYPE NAME_CONTRACT_TYPE NAME_INCOME_TYPE NAME_FAMILY_STATUS NAME_HOUSING_TYPE "
        "OCCUPATION_TYPE ORGANIZATION_TYPE FLAG_OWN_CAR FLAG_OWN_REALTY").split()
    income = 'least("AMT_INCOME_TOTAL", CASE WHEN "AMT_INCOME_TOTAL" IS NOT NULL THEN cap.c END)'
    ratios = {
        "CREDIT_INCOME_RATIO": ('"AMT_CREDIT"', income), "ANNUITY_INCOME_RATIO": ('"AMT_ANNUITY"', income),
        "CREDIT_TERM": ('"AMT_ANNUITY"', '"AMT_CREDIT"'), "EMPLOYED_AGE_RATIO": ('"DAYS_EMPLOYED"', '"DAYS_BIRTH"'),
        "REGISTRATION_AGE_RATIO": ('"DAYS_REGISTRATION"', '"DAYS_BIRTH"'),
        "ID_PUBLISH_AGE_RATIO": ('"DAYS_ID_PUBLISH"', '"DAYS_BIRTH"'),
        "PHONE_CHANGE_AGE_RATIO": ('"DAYS_LAST_PHONE_CHANGE"', '"DAYS_BIRTH"'),
        "INCOME_PER_PERSON": (income, '"CNT_FAM_MEMBERS"'), "CREDIT_GOODS_RATIO": ('"AMT_CREDIT"', '"AMT_GOODS_PRICE"')}
    values = '(VALUES ("EXT_SOURCE_1"), ("EXT_SOURCE_2"), ("EXT_SOURCE_3")) e(x)'
    stats = {"MEAN": "avg(x)", "MAX": "max(x)", "MIN": "min(x)", "STD": "stddev_samp(x)"}
    flags = {"HAS_BUREAU": "b", "HAS_PREV": "b", "HAS_POS": "p", "HAS_CC": "k", "HAS_INST": "i"}
    hits = {n: f'CAST({a}."SK_ID_CURR" IS NOT NULL AS INTEGER)' for n, a in flags.items()}
    inner = " + ".join(hits[n] for n in ("HAS_PREV", "HAS_POS", "HAS_CC", "HAS_INST"))
    own = {c: f'c."{c}"' for c in numbers} | {c: f'length(c."{c}")' for c in texts} | {"AMT_INCOME_TOTAL": income}
    own |= {n: f"{x} / nullif(CAST({y} AS DOUBLE), 0)" for n, (x, y) in ratios.items()}
    own |= {n: f'round_even(-"{d}" / 365.25e0, 1)' for n, d in (("AGE_YEARS", "DAYS_BIRTH"), ("YEARS_EMPLOYED", "DAYS_EMPLOYED"))}
    own |= {f"EXT_SOURCE_{n}": f"(SELECT {x} FROM {values})" for n, x in stats.items()} | {
        "EXT_SOURCE_PROD": '"EXT_SOURCE_1" * "EXT_SOURCE_2" * "EXT_SOURCE_3"', "N_EXT_SOURCE_PRESENT": f"(SELECT count(x) FROM {values})"}
    own |= hits | {
        "N_INTERNAL_SOURCES": inner, "N_SOURCES": f"{hits['HAS_BUREAU']} + {inner}",
        "NO_HISTORY": f"CAST({hits['HAS_BUREAU']} + {inner} = 0 AS INTEGER)"}

    def listed(columns: dict[str, str]) -> str:
        return ", ".join(f'{x} AS "{c}"' for c, x in columns.items())

    keys = {"b": "bureau", "p": "pos_cash", "k": "credit_card", "i": "instalments"}
    joins = " ".join(
        f'LEFT JOIN (SELECT DISTINCT "SK_ID_CURR" FROM {source}) {a} ON {a}."SK_ID_CURR" = c."SK_ID_CURR"' for a, source in keys.items())
    ctes = ['cap AS (SELECT quantile_cont("AMT_INCOME_TOTAL", 0.999) AS c FROM base_clients)']
    ctes += [f"own AS (SELECT {listed(own)} FROM cap, base_clients c {joins})"]
    ctes += [f'{name} AS (SELECT "SK_ID_CURR", {listed(columns)} FROM {source} GROUP BY 1)' for name, (columns, source) in parts.items()]
    rows = [
        f"""SELECT '{c}' AS column_name, count("{c}") AS n_filled, round(avg(CAST("{c}" AS DOUBLE)), 6) AS mean, round(min(CAST("{c}" AS DOUBLE)), 6) AS low, round(max(CAST("{c}" AS DOUBLE)), 6) AS high
        FROM {name} WHERE "SK_ID_CURR" IN (SELECT "SK_ID_CURR" FROM base_clients)"""
        for name, columns in [("own", own), *((n, p[0]) for n, p in parts.items())] for c in columns
    ]
    return f"WITH {', '.join(ctes)} {' UNION ALL '.join(rows)}"


@query("feature_table_other_columns", other_digest_sql())
def _(t: Tables) -> DataFrame:
    wide = whole_feature_table(t)
    return column_digest(wide, [c for c in wide.columns if c.split("_")[0] not in HISTORY_PREFIXES])


@query("feature_table_written", "SELECT count(*) AS n_rows, count(*) AS n_keys, true AS one_row_per_key FROM customer")
def _(t: Tables) -> DataFrame:
    path = writers.write_parquet(whole_feature_table(t), scratch_path(t.spark, "features"))
    return portfolio.granularity(readers.read_parquet(t.spark, path))
