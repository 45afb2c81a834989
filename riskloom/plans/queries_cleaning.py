"""Queries for sources, cleaning, derived columns, bands, filters and joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.functions import columns as C
from riskloom.functions import constants as K
from riskloom.operators import aggregation, cleaning, features, filters, portfolio, ranking, sets
from riskloom.plans.registry import Tables, query


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles rounded, so float summation order does not show in the checks."""
    kinds = dict(df.dtypes)
    return df.select(
        *[
            (F.round(c, digits) + F.lit(0.0)).alias(c) if kinds[c] in ("double", "float") else F.col(c)
            for c in df.columns
        ]
    )


AGE_CASE = """CASE WHEN "AGE_YEARS" IS NULL THEN 'desconhecido' WHEN "AGE_YEARS" < 25 THEN '<25'
 WHEN "AGE_YEARS" < 35 THEN '25-35' WHEN "AGE_YEARS" < 45 THEN '35-45' WHEN "AGE_YEARS" < 55 THEN '45-55'
 WHEN "AGE_YEARS" < 65 THEN '55-65' ELSE '65+' END"""
THRESHOLD = 0.09


def rate_sql(expr: str, where: str = "TRUE", min_count: int = 30, order: str = "default_rate DESC NULLS LAST", limit: int | None = None) -> str:
    return f"""
    WITH f AS (SELECT * FROM clients WHERE {where}),
    g AS (SELECT CAST({expr} AS VARCHAR) AS value, count(*) AS n,
                 count(CASE WHEN "TARGET" = 1 THEN 1 END) AS defaults,
                 round(avg("TARGET"), 9) AS default_rate, round(avg(proba_champion), 9) AS avg_score,
                 round(avg(CASE WHEN proba_champion < 0.09e0 THEN 1e0 WHEN proba_champion IS NULL THEN NULL ELSE 0e0 END), 9) AS approval_rate,
                 round((SELECT avg("TARGET") FROM f), 9) AS overall_default_rate,
                 round(avg("TARGET") / nullif((SELECT avg("TARGET") FROM f), 0), 9) AS lift
          FROM f GROUP BY 1 HAVING count(*) >= {min_count})
    SELECT * FROM g ORDER BY {order}, value ASC NULLS LAST {"" if limit is None else f"LIMIT {limit}"}
    """


@query("default_rate_by_age_band", rate_sql(AGE_CASE))
def _(t: Tables) -> DataFrame:
    return rounded(portfolio.default_rate(t.clients, "age_band", THRESHOLD), 9)


@query("default_rate_by_education_filtered", rate_sql(
    '"NAME_EDUCATION_TYPE"', '"BUREAU_COUNT" IS NULL AND "AGE_YEARS" <= 50', 20, "n DESC"))
def _(t: Tables) -> DataFrame:
    spec = filters.ClientFilters(thin_file=True, age_max=50)
    return rounded(portfolio.default_rate(
        spec.apply(t.clients, THRESHOLD), "education", THRESHOLD, 20, "n"), 9)


@query("default_rate_sorted_by_value", rate_sql(
    'CAST(least("CNT_CHILDREN", 5) AS INTEGER)', "TRUE", 1, "value ASC", 3))
def _(t: Tables) -> DataFrame:
    return rounded(portfolio.default_rate(t.clients, "children", THRESHOLD, 1, "value", 3), 9)


# ---------------------------------------------------------------- cleaning


@query("sentinel_to_null", """
SELECT c_custkey, nullif(c_nationkey, 7) AS nation, nullif(c_mktsegment, 'MACHINERY') AS segment FROM customer
""")
def _(t: Tables) -> DataFrame:
    df = t.customer.select("c_custkey", F.col("c_nationkey").alias("nation"), F.col("c_mktsegment").alias("segment"))
    return cleaning.null_values(df, {"nation": 7, "segment": "MACHINERY"})


@query("invalid_category_to_null", """
SELECT "SK_ID_CURR" AS id, CASE WHEN "CODE_GENDER" <> 'F' THEN "CODE_GENDER" END AS gender FROM clients
""")
def _(t: Tables) -> DataFrame:
    return cleaning.null_values(t.clients, {"CODE_GENDER": "F"}).select(
        F.col("SK_ID_CURR").alias("id"), F.col("CODE_GENDER").alias("gender"))


@query("cap_upper_tail", """
SELECT o_orderkey, round(least(o_totalprice, (SELECT quantile_cont(o_totalprice, 0.999) FROM orders)), 4) AS price
FROM orders
""")
def _(t: Tables) -> DataFrame:
    df = t.orders.select("o_orderkey", F.col("o_totalprice").alias("price"))
    return rounded(cleaning.cap_upper_tail(df, "price"), 4)


@query("days_to_years", """
SELECT "SK_ID_CURR" AS id, round_even(-"DAYS_BIRTH" / 365.25e0, 1) + 0e0 AS age,
       round_even(-"DAYS_EMPLOYED" / 365.25e0, 1) + 0e0 AS employed FROM base_clients
""")
def _(t: Tables) -> DataFrame:
    return cleaning.add_years(t.base_clients).select(
        F.col("SK_ID_CURR").alias("id"), F.col("AGE_YEARS").alias("age"), F.col("YEARS_EMPLOYED").alias("employed"))


@query("trim_strings", """
SELECT c_custkey, trim('  ' || c_mktsegment || ' ') AS segment, trim(c_name) AS name FROM customer
""")
def _(t: Tables) -> DataFrame:
    padded = t.customer.select(
        "c_custkey", F.concat(F.lit("  "), "c_mktsegment", F.lit(" ")).alias("segment"), F.col("c_name").alias("name"))
    return cleaning.trim_strings(padded)


@query("sanitize_client_table", """
WITH src AS (SELECT "SK_ID_CURR", nullif("DAYS_EMPLOYED", -5000) AS de, "DAYS_BIRTH", "AMT_INCOME_TOTAL",
                    nullif("CODE_GENDER", 'XNA') AS g FROM base_clients)
SELECT "SK_ID_CURR" AS id, g AS gender,
       round(least("AMT_INCOME_TOTAL", CASE WHEN "AMT_INCOME_TOTAL" IS NOT NULL THEN (SELECT quantile_cont("AMT_INCOME_TOTAL", 0.999) FROM src) END), 4) AS income,
       round_even(-"DAYS_BIRTH" / 365.25e0, 1) + 0e0 AS age, round_even(-de / 365.25e0, 1) + 0e0 AS employed
FROM src
""")
def _(t: Tables) -> DataFrame:
    df = t.base_clients.withColumn(
        "DAYS_EMPLOYED", F.when(F.col("DAYS_EMPLOYED") == -5000, K.EMPLOYED_SENTINEL).otherwise(F.col("DAYS_EMPLOYED")))
    return cleaning.sanitize(df).select(
        F.col("SK_ID_CURR").alias("id"), F.col("CODE_GENDER").alias("gender"),
        (F.round("AMT_INCOME_TOTAL", 4)).alias("income"),
        F.col("AGE_YEARS").alias("age"), F.col("YEARS_EMPLOYED").alias("employed"))


@query("reproducible_sample", """
SELECT o_orderkey, o_custkey FROM orders
ORDER BY ('0x' || substr(md5(o_orderkey || '|42'), 1, 8))::BIGINT, o_orderkey LIMIT 500
""")
def _(t: Tables) -> DataFrame:
    return cleaning.reproducible_sample(t.orders.select("o_orderkey", "o_custkey"), 500, "o_orderkey")


@query("large_reproducible_sample", """
SELECT l_orderkey, l_linenumber FROM (SELECT l_orderkey, l_linenumber, l_orderkey * 10 + l_linenumber AS k FROM lineitem)
ORDER BY ('0x' || substr(md5(k || '|42'), 1, 8))::BIGINT, k LIMIT 20000
""")
def _(t: Tables) -> DataFrame:
    keyed = t.lineitem.select("l_orderkey", "l_linenumber", (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("k"))
    return cleaning.reproducible_sample(keyed, 20_000, "k").drop("k")


@query("non_finite_to_null", """
SELECT event_id, CASE WHEN event_id % 5 IN (1, 2) THEN NULL ELSE round(value, 6) END AS value FROM events
""")
def _(t: Tables) -> DataFrame:
    k = F.col("event_id") % 5
    dirty = t.events.select("event_id", F.when(k == 1, float("nan")).when(k == 2, float("inf")).otherwise(F.col("value")).alias("value"))
    return rounded(cleaning.nan_to_null(dirty))


@query("numeric_text_columns", """
SELECT 'k_text' AS column_name, count(k_text) AS n_values, count(TRY_CAST(k_text AS DOUBLE)) AS n_numeric,
       count(TRY_CAST(k_text AS DOUBLE)) > 0 AS holds_numbers
FROM (SELECT CAST(user_id AS VARCHAR) AS k_text FROM events)
UNION ALL
SELECT 'event_type', count(event_type), count(TRY_CAST(event_type AS DOUBLE)), count(TRY_CAST(event_type AS DOUBLE)) > 0 FROM events
""")
def _(t: Tables) -> DataFrame:
    return cleaning.numeric_text_report(t.events.select(F.col("user_id").cast("string").alias("k_text"), "event_type"))


@query("clean_column_names", """
SELECT p_partkey, trim(regexp_replace(regexp_replace(upper(trim(p_type || ' (' || p_name || ')')), '[^0-9A-Za-z_]+', '_', 'g'), '_+', '_', 'g'), '_') AS name
FROM part
""")
def _(t: Tables) -> DataFrame:
    raw = F.concat("p_type", F.lit(" ("), "p_name", F.lit(")"))
    return t.part.select("p_partkey", C.clean_name_column(raw).alias("name"))


@query("align_to_model_columns", """
SELECT event_id, TRY_CAST(CASE WHEN event_id % 4 = 0 THEN 'n/a' ELSE CAST(user_id AS VARCHAR) END AS DOUBLE) AS amount,
       CASE WHEN event_type IN ('click', 'purchase') THEN event_type END AS kind, CAST(NULL AS DOUBLE) AS absent
FROM events
""")
def _(t: Tables) -> DataFrame:
    raw = t.events.select(
        "event_id", F.when(F.col("event_id") % 4 == 0, "n/a").otherwise(F.col("user_id").cast("string")).alias("amount"),
        F.col("event_type").alias("kind"))
    return cleaning.align_to_model(raw, ["amount", "absent"], {"kind": ["click", "purchase"]})


@query("payload_quality", """
SELECT event_id, CAST(CASE WHEN event_id % 3 = 0 THEN 1 ELSE 2 END AS INTEGER) AS features_informed, 3 AS features_expected,
       round(CASE WHEN event_id % 3 = 0 THEN 1 ELSE 2 END / 3e0, 6) AS coverage, ['oops'] AS unknown_features
FROM events
""")
def _(t: Tables) -> DataFrame:
    payload = F.create_map(
        F.lit("a"), F.col("value"), F.lit("b"), F.when(F.col("event_id") % 3 != 0, F.col("value")), F.lit("oops"), F.lit(1.0))
    df = cleaning.payload_quality(t.events.withColumn("payload", payload), "payload", ["a", "b", "c"])
    return rounded(df.select("event_id", "features_informed", "features_expected", "coverage", "unknown_features"))


# ---------------------------------------------------------------- derived columns


@query("safe_ratios", """
SELECT "SK_ID_CURR" AS id,
 round("AMT_CREDIT" / nullif("AMT_INCOME_TOTAL", 0), 6) AS credit_income,
 round("AMT_ANNUITY" / nullif("AMT_INCOME_TOTAL", 0), 6) AS annuity_income,
 round("AMT_ANNUITY" / nullif("AMT_CREDIT", 0), 6) AS term,
 round("DAYS_EMPLOYED" / nullif(CAST("DAYS_BIRTH" AS DOUBLE), 0), 6) AS employed_age
FROM base_clients
""")
def _(t: Tables) -> DataFrame:
    df = features.add_ratios(t.base_clients)
    return rounded(df.select(
        F.col("SK_ID_CURR").alias("id"), F.col("CREDIT_INCOME_RATIO").alias("credit_income"),
        F.col("ANNUITY_INCOME_RATIO").alias("annuity_income"), F.col("CREDIT_TERM").alias("term"),
        F.col("EMPLOYED_AGE_RATIO").alias("employed_age")))


@query("age_relative_features", """
SELECT "SK_ID_CURR" AS id,
 round("DAYS_REGISTRATION" / nullif(CAST("DAYS_BIRTH" AS DOUBLE), 0), 6) AS registration,
 round("DAYS_ID_PUBLISH" / nullif(CAST("DAYS_BIRTH" AS DOUBLE), 0), 6) AS id_publish,
 round("DAYS_LAST_PHONE_CHANGE" / nullif(CAST("DAYS_BIRTH" AS DOUBLE), 0), 6) AS phone,
 round("AMT_INCOME_TOTAL" / nullif(CAST("CNT_FAM_MEMBERS" AS DOUBLE), 0), 7) AS per_person,
 round("AMT_CREDIT" / nullif("AMT_GOODS_PRICE", 0), 6) AS credit_goods
FROM base_clients
""")
def _(t: Tables) -> DataFrame:
    df = features.add_ratios(t.base_clients)
    return df.select(
        F.col("SK_ID_CURR").alias("id"),
        (F.round("REGISTRATION_AGE_RATIO", 6) + 0.0).alias("registration"),
        (F.round("ID_PUBLISH_AGE_RATIO", 6) + 0.0).alias("id_publish"),
        (F.round("PHONE_CHANGE_AGE_RATIO", 6) + 0.0).alias("phone"),
        F.round("INCOME_PER_PERSON", 7).alias("per_person"), F.round("CREDIT_GOODS_RATIO", 6).alias("credit_goods"))


@query("external_score_stats", """
WITH u AS (SELECT "SK_ID_CURR" AS id, unnest([1, 2, 3]) AS i, unnest(["EXT_SOURCE_1", "EXT_SOURCE_2", "EXT_SOURCE_3"]) AS x FROM base_clients)
SELECT id, round(avg(x), 6) AS mean, round(max(x), 6) AS max, round(min(x), 6) AS min, round(stddev_samp(x), 6) AS std,
       CASE WHEN count(x) = 3 THEN round(product(x), 6) END AS prod, count(x) AS n
FROM u GROUP BY id
""")
def _(t: Tables) -> DataFrame:
    df = features.add_external_score_stats(t.base_clients)
    return rounded(df.select(
        F.col("SK_ID_CURR").alias("id"), F.col("EXT_SOURCE_MEAN").alias("mean"), F.col("EXT_SOURCE_MAX").alias("max"),
        F.col("EXT_SOURCE_MIN").alias("min"), F.col("EXT_SOURCE_STD").alias("std"), F.col("EXT_SOURCE_PROD").alias("prod"),
        F.col("N_EXT_SOURCE_PRESENT").cast("long").alias("n")))


@query("source_presence_flags", """
SELECT "SK_ID_CURR" AS id, CAST(coalesce("BUREAU_COUNT", 0) > 0 AS INTEGER) AS bureau, CAST(coalesce("PREV_COUNT", 0) > 0 AS INTEGER) AS prev,
 CAST(coalesce("POS_COUNT", 0) > 0 AS INTEGER) + CAST(coalesce("CC_COUNT", 0) > 0 AS INTEGER) + CAST(coalesce("PREV_COUNT", 0) > 0 AS INTEGER)
  + CAST(coalesce("INST_COUNT", 0) > 0 AS INTEGER) AS internal,
 CAST(coalesce("BUREAU_COUNT", 0) + coalesce("PREV_COUNT", 0) = 0 AS INTEGER) AS no_history
FROM base_clients
""")
def _(t: Tables) -> DataFrame:
    df = features.add_presence_flags(t.base_clients)
    return df.select(
        F.col("SK_ID_CURR").alias("id"), F.col("HAS_BUREAU").cast("int").alias("bureau"), F.col("HAS_PREV").cast("int").alias("prev"),
        F.col("N_INTERNAL_SOURCES").cast("int").alias("internal"), F.col("NO_HISTORY").cast("int").alias("no_history"))


@query("payment_behaviour", """
SELECT "SK_ID_PREV" AS loan, count(*) AS n, round(avg("AMT_PAYMENT" / nullif("AMT_INSTALMENT", 0)), 6) AS paid_ratio,
 round(sum("AMT_INSTALMENT" - "AMT_PAYMENT"), 6) AS shortfall,
 CAST(sum(CASE WHEN d IS NOT NULL THEN greatest(d, 0) END) AS BIGINT) AS days_late,
 CAST(sum(CASE WHEN d IS NOT NULL THEN greatest(-d, 0) END) AS BIGINT) AS days_early,
 CAST(sum(CASE WHEN d > 0 THEN 1 ELSE 0 END) AS BIGINT) AS n_late
FROM (SELECT *, "DAYS_ENTRY_PAYMENT" - "DAYS_INSTALMENT" AS d FROM instalments) GROUP BY 1
""")
def _(t: Tables) -> DataFrame:
    df = features.add_payment_behaviour(t.instalments)
    return df.groupBy(F.col("SK_ID_PREV").alias("loan")).agg(
        F.count(F.lit(1)).alias("n"), F.round(F.avg("PAYMENT_RATIO"), 6).alias("paid_ratio"),
        (F.round(F.sum("PAYMENT_DIFF"), 6) + 0.0).alias("shortfall"), F.sum("DPD").alias("days_late"),
        F.sum("DBD").alias("days_early"), F.sum("LATE_FLAG").cast("long").alias("n_late"))


@query("limit_utilisation", """
SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice / nullif(lim, 0) AS used, l_extendedprice * l_discount / nullif(lim, 0) AS drawn
FROM (SELECT *, CASE WHEN l_quantity < 5 THEN 0 ELSE l_quantity * 3000 END AS lim FROM lineitem)
""")
def _(t: Tables) -> DataFrame:
    limit = F.when(F.col("l_quantity") < 5, 0.0).otherwise(F.col("l_quantity") * 3000)
    df = t.lineitem.withColumns({"lim": limit, "drawings": F.col("l_extendedprice") * F.col("l_discount")})
    out = features.add_limit_use(df, "l_extendedprice", "drawings", "lim")
    return out.select("l_orderkey", "l_linenumber", "l_partkey", F.col("UTILIZATION").alias("used"), F.col("DRAWING_RATIO").alias("drawn"))


@query("recompute_derived", """
SELECT "SK_ID_CURR" AS id, round("CREDIT_INCOME_RATIO", 6) AS cir, round("CREDIT_TERM", 6) AS term, "AGE_YEARS" AS age,
       round("EXT_SOURCE_MEAN", 6) AS ext_mean, "N_EXT_SOURCE_PRESENT" AS n_ext FROM clients
""")
def _(t: Tables) -> DataFrame:
    stale = t.clients.withColumns({c: F.lit(-1.0) for c in ("CREDIT_INCOME_RATIO", "CREDIT_TERM", "AGE_YEARS", "EXT_SOURCE_MEAN")})
    df = features.recompute(stale)
    return rounded(df.select(
        F.col("SK_ID_CURR").alias("id"), F.col("CREDIT_INCOME_RATIO").alias("cir"), F.col("CREDIT_TERM").alias("term"),
        F.col("AGE_YEARS").alias("age"), F.col("EXT_SOURCE_MEAN").alias("ext_mean"),
        F.col("N_EXT_SOURCE_PRESENT").cast("int").alias("n_ext")))


@query("apply_changes_what_if", """
SELECT "SK_ID_CURR" AS id, round("AMT_CREDIT" * 1.5e0, 2) AS credit, round("AMT_CREDIT" * 1.5e0 / nullif("AMT_INCOME_TOTAL", 0), 6) AS cir,
       round("AMT_ANNUITY" / nullif("AMT_CREDIT" * 1.5e0, 0), 6) AS term FROM clients
""")
def _(t: Tables) -> DataFrame:
    df = features.apply_changes(t.clients, {"AMT_CREDIT": F.col("AMT_CREDIT") * 1.5})
    return df.select(
        F.col("SK_ID_CURR").alias("id"), F.round("AMT_CREDIT", 2).alias("credit"),
        F.round("CREDIT_INCOME_RATIO", 6).alias("cir"), F.round("CREDIT_TERM", 6).alias("term"))


@query("feature_origin_table", """
SELECT p_partkey, CASE WHEN nm LIKE 'BUREAU#_BB#_%' ESCAPE '#' THEN 'BUREAU_BALANCE' WHEN nm LIKE 'BUREAU#_%' ESCAPE '#' THEN 'BUREAU'
 WHEN nm LIKE 'PREV#_%' ESCAPE '#' THEN 'PREV' WHEN nm LIKE 'INST#_%' ESCAPE '#' THEN 'INST' ELSE 'application' END AS origin
FROM (SELECT p_partkey, CASE p_partkey % 5 WHEN 0 THEN 'BUREAU_BB_' WHEN 1 THEN 'BUREAU_' WHEN 2 THEN 'PREV_' WHEN 3 THEN 'INST_' ELSE 'AMT_' END || p_brand AS nm FROM part)
""")
def _(t: Tables) -> DataFrame:
    prefix = F.element_at(F.array(*[F.lit(p) for p in ("BUREAU_BB_", "BUREAU_", "PREV_", "INST_", "AMT_")]), (F.col("p_partkey") % 5 + 1).cast("int"))
    return t.part.select("p_partkey", C.origin_table(F.concat(prefix, "p_brand")).alias("origin"))


@query("segment_row_weights", f"""
SELECT band, count(*) AS n, round(sum(w), 2) AS weight FROM (
 SELECT {AGE_CASE} AS band, CASE WHEN {AGE_CASE} = '<25' THEN 3e0 WHEN {AGE_CASE} = '55-65' THEN 2e0 ELSE 1e0 END AS w FROM clients) GROUP BY 1
""")
def _(t: Tables) -> DataFrame:
    df = t.clients.select(C.age_band().alias("band"))
    weighted = df.withColumn("w", features.segment_weights("band", {"<25": 3.0, "55-65": 2.0}))
    return weighted.groupBy("band").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("w"), 2).alias("weight"))


# ---------------------------------------------------------------- bands and decisions

DIMENSION_SQL = {
    "gender": '"CODE_GENDER"', "contract_type": '"NAME_CONTRACT_TYPE"', "education": '"NAME_EDUCATION_TYPE"',
    "family_status": '"NAME_FAMILY_STATUS"', "income_type": '"NAME_INCOME_TYPE"', "housing_type": '"NAME_HOUSING_TYPE"',
    "occupation": '"OCCUPATION_TYPE"', "organization": '"ORGANIZATION_TYPE"', "split": "split",
    "target": 'CAST("TARGET" AS VARCHAR)',
    "children": 'CAST(least("CNT_CHILDREN", 5) AS VARCHAR)',
    "age_band": AGE_CASE,
    "income_band": """CASE WHEN "AMT_INCOME_TOTAL" IS NULL THEN 'desconhecido' WHEN "AMT_INCOME_TOTAL" < 100000 THEN 'ate 100k'
      WHEN "AMT_INCOME_TOTAL" < 150000 THEN '100k-150k' WHEN "AMT_INCOME_TOTAL" < 225000 THEN '150k-225k' ELSE '225k+' END""",
    "credit_band": """CASE WHEN "AMT_CREDIT" IS NULL THEN 'desconhecido' WHEN "AMT_CREDIT" < 250000 THEN 'ate 250k'
      WHEN "AMT_CREDIT" < 500000 THEN '250k-500k' WHEN "AMT_CREDIT" < 1000000 THEN '500k-1M' ELSE '1M+' END""",
    "score_band": """CASE WHEN proba_champion IS NULL THEN 'sem score' WHEN proba_champion < 0.05e0 THEN 'A (<5%)'
      WHEN proba_champion < 0.10e0 THEN 'B (5-10%)' WHEN proba_champion < 0.20e0 THEN 'C (10-20%)'
      WHEN proba_champion < 0.35e0 THEN 'D (20-35%)' ELSE 'E (35%+)' END""",
    "thin_file": """CASE WHEN "BUREAU_COUNT" IS NULL THEN 'thin-file (sem bureau)' ELSE 'com historico de bureau' END""",
}


@query("all_dimension_counts", " UNION ALL ".join(
    f"SELECT '{k}' AS dimension, {e} AS grp, count(*) AS n FROM clients GROUP BY 2" for k, e in DIMENSION_SQL.items()))
def _(t: Tables) -> DataFrame:
    named = t.clients.select(*[c.cast("string").alias(k) for k, c in C.dimensions().items()])
    return named.unpivot([], list(C.dimensions()), "dimension", "grp").groupBy("dimension", "grp").agg(F.count(F.lit(1)).alias("n"))


@query("score_band_counts", f"SELECT {DIMENSION_SQL['score_band']} AS band, count(*) AS n FROM clients GROUP BY 1")
def _(t: Tables) -> DataFrame:
    return t.clients.groupBy(C.score_band().alias("band")).agg(F.count(F.lit(1)).alias("n"))


SEXTILE_CTE = """e AS (SELECT quantile_cont("AGE_YEARS", [1/6e0, 2/6e0, 3/6e0, 4/6e0, 5/6e0]) AS q FROM clients)"""
SEXTILE_CASE = """CASE WHEN "AGE_YEARS" IS NULL THEN NULL WHEN "AGE_YEARS" <= q[1] THEN 'S1 ate ' || CAST(round_even(q[1], 0) AS INTEGER)
 WHEN "AGE_YEARS" <= q[2] THEN 'S2 ' || CAST(round_even(q[1], 0) AS INTEGER) || '-' || CAST(round_even(q[2], 0) AS INTEGER)
 WHEN "AGE_YEARS" <= q[3] THEN 'S3 ' || CAST(round_even(q[2], 0) AS INTEGER) || '-' || CAST(round_even(q[3], 0) AS INTEGER)
 WHEN "AGE_YEARS" <= q[4] THEN 'S4 ' || CAST(round_even(q[3], 0) AS INTEGER) || '-' || CAST(round_even(q[4], 0) AS INTEGER)
 WHEN "AGE_YEARS" <= q[5] THEN 'S5 ' || CAST(round_even(q[4], 0) AS INTEGER) || '-' || CAST(round_even(q[5], 0) AS INTEGER)
 ELSE 'S6 ' || CAST(round_even(q[5], 0) AS INTEGER) || '+' END"""


@query("age_sextiles", f"WITH {SEXTILE_CTE} SELECT {SEXTILE_CASE} AS sextile, count(*) AS n FROM clients, e GROUP BY 1")
def _(t: Tables) -> DataFrame:
    df, _cuts = ranking.sextiles(t.clients, "AGE_YEARS")
    return df.groupBy("sextile").agg(F.count(F.lit(1)).alias("n"))


FIVE_YEAR = """CAST(CAST(floor("AGE_YEARS" / 5) * 5 AS INTEGER) AS VARCHAR) || '-' || CAST(CAST(floor("AGE_YEARS" / 5) * 5 AS INTEGER) + 5 AS VARCHAR)"""


@query("five_year_windows", f"SELECT {FIVE_YEAR} AS win, count(*) AS n, round(avg(proba_champion), 6) AS score FROM clients GROUP BY 1")
def _(t: Tables) -> DataFrame:
    return rounded(t.clients.groupBy(C.five_year_window("AGE_YEARS").alias("win")).agg(
        F.count(F.lit(1)).alias("n"), F.avg("proba_champion").alias("score")))


@query("three_way_decision", """
SELECT "SK_ID_CURR" AS id, CASE WHEN proba_champion >= 0.09e0 THEN 'NEGAR' WHEN proba_champion < 0.09e0 THEN 'APROVAR' END AS two_way,
 CASE WHEN proba_champion < 0.09e0 - 0.05e0 / 2 THEN 'APROVAR' WHEN proba_champion >= 0.09e0 + 0.05e0 / 2 THEN 'NEGAR'
      WHEN proba_champion IS NOT NULL THEN 'REVISAR' END AS three_way
FROM clients
""")
def _(t: Tables) -> DataFrame:
    return t.clients.select(
        F.col("SK_ID_CURR").alias("id"), C.decide("proba_champion", THRESHOLD).alias("two_way"),
        C.decide("proba_champion", THRESHOLD, K.DEFAULT_BAND).alias("three_way"))


@query("client_band_width", f"""
SELECT "SK_ID_CURR" AS id, w AS width, CASE WHEN proba_champion < 0.09e0 - w / 2 THEN 'APROVAR' WHEN proba_champion >= 0.09e0 + w / 2 THEN 'NEGAR'
      WHEN proba_champion IS NOT NULL THEN 'REVISAR' END AS decision FROM (
 SELECT *, CASE WHEN "AGE_YEARS" IS NOT NULL AND {AGE_CASE} IN ('<25', '55-65') THEN 0.1e0 WHEN "BUREAU_COUNT" IS NULL THEN 0.1e0 ELSE 0.05e0 END AS w FROM clients)
""")
def _(t: Tables) -> DataFrame:
    weak = {"age_band": ["<25", "55-65"], "thin_file": [K.THIN_FILE]}
    df = t.clients.withColumn("width", C.band_width(weak))
    return df.select(F.col("SK_ID_CURR").alias("id"), "width", C.decide("proba_champion", THRESHOLD, "width").alias("decision"))


# ---------------------------------------------------------------- filters


def filtered(t: Tables, **spec) -> DataFrame:
    df = filters.ClientFilters(**spec).apply(t.clients, THRESHOLD)
    return df.select(F.col("SK_ID_CURR").alias("id"))


def ids_sql(where: str) -> str:
    return f'SELECT "SK_ID_CURR" AS id FROM clients WHERE {where}'


@query("filter_ranges", ids_sql("""
 "AGE_YEARS" >= 25 AND "AGE_YEARS" <= 60 AND "AMT_INCOME_TOTAL" >= 150000 AND "AMT_INCOME_TOTAL" <= 300000 AND "AMT_CREDIT" >= 300000 AND "AMT_CREDIT" <= 990000
 AND "AMT_ANNUITY" >= 1000 AND "AMT_ANNUITY" <= 200000 AND "CNT_CHILDREN" >= 1 AND "CNT_CHILDREN" <= 6 AND "YEARS_EMPLOYED" >= 1 AND "YEARS_EMPLOYED" <= 23
 AND proba_champion >= 0.01e0 AND proba_champion <= 0.4e0"""))
def _(t: Tables) -> DataFrame:
    return filtered(
        t, age_min=25, age_max=60, income_min=150000, income_max=300000, credit_min=300000, credit_max=990000,
        annuity_min=1000, annuity_max=200000, children_min=1, children_max=6, employed_years_min=1,
        employed_years_max=23, score_min=0.01, score_max=0.4)


@query("filter_equalities", ids_sql(""" "CODE_GENDER" = 'M' AND "TARGET" = 1 AND split = 'train'"""))
def _(t: Tables) -> DataFrame:
    return filtered(t, gender="M", target=1, split="train")


@query("filter_memberships", ids_sql(""" "NAME_EDUCATION_TYPE" IN ('BUILDING', 'MACHINERY') AND "NAME_INCOME_TYPE" IN ('Working', 'Pensioner')
 AND "NAME_CONTRACT_TYPE" IN ('Cash loans') AND "NAME_FAMILY_STATUS" IN ('Married', 'Single') AND "NAME_HOUSING_TYPE" IN ('House / apartment') AND "OCCUPATION_TYPE" IN ('Laborers')"""))
def _(t: Tables) -> DataFrame:
    return filtered(
        t, education="BUILDING, MACHINERY", income_type=["Working", "Pensioner"], contract_type="Cash loans",
        family_status="Married,Single", housing_type="House / apartment", occupation="Laborers")


@query("filter_thin_file", ids_sql('"BUREAU_COUNT" IS NULL'))
def _(t: Tables) -> DataFrame:
    return filtered(t, thin_file=True)


@query("filter_decision", ids_sql("proba_champion >= 0.09e0"))
def _(t: Tables) -> DataFrame:
    return filtered(t, decision=K.DENY)


@query("filter_combined", ids_sql(""" "AGE_YEARS" >= 30 AND "CODE_GENDER" = 'F' AND "NAME_INCOME_TYPE" IN ('Working') AND "BUREAU_COUNT" IS NOT NULL AND proba_champion < 0.09e0"""))
def _(t: Tables) -> DataFrame:
    return filtered(t, age_min=30, gender="F", income_type="Working", thin_file=False, decision=K.APPROVE)


@query("filter_recent_window", """
SELECT "SK_ID_CURR" AS id, count(*) AS n FROM bureau WHERE "DAYS_DECISION" >= -24 * 30 GROUP BY 1
""")
def _(t: Tables) -> DataFrame:
    cut = aggregation.recent_cut("DAYS_DECISION", 24)
    return t.bureau.filter(F.col("DAYS_DECISION") >= cut).groupBy(F.col("SK_ID_CURR").alias("id")).agg(F.count(F.lit(1)).alias("n"))


@query("id_lookup", """
SELECT "SK_ID_CURR" AS id, "TARGET" AS target FROM clients WHERE "SK_ID_CURR" IN (SELECT user_id FROM events WHERE event_type = 'purchase')
""")
def _(t: Tables) -> DataFrame:
    ids = t.events.filter(F.col("event_type") == "purchase").select(F.col("user_id").alias("SK_ID_CURR")).distinct()
    return filters.by_ids(t.clients, ids).select(F.col("SK_ID_CURR").alias("id"), F.col("TARGET").alias("target"))


@query("scored_rows_of_split", """
SELECT "SK_ID_CURR" AS id, proba_baseline AS score FROM scores WHERE split = 'test' AND proba_baseline IS NOT NULL
""")
def _(t: Tables) -> DataFrame:
    return filters.scored(t.scores, "test", "proba_baseline").select(F.col("SK_ID_CURR").alias("id"), F.col("proba_baseline").alias("score"))


@query("minimum_group_size", """
SELECT o_custkey, count(*) AS n, round(avg(o_totalprice), 7) AS price FROM orders GROUP BY 1 HAVING count(*) >= 12
""")
def _(t: Tables) -> DataFrame:
    return t.orders.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("o_totalprice"), 7).alias("price")).filter(F.col("n") >= 12)


@query("key_modulus_sample", "SELECT o_orderkey, o_custkey FROM orders WHERE o_orderkey % 97 = 0")
def _(t: Tables) -> DataFrame:
    # the modulus is the sampling operator itself
    return filters.modulus_sample(t.orders.select("o_orderkey", "o_custkey"), 97, "o_orderkey")


@query("select_validated_columns", 'SELECT "SK_ID_CURR", "AMT_CREDIT", proba_champion FROM clients')
def _(t: Tables) -> DataFrame:
    return filters.select_columns(t.clients, "AMT_CREDIT, proba_champion", ["SK_ID_CURR"])


@query("client_sheet", """
SELECT "SK_ID_CURR" AS id, "BUREAU_COUNT" IS NULL AS thin_file, "CODE_GENDER" AS gender, "AMT_CREDIT" AS credit, "PREV_COUNT" AS prev,
 CAST("EXT_SOURCE_1" IS NOT NULL AS INTEGER) + CAST("EXT_SOURCE_2" IS NOT NULL AS INTEGER) + CAST("EXT_SOURCE_3" IS NOT NULL AS INTEGER) AS n_ext,
 CASE WHEN proba_champion >= 0.09e0 THEN 'NEGAR' WHEN proba_champion < 0.09e0 THEN 'APROVAR' END AS decision
FROM clients
""")
def _(t: Tables) -> DataFrame:
    sheet = portfolio.client_sheet(t.clients, THRESHOLD)
    return sheet.select(
        F.col("SK_ID_CURR").alias("id"), "thin_file", F.col("identificacao.CODE_GENDER").alias("gender"),
        F.col("financeiro.AMT_CREDIT").alias("credit"), F.col("historico.PREV_COUNT").alias("prev"),
        F.col("scores_externos.n_disponiveis").alias("n_ext"), F.col("score.decision").alias("decision"))


# ---------------------------------------------------------------- joins and sets


@query("attach_history_left", """
SELECT c_custkey, h.n, round(h.avg_price, 4) AS avg_price FROM customer LEFT JOIN history h ON o_custkey = c_custkey
""")
def _(t: Tables) -> DataFrame:
    part = t.orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.count(F.lit(1)).alias("n"), F.round(F.avg("o_totalprice"), 4).alias("avg_price"))
    return aggregation.attach(t.customer.select("c_custkey"), [part], "c_custkey")


@query("restrict_children_to_parents", """
SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')
""")
def _(t: Tables) -> DataFrame:
    parents = t.orders.filter(F.col("o_orderstatus") == "F").select(F.col("o_orderkey").alias("l_orderkey"))
    return aggregation.restrict_to(t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey"), parents, "l_orderkey")


@query("clients_with_scores_view", """
SELECT b."SK_ID_CURR" AS id, b."TARGET" AS target, s.split, s.proba_champion AS score
FROM base_clients b LEFT JOIN partial_scores s ON s."SK_ID_CURR" = b."SK_ID_CURR"
""")
def _(t: Tables) -> DataFrame:
    view = t.base_clients.select("SK_ID_CURR", "TARGET").join(t.partial_scores, "SK_ID_CURR", "left")
    return view.select(F.col("SK_ID_CURR").alias("id"), F.col("TARGET").alias("target"), "split", F.col("proba_champion").alias("score"))


@query("inner_join_loss", """
SELECT count(*) AS n_left, count(o_custkey) AS n_matched, count(*) - count(o_custkey) AS n_lost
FROM customer LEFT JOIN (SELECT DISTINCT o_custkey FROM orders) ON o_custkey = c_custkey
""")
def _(t: Tables) -> DataFrame:
    return aggregation.join_report(
        t.customer.select("c_custkey"), t.orders.select(F.col("o_custkey").alias("c_custkey")), "c_custkey")


@query("lookup_with_default", """
SELECT b."SK_ID_CURR" AS id, coalesce(s.split, 'calib') AS split FROM base_clients b LEFT JOIN partial_scores s ON s."SK_ID_CURR" = b."SK_ID_CURR"
""")
def _(t: Tables) -> DataFrame:
    joined = t.base_clients.select("SK_ID_CURR").join(t.partial_scores.select("SK_ID_CURR", "split"), "SK_ID_CURR", "left")
    return joined.select(F.col("SK_ID_CURR").alias("id"), F.coalesce("split", F.lit("calib")).alias("split"))


@query("clients_outside_scores", """
SELECT "SK_ID_CURR" AS id FROM base_clients WHERE "SK_ID_CURR" NOT IN (SELECT "SK_ID_CURR" FROM partial_scores)
""")
def _(t: Tables) -> DataFrame:
    return t.base_clients.join(t.partial_scores, "SK_ID_CURR", "left_anti").select(F.col("SK_ID_CURR").alias("id"))


@query("groups_aligned_in_one_pass", """
SELECT o_custkey, CAST(count(CASE WHEN o_orderstatus = 'F' THEN 1 END) AS DOUBLE) AS final_sum,
 round(avg(CASE WHEN o_orderstatus = 'F' THEN 1e0 ELSE 0e0 END), 6) AS final_mean,
 CAST(count(CASE WHEN o_orderpriority = '1-URGENT' THEN 1 END) AS DOUBLE) AS urgent_sum FROM orders GROUP BY 1
""")
def _(t: Tables) -> DataFrame:
    exprs = aggregation.categorical_expressions({"o_orderstatus": ["F"], "o_orderpriority": ["1-URGENT"]}, "X")
    wide = aggregation.group_wide(t.orders, "o_custkey", exprs)
    return rounded(wide.select(
        "o_custkey", F.col("X_O_ORDERSTATUS_F_SUM").alias("final_sum"), F.col("X_O_ORDERSTATUS_F_MEAN").alias("final_mean"),
        F.col("X_O_ORDERPRIORITY_1_URGENT_SUM").alias("urgent_sum")))


@query("align_values_before_after", """
WITH a AS (SELECT l_partkey AS k, sum(l_quantity) AS v FROM lineitem WHERE l_returnflag = 'A' GROUP BY 1),
     b AS (SELECT l_partkey AS k, sum(l_quantity) AS v FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1)
SELECT k, coalesce(a.v, 0e0) AS before, coalesce(b.v, 0e0) AS after, coalesce(b.v, 0e0) - coalesce(a.v, 0e0) AS difference FROM a FULL OUTER JOIN b USING (k)
""")
def _(t: Tables) -> DataFrame:
    def side(flag: str) -> DataFrame:
        return t.lineitem.filter(F.col("l_returnflag") == flag).groupBy(F.col("l_partkey").alias("k")).agg(F.sum("l_quantity").alias("v"))

    return sets.align_two(side("A"), side("R"), ["k"], "v")


@query("union_of_splits", """
SELECT split, count(*) AS n, round(avg(proba_champion), 6) AS score FROM scores GROUP BY 1
""")
def _(t: Tables) -> DataFrame:
    parts = [t.scores.filter(F.col("split") == s) for s in ("train", "valid", "test")]
    return rounded(parts[0].unionByName(parts[1]).unionByName(parts[2]).groupBy("split").agg(
        F.count(F.lit(1)).alias("n"), F.avg("proba_champion").alias("score")))


@query("symmetric_difference_of_ids", """
SELECT c_custkey AS id, 'left' AS side FROM customer WHERE c_custkey NOT IN (SELECT user_id FROM events)
UNION ALL SELECT DISTINCT user_id, 'right' FROM events WHERE user_id NOT IN (SELECT c_custkey FROM customer)
""")
def _(t: Tables) -> DataFrame:
    return sets.symmetric_difference(
        t.customer.select(F.col("c_custkey").alias("id")), t.events.select(F.col("user_id").alias("id")), "id")


@query("distinct_sorted_values", 'SELECT DISTINCT p_brand FROM part WHERE p_brand IS NOT NULL')
def _(t: Tables) -> DataFrame:
    return sets.distinct_sorted(t.part, "p_brand")


@query("known_and_unknown_names", """
SELECT event_id, CASE WHEN event_type IN ('click', 'view') THEN [event_type] ELSE [] END AS known,
 CASE WHEN event_type IN ('click', 'view') THEN ['zz'] ELSE list_sort([event_type, 'zz']) END AS unknown FROM events
""")
def _(t: Tables) -> DataFrame:
    names = t.events.select("event_id", F.array("event_type", F.lit("zz")).alias("names"))
    return sets.known_and_unknown(names, "names", ["click", "view"]).drop("names")
