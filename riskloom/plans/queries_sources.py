"""Queries for sources and sinks: every one writes given tables out, reads them back and checks them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.functions import constants as K
from riskloom.operators import drift, learning, portfolio
from riskloom.plans import training
from riskloom.plans.queries_cleaning import rounded
from riskloom.plans.queries_gates import VERDICT, psi_ctes
from riskloom.plans.queries_portfolio import PROFILED
from riskloom.plans.registry import Tables, query
from riskloom.session import scratch_path
from riskloom.sources import readers, writers

CUSTOMER = "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING"


def customer_with_gaps(t: Tables) -> DataFrame:
    """Customers with empty segments, so nulls make the trip."""
    gap = F.when(F.col("c_custkey") % 7 != 3, F.col("c_mktsegment"))
    return t.customer.select("c_custkey", "c_name", "c_nationkey", "c_acctbal", gap.alias("c_mktsegment"))


GAPS_SQL = "SELECT c_custkey, c_name, c_nationkey, c_acctbal, CASE WHEN c_custkey % 7 <> 3 THEN c_mktsegment END AS c_mktsegment FROM customer"


@query("csv_with_schema", GAPS_SQL)
def _(t: Tables) -> DataFrame:
    path = writers.write_csv(customer_with_gaps(t), scratch_path(t.spark, "csv"))
    return readers.read_csv(t.spark, path, CUSTOMER)


@query("csv_with_inferred_types", """
SELECT o_orderkey, o_totalprice, o_orderstatus, CASE WHEN o_orderkey % 9 = 0 THEN NULL ELSE o_custkey END AS o_custkey FROM orders
""")
def _(t: Tables) -> DataFrame:
    df = t.orders.select(
        "o_orderkey", "o_totalprice", "o_orderstatus", F.when(F.col("o_orderkey") % 9 != 0, F.col("o_custkey")).alias("o_custkey"))
    path = writers.write_csv(df, scratch_path(t.spark, "csv"))
    back = readers.read_csv(t.spark, path)
    return back.withColumns({"o_orderkey": F.col("o_orderkey").cast("long"), "o_custkey": F.col("o_custkey").cast("long")})


@query("parquet_view", "SELECT o_orderstatus, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders GROUP BY 1")
def _(t: Tables) -> DataFrame:
    readers.register_view(t.orders, "orders_view")
    return t.spark.sql(
        "SELECT o_orderstatus, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders_view GROUP BY o_orderstatus")


@query("projected_parquet_scan", "SELECT l_orderkey, l_quantity FROM lineitem")
def _(t: Tables) -> DataFrame:
    return readers.read_parquet(t.spark, f"{t.root}/lineitem.parquet", ["l_orderkey", "l_quantity", "not_there"])


@query("parquet_preferred_over_csv", "SELECT 'parquet' AS kind, count(*) AS n FROM part UNION ALL SELECT 'csv', count(*) FROM supplier")
def _(t: Tables) -> DataFrame:
    csv = writers.write_csv(t.supplier, scratch_path(t.spark, "csv"))
    first = readers.read_preferred(t.spark, f"{t.root}/part.parquet", csv)
    second = readers.read_preferred(t.spark, f"{t.root}/no_such.parquet", csv)
    return first.agg(F.lit("parquet").alias("kind"), F.count(F.lit(1)).alias("n")).unionByName(
        second.agg(F.lit("csv").alias("kind"), F.count(F.lit(1)).alias("n")))


@query("missing_optional_source", """
SELECT c_custkey AS "SK_ID_CURR", CAST(NULL AS VARCHAR) AS split, CAST(NULL AS DOUBLE) AS proba_champion FROM customer
""")
def _(t: Tables) -> DataFrame:
    base = t.customer.select(F.col("c_custkey").alias(K.ID))
    return readers.with_optional(base, None, K.ID, {"split": "string", "proba_champion": "double"})


@query("present_optional_source", 'SELECT b."SK_ID_CURR", s.split, s.proba_champion FROM base_clients b LEFT JOIN partial_scores s USING ("SK_ID_CURR")')
def _(t: Tables) -> DataFrame:
    base = t.base_clients.select(K.ID)
    return readers.with_optional(base, t.partial_scores, K.ID, {"split": "string", "proba_champion": "double"})


@query("column_catalogue", """
SELECT name, type FROM (VALUES ('l_orderkey', 'bigint'), ('l_linenumber', 'int'), ('l_linestatus', 'string')) v(name, type) WHERE (SELECT count(*) FROM lineitem) > 0
""")
def _(t: Tables) -> DataFrame:
    found = readers.column_catalogue(t.lineitem, search="L_")
    names = readers.column_catalogue(t.lineitem, prefix="l_line").unionByName(
        readers.column_catalogue(t.lineitem, prefix="l_", limit=1))
    return names.join(found.select("name"), "name").select("name", "type")


@query("column_catalogue_with_profile", """
SELECT 'POS_COUNT' AS name, round(avg(CASE WHEN "POS_COUNT" IS NULL THEN 1e0 ELSE 0e0 END), 9) AS missing_rate FROM base_clients
UNION ALL SELECT 'PREV_COUNT', round(avg(CASE WHEN "PREV_COUNT" IS NULL THEN 1e0 ELSE 0e0 END), 9) FROM base_clients
""")
def _(t: Tables) -> DataFrame:
    profile = portfolio.column_profile(t.base_clients.select(*PROFILED))
    out = readers.column_catalogue(t.base_clients, profile, prefix="P")
    return rounded(out.select("name", "missing_rate"), 9)


@query("input_size_check")
def _(t: Tables) -> DataFrame:
    names = ("customer", "orders", "lineitem", "events", "part")
    sizes = readers.check_inputs(t.spark, [f"{t.root}/{n}.parquet" for n in names], min_bytes=100)
    return sizes.select(F.regexp_extract("path", "([a-z]+)[.]parquet$", 1).alias("source"), "n_files", "bytes")


@query("json_records_tolerant", """
SELECT event_id, CASE WHEN event_id % 10 <> 0 THEN CAST(json_extract(props, '$.k') AS BIGINT) END AS k, event_id % 10 = 0 AS corrupt FROM events
""")
def _(t: Tables) -> DataFrame:
    line = F.to_json(F.struct("event_id", F.get_json_object("props", "$.k").cast("long").alias("k")))
    # every tenth line is cut short
    text = t.events.select("event_id", F.when(F.col("event_id") % 10 == 0, F.concat(F.lit("{broken "), F.col("event_id"))).otherwise(line).alias("value"))
    path = scratch_path(t.spark, "json")
    text.select("value").write.text(path)
    back = readers.read_json(t.spark, path, "event_id BIGINT, k BIGINT")
    number = F.coalesce("event_id", F.regexp_extract("_corrupt", "([0-9]+)", 1).cast("long"))
    return back.select(number.alias("event_id"), "k", F.col("_corrupt").isNotNull().alias("corrupt"))


@query("verified_conversion", """
SELECT 'n_rows' AS "check", CAST(count(*) AS VARCHAR) AS source, CAST(count(*) AS VARCHAR) AS written, true AS ok FROM customer
UNION ALL SELECT 'n_columns', '3', '3', true UNION ALL SELECT 'target_sum', CAST(count(CASE WHEN c_acctbal < 0 THEN 1 END) AS VARCHAR), CAST(count(CASE WHEN c_acctbal < 0 THEN 1 END) AS VARCHAR), true FROM customer
UNION ALL SELECT 'key_unique', 'true', 'true', true
""")
def _(t: Tables) -> DataFrame:
    df = t.customer.select(
        F.col("c_custkey").alias(K.ID), (F.col("c_acctbal") < 0).cast("int").alias(K.TARGET), "c_name")
    csv = writers.write_csv(df, scratch_path(t.spark, "csv"))
    return writers.convert_csv(t.spark, csv, scratch_path(t.spark, "parquet"), profile_path=scratch_path(t.spark, "profile"))


@query("partitioned_score_table", "SELECT split, count(*) AS n, round(sum(proba_champion), 6) AS total FROM scores GROUP BY 1")
def _(t: Tables) -> DataFrame:
    path = writers.write_scores(t.scores, scratch_path(t.spark, "scores"))
    back = readers.read_parquet(t.spark, path)
    return back.groupBy("split").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("proba_champion"), 6).alias("total"))


@query("snapshot_rotation", """
SELECT count(*) AS n, round(avg(proba_champion) * 0.5e0, 9) AS previous_mean FROM scores
""")
def _(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "snapshots")
    def lowered(by: float) -> DataFrame:
        return t.scores.withColumn("proba_champion", F.col("proba_champion") * by)

    writers.snapshot(lowered(0.25), path, "20240101")
    writers.snapshot(lowered(0.5), path, "20240201")
    writers.snapshot(t.scores, path, "20240301")
    before = writers.previous_snapshot(t.spark, path, "20240301")
    return before.agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("proba_champion"), 9).alias("previous_mean"))


@query("drift_against_snapshot", f"""
WITH {psi_ctes("SELECT 'proba_champion' AS feature, proba_champion * 0.8e0 AS x, 0 AS side FROM scores UNION ALL SELECT 'proba_champion', proba_champion, 1 FROM scores")}
SELECT 'rodada anterior vs. atual' AS comparison, round(psi, 9) AS psi, {VERDICT} AS verdict, te AS n_expected, tt AS n_observed FROM s JOIN t USING (feature)
""")
def _(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "snapshots")
    writers.snapshot(t.scores.withColumn("proba_champion", F.col("proba_champion") * 0.8), path, "a")
    return rounded(drift.score_drift_report(t.scores, writers.previous_snapshot(t.spark, path, "b")), 9)


@query("sample_run_kept_apart", "SELECT 'demo' AS branch, count(*) AS n FROM supplier UNION ALL SELECT 'official', count(*) FROM part")
def _(t: Tables) -> DataFrame:
    root = scratch_path(t.spark, "runs")
    official = writers.write_report({"rows": t.part.select("p_partkey")}, root, "v1")
    demo = writers.write_report({"rows": t.supplier.select("s_suppkey")}, root, "v1", sample=True)
    parts = [
        readers.read_json(t.spark, paths["rows"], schema).agg(F.lit(branch).alias("branch"), F.count(F.lit(1)).alias("n"))
        for branch, paths, schema in (("official", official, "p_partkey BIGINT"), ("demo", demo, "s_suppkey BIGINT"))
    ]
    return parts[0].unionByName(parts[1])


@query("report_pack")
def _(t: Tables) -> DataFrame:
    bundle = training.trained(t)
    df = training.applications(t)
    scores = t.spark.read.parquet(
        writers.write_parquet(learning.score_table(df, bundle), scratch_path(t.spark, "scores")))
    tables = training.report_pack(scores, df, bundle)
    paths = writers.write_report(tables, scratch_path(t.spark, "report"), "v1")
    parts = None
    for name, path in sorted(paths.items()):
        part = t.spark.read.text(path).agg(F.lit(name).alias("report_table"), F.count(F.lit(1)).alias("n"))
        parts = part if parts is None else parts.unionByName(part)
    return parts


@query("score_client_csv")
def _(t: Tables) -> DataFrame:
    bundle = training.trained(t)
    names = [K.ID, "AMT_CREDIT", "DAYS_BIRTH", "EXT_SOURCE_2", "NAME_EDUCATION_TYPE", "FLAG_OWN_CAR"]
    source = writers.write_csv(training.applications(t).select(*names), scratch_path(t.spark, "batch"))
    target = scratch_path(t.spark, "scored")
    writers.score_csv(t.spark, source, target, bundle)
    return t.spark.read.option("header", True).csv(target)
