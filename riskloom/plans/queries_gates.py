"""Queries for drift, quality gates and run history."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.functions import constants as K
from riskloom.operators import drift, evaluation, features, gates
from riskloom.operators import learning
from riskloom.plans.queries_cleaning import rounded
from riskloom.plans.queries_evaluation import auc_sql
from riskloom.plans.registry import Tables, query
from riskloom.session import scratch_path
from riskloom.sources import publication

# ---------------------------------------------------------------- drift

TENTHS = "[" + ", ".join(f"{i / 10}e0" for i in range(11)) + "]"
VERDICT = "CASE WHEN psi < 0.1 THEN 'estável' WHEN psi < 0.25 THEN 'atenção' WHEN psi IS NOT NULL THEN 'mudança relevante' END"


def psi_ctes(source: str) -> str:
    """``source`` gives feature, x (not null) and side (0 expected, 1 observed)."""
    return f"""l AS ({source}),
     q AS (SELECT feature, list_sort(list_distinct(quantile_cont(x, {TENTHS}))) AS q FROM l WHERE side = 0 GROUP BY 1),
     b AS (SELECT feature, side, CAST(len(list_filter(q[2:len(q) - 1], lambda e: e <= x)) AS INTEGER) AS bin FROM l JOIN q USING (feature) WHERE len(q) >= 3),
     frame AS (SELECT feature, q, CAST(unnest(range(len(q) - 1)) AS INTEGER) AS bin FROM q WHERE len(q) >= 3),
     c AS (SELECT feature, bin, count(CASE WHEN side = 0 THEN 1 END) AS ne, count(CASE WHEN side = 1 THEN 1 END) AS no FROM b GROUP BY 1, 2),
     t AS (SELECT feature, count(CASE WHEN side = 0 THEN 1 END) AS te, count(CASE WHEN side = 1 THEN 1 END) AS tt FROM l GROUP BY 1),
     p AS (SELECT feature, bin, CASE WHEN bin > 0 THEN q[bin + 1] END AS lower, q[bin + 2] AS upper, greatest(coalesce(ne, 0) / CAST(te AS DOUBLE), 1e-6) AS pe, greatest(coalesce(no, 0) / CAST(tt AS DOUBLE), 1e-6) AS po
           FROM frame LEFT JOIN c USING (feature, bin) JOIN t USING (feature)),
     s AS (SELECT feature, sum((po - pe) * ln(po / pe)) AS psi FROM p GROUP BY 1)"""


LOAN_YEARS = "SELECT 'raw' AS feature, raw AS x, CASE WHEN yr < 1998 THEN 0 ELSE 1 END AS side FROM loans"
EVENT_HALVES = "SELECT 'value' AS feature, value AS x, CASE WHEN ts < TIMESTAMP '2024-01-16' THEN 0 ELSE 1 END AS side FROM events"
MULTI = ["AGE_YEARS", "AMT_CREDIT", "CNT_CHILDREN", "EXT_SOURCE_1", "proba_champion", "TARGET"]
SPLITS = " UNION ALL ".join(
    f"""SELECT '{c}' AS feature, CAST("{c}" AS DOUBLE) AS x, CASE WHEN split = 'train' THEN 0 ELSE 1 END AS side FROM clients WHERE split IN ('train', 'test') AND "{c}" IS NOT NULL""" for c in MULTI)


@query("psi_bins", f"""
WITH {psi_ctes(LOAN_YEARS)} SELECT feature, bin, round(lower, 9) AS lower, round(upper, 9) AS upper, round(pe, 9) AS pct_expected, round(po, 9) AS pct_observed, round((po - pe) * ln(po / pe), 9) AS contribution FROM p
""")
def _(t: Tables) -> DataFrame:
    cuts = drift.reference_cuts(t.loans.filter(F.col("yr") < 1998), ["raw"])
    return rounded(drift.psi_bins(t.loans, cuts, F.col("yr") >= 1998), 9)


@query("psi_two_periods", f"""
WITH {psi_ctes(EVENT_HALVES)} SELECT feature, round(psi, 9) AS psi, {VERDICT} AS verdict, te AS n_expected, tt AS n_observed, CAST(NULL AS VARCHAR) AS note FROM s JOIN t USING (feature)
""")
def _(t: Tables) -> DataFrame:
    late = F.col("ts") >= F.lit("2024-01-16").cast("timestamp_ntz")
    return rounded(drift.psi_of_two(t.events.filter(~late), t.events.filter(late), ["value"]), 9)


@query("psi_many_features", f"""
WITH {psi_ctes(SPLITS)} SELECT t.feature, round(psi, 9) AS psi, {VERDICT} AS verdict, te AS n_expected, tt AS n_observed,
 CASE WHEN psi IS NULL THEN 'variável quase constante na referência' END AS note FROM t LEFT JOIN s USING (feature)
""")
def _(t: Tables) -> DataFrame:
    split = F.col("split")
    return rounded(drift.psi_between(t.clients, MULTI, split == "train", split == "test"), 9)


@query("psi_verdict_counts", f"""
WITH {psi_ctes(SPLITS)}, v AS (SELECT {VERDICT} AS verdict FROM t LEFT JOIN s USING (feature)) SELECT coalesce(verdict, 'sem_calculo') AS verdict, count(*) AS n FROM v GROUP BY 1
""")
def _(t: Tables) -> DataFrame:
    split = F.col("split")
    return drift.verdict_counts(drift.psi_between(t.clients, MULTI, split == "train", split == "test"))


SCORE_SPLITS = "SELECT 'proba_champion' AS feature, proba_champion AS x, CASE WHEN split = 'train' THEN 0 ELSE 1 END AS side FROM scores WHERE split IN ('train', 'test')"
SCORE_RUNS = "SELECT 'proba_champion' AS feature, round(proba_champion * 0.9e0, 6) AS x, 0 AS side FROM scores UNION ALL SELECT 'proba_champion', proba_champion, 1 FROM scores"


@query("score_drift_train_test", f"""
WITH {psi_ctes(SCORE_SPLITS)} SELECT 'treino vs. teste (sem rodada anterior para comparar)' AS comparison, round(psi, 9) AS psi, {VERDICT} AS verdict, te AS n_expected, tt AS n_observed FROM s JOIN t USING (feature)
""")
def _(t: Tables) -> DataFrame:
    return rounded(drift.score_drift_report(t.scores, None), 9)


@query("score_drift_against_previous_run", f"""
WITH {psi_ctes(SCORE_RUNS)} SELECT 'rodada anterior vs. atual' AS comparison, round(psi, 9) AS psi, {VERDICT} AS verdict, te AS n_expected, tt AS n_observed FROM s JOIN t USING (feature)
""")
def _(t: Tables) -> DataFrame:
    previous = t.scores.withColumn(K.SCORE, F.round(F.col(K.SCORE) * 0.9, 6))
    return rounded(drift.score_drift_report(t.scores, previous), 9)


@query("metric_history_by_cohort", f"""
WITH a AS ({auc_sql('SELECT yr, y, raw AS s FROM loans', 'yr')})
SELECT yr, n_events + n_nonevents AS n, round(auc, 9) AS auc, round(ok, 9) AS approval_rate, round(n_events / CAST(n_events + n_nonevents AS DOUBLE), 9) AS default_rate
FROM a JOIN (SELECT yr, avg(CASE WHEN raw < 0.35e0 THEN 1e0 ELSE 0e0 END) AS ok FROM loans GROUP BY 1) USING (yr)
""")
def _(t: Tables) -> DataFrame:
    out = evaluation.group_quality(t.loans, "y", "raw", ["yr"], 0.35)
    return rounded(out.select("yr", "n", "auc", "approval_rate", "default_rate"), 9)


# ---------------------------------------------------------------- gates


@query("feature_table_gate", """
SELECT 'one_row_per_key' AS "check", count(*) = count(DISTINCT "SK_ID_CURR") AS ok, count(*) || ' rows, ' || count(DISTINCT "SK_ID_CURR") || ' keys' AS detail FROM clients
UNION ALL SELECT 'rows', count(*) >= 1000, count(*) || ' of at least 1000' FROM clients
UNION ALL SELECT 'columns', false, '43 of at least 400'
UNION ALL SELECT 'has_SK_ID_CURR', true, 'SK_ID_CURR' UNION ALL SELECT 'has_TARGET', true, 'TARGET'
UNION ALL SELECT 'no_leaky_names', false, 'y_true, proba_champion, proba_champion_raw, proba_baseline'
""")
def _(t: Tables) -> DataFrame:
    return gates.table_checks(t.clients)


@query("leaky_column_names", """
SELECT p_partkey, 'x_' || CASE p_partkey % 3 WHEN 0 THEN 'y_true' WHEN 1 THEN 'proba' ELSE 'size' END AS column_name FROM part WHERE p_partkey % 3 < 2
""")
def _(t: Tables) -> DataFrame:
    k = F.col("p_partkey") % 3
    names = t.part.select("p_partkey", F.concat(F.lit("x_"), F.when(k == 0, "y_true").when(k == 1, "proba").otherwise("size")).alias("column_name"))
    return gates.leaky_columns(names)


ACCEPTED_RUNS = "sample IS NULL AND coalesce(status, 'aceita') = 'aceita'"


def gate_sql(run: str) -> str:
    return f"""
    WITH c AS (SELECT run_id, auc AS current FROM runs WHERE run_id = '{run}'), r AS (SELECT run_id AS reference_run, auc AS reference FROM runs WHERE {ACCEPTED_RUNS} AND run_id <> '{run}' ORDER BY trained_at DESC LIMIT 1)
    SELECT run_id, current, reference_run, reference, round(current - reference, 9) AS delta,
     CASE WHEN reference IS NULL THEN 'linha_de_base' WHEN current - reference < -0.01e0 THEN 'regressao' WHEN current >= reference THEN 'melhorou' ELSE 'piorou dentro do limiar' END AS status
    FROM c LEFT JOIN r ON true"""


@query("metric_regression_gate", gate_sql("2000"))
def _(t: Tables) -> DataFrame:
    return gates.metric_gate(t.runs, "2000").withColumn("delta", F.round("delta", 9) + 0.0)


PUBLISHED = (("v1", K.BASELINE_SCORE), ("v2", K.SCORE), ("v3", K.RAW_SCORE))


def published_history(t: Tables) -> str:
    """Three runs on the test slice with their real metrics, a sample run, a run that was never committed, and v2 again."""
    root = scratch_path(t.spark, "published")
    test = t.scores.filter(F.col("split") == "test")
    steps = [(tag, score, False) for tag, score in PUBLISHED] + [("v2", K.BASELINE_SCORE, False), ("v4", K.SCORE, True)]
    for at, (tag, score, sample) in enumerate(steps):
        table = test.select(K.ID, "y_true", F.col(score).alias("score"))
        row = evaluation.auc(table, "y_true", "score").first()
        status = K.REJECTED if tag == "v2" and at == 1 else None
        publication.publish({"scores": table}, root, tag, at, {"auc": row["auc"], "n": float(row["n_events"] + row["n_nonevents"])}, sample, status)
    publication.stage_run({"scores": test.select(K.ID)}, root, "v5")
    return root


PUBLISHED_SQL = "WITH " + ", ".join(
    f"""{tag} AS (SELECT auc, CAST(n_events + n_nonevents AS DOUBLE) AS n FROM ({auc_sql(f"SELECT y_true AS y, {score} AS s FROM scores WHERE split = 'test'")}))"""
    for tag, score in (("b", K.BASELINE_SCORE), ("s", K.SCORE), ("r", K.RAW_SCORE)))


@query("published_run_log", f"""{PUBLISHED_SQL}
SELECT 'v1' AS tag, NULL AS sample, 'aceita' AS status, CAST(0 AS BIGINT) AS trained_at, round(auc, 9) AS auc, n FROM b
UNION ALL SELECT 'v2', NULL, 'rejeitada', 3, round(auc, 9), n FROM b UNION ALL SELECT 'v3', NULL, 'aceita', 2, round(auc, 9), n FROM r
UNION ALL SELECT 'v4', 'demo', 'aceita', 4, round(auc, 9), n FROM s""")
def _(t: Tables) -> DataFrame:
    return rounded(publication.run_log(t.spark, published_history(t), ["auc", "n"]).drop("run_id"), 9)


@query("published_run_gate", f"""{PUBLISHED_SQL}
SELECT round(r.auc, 9) AS current, round(b.auc, 9) AS reference, round(r.auc - b.auc, 9) AS delta,
 CASE WHEN r.auc - b.auc < -0.01e0 THEN 'regressao' WHEN r.auc >= b.auc THEN 'melhorou' ELSE 'piorou dentro do limiar' END AS status FROM r, b""")
def _(t: Tables) -> DataFrame:
    # v3 against v1: v2 was rejected, v4 is a sample, v5 was never committed
    log = publication.run_log(t.spark, published_history(t), ["auc"])
    current = log.filter(F.col("tag") == "v3").first()["run_id"]
    return rounded(gates.metric_gate(log, current).select("current", "reference", "delta", "status"), 9)


@query("published_run_checks", "SELECT 'scores' AS \"table\", k AS \"check\", true AS ok, CASE WHEN k = 'rows' THEN count(*) END AS n FROM scores, (SELECT unnest(['rows', 'checksum']) AS k) WHERE split = 'test' GROUP BY k")
def _(t: Tables) -> DataFrame:
    root = published_history(t)
    checks = publication.verify_run(t.spark, root, publication.newest_run(t.spark, root))
    return checks.select("table", "check", "ok", F.when(F.col("check") == "rows", F.col("found").cast("long")).alias("n"))


@query("latest_accepted_run", f"SELECT run_id, tag, auc FROM runs WHERE {ACCEPTED_RUNS} ORDER BY trained_at DESC LIMIT 1")
def _(t: Tables) -> DataFrame:
    return gates.latest(gates.accepted(t.runs)).select("run_id", "tag", "auc")


@query("latest_run_per_tag", "SELECT run_id, tag, auc FROM runs QUALIFY row_number() OVER (PARTITION BY tag ORDER BY trained_at DESC) = 1")
def _(t: Tables) -> DataFrame:
    return gates.latest(t.runs, by=["tag"]).select("run_id", "tag", "auc")


@query("upsert_run_log", """
WITH entry AS (SELECT 'new' AS run_id, tag, trained_at + 100 AS trained_at, auc * 2 AS auc FROM runs WHERE tag IN ('v0', 'v4')),
 newest AS (SELECT * FROM entry QUALIFY row_number() OVER (PARTITION BY tag ORDER BY trained_at DESC) = 1),
 st AS (SELECT tag, status FROM runs QUALIFY row_number() OVER (PARTITION BY tag ORDER BY trained_at DESC) = 1)
SELECT run_id, tag, trained_at, coalesce(st.status, 'aceita') AS status, round(auc, 8) AS auc FROM newest LEFT JOIN st USING (tag)
UNION ALL SELECT run_id, tag, trained_at, coalesce(st.status, runs.status, 'aceita'), round(auc, 8) FROM runs JOIN st USING (tag) WHERE tag NOT IN ('v0', 'v4')
""")
def _(t: Tables) -> DataFrame:
    entry = t.runs.filter(F.col("tag").isin("v0", "v4")).select(
        F.lit("new").alias("run_id"), "tag", (F.col("trained_at") + 100).alias("trained_at"), (F.col("auc") * 2).alias("auc"),
        F.lit(None).cast("string").alias("status"))
    log = t.runs.select("run_id", "tag", "trained_at", "status", "auc")
    return gates.upsert_runs(log, entry).select("run_id", "tag", "trained_at", "status", F.round("auc", 8).alias("auc"))


@query("run_deltas", f"""
WITH a AS (SELECT * FROM runs WHERE {ACCEPTED_RUNS}), f AS (SELECT * FROM a ORDER BY trained_at LIMIT 1), l AS (SELECT * FROM a ORDER BY trained_at DESC LIMIT 1)
SELECT f.tag AS baseline_tag, l.tag AS latest_tag, m.metric, m.before, m.after, round(m.after - m.before, 9) AS delta FROM f, l,
 LATERAL (SELECT 'auc' AS metric, f.auc AS before, l.auc AS after UNION ALL SELECT 'ks', f.ks, l.ks UNION ALL SELECT 'brier', f.brier, l.brier UNION ALL SELECT 'approval_rate', f.approval_rate, l.approval_rate) m
""")
def _(t: Tables) -> DataFrame:
    return gates.run_deltas(t.runs).withColumn("delta", F.round("delta", 9) + 0.0)


@query("segment_deltas_between_runs", f"""
WITH a AS (SELECT * FROM run_segments WHERE {ACCEPTED_RUNS}), e AS (SELECT min(trained_at) AS lo, max(trained_at) AS hi FROM a)
SELECT x.dimension, x."group", x.auc AS before, y.auc AS after, y.n, round(y.auc - x.auc, 9) AS delta
FROM e JOIN a x ON x.trained_at = lo JOIN a y ON y.trained_at = hi AND y.dimension = x.dimension AND y."group" = x."group"
""")
def _(t: Tables) -> DataFrame:
    return gates.segment_deltas(t.run_segments).withColumn("delta", F.round("delta", 9) + 0.0)


@query("rejected_runs", "SELECT run_id, tag, auc FROM runs WHERE sample IS NULL AND status = 'rejeitada'")
def _(t: Tables) -> DataFrame:
    return gates.rejected(t.runs).select("run_id", "tag", "auc")


@query("interval_overlap_flags", """
WITH s AS (SELECT grp, avg(score) AS m, stddev_samp(score) / sqrt(count(*)) AS e FROM loans GROUP BY 1), o AS (SELECT avg(score) - stddev_samp(score) / sqrt(count(*)) AS lo, avg(score) + stddev_samp(score) / sqrt(count(*)) AS hi FROM loans)
SELECT grp, NOT (m + e < lo OR m - e > hi) AS overlaps_overall FROM s, o
""")
def _(t: Tables) -> DataFrame:
    err = F.stddev_samp("score") / F.sqrt(F.count(F.lit(1)))
    whole = t.loans.agg((F.avg("score") - err).alias("lo"), (F.avg("score") + err).alias("hi"))
    per = t.loans.groupBy("grp").agg((F.avg("score") - err).alias("ci_low"), (F.avg("score") + err).alias("ci_high"))
    flagged = gates.overlap_flags(per, whole.select("lo").scalar(), whole.select("hi").scalar())
    return flagged.select("grp", "overlaps_overall")


@query("derived_column_consistency", """
SELECT 'CREDIT_INCOME_RATIO' AS column_name, count(*) AS n_compared, CAST(0 AS BIGINT) AS n_different FROM clients
UNION ALL SELECT 'ANNUITY_INCOME_RATIO', count(*), 0 FROM clients
UNION ALL SELECT 'CREDIT_TERM', count(*), count(CASE WHEN "SK_ID_CURR" % 50 = 0 AND "CREDIT_TERM" IS NOT NULL THEN 1 END) FROM clients
UNION ALL SELECT 'AGE_YEARS', count(*), 0 FROM clients UNION ALL SELECT 'YEARS_EMPLOYED', count(*), 0 FROM clients
UNION ALL SELECT 'EXT_SOURCE_MEAN', count(*), 0 FROM clients UNION ALL SELECT 'N_EXT_SOURCE_PRESENT', count(*), 0 FROM clients
""")
def _(t: Tables) -> DataFrame:
    # one planted error in every fiftieth client
    planted = F.when(F.col("SK_ID_CURR") % 50 == 0, F.col("CREDIT_TERM") + 1).otherwise(F.col("CREDIT_TERM"))
    return features.consistency(t.clients.withColumn("CREDIT_TERM", planted))


# ---------------------------------------------------------------- splits


SPLIT_SQL = """
 u AS (SELECT o_orderkey AS id, CAST(o_orderstatus = 'F' AS INTEGER) AS y, ('0x' || substr(md5(o_orderkey || '|42'), 1, 8))::BIGINT / 4294967296e0 AS u FROM orders),
 r AS (SELECT id, y, row_number() OVER (PARTITION BY y ORDER BY u, id) - 1 AS i, count(*) OVER (PARTITION BY y) AS n FROM u),
 parts AS (SELECT id, y, CASE WHEN i < n * 50 // 100 THEN 'train' WHEN i < n * 70 // 100 THEN 'valid' WHEN i < n * 80 // 100 THEN 'calib' ELSE 'test' END AS split FROM r)"""


def order_labels(t: Tables) -> DataFrame:
    return t.orders.select(F.col("o_orderkey").alias("id"), (F.col("o_orderstatus") == "F").cast("int").alias("y"))


@query("stratified_split", f"WITH {SPLIT_SQL} SELECT id, split FROM parts")
def _(t: Tables) -> DataFrame:
    return learning.stratified_split(order_labels(t), "id", "y").select("id", "split")


@query("stratified_split_shares", f"""
WITH {SPLIT_SQL} SELECT split, count(*) AS n, CAST(sum(y) AS BIGINT) AS events FROM parts GROUP BY 1
""")
def _(t: Tables) -> DataFrame:
    return learning.stratified_split(order_labels(t), "id", "y").groupBy("split").agg(
        F.count(F.lit(1)).alias("n"), F.sum("y").alias("events"))


@query("split_integrity", f"""
WITH {SPLIT_SQL}, d AS (SELECT id, CASE WHEN id % 100 = 7 THEN 'train' ELSE split END AS split FROM parts)
SELECT CAST(count(CASE WHEN parts.split <> d.split THEN 1 END) AS BIGINT) AS only_stored, CAST(count(CASE WHEN parts.split <> d.split THEN 1 END) AS BIGINT) AS only_derived,
 CAST(0 AS BIGINT) AS keys_in_several_slices, count(CASE WHEN parts.split <> d.split THEN 1 END) = 0 AS ok FROM parts JOIN d USING (id)
""")
def _(t: Tables) -> DataFrame:
    stored = learning.stratified_split(order_labels(t), "id", "y")
    # a planted disagreement, so the check has something to find
    derived = stored.withColumn("split", F.when(F.col("id") % 100 == 7, "train").otherwise(F.col("split")))
    return gates.split_integrity(stored, derived, "id")


@query("stratified_sample", """
WITH u AS (SELECT o_orderkey AS id, CAST(o_orderstatus = 'F' AS INTEGER) AS y, ('0x' || substr(md5(o_orderkey || '|42'), 1, 8))::BIGINT / 4294967296e0 AS u FROM orders),
 r AS (SELECT id, y, row_number() OVER (PARTITION BY y ORDER BY u, id) - 1 AS i, count(*) OVER (PARTITION BY y) AS n, count(*) OVER () AS t FROM u)
SELECT id, y FROM r WHERE i < (2000 * n + t) // (2 * t)
""")
def _(t: Tables) -> DataFrame:
    return learning.stratified_sample(order_labels(t), 1000, "id", "y").select("id", "y")
