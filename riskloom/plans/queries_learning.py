"""Queries for training, scoring, explanation and what-if runs.

Learned models have no SQL twin: their queries return invariants that must hold (additivity,
agreement, calibration). The what-if and explanation machinery is checked against SQL with a
fixed linear score.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.functions import columns as C
from riskloom.functions import constants as K
from riskloom.operators import boosting, evaluation, explain, features, learning, portfolio, ranking
from riskloom.plans import training
from riskloom.plans.queries_cleaning import rounded
from riskloom.plans.registry import Tables, query
from riskloom.session import scratch_path
from riskloom.sources import readers, writers

# A fixed linear score over five client columns.
COEF = {"EXT_SOURCE_1": -1.5, "EXT_SOURCE_2": -2.0, "EXT_SOURCE_3": -1.0, "CREDIT_INCOME_RATIO": 0.4, "AGE_YEARS": -0.02}
MEANS = {"EXT_SOURCE_1": 0.5, "EXT_SOURCE_2": 0.5, "EXT_SOURCE_3": 0.5, "CREDIT_INCOME_RATIO": 3.0, "AGE_YEARS": 45.0}
INTERCEPT = 0.6
CUT = 0.2


def e0(x: float) -> str:
    return f"({x!r}e0)"


def term_sql(c: str, column: str | None = None) -> str:
    return f"coalesce({column or chr(34) + c + chr(34)}, {e0(MEANS[c])}) * {e0(COEF[c])}"


def probability_sql(**replaced: str) -> str:
    terms = " + ".join(term_sql(c, replaced.get(c)) for c in COEF)
    return f"1e0 / (1e0 + exp(-({e0(INTERCEPT)} + {terms})))"


def linear_scorer(df: DataFrame) -> DataFrame:
    return df.withColumn("probability_default", explain.sigmoid(explain.linear_margin(COEF, INTERCEPT, MEANS)))


CONTRIBUTIONS = " UNION ALL ".join(
    f"""SELECT "SK_ID_CURR" AS id, '{c}' AS feature, (coalesce("{c}", {e0(MEANS[c])}) - {e0(MEANS[c])}) * {e0(w)} AS v FROM clients""" for c, w in COEF.items())


def explained(t: Tables) -> DataFrame:
    base = explain.linear_base(COEF, INTERCEPT, MEANS)
    scored = linear_scorer(t.clients)
    return scored.withColumns({
        "contributions": explain.linear_contributions(COEF, MEANS), "base_value": F.lit(base),
        "decision": C.decide("probability_default", CUT)})


@query("linear_probability", f'SELECT "SK_ID_CURR" AS id, round({probability_sql()}, 9) AS p FROM clients')
def _(t: Tables) -> DataFrame:
    return linear_scorer(t.clients).select(F.col(K.ID).alias("id"), F.round("probability_default", 9).alias("p"))


@query("linear_contributions", f"SELECT id, feature, round(v, 9) + 0e0 AS shap_value FROM ({CONTRIBUTIONS})")
def _(t: Tables) -> DataFrame:
    rows = explained(t).select(F.col(K.ID).alias("id"), F.explode("contributions").alias("c"))
    return rows.select("id", "c.feature", (F.round("c.shap_value", 9) + 0.0).alias("shap_value"))


@query("linear_additivity", f"""
SELECT count(*) AS n, true AS adds_up FROM clients
""")
def _(t: Tables) -> DataFrame:
    df = explained(t)
    margin = F.col("base_value") + explain.total("contributions")
    gap = F.max(F.abs(explain.sigmoid(margin) - F.col("probability_default")))
    return df.agg(F.count(F.lit(1)).alias("n"), (gap < 1e-12).alias("adds_up"))


def shown_sql(c: str) -> str:
    number = f"CASE WHEN {c} = floor({c}) THEN format('{{:,d}}', CAST({c} AS BIGINT)) ELSE format('{{:,.2f}}', {c}) END"
    return f"translate({number}, ',.', '.,')"


SHOWN = " UNION ALL ".join(
    f"""SELECT "SK_ID_CURR" AS id, '{c}' AS feature, CASE WHEN "{c}" IS NOT NULL THEN {shown_sql(f'CAST("{c}" AS DOUBLE)')} END AS value FROM clients""" for c in COEF)


@query("base_probability", f"""SELECT "SK_ID_CURR" AS id, round(1e0 / (1e0 + exp(-({e0(INTERCEPT)} + {" + ".join(f"{e0(MEANS[c])} * {e0(w)}" for c, w in COEF.items())}))), 9) AS base_probability FROM clients""")
def _(t: Tables) -> DataFrame:
    out = explain.top_contributions(explained(t), 1)
    return out.select(F.col(K.ID).alias("id"), F.round("base_probability", 9).alias("base_probability"))


@query("top_contributions_per_client", f"""
WITH v AS ({CONTRIBUTIONS}), r AS (SELECT id, feature, v, row_number() OVER (PARTITION BY id, v > 0 ORDER BY abs(v) DESC, feature) AS rank FROM v WHERE v <> 0)
SELECT r.id, CAST(rank AS INTEGER) AS rank, r.feature, t.value, round(v, 9) AS shap_value, CASE WHEN v > 0 THEN 'aumenta risco' ELSE 'reduz risco' END AS effect, 'application' AS source_table FROM r JOIN ({SHOWN}) t ON t.id = r.id AND t.feature = r.feature WHERE rank <= 2
""")
def _(t: Tables) -> DataFrame:
    top = explain.driver_rows(explain.top_contributions(explained(t), 2, features=list(COEF)))
    return rounded(top.withColumnRenamed(K.ID, "id"), 9)


@query("sum_of_other_contributions", f"""
WITH v AS ({CONTRIBUTIONS}), r AS (SELECT id, v, row_number() OVER (PARTITION BY id, v > 0 ORDER BY abs(v) DESC, feature) AS rank FROM v WHERE v <> 0)
SELECT "SK_ID_CURR" AS id, coalesce(round((SELECT sum(v) FROM r WHERE r.id = "SK_ID_CURR" AND rank > 1), 8), 0) + 0e0 AS rest FROM clients
""")
def _(t: Tables) -> DataFrame:
    top = explain.top_contributions(explained(t), 1)
    return top.select(F.col(K.ID).alias("id"), (F.round("sum_other_features", 8) + 0.0).alias("rest"))


# the whole sentence, risk first
NARRATIVE = f"""
WITH v AS ({CONTRIBUTIONS}), r AS (SELECT id, feature, v, row_number() OVER (PARTITION BY id, v > 0 ORDER BY abs(v) DESC, feature) AS rank FROM v WHERE v <> 0),
 n AS (SELECT r.id, v > 0 AS up, string_agg(r.feature || ' = ' || coalesce(t.value, 'ausente') || ' (' || format('{{:+.3f}}', CAST(round(CAST(v AS DECIMAL(18, 9)), 3) AS DOUBLE)) || ')', '; ' ORDER BY rank) AS names
   FROM r JOIN ({SHOWN}) t ON t.id = r.id AND t.feature = r.feature WHERE rank <= 3 GROUP BY 1, 2),
 p AS (SELECT "SK_ID_CURR" AS id, {probability_sql()} AS p FROM clients)
SELECT p.id, 'Cliente ' || p.id || ': risco estimado de ' || format('{{:.1f}}%', CAST(round(CAST(p * 100 AS DECIMAL(18, 9)), 1) AS DOUBLE)) || ', ' || CASE WHEN p >= {e0(CUT)} THEN 'acima' ELSE 'abaixo' END || ' do corte de {CUT:.1%} → '
  || CASE WHEN p >= {e0(CUT)} THEN 'NEGAR' ELSE 'APROVAR' END || '.' || coalesce(' Principais fatores de risco: ' || a.names || '.', '') || coalesce(' Fatores favoráveis: ' || b.names || '.', '') AS narrative
FROM p LEFT JOIN n a ON a.id = p.id AND a.up LEFT JOIN n b ON b.id = p.id AND NOT b.up"""


@query("client_narratives", NARRATIVE)
def _(t: Tables) -> DataFrame:
    out = explain.top_contributions(explained(t), 10)
    text = explain.narrate(out, CUT, explain.shown_values(out, list(COEF)))
    return text.select(F.col(K.ID).alias("id"), "narrative")


WHAT_IF_CIR = '("AMT_CREDIT" * 1.5e0 / nullif("AMT_INCOME_TOTAL", 0))'


@query("what_if_simulation", f"""
WITH p AS (SELECT "SK_ID_CURR" AS id, {probability_sql()} AS b, {probability_sql(CREDIT_INCOME_RATIO=WHAT_IF_CIR)} AS c FROM clients)
SELECT id, round(b, 9) AS base_probability, CASE WHEN b >= {CUT}e0 THEN 'NEGAR' ELSE 'APROVAR' END AS base_decision, round(c, 9) AS changed_probability, CASE WHEN c >= {CUT}e0 THEN 'NEGAR' ELSE 'APROVAR' END AS changed_decision,
 round(c - b, 9) + 0e0 AS delta_probability, (b >= {CUT}e0) <> (c >= {CUT}e0) AS decision_changed FROM p
""")
def _(t: Tables) -> DataFrame:
    out = explain.simulate(t.clients, linear_scorer, {"AMT_CREDIT": F.col("AMT_CREDIT") * 1.5}, CUT)
    return rounded(out.withColumnRenamed(K.ID, "id"), 9)


SWEEP = [i / 10 for i in range(11)]
SWEEP_SQL = f"""WITH v AS (SELECT unnest([{", ".join(f"{x!r}e0" for x in SWEEP)}]) AS value),
 s AS (SELECT "SK_ID_CURR" AS id, value, {probability_sql(EXT_SOURCE_2="value")} AS p FROM clients, v)"""


@query("what_if_sweep", f"{SWEEP_SQL} SELECT id, value, round(p, 9) AS probability_default, CASE WHEN p >= {CUT}e0 THEN 'NEGAR' ELSE 'APROVAR' END AS decision FROM s")
def _(t: Tables) -> DataFrame:
    out = explain.sweep(t.clients, linear_scorer, "EXT_SOURCE_2", SWEEP, CUT)
    return rounded(out.withColumnRenamed(K.ID, "id"), 9)


@query("decision_switch_points", f"""
{SWEEP_SQL}, d AS (SELECT id, value, CASE WHEN p >= {CUT}e0 THEN 'NEGAR' ELSE 'APROVAR' END AS decision FROM s),
 l AS (SELECT *, lag(decision) OVER (PARTITION BY id ORDER BY value) AS before FROM d)
SELECT id, value, before AS from_decision, decision AS to_decision FROM l WHERE before <> decision
""")
def _(t: Tables) -> DataFrame:
    swept = explain.sweep(t.clients, linear_scorer, "EXT_SOURCE_2", SWEEP, CUT)
    return explain.switch_points(swept).withColumnRenamed(K.ID, "id")


@query("drivers_of_change", f"""
WITH x AS (SELECT "SK_ID_CURR" AS id, (coalesce({WHAT_IF_CIR}, 3e0) - coalesce("CREDIT_INCOME_RATIO", 3e0)) * 0.4e0 AS v FROM clients)
SELECT id, 1 AS rank, 'CREDIT_INCOME_RATIO' AS feature, round(v, 9) AS shap_value, CASE WHEN v > 0 THEN 'aumenta risco' ELSE 'reduz risco' END AS effect, 'application' AS source_table FROM x WHERE abs(v) > 1e-9
""")
def _(t: Tables) -> DataFrame:
    changed = features.apply_changes(t.clients, {"AMT_CREDIT": F.col("AMT_CREDIT") * 1.5})
    contributions = explain.linear_contributions(COEF, MEANS)
    out = explain.change_drivers(
        t.clients.withColumn("contributions", contributions), changed.withColumn("contributions", contributions))
    return rounded(out.withColumnRenamed(K.ID, "id"), 9)


# ---------------------------------------------------------------- learned models (invariants)


@query("trained_score_table")
def _(t: Tables) -> DataFrame:
    return learning.score_table(training.applications(t), training.trained(t))


CLIENT_SPLIT = """u AS (SELECT "SK_ID_CURR" AS id, "TARGET" AS y, ('0x' || substr(md5("SK_ID_CURR" || '|42'), 1, 8))::BIGINT / 4294967296e0 AS u FROM clients),
 i AS (SELECT id, y, row_number() OVER (PARTITION BY y ORDER BY u, id) - 1 AS i, count(*) OVER (PARTITION BY y) AS n FROM u),
 parts AS (SELECT id, y, CASE WHEN i < n * 50 // 100 THEN 'train' WHEN i < n * 70 // 100 THEN 'valid' WHEN i < n * 80 // 100 THEN 'calib' ELSE 'test' END AS split FROM i)"""


@query("trained_score_table_shape", f"""
WITH {CLIENT_SPLIT} SELECT split, count(*) AS n, CAST(sum(y) AS BIGINT) AS events, count(*) AS n_served, count(*) AS n_raw, count(CASE WHEN split <> 'train' THEN 1 END) AS n_baseline,
 CAST(0 AS BIGINT) AS outside_unit FROM parts GROUP BY 1
""")
def _(t: Tables) -> DataFrame:
    scores = learning.score_table(training.applications(t), training.trained(t))
    served = F.col(K.SCORE)
    return scores.groupBy("split").agg(
        F.count(F.lit(1)).alias("n"), F.sum("y_true").cast("long").alias("events"), F.count(served).alias("n_served"),
        F.count(K.RAW_SCORE).alias("n_raw"), F.count(K.BASELINE_SCORE).alias("n_baseline"),
        F.count_if((served < 0) | (served > 1)).alias("outside_unit"))


@query("calibrated_order_violations", "SELECT count(*) AS n, CAST(0 AS BIGINT) AS violations FROM clients")
def _(t: Tables) -> DataFrame:
    # one row per raw score: the served score must never fall from one to the next
    scores = learning.score_table(training.applications(t), training.trained(t))
    cells = scores.groupBy(K.RAW_SCORE).agg(F.count(F.lit(1)).alias("n"), F.min(K.SCORE).alias("low"), F.max(K.SCORE).alias("high"))
    ranked = ranking.running_sums(cells.withColumn("one", F.lit(1)), K.RAW_SCORE, ["one"])
    after = ranked.select((F.col("below_one") - 1).alias("below_one"), F.col("low").alias("next_low"))
    pairs = ranked.select("below_one", "n", "low", "high").join(after, "below_one", "left")
    falls = (F.col("low") != F.col("high")) | F.coalesce(F.col("next_low") < F.col("high"), F.lit(False))
    return pairs.agg(F.sum("n").alias("n"), F.count_if(falls).alias("violations"))


@query("trained_run_metrics")
def _(t: Tables) -> DataFrame:
    bundle = training.trained(t)
    return training.run_metrics(learning.score_table(training.applications(t), bundle), bundle)


@query("calibration_keeps_order")
def _(t: Tables) -> DataFrame:
    bundle = training.trained(t)
    metrics = training.run_metrics(learning.score_table(training.applications(t), bundle), bundle)

    def of(model: str, c: str):
        return F.max(F.when(F.col("model") == model, F.col(c)))

    return metrics.agg(
        (F.abs(of("served", "auc") - of("champion", "auc")) < 0.05).alias("auc_kept"),
        (of("served", "brier") < of("champion", "brier")).alias("brier_fell"))


@query("batch_scoring")
def _(t: Tables) -> DataFrame:
    out = learning.predict(training.applications(t), training.trained(t))
    return out.select(F.col(K.ID).alias("id"), "probability_default", "threshold", "decision", "score_band")


@query("stored_and_live_scores_agree", """
SELECT count(*) AS n_compared, true AS agree FROM customer
""")
def _(t: Tables) -> DataFrame:
    bundle = training.trained(t)
    df = training.applications(t)
    folder = writers.write_parquet(learning.score_table(df, bundle), scratch_path(t.spark, "stored-scores"))
    stored = readers.read_parquet(t.spark, folder)
    # the second scoring starts from a text file of the base columns and derives the others again
    bases = [c for c in training.base_inputs(df, bundle.spec) if c not in bundle.spec.categorical]
    text = writers.write_csv(df.select(K.ID, *bases, *bundle.spec.categorical), scratch_path(t.spark, "bases"))
    batch = readers.read_client_batch(t.spark, text, learning.input_names(bundle.spec))
    numbers = [F.expr(f"try_cast(`{c}` AS double)").alias(c) for c in bases]
    words = [F.nullif(F.col(c), F.lit("")).alias(c) for c in bundle.spec.categorical]
    rebuilt = features.recompute(batch.select(F.col(K.ID).cast("long"), *numbers, *words), only_present=False)
    out = learning.agreement(stored, learning.score(rebuilt, bundle))
    return out.select("n_compared", (F.col("max_abs_error") < 1e-12).alias("agree"))


@query("gain_importance")
def _(t: Tables) -> DataFrame:
    return portfolio.importance_ranking(explain.gain_importance(training.trained(t)))


@query("split_importance")
def _(t: Tables) -> DataFrame:
    return portfolio.importance_ranking(explain.split_importance(training.trained(t)))


@query("tree_contributions_add_up", "SELECT count(*) AS n, true AS adds_up FROM customer")
def _(t: Tables) -> DataFrame:
    out = explain.tree_contributions(training.applications(t), training.trained(t))
    return explain.consistency(out).select("n", (F.col("max_abs_error") < 1e-9).alias("adds_up"))


@query("tree_top_drivers")
def _(t: Tables) -> DataFrame:
    out = explain.tree_contributions(training.applications(t), training.trained(t))
    return explain.driver_rows(explain.top_contributions(out, 5)).withColumnRenamed(K.ID, "id")


@query("tree_narratives")
def _(t: Tables) -> DataFrame:
    bundle = training.trained(t)
    df = training.applications(t)
    names = learning.input_names(bundle.spec)
    out = explain.tree_contributions(df, bundle).join(df.select(K.ID, *names), K.ID)
    out = explain.top_contributions(out, 10, features=names).withColumn(
        "decision", C.decide("probability_default", bundle.threshold))
    return explain.narrate(out, bundle.threshold, explain.shown_values(out, names)).select(F.col(K.ID).alias("id"), "decision", "narrative")


@query("trained_what_if")
def _(t: Tables) -> DataFrame:
    bundle = training.trained(t)
    df = training.applications(t)
    return explain.simulate(df, explain.bundle_scorer(bundle), {"EXT_SOURCE_2": 0.1}, bundle.threshold)


@query("native_tree_scores")
def _(t: Tables) -> DataFrame:
    scored = boosting.score(training.applications(t), training.native_trees(t))
    return scored.select(F.col(K.ID).alias("id"), "split", F.col(K.TARGET).alias("y"), K.RAW_SCORE)


@query("native_tree_facts", f"""
WITH {CLIENT_SPLIT} SELECT split, count(*) AS n, CAST(sum(y) AS BIGINT) AS events, true AS adds_up, true AS prefix_agrees, true AS learns FROM parts GROUP BY 1
""")
def _(t: Tables) -> DataFrame:
    model, df = training.native_trees(t), training.applications(t)
    explained = boosting.contributions(df, model).join(df.select(K.ID, "split", K.TARGET), K.ID)
    gap = F.max(F.abs(explain.sigmoid("margin") - F.col("raw_probability")))
    per = explained.groupBy("split").agg(
        F.count(F.lit(1)).alias("n"), F.sum(K.TARGET).cast("long").alias("events"), (gap < 1e-9).alias("adds_up"))
    auc = evaluation.auc(explained, K.TARGET, "raw_probability", ["split"])
    stored = F.lit(model.valid_auc[model.best_iteration - 1])
    # the AUC of the kept prefix, taken from cells while fitting, is that of the scored validation rows
    agrees = (F.col("split") != "valid") | (F.abs(F.col("auc") - stored) < 1e-9)
    facts = per.join(auc, "split").withColumns({"prefix_agrees": agrees, "learns": F.col("auc") > 0.6})
    return facts.select("split", "n", "events", "adds_up", "prefix_agrees", "learns")


@query("native_tree_importance")
def _(t: Tables) -> DataFrame:
    return boosting.importance(t.spark, training.native_trees(t))


NATIVE_CUT = 0.5


@query("native_tree_what_if")
def _(t: Tables) -> DataFrame:
    out = boosting.simulate(training.applications(t), training.native_trees(t), {"EXT_SOURCE_2": 0.1}, NATIVE_CUT)
    return out.withColumnRenamed(K.ID, "id")


@query("native_tree_what_if_facts", """
SELECT count(*) AS n, count("EXT_SOURCE_2") AS n_given, CAST(0 AS BIGINT) AS n_off, true AS walks_fewer FROM clients
""")
def _(t: Tables) -> DataFrame:
    model, df = training.native_trees(t), training.applications(t)
    change = {"EXT_SOURCE_2": 0.1}
    out = boosting.simulate(df, model, change, NATIVE_CUT)
    # the whole model on the changed rows, by a plan of its own
    whole = boosting.score(features.apply_changes(df, change), model, "whole").select(K.ID, "whole")
    both = out.join(whole, K.ID).join(df.select(K.ID, "EXT_SOURCE_2"), K.ID)
    return both.agg(
        F.count(F.lit(1)).alias("n"), F.count("EXT_SOURCE_2").alias("n_given"),
        F.count_if(F.abs(F.col("whole") - F.col("changed_probability")) > 1e-12).alias("n_off"),
        (F.sum("trees_walked") < F.count(F.lit(1)) * len(model.trees)).alias("walks_fewer"))


def native_sweep(t: Tables) -> DataFrame:
    return boosting.sweep(training.applications(t), training.native_trees(t), "EXT_SOURCE_2", SWEEP, NATIVE_CUT)


@query("native_tree_switch_points")
def _(t: Tables) -> DataFrame:
    return explain.switch_points(native_sweep(t)).withColumnRenamed(K.ID, "id")


@query("native_tree_sweep_facts", f"""
SELECT value, count(*) AS n, CAST(0 AS BIGINT) AS n_off FROM clients, (SELECT unnest([{", ".join(f"{x!r}e0" for x in SWEEP)}]) AS value) GROUP BY 1
""")
def _(t: Tables) -> DataFrame:
    model = training.native_trees(t)
    whole = explain.sweep(
        training.applications(t), lambda df: boosting.score(df, model, "probability_default"), "EXT_SOURCE_2", SWEEP, NATIVE_CUT)
    both = native_sweep(t).join(whole.select(K.ID, "value", F.col("probability_default").alias("whole")), [K.ID, "value"])
    off = F.abs(F.col("whole") - F.col("probability_default")) > 1e-12
    return both.groupBy("value").agg(F.count(F.lit(1)).alias("n"), F.count_if(off).alias("n_off"))


@query("native_tree_prefix_auc")
def _(t: Tables) -> DataFrame:
    model = training.native_trees(t)
    rows = [(k + 1, auc, k < model.best_iteration) for k, auc in enumerate(model.valid_auc)]
    return t.spark.createDataFrame(rows, "tree int, auc_valid double, kept boolean")


@query("segment_ceiling_verdict")
def _(t: Tables) -> DataFrame:
    return training.ceiling_verdict(training.segment_ceiling(training.applications(t), training.trained(t)))


@query("trained_segment_auc")
def _(t: Tables) -> DataFrame:
    bundle = training.trained(t)
    df = learning.score(training.applications(t).filter(F.col("split") == "test"), bundle)
    return evaluation.segment_points(df, K.TARGET, K.SCORE, bundle.threshold)
