"""Queries for score evaluation, resampling and segment reports."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.functions import columns as C
from riskloom.functions import constants as K
from riskloom.operators import evaluation as E
from riskloom.operators import gates, ranking
from riskloom.operators import resampling as R
from riskloom.plans.queries_cleaning import AGE_CASE, DIMENSION_SQL, FIVE_YEAR, SEXTILE_CASE, SEXTILE_CTE, rounded
from riskloom.plans.registry import Tables, query

RATES = """
 round(coalesce((tp + tn) / nullif(CAST(tn + fp + fn + tp AS DOUBLE), 0), 0), 9) AS accuracy, round(coalesce(tp / nullif(CAST(tp + fp AS DOUBLE), 0), 0), 9) AS precision,
 round(coalesce(tp / nullif(CAST(tp + fn AS DOUBLE), 0), 0), 9) AS recall, round(coalesce(tn / nullif(CAST(tn + fp AS DOUBLE), 0), 0), 9) AS specificity,
 round(coalesce(2 * tp / nullif(CAST(2 * tp + fp + fn AS DOUBLE), 0), 0), 9) AS f1, round(coalesce((tn + fn) / nullif(CAST(tn + fp + fn + tp AS DOUBLE), 0), 0), 9) AS approval_rate,
 round(coalesce(fn / nullif(CAST(tn + fn AS DOUBLE), 0), 0), 9) AS default_rate_approved, round(coalesce(tp / nullif(CAST(tp + fp AS DOUBLE), 0), 0), 9) AS default_rate_denied"""


def grid_cte(points: int = 99, extra: tuple[float, ...] = (), source: str = "SELECT y, score AS s FROM loans") -> str:
    values = ", ".join(f"{v!r}e0" for v in sorted({*E.grid(points), *extra}))
    return f"""src AS ({source}), grid AS (SELECT unnest([{values}]) AS threshold),
    cm AS (SELECT threshold, count(*) AS n, count(CASE WHEN s < threshold AND y = 0 THEN 1 END) AS tn, count(CASE WHEN s >= threshold AND y = 0 THEN 1 END) AS fp,
      count(CASE WHEN s < threshold AND y = 1 THEN 1 END) AS fn, count(CASE WHEN s >= threshold AND y = 1 THEN 1 END) AS tp FROM grid, src GROUP BY 1)"""


def auc_sql(source: str, by: str = "") -> str:
    """Rank-sum AUC; ``source`` gives y, s and the group columns ``by``."""
    part = f"PARTITION BY {by}" if by else ""
    keep = f"{by}, " if by else ""
    group = f"GROUP BY {by}" if by else ""
    return f"""SELECT {keep}CAST(sum(y) AS BIGINT) AS n_events, CAST(sum(1 - y) AS BIGINT) AS n_nonevents,
      (sum(CASE WHEN y = 1 THEN r END) - sum(y) * (sum(y) + 1) / 2e0) / nullif(CAST(sum(y) AS DOUBLE) * sum(1 - y), 0) AS auc
     FROM (SELECT *, rank() OVER ({part} ORDER BY s) + (count(*) OVER ({part + ',' if part else 'PARTITION BY'} s) - 1) / 2e0 AS r FROM ({source})) {group}"""


CURVE = """cells AS (SELECT {keep}s, sum(y) AS e, sum(1 - y) AS ne FROM ({source}) GROUP BY ALL),
 curve AS (SELECT {keep}s AS threshold, CAST(sum(e) OVER w AS BIGINT) AS tp, CAST(sum(ne) OVER w AS BIGINT) AS fp, CAST(sum(e) OVER a AS BIGINT) AS te, CAST(sum(ne) OVER a AS BIGINT) AS tn,
   row_number() OVER ({part} ORDER BY s DESC) AS position, count(*) OVER a AS n_scores
  FROM cells WINDOW w AS ({part} ORDER BY s DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), a AS ({part}))"""


def curve_cte(source: str, by: str = "") -> str:
    return CURVE.format(source=source, keep=f"{by}, " if by else "", part=f"PARTITION BY {by}" if by else "")


LOANS = "SELECT id, y, score AS s, grp FROM loans"
RAW = "SELECT id, y, raw AS s, grp FROM loans"


# ---------------------------------------------------------------- confusion, cost, thresholds


@query("confusion_matrix", f"""
WITH cm AS (SELECT 0.35e0 AS threshold, count(*) AS n, count(CASE WHEN score < 0.35e0 AND y = 0 THEN 1 END) AS tn, count(CASE WHEN score >= 0.35e0 AND y = 0 THEN 1 END) AS fp,
  count(CASE WHEN score < 0.35e0 AND y = 1 THEN 1 END) AS fn, count(CASE WHEN score >= 0.35e0 AND y = 1 THEN 1 END) AS tp FROM loans)
SELECT threshold, n, tn, fp, fn, tp, {RATES}, round(fn + 0.1e0 * fp, 6) AS cost FROM cm
""")
def _(t: Tables) -> DataFrame:
    return rounded(E.confusion_report(t.loans, "y", "score", 0.35), 9).withColumn("cost", F.round("cost", 6))


@query("confusion_by_group", f"""
WITH cm AS (SELECT grp, count(*) AS n, count(CASE WHEN score < 0.5e0 AND y = 0 THEN 1 END) AS tn, count(CASE WHEN score >= 0.5e0 AND y = 0 THEN 1 END) AS fp,
  count(CASE WHEN score < 0.5e0 AND y = 1 THEN 1 END) AS fn, count(CASE WHEN score >= 0.5e0 AND y = 1 THEN 1 END) AS tp FROM loans GROUP BY 1)
SELECT grp, n, tn, fp, fn, tp, {RATES} FROM cm
""")
def _(t: Tables) -> DataFrame:
    return rounded(E.with_rates(E.confusion(t.loans, "y", "score", 0.5, ["grp"])).drop("threshold"), 9)


@query("error_cost", """
SELECT grp, CAST(count(CASE WHEN score < 0.4e0 AND y = 1 THEN 1 END) * 5e0 + count(CASE WHEN score >= 0.4e0 AND y = 0 THEN 1 END) * 1e0 AS DOUBLE) AS cost FROM loans GROUP BY 1
""")
def _(t: Tables) -> DataFrame:
    return E.confusion_report(t.loans, "y", "score", 0.4, 5.0, 1.0, ["grp"]).select("grp", "cost")


@query("threshold_sweep", f"""
WITH {grid_cte()} SELECT threshold, n, tn, fp, fn, tp, {RATES}, round(fn + 0.1e0 * fp, 6) AS cost FROM cm
""")
def _(t: Tables) -> DataFrame:
    return rounded(E.threshold_sweep(t.loans, "y", "score"), 9)


@query("business_threshold", f"""
WITH {grid_cte()} SELECT threshold, n, tn, fp, fn, tp, {RATES}, round(fn + 0.1e0 * fp, 6) AS cost FROM cm ORDER BY fn + 0.1e0 * fp, threshold LIMIT 1
""")
def _(t: Tables) -> DataFrame:
    return rounded(E.best_threshold(t.loans, "y", "score"), 9).withColumn("cost", F.round("cost", 6))


@query("threshold_analysis", f"""
WITH {grid_cte(99, (0.333,), "SELECT y_true AS y, proba_champion AS s FROM scores WHERE split = 'valid'")},
 p AS (SELECT *, fn + 0.1e0 * fp AS cost, (tn + fn) / CAST(n AS DOUBLE) AS ok FROM cm),
 b AS (SELECT * FROM p WHERE threshold <> 0.333e0 ORDER BY cost, threshold LIMIT 1), c AS (SELECT * FROM p WHERE threshold = 0.333e0)
SELECT b.n, round(1e0 / 0.1e0, 9) AS cost_ratio, round(b.threshold, 9) AS best_threshold, round(b.cost, 9) AS best_cost, round(b.ok, 9) AS best_approval_rate, 0.333e0 AS frozen_threshold,
 round(c.cost, 9) AS frozen_cost, round(c.ok, 9) AS frozen_approval_rate, round(b.cost - c.cost, 9) AS delta_cost FROM b, c
""")
def _(t: Tables) -> DataFrame:
    valid = t.scores.filter(F.col("split") == "valid")
    return rounded(E.threshold_analysis(valid, "y_true", K.SCORE, 0.333), 9)


@query("cost_ratio_sensitivity", f"""
WITH {grid_cte()}, r AS (SELECT unnest([1e0, 5e0, 10e0, 20e0, 50e0]) AS cost_ratio),
 p AS (SELECT cost_ratio, threshold, fn * cost_ratio + fp AS cost, (tn + fn) / CAST(n AS DOUBLE) AS approval_rate, coalesce(fn / nullif(CAST(tn + fn AS DOUBLE), 0), 0) AS default_rate_approved,
  row_number() OVER (PARTITION BY cost_ratio ORDER BY fn * cost_ratio + fp, threshold) AS k FROM cm, r)
SELECT cost_ratio, round(threshold, 9) AS threshold, cost, round(approval_rate, 9) AS approval_rate, round(default_rate_approved, 9) AS default_rate_approved FROM p WHERE k = 1
""")
def _(t: Tables) -> DataFrame:
    return rounded(E.cost_sensitivity(t.loans, "y", "score"), 9)


# ---------------------------------------------------------------- ranking quality


@query("exact_auc", f"SELECT n_events, n_nonevents, round(auc, 9) AS auc, round(2 * auc - 1, 9) AS gini FROM ({auc_sql(LOANS)})")
def _(t: Tables) -> DataFrame:
    return rounded(E.auc_summary(t.loans, "y", "score"), 9)


@query("exact_auc_by_group", f"SELECT grp, n_events, n_nonevents, round(auc, 9) AS auc FROM ({auc_sql(RAW, 'grp')})")
def _(t: Tables) -> DataFrame:
    return rounded(E.auc(t.loans, "y", "raw", ["grp"]), 9)


@query("auc_by_period", f"SELECT yr, n_events, n_nonevents, round(auc, 9) AS auc FROM ({auc_sql('SELECT yr, y, raw AS s FROM loans', 'yr')})")
def _(t: Tables) -> DataFrame:
    return rounded(E.auc(t.loans, "y", "raw", ["yr"]), 9)


@query("roc_curve", f"""
WITH {curve_cte(LOANS)} SELECT threshold, position, round(tp / CAST(te AS DOUBLE), 9) AS tpr, round(fp / CAST(tn AS DOUBLE), 9) AS fpr FROM curve
UNION ALL SELECT NULL, 0, 0e0, 0e0
""")
def _(t: Tables) -> DataFrame:
    return rounded(E.roc_curve(t.loans, "y", "score"), 9)


@query("roc_curve_downsampled", f"""
WITH {curve_cte(RAW)}, n AS (SELECT max(n_scores) + 1 AS n FROM curve), keep AS (SELECT DISTINCT CAST(floor(k * (n - 1) / 299) AS BIGINT) AS i FROM range(300) x(k), n)
SELECT threshold, position, round(tp / CAST(te AS DOUBLE), 9) AS tpr, round(fp / CAST(tn AS DOUBLE), 9) AS fpr FROM curve WHERE n_scores + 1 <= 300 OR position IN (SELECT i FROM keep)
UNION ALL SELECT NULL, 0, 0e0, 0e0
""")
def _(t: Tables) -> DataFrame:
    return rounded(E.roc_curve(t.loans, "y", "raw", 300), 9)


@query("ks_statistic", f"""
WITH {curve_cte(RAW, 'grp')}, g AS (SELECT grp, threshold, tp / CAST(te AS DOUBLE) - fp / CAST(tn AS DOUBLE) AS gap FROM curve)
SELECT grp, round(greatest(max(gap), 0), 9) AS ks, arg_max(threshold, (gap, threshold)) AS ks_threshold FROM g GROUP BY 1
""")
def _(t: Tables) -> DataFrame:
    return rounded(E.ks(t.loans, "y", "raw", ["grp"]), 9)


@query("ks_curve", f"""
WITH {curve_cte(LOANS)} SELECT threshold, position, round(tp / CAST(te AS DOUBLE), 9) AS tpr, round(fp / CAST(tn AS DOUBLE), 9) AS fpr,
 round(tp / CAST(te AS DOUBLE) - fp / CAST(tn AS DOUBLE), 9) AS ks FROM curve UNION ALL SELECT NULL, 0, 0e0, 0e0, 0e0
""")
def _(t: Tables) -> DataFrame:
    return rounded(E.ks_curve(t.loans, "y", "score"), 9)


@query("precision_recall_curve", f"""
WITH {curve_cte(LOANS)} SELECT threshold, round(tp / CAST(tp + fp AS DOUBLE), 9) AS precision, round(tp / CAST(te AS DOUBLE), 9) AS recall FROM curve
""")
def _(t: Tables) -> DataFrame:
    return rounded(E.precision_recall_curve(t.loans, "y", "score"), 9)


@query("decile_table", f"""
WITH r AS (SELECT y, s, row_number() OVER (ORDER BY s DESC, id) - 1 AS i, count(*) OVER () AS n, sum(y) OVER () AS te FROM ({LOANS})),
 d AS (SELECT CAST(((i + 1) * 10 - 1) // n AS INTEGER) + 1 AS decile, y, s, n, te FROM r),
 g AS (SELECT decile, count(*) AS n, min(s) AS min_score, max(s) AS max_score, avg(s) AS avg_score, CAST(sum(y) AS BIGINT) AS events, max(te) / CAST(max(n) AS DOUBLE) AS base FROM d GROUP BY 1),
 c AS (SELECT *, sum(events) OVER (ORDER BY decile) / CAST(sum(events) OVER () AS DOUBLE) AS ce, sum(n - events) OVER (ORDER BY decile) / CAST(sum(n - events) OVER () AS DOUBLE) AS cn FROM g)
SELECT decile, n, min_score, max_score, round(avg_score, 9) AS avg_score, events, round(events / CAST(n AS DOUBLE), 9) AS event_rate, round(events / CAST(n AS DOUBLE) / base, 9) AS lift,
 round(ce, 9) AS cum_event_pct, round(cn, 9) AS cum_nonevent_pct, round(abs(ce - cn), 9) AS ks FROM c
""")
def _(t: Tables) -> DataFrame:
    return rounded(E.decile_table(t.loans, "y", "score", "id"), 9)


@query("brier_score", "SELECT grp, round(avg(pow(score - y, 2)), 9) AS brier, count(*) AS n FROM loans GROUP BY 1")
def _(t: Tables) -> DataFrame:
    return rounded(E.brier_score(t.loans, "y", "score", ["grp"]), 9)


def calibration_sql(edges: str, column: str) -> str:
    return f"""
    WITH e AS (SELECT {edges} AS q FROM loans), d AS (SELECT list_sort(list_distinct(q)) AS q FROM e),
     b AS (SELECT y, {column} AS s, CAST(len(list_filter(q[2:len(q) - 1], lambda x: x <= {column})) AS INTEGER) AS bin FROM loans, d)
    SELECT bin, count(*) AS n, round(avg(s), 11) AS mean_predicted, round(avg(y), 11) AS observed_rate, round(avg(s) - avg(y), 11) AS gap FROM b GROUP BY 1"""


TENTHS = "[" + ", ".join(f"{i / 10}e0" for i in range(11)) + "]"


@query("calibration_quantile_bins", calibration_sql(f"quantile_cont(score, {TENTHS})", "score"))
def _(t: Tables) -> DataFrame:
    return rounded(E.calibration_curve(t.loans, "y", "score"), 11)


@query("calibration_equal_width_bins", calibration_sql("list_transform(range(11), lambda i: min(raw) + i * ((max(raw) - min(raw)) / 10))", "raw"))
def _(t: Tables) -> DataFrame:
    return rounded(E.calibration_curve(t.loans, "y", "raw", strategy="width"), 11)


@query("calibration_by_group", """
WITH e AS (SELECT grp, list_sort(list_distinct(quantile_cont(score, [0e0, 0.2e0, 0.4e0, 0.6e0, 0.8e0, 1e0]))) AS q FROM loans GROUP BY 1),
 b AS (SELECT grp, y, score AS s, CAST(len(list_filter(q[2:len(q) - 1], lambda x: x <= score)) AS INTEGER) AS bin FROM loans JOIN e USING (grp))
SELECT grp, bin, count(*) AS n, round(avg(s), 9) AS mean_predicted, round(avg(y), 9) AS observed_rate, round(avg(s) - avg(y), 9) AS gap FROM b GROUP BY 1, 2
""")
def _(t: Tables) -> DataFrame:
    return rounded(E.grouped_calibration_curve(t.loans, "y", "score", "grp"), 9)


@query("auc_per_split", f"""
WITH m AS (SELECT split, 'champion' AS model, y_true AS y, proba_champion AS s FROM scores UNION ALL SELECT split, 'baseline', y_true, proba_baseline FROM scores WHERE proba_baseline IS NOT NULL),
 a AS ({auc_sql('SELECT * FROM m', 'split, model')}),
 p AS (SELECT max(CASE WHEN split = 'train' AND model = 'champion' THEN auc END) AS tr, max(CASE WHEN split = 'valid' AND model = 'champion' THEN auc END) AS va,
  max(CASE WHEN split = 'test' AND model = 'champion' THEN auc END) AS te, max(CASE WHEN split = 'test' AND model = 'baseline' THEN auc END) AS ba FROM a)
SELECT round(tr, 9) AS auc_train, round(va, 9) AS auc_valid, round(te, 9) AS auc_test, round(ba, 9) AS auc_baseline, round(tr - te, 9) AS overfit_gap, round(te - ba, 9) AS lift_vs_baseline FROM p
""")
def _(t: Tables) -> DataFrame:
    return rounded(E.split_quality(t.scores, "y_true"), 9)


# ---------------------------------------------------------------- groups

PAIRS = """cells AS (SELECT grp, score, sum(y) AS e, sum(1 - y) AS ne FROM loans GROUP BY 1, 2),
 pairs AS (SELECT a.grp AS event_group, b.grp AS nonevent_group, CAST(sum(a.e * b.ne) AS DOUBLE) AS pairs,
   sum(a.e * b.ne * CASE WHEN a.score > b.score THEN 1e0 WHEN a.score = b.score THEN 0.5e0 ELSE 0e0 END) AS won FROM cells a, cells b GROUP BY 1, 2)"""


@query("auc_matrix_between_groups", f"""
WITH {PAIRS} SELECT event_group, nonevent_group, pairs, won, round(won / pairs, 9) AS auc FROM pairs WHERE pairs > 0
""")
def _(t: Tables) -> DataFrame:
    return E.auc_matrix(t.loans, "y", "score", "grp").withColumn("auc", F.round("auc", 9))


@query("auc_within_between", f"""
WITH {PAIRS}, a AS (SELECT sum(pairs) AS p, sum(won) AS w, sum(CASE WHEN event_group = nonevent_group THEN pairs ELSE 0 END) AS pi, sum(CASE WHEN event_group = nonevent_group THEN won ELSE 0 END) AS wi FROM pairs)
SELECT round(w / p, 9) AS auc_overall, round(wi / pi, 9) AS auc_within, round((w - wi) / (p - pi), 9) AS auc_between, round(pi / p, 9) AS w_within, round((p - pi) / p, 9) AS w_between, p AS pairs_total FROM a
""")
def _(t: Tables) -> DataFrame:
    return rounded(E.auc_within_between(E.auc_matrix(t.loans, "y", "score", "grp")), 9)


QUALITY = """count(*) AS n, CAST(sum(y) AS BIGINT) AS n_events, round(avg(CASE WHEN s < {thr}e0 THEN 1e0 ELSE 0e0 END), 9) AS approval_rate, round(avg(y), 9) AS default_rate,
 round(avg(s), 9) AS avg_score, round(avg(pow(s - y, 2)), 9) AS brier, round(avg(s) - avg(y), 9) AS calibration_gap"""


def quality_sql(source: str, by: str, threshold: float, min_count: int = 30) -> str:
    keys = ", ".join(f"a.{k}" for k in by.split(", "))
    on = " AND ".join(f"a.{k} = g.{k}" for k in by.split(", "))
    return f"""WITH src AS ({source}), a AS ({auc_sql('SELECT * FROM src', by)}),
     g AS (SELECT {by}, {QUALITY.format(thr=threshold)} FROM src GROUP BY {by})
    SELECT {keys}, g.n, g.n_events, round(a.auc, 9) AS auc, g.approval_rate, g.default_rate, g.avg_score, g.brier, g.calibration_gap
    FROM a JOIN g ON {on} WHERE g.n >= {min_count}"""


SCORED = "proba_champion IS NOT NULL"
AXES_SOURCE = f"""SELECT 'gender' AS dimension, "CODE_GENDER" AS "group", "TARGET" AS y, proba_champion AS s FROM clients WHERE {SCORED} AND "CODE_GENDER" IS NOT NULL
 UNION ALL SELECT 'age_band', {AGE_CASE}, "TARGET", proba_champion FROM clients WHERE {SCORED}
 UNION ALL SELECT 'thin_file', {DIMENSION_SQL['thin_file']}, "TARGET", proba_champion FROM clients WHERE {SCORED}"""


@query("segment_quality", f"""
WITH total AS (SELECT count(*) AS t FROM clients WHERE {SCORED}), q AS ({quality_sql(AXES_SOURCE, 'dimension, "group"', 0.09)})
SELECT q.*, round(n / CAST(t AS DOUBLE), 9) AS share_of_base FROM q, total
""")
def _(t: Tables) -> DataFrame:
    return rounded(E.segment_points(t.clients, K.TARGET, K.SCORE, 0.09), 9)


@query("axis_quality_age_bands", quality_sql(f'SELECT {AGE_CASE} AS band, "TARGET" AS y, proba_champion AS s FROM clients WHERE {SCORED}', "band", 0.09))
def _(t: Tables) -> DataFrame:
    df = t.clients.withColumn("band", C.age_band())
    return rounded(E.group_quality(df, K.TARGET, K.SCORE, ["band"], 0.09), 9)


@query("axis_quality_sextiles", f"""
WITH {SEXTILE_CTE}, q AS ({quality_sql(f'SELECT {SEXTILE_CASE} AS band, "TARGET" AS y, proba_champion AS s FROM clients, e WHERE {SCORED} AND "AGE_YEARS" IS NOT NULL', "band", 0.09)}) SELECT * FROM q
""")
def _(t: Tables) -> DataFrame:
    df, _cuts = ranking.sextiles(t.clients, "AGE_YEARS", "band")
    return rounded(E.group_quality(df, K.TARGET, K.SCORE, ["band"], 0.09), 9)


@query("axis_quality_five_year_windows", quality_sql(f'SELECT {FIVE_YEAR} AS band, "TARGET" AS y, proba_champion AS s FROM clients WHERE {SCORED} AND "AGE_YEARS" IS NOT NULL', "band", 0.09))
def _(t: Tables) -> DataFrame:
    df = t.clients.withColumn("band", C.five_year_window("AGE_YEARS"))
    return rounded(E.group_quality(df, K.TARGET, K.SCORE, ["band"], 0.09), 9)


@query("tie_cost_by_band", f"""
WITH src AS (SELECT {AGE_CASE} AS band, "TARGET" AS y, proba_champion AS c, proba_champion_raw AS r FROM clients WHERE {SCORED}),
 a AS ({auc_sql('SELECT band, y, c AS s FROM src', 'band')}), b AS ({auc_sql('SELECT band, y, r AS s FROM src', 'band')}),
 d AS (SELECT band, count(*) AS n, count(DISTINCT c) AS dc, count(DISTINCT r) AS dr FROM src GROUP BY 1)
SELECT a.band, d.n, round(a.auc, 9) AS auc_calibrated, round(b.auc, 9) AS auc_raw, round(a.auc - b.auc, 9) AS delta, dc AS distinct_calibrated, dr AS distinct_raw
FROM a JOIN b USING (band) JOIN d USING (band) WHERE d.n >= 30 AND a.auc IS NOT NULL
""")
def _(t: Tables) -> DataFrame:
    df = t.clients.withColumn("band", C.age_band())
    return rounded(E.tie_cost(df, K.TARGET, K.SCORE, K.RAW_SCORE, "band"), 9)


PROFILE_FEATURES = ["EXT_SOURCE_1", "EXT_SOURCE_2", "EXT_SOURCE_3", "AMT_INCOME_TOTAL", "YEARS_EMPLOYED"]


def feature_profile_sql() -> str:
    long = " UNION ALL ".join(
        f"""SELECT '{c}' AS feature, {AGE_CASE} AS band, "TARGET" AS y, CAST("{c}" AS DOUBLE) AS v FROM clients""" for c in PROFILE_FEATURES)
    absent = auc_sql("SELECT feature, band, y, CASE WHEN v IS NULL THEN 1e0 ELSE 0e0 END AS s FROM l", "feature, band")
    return f"""
    WITH l AS ({long}), a AS ({auc_sql('SELECT feature, band, y, v AS s FROM l WHERE v IS NOT NULL', 'feature, band')}), m AS ({absent}),
     o AS (SELECT feature, stddev_pop(v) AS sd, count(v) / CAST(count(*) AS DOUBLE) AS cov FROM l GROUP BY 1),
     g AS (SELECT feature, band, count(v) AS n_usable, count(v) / CAST(count(*) AS DOUBLE) AS coverage, stddev_pop(v) AS sd FROM l GROUP BY 1, 2)
    SELECT g.feature, g.band, g.n_usable, round(g.coverage, 9) AS coverage, round(o.cov, 9) AS overall_coverage, round(greatest(a.auc, 1 - a.auc), 9) AS auc_univariate,
     CASE WHEN g.coverage > 0 AND g.coverage < 1 THEN round(greatest(m.auc, 1 - m.auc), 9) END AS auc_of_absence, round(g.sd / nullif(o.sd, 0), 9) AS std_ratio
    FROM g JOIN o USING (feature) JOIN a USING (feature, band) LEFT JOIN m USING (feature, band) WHERE g.n_usable >= 30 AND a.auc IS NOT NULL"""


@query("feature_profile_by_band", feature_profile_sql())
def _(t: Tables) -> DataFrame:
    df = t.clients.withColumn("band", C.age_band())
    return rounded(E.feature_profile(df, K.TARGET, "band", PROFILE_FEATURES), 9)


# ---------------------------------------------------------------- resampling

REPLICAS = 500


def uniform_sql(key: str, unit: str, replica: str, seed: int = 42) -> str:
    m, p = R.MIX, C.MIX_PRIME
    a = f"(({key} * {m['key']} + {unit} * {m['unit']} + {replica} * {m['replica']} + {seed}) % {p})"
    b = f"(({a} * {a} + {m['offset']}) % {p})"
    c = f"(({b} * {m['key']} + {replica} * {m['replica2']} + {unit} * {m['unit2']}) % {p})"
    return f"((({c} * {c} + {a}) % {p}) / {p}e0)"


def replica_ctes(source: str, by: str, rate: str = "1e0", extra: str = "", replicas: int = REPLICAS) -> str:
    """``source`` gives y, s and the text columns of ``by``/``extra``; CTE ``reps`` holds AUC and gap per replica."""
    keys = [k for k in (by, extra) if k]
    names = ", ".join(keys)
    keep = f"{names}, " if names else ""
    byk = f"{by}, " if by else ""
    text = " || '|' || ".join([*[f"CAST({k} AS VARCHAR)" for k in names.split(", ") if k], "CAST(CAST(round(s * 1e9) AS BIGINT) AS VARCHAR)", "CAST(y AS VARCHAR)"])
    rows, width = R.BLOCK_ROWS, R.TABLE_WIDTH
    digits = ", ".join(f"({1 << d}, {d})" for d in range(rows.bit_length() - 1))
    return f"""bsrc AS ({source}),
     cells AS (SELECT {keep}{rate} AS rate, y, s, ('0x' || substr(md5({text}), 1, 8))::BIGINT % {C.MIX_PRIME} AS k, count(*) AS n FROM bsrc GROUP BY ALL),
     units AS (SELECT * EXCLUDE (n), unnest(range(1, n // {rows} + 1)) AS unit, {rows} AS m FROM cells
        UNION ALL SELECT c.* EXCLUDE (n), n // {rows} + 1 + d.digit AS unit, d.m FROM cells c JOIN (VALUES {digits}) d(m, digit) ON (n // d.m) % 2 = 1),
     draws AS (SELECT {byk}y, s, m * rate AS mean, replica, {uniform_sql('k', 'unit', 'replica')} AS u FROM units, (SELECT range AS replica FROM range({replicas}))),
     means AS (SELECT DISTINCT m * rate AS mean FROM units),
     spans AS (SELECT mean, CAST(greatest(0, floor(mean - {width} * sqrt(mean) - {width})) AS BIGINT) AS low, CAST(ceil(mean + {width} * sqrt(mean) + {width}) AS BIGINT) AS high FROM means),
     pmf AS (SELECT mean, low, unnest(range(low, high + 1)) AS kk FROM spans),
     cdf AS (SELECT mean, low, kk, sum(exp(kk * ln(mean) - mean - lgamma(kk + 1))) OVER (PARTITION BY mean ORDER BY kk) AS upto FROM pmf),
     weights AS (SELECT draws.* EXCLUDE (mean, u), coalesce(cdf.kk + 1, 0) AS w FROM draws ASOF LEFT JOIN cdf ON draws.mean = cdf.mean AND draws.u >= cdf.upto),
     wcells AS (SELECT {byk}replica, s, sum(CASE WHEN y = 1 THEN w ELSE 0 END) AS e, sum(CASE WHEN y = 0 THEN w ELSE 0 END) AS ne FROM weights GROUP BY {byk}replica, s),
     wcum AS (SELECT *, sum(ne) OVER (PARTITION BY {byk}replica ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - ne AS below FROM wcells),
     reps AS (SELECT {byk}replica, sum(e) AS e, sum(ne) AS ne, sum(e * (below + ne / 2e0)) / nullif(CAST(sum(e) AS DOUBLE) * sum(ne), 0) AS auc,
        (sum((e + ne) * s) - sum(e)) / nullif(CAST(sum(e) + sum(ne) AS DOUBLE), 0) AS gap FROM wcum GROUP BY {byk}replica)"""


DIFF_CTES = """pt AS (SELECT {axis}{g}, auc, CAST(n_events AS DOUBLE) * n_nonevents AS w FROM points WHERE auc IS NOT NULL),
 ref AS (SELECT a.{g}{axa}, a.auc AS auc_target, sum(b.w * b.auc) / sum(b.w) AS auc_reference FROM pt a JOIN pt b ON a.{g} <> b.{g}{on} GROUP BY ALL),
 rr AS (SELECT r.*, pt.w FROM reps r JOIN pt ON r.{g} = pt.{g}{onp}),
 dd AS (SELECT a.{g}{axa}, a.replica, a.auc - sum(CASE WHEN b.auc IS NOT NULL THEN b.w * b.auc END) / nullif(sum(CASE WHEN b.auc IS NOT NULL THEN b.w END), 0) AS diff
        FROM rr a JOIN rr b ON a.replica = b.replica AND a.{g} <> b.{g}{on} GROUP BY a.{g}{axa}, a.replica, a.auc),
 dq AS (SELECT {axis}{g}, quantile_cont(diff, 0.025) AS lo, quantile_cont(diff, 0.975) AS hi, count(diff) AS n_boot,
        least(1e0, 2e0 * (1 + least(count(CASE WHEN diff >= 0 THEN 1 END), count(CASE WHEN diff <= 0 THEN 1 END))) / (count(diff) + 1)) AS p_value FROM dd GROUP BY ALL)"""
DIFF_COLUMNS = """round(auc_target, 9) AS auc_target, round(auc_reference, 9) AS auc_reference, round(auc_target - auc_reference, 9) AS diff, round(lo, 9) AS diff_ci_low, round(hi, 9) AS diff_ci_high,
 round(p_value, 9) AS p_value, n_boot, (hi < 0 OR lo > 0) AS significant, hi < 0 AS worse_than_reference"""


def diff_ctes(group: str, axis: str = "") -> str:
    if axis:
        return DIFF_CTES.format(g=group, axis=f"{axis}, ", axa=f", a.{axis}", on=f" AND a.{axis} = b.{axis}", onp=f" AND r.{axis} = pt.{axis}")
    return DIFF_CTES.format(g=group, axis="", axa="", on="", onp="")


@query("bootstrap_auc_interval", f"""
WITH {replica_ctes(LOANS, '')}, p AS ({auc_sql(LOANS)})
SELECT n_events + n_nonevents AS n, n_events, round(p.auc, 9) AS auc, round(q[1], 9) AS ci_low, round(q[2], 9) AS ci_high, round(q[2] - q[1], 9) AS ci_width, nb AS n_boot, CAST(NULL AS VARCHAR) AS note
FROM p, (SELECT quantile_cont(auc, [0.025, 0.975]) AS q, count(auc) AS nb FROM reps)
""")
def _(t: Tables) -> DataFrame:
    return rounded(R.auc_interval(t.loans, "y", "score", replicas=REPLICAS), 9)


@query("bootstrap_auc_interval_by_group", f"""
WITH {replica_ctes(RAW, 'grp')}, p AS ({auc_sql(RAW, 'grp')}), q AS (SELECT grp, quantile_cont(auc, [0.025, 0.975]) AS q, count(auc) AS nb FROM reps GROUP BY 1)
SELECT grp, n_events + n_nonevents AS n, n_events, round(p.auc, 9) AS auc, round(q.q[1], 9) AS ci_low, round(q.q[2], 9) AS ci_high, round(q.q[2] - q.q[1], 9) AS ci_width, nb AS n_boot, CAST(NULL AS VARCHAR) AS note
FROM p JOIN q USING (grp)
""")
def _(t: Tables) -> DataFrame:
    return rounded(R.auc_interval(t.loans, "y", "raw", ["grp"], REPLICAS), 9)


@query("auc_difference_all_groups", f"""
WITH {replica_ctes(RAW, 'grp')}, points AS ({auc_sql(RAW, 'grp')}), {diff_ctes('grp')}
SELECT grp, {DIFF_COLUMNS} FROM ref JOIN dq USING (grp)
""")
def _(t: Tables) -> DataFrame:
    return rounded(R.auc_differences(t.loans, "y", "raw", "grp", REPLICAS), 9)


@query("auc_difference_one_group", f"""
WITH {replica_ctes(LOANS, 'grp')}, points AS ({auc_sql(LOANS, 'grp')}), {diff_ctes('grp')}
SELECT grp, {DIFF_COLUMNS} FROM ref JOIN dq USING (grp) WHERE grp = '1-URGENT'
""")
def _(t: Tables) -> DataFrame:
    return rounded(R.auc_difference_of_group(t.loans, "y", "score", "grp", "1-URGENT", REPLICAS), 9)


@query("calibration_gap_by_group", f"""
WITH {replica_ctes(LOANS, 'grp')}, q AS (SELECT grp, quantile_cont(gap, 0.025) AS lo, quantile_cont(gap, 0.975) AS hi FROM reps GROUP BY 1),
 g AS (SELECT grp, count(*) AS n, avg(s) AS p, avg(y) AS o, avg(pow(s - y, 2)) AS b FROM bsrc GROUP BY 1)
SELECT grp, n, round(p, 9) AS predicted, round(o, 9) AS observed, round(p - o, 9) AS gap, round(lo, 9) AS gap_ci_low, round(hi, 9) AS gap_ci_high, (hi < 0 OR lo > 0) AS gap_significant, round(b, 9) AS brier
FROM g JOIN q USING (grp)
""")
def _(t: Tables) -> DataFrame:
    return rounded(R.calibration_gaps(t.loans, "y", "score", "grp", REPLICAS), 9)


def segment_report_sql(source: str) -> str:
    ctes = f"""{replica_ctes(source, 'dimension, "group"')}, points AS ({auc_sql('SELECT * FROM bsrc', 'dimension, "group"')}), {diff_ctes('"group"', 'dimension')},
 ci AS (SELECT dimension, "group", quantile_cont(auc, [0.025, 0.975]) AS q, count(auc) AS n_boot FROM reps GROUP BY 1, 2),
 fig AS (SELECT dimension, "group", {QUALITY.format(thr=0.09)} FROM bsrc GROUP BY 1, 2)"""
    return f"""WITH {ctes}
SELECT dimension, "group", fig.n, fig.n_events, round(points.auc, 9) AS auc, approval_rate, default_rate, avg_score, brier, calibration_gap,
 CASE WHEN points.auc IS NOT NULL THEN round(ci.q[1], 9) END AS ci_low, CASE WHEN points.auc IS NOT NULL THEN round(ci.q[2], 9) END AS ci_high, CASE WHEN points.auc IS NOT NULL THEN ci.n_boot END AS n_boot,
 round(auc_reference, 9) AS auc_reference, round(auc_target - auc_reference, 9) AS diff, round(lo, 9) AS diff_ci_low, round(hi, 9) AS diff_ci_high, round(p_value, 9) AS p_value,
 coalesce(hi < 0, false) AS confirmed_weakness
FROM fig JOIN points USING (dimension, "group") LEFT JOIN ci USING (dimension, "group") LEFT JOIN ref USING (dimension, "group") LEFT JOIN dq USING (dimension, "group") WHERE fig.n >= 30"""


@query("segment_report", segment_report_sql(AXES_SOURCE))
def _(t: Tables) -> DataFrame:
    return rounded(R.segment_report(t.clients, K.TARGET, K.SCORE, 0.09, REPLICAS), 9)


# a score that follows the outcome, except for one gender and one age band
HASH_UNIT = """('0x' || substr(md5("SK_ID_CURR" || '|7'), 1, 8))::BIGINT / 4294967296e0"""
UNEVEN = f"""CASE WHEN "CODE_GENDER" = 'F' OR {AGE_CASE} = '25-35' THEN {HASH_UNIT} ELSE 0.5e0 * {HASH_UNIT} + 0.4e0 * "TARGET" END"""
UNEVEN_SOURCE = AXES_SOURCE.replace("proba_champion AS s", f"{UNEVEN} AS s").replace('"TARGET", proba_champion FROM', f'"TARGET", {UNEVEN} FROM')


@query("weak_segments", f'WITH r AS ({segment_report_sql(UNEVEN_SOURCE)}) SELECT dimension, "group" FROM r WHERE confirmed_weakness')
def _(t: Tables) -> DataFrame:
    noise = C.hash_unit(K.ID, seed=7)
    weak = F.coalesce(F.col("CODE_GENDER") == "F", F.lit(False)) | (C.age_band() == "25-35")
    uneven = F.when(weak, noise).otherwise(0.5 * noise + 0.4 * F.col(K.TARGET))
    clients = t.clients.withColumn(K.SCORE, F.when(F.col(K.SCORE).isNotNull(), uneven))
    return gates.weak_segments(R.segment_report(clients, K.TARGET, K.SCORE, 0.09, REPLICAS))


OVERALL = f"""SELECT 'all' AS a, "TARGET" AS y, proba_champion AS s FROM clients WHERE {SCORED}"""


@query("overall_quality_with_interval", f"""
WITH {replica_ctes(OVERALL, 'a')}, p AS ({auc_sql('SELECT * FROM bsrc')}), c AS (SELECT quantile_cont(auc, [0.025, 0.975]) AS q, count(auc) AS n_boot FROM reps), f AS (SELECT {QUALITY.format(thr=0.09)} FROM bsrc)
SELECT f.n, f.n_events, round(p.auc, 9) AS auc, approval_rate, default_rate, avg_score, brier, calibration_gap, round(q[1], 9) AS ci_low, round(q[2], 9) AS ci_high, round(q[2] - q[1], 9) AS ci_width, c.n_boot FROM f, p, c
""")
def _(t: Tables) -> DataFrame:
    return rounded(R.overall_quality(t.clients, K.TARGET, K.SCORE, 0.09, REPLICAS), 9)


STRATUM = """CAST(CAST("BUREAU_COUNT" IS NULL AS INTEGER) AS VARCHAR) || '|' || CAST("N_EXT_SOURCE_PRESENT" AS VARCHAR) || '|' ||
 CAST(CAST(coalesce("YEARS_EMPLOYED", -1) > 0 AS INTEGER) + CAST(coalesce("YEARS_EMPLOYED", -1) > 2 AS INTEGER) + CAST(coalesce("YEARS_EMPLOYED", -1) > 5 AS INTEGER) + CAST(coalesce("YEARS_EMPLOYED", -1) > 10 AS INTEGER) AS VARCHAR) || '|' ||
 CAST(CAST(coalesce("INST_COUNT", 0) > 5 AS INTEGER) + CAST(coalesce("INST_COUNT", 0) > 15 AS INTEGER) + CAST(coalesce("INST_COUNT", 0) > 30 AS INTEGER) + CAST(coalesce("INST_COUNT", 0) > 60 AS INTEGER) AS VARCHAR)"""


LEVELED = """SELECT c.*, CAST(greatest(ceil((r - 1) * 8 / CAST(n - 1 AS DOUBLE)), 1) - 1 AS INTEGER) AS lvl FROM clients c LEFT JOIN
 (SELECT "SK_ID_CURR" AS rid, row_number() OVER (ORDER BY "EXT_SOURCE_MEAN", "SK_ID_CURR") AS r, count(*) OVER () AS n FROM clients WHERE "EXT_SOURCE_MEAN" IS NOT NULL) p ON p.rid = c."SK_ID_CURR" """
COHORT_SOURCE = f"""SELECT {AGE_CASE} AS band, {STRATUM} AS stratum, "TARGET" AS y, proba_champion_raw AS s FROM clients WHERE {SCORED}"""


LEVEL_SOURCE = f"""SELECT {AGE_CASE} AS band, concat_ws('|', {STRATUM}, lvl) AS stratum, "TARGET" AS y, proba_champion_raw AS s FROM ({LEVELED}) WHERE {SCORED}"""


def cohort_sql(target: str, reference: str, source: str = COHORT_SOURCE) -> str:
    pool = f"""SELECT y, s, stratum, rate FROM rows_ JOIN (SELECT stratum, count(CASE WHEN band = '{target}' THEN 1 END) / CAST(count(CASE WHEN band IN ({reference}) THEN 1 END) AS DOUBLE) AS rate
      FROM rows_ GROUP BY 1 HAVING count(CASE WHEN band = '{target}' THEN 1 END) > 0 AND count(CASE WHEN band IN ({reference}) THEN 1 END) > 0) USING (stratum) WHERE band IN ({reference})"""
    return f"""
    WITH rows_ AS ({source}), {replica_ctes(pool, '', 'rate', 'stratum')},
     own AS ({auc_sql(f"SELECT y, s FROM rows_ WHERE band = '{target}'")}),
     mix AS (SELECT stratum, count(CASE WHEN band = '{target}' THEN 1 END) AS nt, count(CASE WHEN band IN ({reference}) THEN 1 END) AS np FROM rows_ GROUP BY 1),
     cov AS (SELECT count(*) AS n_strata, sum(CASE WHEN np > 0 THEN nt ELSE 0 END) / CAST(sum(nt) AS DOUBLE) AS coverage, CAST(sum(nt) AS BIGINT) AS n_target FROM mix WHERE nt > 0),
     sp AS (SELECT avg(reps.auc) AS m, quantile_cont(reps.auc, [0.025, 0.975]) AS q, avg(CASE WHEN own.auc < reps.auc THEN 1e0 ELSE 0e0 END) AS p, count(reps.auc) AS nb FROM reps, own)
    SELECT round(own.auc, 9) AS auc_target, round(m, 9) AS auc_cohort, round(q[1], 9) AS ci_low, round(q[2], 9) AS ci_high, round(own.auc - m, 9) AS diff, round(p, 9) AS p_target_worse, nb AS n_boot, n_strata, round(coverage, 9) AS coverage, n_target
    FROM own, cov, sp"""


@query("matched_cohort", cohort_sql("55-65", "'35-45', '45-55'"))
def _(t: Tables) -> DataFrame:
    df, strata = R.profile_strata(t.clients.withColumn("band", C.age_band()))
    return rounded(R.matched_cohort(df, K.TARGET, K.RAW_SCORE, "band", "55-65", ["35-45", "45-55"], strata, REPLICAS), 9)


@query("matched_cohort_coverage", f"""
WITH x AS (SELECT {AGE_CASE} AS band, {STRATUM} AS stratum FROM clients WHERE {SCORED}),
 m AS (SELECT stratum, count(CASE WHEN band = '55-65' THEN 1 END) AS nt, count(CASE WHEN band IN ('35-45', '45-55') THEN 1 END) AS np FROM x GROUP BY 1 HAVING count(CASE WHEN band = '55-65' THEN 1 END) > 0),
 a AS ({auc_sql(f"SELECT y, s FROM (SELECT {AGE_CASE} AS band, " + '"TARGET"' + f" AS y, proba_champion AS s FROM clients WHERE {SCORED}) WHERE band = '55-65'")})
SELECT count(*) AS n_strata, round(sum(CASE WHEN np > 0 THEN nt ELSE 0 END) / CAST(sum(nt) AS DOUBLE), 9) AS coverage, CAST(sum(nt) AS BIGINT) AS n_target, round(max(a.auc), 9) AS auc_target FROM m, a
""")
def _(t: Tables) -> DataFrame:
    df, strata = R.profile_strata(t.clients.withColumn("band", C.age_band()))
    out = R.matched_cohort(df, K.TARGET, K.SCORE, "band", "55-65", ["35-45", "45-55"], strata, 20)
    return rounded(out.select("n_strata", "coverage", "n_target", "auc_target"), 9)


@query("matched_cohort_with_score_level", cohort_sql("25-35", "'35-45', '45-55'", LEVEL_SOURCE))
def _(t: Tables) -> DataFrame:
    df, strata = R.profile_strata(t.clients.withColumn("band", C.age_band()), True)
    return rounded(R.matched_cohort(df, K.TARGET, K.RAW_SCORE, "band", "25-35", ["35-45", "45-55"], strata, REPLICAS), 9)


FLAGGED = f"""SELECT {AGE_CASE} AS band, CASE WHEN "NAME_INCOME_TYPE" = 'Pensioner' THEN 'aposentado' ELSE 'ativo' END AS flag, "TARGET" AS y, proba_champion AS s FROM clients WHERE {SCORED}"""


def flagged(t: Tables) -> DataFrame:
    flag = F.when(F.col("NAME_INCOME_TYPE") == "Pensioner", "aposentado").otherwise("ativo")
    return t.clients.withColumns({"band": C.age_band(), "flag": flag})


@query("flag_inside_bands", f"""
WITH {replica_ctes(FLAGGED, 'band, flag')}, p AS ({auc_sql('SELECT * FROM bsrc', 'band, flag')}), q AS (SELECT band, flag, quantile_cont(auc, [0.025, 0.975]) AS q, count(auc) AS nb FROM reps GROUP BY 1, 2)
SELECT band, flag, n_events + n_nonevents AS n, n_events, round(p.auc, 9) AS auc, round(q.q[1], 9) AS ci_low, round(q.q[2], 9) AS ci_high, round(q.q[2] - q.q[1], 9) AS ci_width, nb AS n_boot,
 round((n_events + n_nonevents) / CAST((SELECT count(*) FROM bsrc z WHERE z.band = p.band) AS DOUBLE), 9) AS share_of_band, round(n_events / CAST(n_events + n_nonevents AS DOUBLE), 9) AS default_rate
FROM p JOIN q USING (band, flag) WHERE n_events + n_nonevents >= 50 AND p.auc IS NOT NULL
""")
def _(t: Tables) -> DataFrame:
    return rounded(R.flag_inside_bands(flagged(t), K.TARGET, K.SCORE, "band", "flag", REPLICAS), 9)


@query("flag_axis_difference", f"""
WITH {replica_ctes('SELECT flag, y, s FROM (' + FLAGGED + ')', 'flag')}, points AS ({auc_sql('SELECT * FROM bsrc', 'flag')}), {diff_ctes('flag')}
SELECT flag, {DIFF_COLUMNS} FROM ref JOIN dq USING (flag)
""")
def _(t: Tables) -> DataFrame:
    return rounded(R.auc_differences(flagged(t), K.TARGET, K.SCORE, "flag", REPLICAS), 9)
