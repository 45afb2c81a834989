"""Training plans over the scenario tables: run, score table, report pack, segment ceiling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.functions import constants as K
from riskloom.operators import boosting, evaluation, explain, features, learning, portfolio, resampling
from riskloom.operators.boosting import BoostedTrees, BoostSpec
from riskloom.operators.learning import Bundle, ModelSpec

# The feature columns of the client table, under the full settings of ModelSpec.
SPEC = ModelSpec(
    numeric=(
        "DAYS_BIRTH", "DAYS_EMPLOYED", "DAYS_REGISTRATION", "DAYS_ID_PUBLISH", "DAYS_LAST_PHONE_CHANGE",
        "CNT_CHILDREN", "CNT_FAM_MEMBERS", "AMT_INCOME_TOTAL", "AMT_CREDIT", "AMT_ANNUITY", "AMT_GOODS_PRICE",
        "EXT_SOURCE_1", "EXT_SOURCE_2", "EXT_SOURCE_3", "BUREAU_COUNT", "PREV_COUNT", "INST_COUNT", "POS_COUNT",
        "CC_COUNT", "AGE_YEARS", "YEARS_EMPLOYED", "CREDIT_INCOME_RATIO", "ANNUITY_INCOME_RATIO", "CREDIT_TERM",
        "EXT_SOURCE_MEAN", "N_EXT_SOURCE_PRESENT",
    ),
    categorical=(
        "CODE_GENDER", "NAME_EDUCATION_TYPE", "NAME_CONTRACT_TYPE", "NAME_INCOME_TYPE", "NAME_FAMILY_STATUS",
        "NAME_HOUSING_TYPE", "OCCUPATION_TYPE", "ORGANIZATION_TYPE", "FLAG_OWN_CAR", "FLAG_OWN_REALTY",
    ),
)
_BUNDLES: dict[tuple, Bundle] = {}
# Native trees on the same columns. Fewer and larger steps than the whole job's 2,000 trees at 0.02 with patience 100.
NATIVE_SPEC = BoostSpec(
    numeric=SPEC.numeric, categorical=SPEC.categorical, trees=30, leaves=16, depth=6, step=0.15, min_rows=40, patience=10)
_NATIVE: dict[tuple, BoostedTrees] = {}


def applications(t) -> DataFrame:
    """Clients without their frozen scores, split; the cuts are searched for once in a query."""
    if "applications" not in t._cache:
        frozen = ("split", "y_true", K.SCORE, K.RAW_SCORE, K.BASELINE_SCORE)
        t._cache["applications"] = learning.stratified_split(t.clients.drop(*frozen))
    return t._cache["applications"]


def base_inputs(df: DataFrame, spec: ModelSpec) -> list[str]:
    """The columns that a scoring job must be given: the model's own, with derived ones replaced by their bases."""
    made = features.derived_columns(df)
    return [c for c in dict.fromkeys([*learning.input_names(spec), *K.YEARS_FROM_DAYS.values()]) if c not in made]


def trained(t) -> Bundle:
    """The bundle of one session and data folder, fitted once."""
    key = (t.spark.sparkContext.applicationId, t.root)
    if key not in _BUNDLES:
        _BUNDLES[key] = learning.train(applications(t), SPEC)
    return _BUNDLES[key]


def native_trees(t) -> BoostedTrees:
    """Trees with native missing values for one session and data folder, fitted once."""
    key = (t.spark.sparkContext.applicationId, t.root)
    if key not in _NATIVE:
        df = applications(t)
        _NATIVE[key] = boosting.fit(df.filter(F.col(K.SPLIT) == "train"), df.filter(F.col(K.SPLIT) == "valid"), NATIVE_SPEC)
    return _NATIVE[key]


def run_metrics(scores: DataFrame, bundle: Bundle) -> DataFrame:
    """AUC, KS and Brier of every model on the test slice, as one row per model."""
    test = scores.filter(F.col(K.SPLIT) == "test")
    long = test.select("y_true", F.explode(F.create_map(
        F.lit("served"), F.col(K.SCORE), F.lit("champion"), F.col(K.RAW_SCORE), F.lit("baseline"), F.col(K.BASELINE_SCORE)
    )).alias("model", "score"))
    quality = evaluation.group_quality(long, "y_true", "score", ["model"], bundle.threshold, 1)
    return quality.join(evaluation.ks(long, "y_true", "score", ["model"]), "model")


def report_pack(scores: DataFrame, clients: DataFrame, bundle: Bundle, replicas: int = 500) -> dict[str, DataFrame]:
    """The named summary tables of a run."""
    valid, test = (scores.filter(F.col(K.SPLIT) == s) for s in ("valid", "test"))
    with_axes = test.join(clients.drop(K.SPLIT), K.ID)
    gain = portfolio.importance_ranking(explain.gain_importance(bundle))
    return {
        "metrics": run_metrics(scores, bundle),
        "roc": evaluation.roc_curve(test, "y_true", K.SCORE, 300),
        "ks": evaluation.ks_curve(test, "y_true", K.SCORE, 300),
        "deciles": evaluation.decile_table(test, "y_true", K.SCORE, K.ID),
        "calibration": evaluation.calibration_curve(test, "y_true", K.SCORE),
        "calibration_raw": evaluation.calibration_curve(test, "y_true", K.RAW_SCORE),
        "sweep": evaluation.threshold_sweep(valid, "y_true", K.SCORE),
        "importance_gain": gain,
        "importance_split": portfolio.importance_ranking(explain.split_importance(bundle)),
        "importance_source": portfolio.importance_by_source(gain),
        "segments": resampling.segment_report(with_axes, "y_true", K.SCORE, bundle.threshold, replicas),
    }


# Variant name and upper age limit of its training rows, settings (a depth for 34, 16 and 8 leaves),
# rows that a segment's own calibration needs.
CEILING_VARIANTS = (("segmentado_<25", 25.0), ("segmentado_<30", 30.0))
CEILING_GRID = ({"depth": 5, "min_rows": 70}, {"depth": 4, "min_rows": 40}, {"depth": 3, "min_rows": 20})
CEILING_CALIBRATION_ROWS = 200


def segment_ceiling(
    df: DataFrame, general: Bundle, age_limit: float = 25.0,
    variants: Sequence[tuple[str, float]] = CEILING_VARIANTS,
    grid: Sequence[dict] = CEILING_GRID, replicas: int = 500, min_rows: int = 500, min_events: int = 50,
) -> DataFrame:
    """Dedicated models per young segment against the general one on the same test clients.

    The loop is over a few named variants and settings; each fit and evaluation is a Spark job. A segment below
    the floors gets no model, and one with a small or one-class calibration slice is judged by its raw score.
    The clients below the highest age limit are kept while the fits read them.
    """
    spec = general.spec
    kept = df.filter(F.col("AGE_YEARS") < max([age_limit, *[limit for _, limit in variants]])).persist(StorageLevel.MEMORY_AND_DISK)
    young = kept.filter((F.col(K.SPLIT) == "test") & (F.col("AGE_YEARS") < age_limit))

    def judged(bundle: Bundle, name: str, setting: str, n_train: int) -> DataFrame:
        scored = learning.score(young, bundle).select(spec.label, K.SCORE, K.RAW_SCORE)
        long = scored.select(spec.label, F.explode(F.create_map(
            F.lit("calibrado"), F.col(K.SCORE), F.lit("cru"), F.col(K.RAW_SCORE))).alias("kind", "score"))
        ci = resampling.auc_interval(long, spec.label, "score", ["kind"], replicas)
        return ci.select(
            F.lit(name).alias("variant"), F.lit(setting).alias("setting"), F.lit(n_train).alias("n_train"),
            "kind", "n", "n_events", "auc", "ci_low", "ci_high")

    try:
        n_general = df.filter(F.col(K.SPLIT) == "train").count()
        parts = [judged(general, "geral (rodada congelada)", "", n_general)]
        for name, limit in variants:
            segment = kept.filter(F.col("AGE_YEARS") < limit)
            counts = learning.class_counts(segment.filter(F.col(K.SPLIT) == "train"), spec.label)
            if sum(counts.values()) < min_rows or counts.get(1, 0) < min_events:
                continue
            held = learning.class_counts(segment.filter(F.col(K.SPLIT) == "calib"), spec.label)
            for setting in grid:
                own = ModelSpec(**{**spec.__dict__, **setting})
                bundle = learning.train(segment, own, with_baseline=False)
                if sum(held.values()) < CEILING_CALIBRATION_ROWS or len(held) < 2:
                    bundle.calibration = None
                label = ", ".join(f"{k}={v}" for k, v in setting.items())
                parts.append(judged(bundle, name, label, sum(counts.values())))
    finally:
        kept.unpersist()
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def ceiling_verdict(results: DataFrame) -> DataFrame:
    """Does the best dedicated model beat the general one on the segment?"""
    own = F.col("variant") != "geral (rodada congelada)"
    served = results.filter(F.col("kind") == "calibrado")
    row = served.agg(
        F.max(F.when(~own, F.col("auc"))).alias("auc_general"), F.max(F.when(own, F.col("auc"))).alias("auc_dedicated")
    )
    delta = F.col("auc_dedicated") - F.col("auc_general")
    return row.withColumns({"delta": delta, "dedicated_is_better": delta > 0})
