"""Splits, training, calibration and scoring with Spark ML."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from fractions import Fraction

from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import (
    Imputer,
    OneHotEncoder,
    StandardScaler,
    StringIndexer,
    VectorAssembler,
)
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.pipeline import Pipeline
from pyspark.ml.regression import IsotonicRegression, IsotonicRegressionModel
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.functions import columns as C
from riskloom.functions import constants as K
from riskloom.operators import aggregation, evaluation, ranking
from riskloom.session import scratch_path, staged

# Shares of the four slices, in this order.
SPLIT_SHARES = (("train", 0.5), ("valid", 0.2), ("calib", 0.1), ("test", 0.2))
# Rows of one partition of a fit, and the partitions that it may always have.
FIT_ROWS = 75_000
FIT_PARTITIONS = 8


# ---------------------------------------------------------------- splits


def class_counts(df: DataFrame, label: str) -> dict:
    rows = df.groupBy(label).agg(F.count(F.lit(1)).alias("n")).collect()
    return {r[label]: r["n"] for r in rows}


def class_text(label: str) -> Column:
    """The class of a row as text; rows without a label share one."""
    return F.when(F.col(label).isNull(), F.lit("none")).otherwise(F.concat(F.lit("="), F.col(label).cast("string")))


def positions_label(
    df: DataFrame, key: str, label: str, cuts: Mapping[object, Sequence[int]], names: Sequence[str]
) -> Column:
    """Name by position inside the class, in the order of a keyed hash."""
    wanted = {v: [p for p in positions if p > 0] for v, positions in cuts.items()}
    found = ranking.cut_keys_by(df.select(label, "_u", key), "_u", key, label, wanted)
    out = None
    for value, positions in cuts.items():
        name = F.lit(names[0])
        for p, following in zip(positions, names[1:]):
            if p == 0:
                name = F.lit(following)
            elif p in found[value]:
                name = F.when(ranking.at_or_after_key("_u", key, found[value][p]), F.lit(following)).otherwise(name)
        hit = F.col(label) == value
        out = F.when(hit, name) if out is None else out.when(hit, name)
    return out


def stratified_split(
    df: DataFrame, key: str = K.ID, label: str = K.TARGET,
    shares: Sequence[tuple[str, float]] = SPLIT_SHARES, seed: int = 42, out: str = K.SPLIT,
) -> DataFrame:
    """Exact shares inside every class, reproducible from the key and the seed alone.

    Rows are ordered by a keyed hash inside their class; only the cut keys are searched for,
    then every row is labelled by comparing its own hash, without a sort or a shuffle. Cuts are
    whole numbers: the shares are added as fractions and a class of n rows is cut at the floor of
    n times each sum. Rows without a label are a class of their own. The three columns that the
    search needs are written once, so its passes do not build the table again.
    """
    hashed = df.withColumns({"_u": C.hash_unit(key, seed=seed), "_class": class_text(label)})
    searched = staged(hashed.select("_class", "_u", key), "split-keys")
    bounds, upto = [], Fraction(0)
    for _name, share in shares[:-1]:
        upto += Fraction(str(share))
        bounds.append(upto)
    cuts = {v: [n * b.numerator // b.denominator for b in bounds] for v, n in class_counts(searched, "_class").items()}
    slice_name = positions_label(searched, key, "_class", cuts, [n for n, _ in shares])
    return hashed.withColumn(out, slice_name).drop("_u", "_class")


def stratified_sample(df: DataFrame, n: int, key: str = K.ID, label: str = K.TARGET, seed: int = 42) -> DataFrame:
    """About ``n`` rows with the class shares of the table (every class rounded on its own)."""
    hashed = df.withColumns({"_u": C.hash_unit(key, seed=seed), "_class": class_text(label)})
    counts = class_counts(hashed, "_class")
    total = sum(counts.values())
    if n >= total:
        return df
    cuts = {v: [(2 * n * c + total) // (2 * total)] for v, c in counts.items()}
    kept = positions_label(hashed, key, "_class", cuts, ["in", "out"])
    return hashed.filter(kept == "in").drop("_u", "_class")


# ---------------------------------------------------------------- models


@dataclass
class ModelSpec:
    numeric: Sequence[str]
    categorical: Sequence[str] = ()
    label: str = K.TARGET
    key: str = K.ID
    max_categories: int = 20
    # boosted trees
    trees: int = 60
    depth: int = 5
    step: float = 0.1
    min_rows: int = 70
    row_share: float = 0.8
    feature_share: str = "0.8"
    seed: int = 42
    # logistic regression
    inverse_penalty: float = 1.0
    iterations: int = 1000


@dataclass
class Bundle:
    """Everything a scoring job needs: models, calibration, threshold and frozen category levels."""

    spec: ModelSpec
    levels: dict[str, list[str]]
    champion: PipelineModel
    calibration: IsotonicRegressionModel | None = None
    baseline: PipelineModel | None = None
    threshold: float = 0.5
    metrics: dict = field(default_factory=dict)


def balanced_weight(df: DataFrame, label: str) -> tuple[Column, int]:
    """Class weight n / (2 * n_class) and the number of labelled rows."""
    counts = class_counts(df.filter(F.col(label).isNotNull()), label)
    n = sum(counts.values())
    out = F.lit(1.0)
    for value, c in counts.items():
        out = F.when(F.col(label) == value, F.lit(n / (len(counts) * c))).otherwise(out)
    return out, n


def frozen_levels(df: DataFrame, spec: ModelSpec) -> dict[str, list[str]]:
    """The most frequent levels of every categorical column, most frequent first."""
    if not spec.categorical:
        return {}
    return aggregation.top_values(df, list(spec.categorical), spec.max_categories)


def as_inputs(df: DataFrame, spec: ModelSpec, levels: Mapping[str, Sequence[str]], missing: str) -> DataFrame:
    """Numbers as doubles with missing flags; unseen or absent categories under one label."""
    cols = {f"x_{c}": F.expr(f"try_cast(`{c}` AS double)") if c in df.columns else F.lit(None).cast("double") for c in spec.numeric}
    cols |= {f"m_{c}": x.isNull().cast("double") for c, x in ((c, cols[f"x_{c}"]) for c in spec.numeric)}
    for c in spec.categorical:
        known = F.col(c).isin(list(levels[c])) if c in df.columns else F.lit(False)
        absent = F.lit(levels[c][0] if missing == "mode" and levels[c] else "?")
        inside = F.when(known, F.col(c)) if c in df.columns else F.lit(None).cast("string")
        if missing == "mode" and c in df.columns:
            cols[f"s_{c}"] = F.when(F.col(c).isNull(), absent).otherwise(F.coalesce(inside, F.lit("?")))
        else:
            cols[f"s_{c}"] = F.coalesce(inside, absent)
    return df.withColumns(cols)


def input_names(spec: ModelSpec) -> list[str]:
    return [*spec.numeric, *spec.categorical]


def fit_baseline(train: DataFrame, spec: ModelSpec, levels: Mapping[str, Sequence[str]]) -> PipelineModel:
    """Median fill and scaling, mode fill and one-hot, class-balanced logistic regression."""
    shaped = as_inputs(train, spec, levels, "mode")
    weight, n = balanced_weight(train, spec.label)
    x = [f"x_{c}" for c in spec.numeric]
    s = [f"s_{c}" for c in spec.categorical]
    stages = [
        Imputer(strategy="median", inputCols=x, outputCols=[f"f_{c}" for c in spec.numeric]),
        VectorAssembler(inputCols=[f"f_{c}" for c in spec.numeric], outputCol="v_num"),
        StandardScaler(inputCol="v_num", outputCol="v_scaled", withMean=True, withStd=True),
    ]
    parts = ["v_scaled"]
    if s:
        stages.append(StringIndexer(inputCols=s, outputCols=[f"i_{c}" for c in spec.categorical], handleInvalid="keep"))
        stages.append(OneHotEncoder(inputCols=[f"i_{c}" for c in spec.categorical], outputCols=[f"o_{c}" for c in spec.categorical], dropLast=False, handleInvalid="keep"))
        parts += [f"o_{c}" for c in spec.categorical]
    stages.append(VectorAssembler(inputCols=parts, outputCol="features"))
    stages.append(
        LogisticRegression(
            labelCol=spec.label, weightCol="_w", maxIter=spec.iterations,
            regParam=1.0 / (spec.inverse_penalty * n), standardization=False,
        )
    )
    fitted = Pipeline(stages=stages).fit(shaped.withColumn("_w", weight))
    return PipelineModel(stages=[*fitted.stages[:-1], without_summary(train.sparkSession, fitted.stages[-1])])


def without_summary(spark: SparkSession, model: LogisticRegressionModel) -> LogisticRegressionModel:
    """The model as read back from its saved form.

    A freshly fitted one holds its training summary and with it the session, which goes into every scoring task and
    cannot be serialized once any table of the session was observed.
    """
    path = scratch_path(spark, "baseline")
    model.save(path)
    return LogisticRegressionModel.load(path)


def fit_champion(
    train: DataFrame, valid: DataFrame, spec: ModelSpec, levels: Mapping[str, Sequence[str]],
    row_weight: Column | None = None, both: DataFrame | None = None,
) -> PipelineModel:
    """Boosted trees with class weights, missing flags and early stopping on the validation rows.

    ``both`` may hold the rows of ``train`` and ``valid`` in one scan, told apart by a flag ``_valid``: a union
    has the partitions of both sides, and every stage of the fit runs a task on those without its rows.
    """
    weight, _n = balanced_weight(train, spec.label)
    if both is None:
        both = train.withColumn("_valid", F.lit(False)).unionByName(valid.withColumn("_valid", F.lit(True)))
    weight = weight if row_weight is None else weight * row_weight
    shaped = as_inputs(both, spec, levels, "label").withColumn("_w", weight)
    stages = []
    if spec.numeric:
        stages.append(Imputer(strategy="median", inputCols=[f"x_{c}" for c in spec.numeric], outputCols=[f"f_{c}" for c in spec.numeric]))
    if spec.categorical:
        stages.append(StringIndexer(inputCols=[f"s_{c}" for c in spec.categorical], outputCols=[f"i_{c}" for c in spec.categorical], handleInvalid="keep"))
    stages.append(VectorAssembler(inputCols=tree_inputs(spec), outputCol="features"))
    # medians and category indexes come from the training rows alone
    prepared = Pipeline(stages=stages).fit(shaped.filter(~F.col("_valid")))
    # every pass of the fit reads the assembled vectors, which take longer to make than to read
    ready = prepared.transform(shaped).select(spec.label, "_w", "_valid", "features").persist(StorageLevel.MEMORY_AND_DISK)
    booster = GBTClassifier(
        labelCol=spec.label, weightCol="_w", validationIndicatorCol="_valid", maxIter=spec.trees,
        maxDepth=spec.depth, stepSize=spec.step, minInstancesPerNode=spec.min_rows,
        subsamplingRate=spec.row_share, featureSubsetStrategy=spec.feature_share,
        maxBins=max(64, spec.max_categories + 4), validationTol=1e-4, seed=spec.seed,
    )
    try:
        trees = booster.fit(ready)
    finally:
        ready.unpersist()
    return PipelineModel(stages=[*prepared.stages, trees])


def tree_inputs(spec: ModelSpec) -> list[str]:
    return [*[f"f_{c}" for c in spec.numeric], *[f"m_{c}" for c in spec.numeric], *[f"i_{c}" for c in spec.categorical]]


def tree_input_owner(spec: ModelSpec) -> list[str]:
    """The source column behind every position of the tree feature vector."""
    return [*spec.numeric, *spec.numeric, *spec.categorical]


def apply_model(df: DataFrame, model: PipelineModel, spec: ModelSpec, levels: Mapping, missing: str, out: str) -> DataFrame:
    """Event probability as a plain column; helper columns are dropped."""
    scored = model.transform(as_inputs(df, spec, levels, missing))
    kept = [c for c in df.columns if c != out]
    return scored.withColumn(out, vector_to_array("probability")[1]).select(*kept, out)


def fit_calibration(df: DataFrame, label: str, score: str) -> IsotonicRegressionModel:
    """Isotonic fit on distinct scores: mean label and count carry everything the rows do."""
    cells = df.groupBy(F.col(score).alias("_x")).agg(
        F.avg(F.col(label).cast("double")).alias("_y"), F.count(F.lit(1)).cast("double").alias("_n")
    )
    shaped = cells.withColumn("_f", array_to_vector(F.array("_x")))
    return IsotonicRegression(featuresCol="_f", labelCol="_y", weightCol="_n").fit(shaped)


def calibrate(df: DataFrame, model: IsotonicRegressionModel | None, raw: str, out: str) -> DataFrame:
    """Calibrated score where a calibration exists, else the raw one."""
    if model is None:
        return df.withColumn(out, F.col(raw))
    shaped = df.withColumn("_f", array_to_vector(F.array(raw)))
    return model.transform(shaped).withColumnRenamed(model.getPredictionCol(), out).drop("_f")


def train(
    df: DataFrame, spec: ModelSpec, split: str = K.SPLIT, cost_fn: float = K.COST_FN, cost_fp: float = K.COST_FP,
    row_weight: Column | None = None, with_baseline: bool = True,
) -> Bundle:
    """Fit champion, calibration and baseline on their slices and freeze the cost threshold.

    The fits pass over their rows many times, so the model columns are kept (memory, then disk)
    while training and released afterwards; a lost block is rebuilt from its lineage.
    """
    needed = dict.fromkeys([split, spec.key, spec.label, *spec.numeric, *spec.categorical])
    slim = df.select(*[c for c in needed if c in df.columns]).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        slim = gathered(slim, spec.key)
        return fit_all(slim, spec, split, cost_fn, cost_fp, row_weight, with_baseline)
    finally:
        slim.unpersist()


def gathered(kept: DataFrame, key: str) -> DataFrame:
    """The rows of a kept table in no more partitions than their number needs, kept again; the first copy is released.

    A fit runs hundreds of short stages, and each of their tasks sends the statistics of all open nodes, so many
    small partitions cost more than the rows. All rows stay. Where they go and their order depend on their values
    alone, so the fit does not follow the partitions or the machines of the jobs before it.
    """
    wanted = max(FIT_PARTITIONS, -(-kept.count() // FIT_ROWS))
    if kept.rdd.getNumPartitions() <= wanted:
        return kept
    mix = F.xxhash64(*kept.columns)
    order = [key] if key in kept.columns else []
    out = kept.repartitionById(wanted, F.pmod(mix, F.lit(wanted)).cast("int")).sortWithinPartitions(*order, mix)
    out = out.persist(StorageLevel.MEMORY_AND_DISK)
    out.count()
    kept.unpersist()
    return out


def fit_all(
    df: DataFrame, spec: ModelSpec, split: str, cost_fn: float, cost_fp: float, row_weight: Column | None,
    with_baseline: bool,
) -> Bundle:
    def rows(name: str) -> DataFrame:
        return df.filter(F.col(split) == name)

    fitted = rows("train")
    levels = frozen_levels(fitted, spec)
    both = df.filter(F.col(split).isin("train", "valid")).withColumn("_valid", F.col(split) == "valid")
    champion = fit_champion(fitted, rows("valid"), spec, levels, row_weight, both)
    bundle = Bundle(spec, levels, champion)
    if rows("calib").head(1):
        held = apply_model(rows("calib"), champion, spec, levels, "label", "_p")
        bundle.calibration = fit_calibration(held, spec.label, "_p")
    if with_baseline:
        bundle.baseline = fit_baseline(fitted, spec, levels)
    valid = score(rows("valid"), bundle)
    best = evaluation.best_threshold(valid, spec.label, K.SCORE, cost_fn, cost_fp).first()
    bundle.threshold = best["threshold"]
    bundle.metrics["approval_rate_valid"] = best["approval_rate"]
    return bundle


def score(df: DataFrame, bundle: Bundle) -> DataFrame:
    """Raw and served score for a whole table, unrounded."""
    raw = apply_model(df, bundle.champion, bundle.spec, bundle.levels, "label", K.RAW_SCORE)
    return calibrate(raw, bundle.calibration, K.RAW_SCORE, K.SCORE)


def predict(df: DataFrame, bundle: Bundle, threshold: float | None = None, width: Column | float = 0.0) -> DataFrame:
    """Served probability, threshold, decision and score band."""
    limit = bundle.threshold if threshold is None else threshold
    scored = score(df, bundle).withColumnRenamed(K.SCORE, "probability_default")
    return scored.withColumns(
        {
            "threshold": F.lit(limit),
            "decision": C.decide("probability_default", limit, width),
            "score_band": C.score_band("probability_default"),
        }
    )


def score_table(df: DataFrame, bundle: Bundle, split: str = K.SPLIT) -> DataFrame:
    """(id, split, label, three scores) for every slice, calibration rows included."""
    spec = bundle.spec
    scored = score(df, bundle)
    if bundle.baseline is not None:
        scored = apply_model(scored, bundle.baseline, spec, bundle.levels, "mode", K.BASELINE_SCORE)
    else:
        scored = scored.withColumn(K.BASELINE_SCORE, F.lit(None).cast("double"))
    return scored.select(
        F.col(spec.key).cast("long").alias(spec.key),
        F.col(split),
        F.col(spec.label).cast("byte").alias("y_true"),
        K.SCORE,
        K.RAW_SCORE,
        F.when(F.col(split) != "train", F.col(K.BASELINE_SCORE)).alias(K.BASELINE_SCORE),
    )


def agreement(stored: DataFrame, live: DataFrame, key: str = K.ID, score_column: str = K.SCORE) -> DataFrame:
    """Stored against recomputed score: rows compared, largest and mean absolute difference."""
    both = stored.select(key, F.col(score_column).alias("_s")).join(
        live.select(key, F.col(score_column).alias("_l")), key
    )
    gap = F.abs(F.col("_s") - F.col("_l"))
    return both.agg(
        F.count(gap).alias("n_compared"), F.max(gap).alias("max_abs_error"), F.avg(gap).alias("mean_abs_error")
    )
