"""Population stability: reference quantile cuts, two binned counts, one small sum."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riskloom.functions import columns as C
from riskloom.functions import constants as K
from riskloom.operators import selection


def verdict(c: str | Column) -> Column:
    x = C.col(c)
    stable, watch = K.PSI_LIMITS
    return F.when(x.isNotNull(), F.when(x < stable, K.PSI_STABLE).when(x < watch, K.PSI_WATCH).otherwise(K.PSI_SHIFT))


def reference_cuts(reference: DataFrame, features: Sequence[str], bins: int = 10) -> dict[str, list[float]]:
    """Distinct quantile cuts of every feature from the reference rows (at most bins + 1 each)."""
    probs = [i / bins for i in range(bins + 1)]
    found = selection.quantiles_of_columns(reference, features, probs)
    return {c: sorted(set(found[c])) for c in features}


def bin_counts(df: DataFrame, cuts: dict[str, list[float]], side: Column) -> DataFrame:
    """(feature, bin) -> rows on the expected and on the observed side, in one pass.

    All features are binned by binary search in the same projection; only bin counts travel.
    """
    usable = [c for c, e in cuts.items() if len(e) >= 3]
    shaped = df.select(side.alias("_observed"), *[C.finite(c).alias(c) for c in cuts])
    if usable:
        binned = Bucketizer(
            splitsArray=[[float("-inf"), *cuts[c][1:-1], float("inf")] for c in usable],
            inputCols=usable,
            outputCols=[f"_b_{c}" for c in usable],
            handleInvalid="keep",
        ).transform(shaped)
    else:
        binned = shaped
    slots = [
        F.struct(
            F.lit(c).alias("feature"),
            F.when(F.col(c).isNotNull(), F.col(f"_b_{c}").cast("int") if c in usable else F.lit(0)).alias("bin"),
        )
        for c in cuts
    ]
    long = binned.select("_observed", F.explode(F.array(*slots)).alias("s")).filter(F.col("s.bin").isNotNull())
    return long.groupBy("s.feature", "s.bin").agg(
        F.count_if(~F.col("_observed")).alias("n_expected"),
        F.count_if(F.col("_observed")).alias("n_observed"),
    )


def bin_frame(spark: SparkSession, cuts: dict[str, list[float]]) -> DataFrame:
    """Every bin of every feature with usable cuts (a few numbers per feature)."""
    rows = [
        (c, i, None if i == 0 else float(e[i]), float(e[i + 1]))
        for c, e in cuts.items()
        if len(e) >= 3
        for i in range(len(e) - 1)
    ]
    return spark.createDataFrame(rows, "feature string, bin int, lower double, upper double")


def shares_of(counts: DataFrame, cuts: dict[str, list[float]], eps: float = K.PSI_EPS) -> DataFrame:
    """Bins table from (feature, bin, n_expected, n_observed): limits, shares and contribution.

    A bin without rows on either side is kept, with both shares at the floor.
    """
    inside = Window.partitionBy("feature")
    filled = bin_frame(counts.sparkSession, cuts).join(counts, ["feature", "bin"], "left")
    sized = filled.fillna(0, ["n_expected", "n_observed"]).withColumns(
        {"_te": F.sum("n_expected").over(inside), "_to": F.sum("n_observed").over(inside)}
    )
    e = F.greatest(C.safe_div("n_expected", "_te"), F.lit(eps))
    o = F.greatest(C.safe_div("n_observed", "_to"), F.lit(eps))
    return sized.filter((F.col("_te") > 0) & (F.col("_to") > 0)).select(
        "feature", "bin", "lower", "upper", e.alias("pct_expected"), o.alias("pct_observed")
    ).withColumn(
        "contribution",
        (F.col("pct_observed") - F.col("pct_expected")) * F.ln(F.col("pct_observed") / F.col("pct_expected")),
    )


def report_of(counts: DataFrame, cuts: dict[str, list[float]], eps: float = K.PSI_EPS) -> DataFrame:
    """One row per feature: PSI, verdict, sizes, or a note when it cannot be computed."""
    psi = shares_of(counts, cuts, eps).groupBy("feature").agg(F.sum("contribution").alias("psi"))
    sizes = counts.groupBy("feature").agg(
        F.sum("n_expected").alias("n_expected"), F.sum("n_observed").alias("n_observed")
    )
    listed = counts.sparkSession.createDataFrame([(c, len(e)) for c, e in cuts.items()], "feature string, n_cuts int")
    empty = (F.col("n_expected") == 0) | (F.col("n_observed") == 0)
    joined = listed.join(sizes, "feature", "left").fillna(0, ["n_expected", "n_observed"]).join(psi, "feature", "left")
    return joined.select(
        "feature",
        "psi",
        verdict("psi").alias("verdict"),
        "n_expected",
        "n_observed",
        F.when(empty, K.NOTE_NO_DATA).when(F.col("n_cuts") < 3, K.NOTE_CONSTANT).alias("note"),
    )


def psi_bins(df: DataFrame, cuts: dict[str, list[float]], side: Column, eps: float = K.PSI_EPS) -> DataFrame:
    return shares_of(bin_counts(df, cuts, side), cuts, eps)


def psi_of(df: DataFrame, cuts: dict[str, list[float]], side: Column, eps: float = K.PSI_EPS) -> DataFrame:
    """PSI report of one table whose rows are on the expected (false) or observed (true) side."""
    return report_of(bin_counts(df, cuts, side), cuts, eps)


def frozen_counts(reference: DataFrame, cuts: dict[str, list[float]]) -> list[tuple[str, int, int]]:
    """Reference rows per (feature, bin): at most bins x features numbers, kept for later batches."""
    rows = bin_counts(reference, cuts, F.lit(False)).select("feature", "bin", "n_expected").collect()
    return [tuple(r) for r in rows]


def psi_against(observed: DataFrame, cuts: dict[str, list[float]], frozen: Sequence[tuple[str, int, int]]) -> DataFrame:
    """PSI report of new rows against frozen reference counts; the reference is not read again."""
    expected = observed.sparkSession.createDataFrame(list(frozen), "feature string, bin int, n_expected long")
    new = bin_counts(observed, cuts, F.lit(True)).drop("n_expected")
    return report_of(expected.join(new, ["feature", "bin"], "full_outer").fillna(0), cuts)


def psi_between(
    df: DataFrame, features: Sequence[str], expected: Column, observed: Column, bins: int = 10, top: int | None = None
) -> DataFrame:
    """PSI of every feature between two subsets of one table, largest first; ``top`` cuts the list."""
    cuts = reference_cuts(df.filter(expected), features, bins)
    both = df.filter(expected | observed)
    ranked = psi_of(both, cuts, observed).orderBy(F.desc_nulls_last("psi"), "feature")
    return ranked if top is None else ranked.limit(top)


def psi_of_two(
    expected: DataFrame, observed: DataFrame, features: Sequence[str], bins: int = 10
) -> DataFrame:
    """PSI of every feature between two tables."""
    cuts = reference_cuts(expected, features, bins)
    both = expected.select(*features, F.lit(False).alias("_side")).unionByName(
        observed.select(*features, F.lit(True).alias("_side"))
    )
    return psi_of(both, cuts, F.col("_side"))


def verdict_counts(psi_table: DataFrame) -> DataFrame:
    return psi_table.groupBy(F.coalesce("verdict", F.lit("sem_calculo")).alias("verdict")).agg(
        F.count(F.lit(1)).alias("n")
    )


def score_drift_report(
    current: DataFrame, previous: DataFrame | None, score: str = K.SCORE, bins: int = 10
) -> DataFrame:
    """Score PSI against the previous run, or train against test when there is none."""
    if previous is not None:
        report = psi_of_two(previous, current, [score], bins)
        what = "rodada anterior vs. atual"
    else:
        split = F.col(K.SPLIT)
        cuts = reference_cuts(current.filter(split == "train"), [score], bins)
        report = psi_of(current.filter(split.isin("train", "test")), cuts, split == "test")
        what = "treino vs. teste (sem rodada anterior para comparar)"
    return report.select(F.lit(what).alias("comparison"), "psi", "verdict", "n_expected", "n_observed")
