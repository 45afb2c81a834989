"""Evaluation of a binary risk score. Rows are first reduced to (group, distinct score) counts.

Decision rule: approved below the threshold, denied at or above it.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.functions import columns as C
from riskloom.functions import constants as K
from riskloom.operators import ranking
from riskloom.session import ship_package, staged


def whole():
    """One frame over a result that is already bounded."""
    return Window.partitionBy()


def score_cells(df: DataFrame, label: str, score: str, by: Sequence[str] = ()) -> DataFrame:
    """(group, score) -> number of events and non-events; rows without score or label are left out."""
    kept = df.filter(F.col(label).isNotNull()).select(*by, label, F.col(score).cast("double").alias("score"))
    return ranking.value_cells(
        kept, "score", by,
        events=F.count_if(F.col(label) == 1),
        nonevents=F.count_if(F.col(label) == 0),
    )


# ---------------------------------------------------------------- confusion and cost


def with_rates(df: DataFrame) -> DataFrame:
    """Rates derived from the columns tn, fp, fn, tp; 0 on an empty denominator."""
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))
    n = tn + fp + fn + tp
    return df.withColumns(
        {
            "accuracy": C.div_or_zero(tp + tn, n),
            "precision": C.div_or_zero(tp, tp + fp),
            "recall": C.div_or_zero(tp, tp + fn),
            "specificity": C.div_or_zero(tn, tn + fp),
            "f1": C.div_or_zero(2 * tp, 2 * tp + fp + fn),
            "approval_rate": C.div_or_zero(tn + fn, n),
            "default_rate_approved": C.div_or_zero(fn, tn + fn),
            "default_rate_denied": C.div_or_zero(tp, tp + fp),
        }
    )


def cost(cost_fn: Column | float, cost_fp: Column | float) -> Column:
    return (C.col("fn") * cost_fn + C.col("fp") * cost_fp).cast("double")


def confusion(
    df: DataFrame, label: str, score: str, threshold: float, by: Sequence[str] = ()
) -> DataFrame:
    """Confusion counts at one threshold, one pass."""
    denied = F.col(score) >= threshold
    event = F.col(label) == 1
    return (
        df.filter(F.col(score).isNotNull() & F.col(label).isNotNull())
        .groupBy(*by)
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.count_if(~denied & ~event).alias("tn"),
            F.count_if(denied & ~event).alias("fp"),
            F.count_if(~denied & event).alias("fn"),
            F.count_if(denied & event).alias("tp"),
        )
        .withColumn("threshold", F.lit(float(threshold)))
    )


def confusion_report(
    df: DataFrame, label: str, score: str, threshold: float,
    cost_fn: float = K.COST_FN, cost_fp: float = K.COST_FP, by: Sequence[str] = (),
) -> DataFrame:
    return with_rates(confusion(df, label, score, threshold, by)).withColumn("cost", cost(cost_fn, cost_fp))


def grid(points: int = K.GRID_POINTS, low: float = K.GRID_LOW, high: float = K.GRID_HIGH) -> list[float]:
    return [float(t) for t in np.linspace(low, high, points)]


def sweep_counts(df: DataFrame, label: str, score: str, thresholds: Sequence[float]) -> DataFrame:
    """Confusion counts at every grid threshold from one grouped pass.

    Each row falls into the slot "number of thresholds at or below its score" by binary
    search; running sums over the slots (one per threshold) give the counts.
    """
    slim = df.filter(F.col(score).isNotNull() & F.col(label).isNotNull()).select(label, score)
    slots = ranking.with_bins(slim, score, thresholds, "slot").groupBy("slot").agg(
        F.count_if(F.col(label) == 1).alias("e"), F.count_if(F.col(label) == 0).alias("ne")
    )
    points = df.sparkSession.createDataFrame(
        [(i, None if i == 0 else float(thresholds[i - 1])) for i in range(len(thresholds) + 1)],
        "slot int, threshold double",
    )
    filled = points.join(slots, "slot", "left").fillna(0, ["e", "ne"])
    below = Window.orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    return (
        filled.withColumns(
            {
                "fn": F.coalesce(F.sum("e").over(below), F.lit(0)),
                "tn": F.coalesce(F.sum("ne").over(below), F.lit(0)),
                "_e": F.sum("e").over(whole()),
                "_ne": F.sum("ne").over(whole()),
            }
        )
        .filter(F.col("slot") > 0)
        .select(
            "threshold",
            (F.col("_e") + F.col("_ne")).alias("n"),
            "tn",
            (F.col("_ne") - F.col("tn")).alias("fp"),
            "fn",
            (F.col("_e") - F.col("fn")).alias("tp"),
        )
    )


def threshold_sweep(
    df: DataFrame, label: str, score: str,
    cost_fn: float = K.COST_FN, cost_fp: float = K.COST_FP,
    points: int = K.GRID_POINTS, low: float = K.GRID_LOW, high: float = K.GRID_HIGH,
) -> DataFrame:
    counts = sweep_counts(df, label, score, grid(points, low, high))
    return with_rates(counts).withColumn("cost", cost(cost_fn, cost_fp))


def best_threshold(
    df: DataFrame, label: str, score: str, cost_fn: float = K.COST_FN, cost_fp: float = K.COST_FP,
    points: int = K.GRID_POINTS,
) -> DataFrame:
    """The first grid threshold with the smallest cost, and its approval rate."""
    return threshold_sweep(df, label, score, cost_fn, cost_fp, points).orderBy("cost", "threshold").limit(1)


def threshold_analysis(
    df: DataFrame, label: str, score: str, frozen: float,
    cost_fn: float = K.COST_FN, cost_fp: float = K.COST_FP, points: int = K.GRID_POINTS,
) -> DataFrame:
    """Best against frozen threshold: costs, approval rates and the difference in one row.

    The frozen threshold is one more grid point, so the scores are read once.
    """
    regular = grid(points)
    every = sorted(set([*regular, float(frozen)]))
    counts = with_rates(sweep_counts(df, label, score, every)).withColumn("cost", cost(cost_fn, cost_fp))
    on_grid = F.col("threshold").isin(regular)
    pick = F.struct("cost", "threshold", "approval_rate", "n")
    row = counts.agg(
        F.min(F.when(on_grid, pick)).alias("b"),
        F.max(F.when(F.col("threshold") == float(frozen), pick)).alias("c"),
    )
    return row.select(
        F.col("b.n").alias("n"),
        F.lit(cost_fn / cost_fp).alias("cost_ratio"),
        F.col("b.threshold").alias("best_threshold"),
        F.col("b.cost").alias("best_cost"),
        F.col("b.approval_rate").alias("best_approval_rate"),
        F.lit(float(frozen)).alias("frozen_threshold"),
        F.col("c.cost").alias("frozen_cost"),
        F.col("c.approval_rate").alias("frozen_approval_rate"),
        (F.col("b.cost") - F.col("c.cost")).alias("delta_cost"),
    )


def cost_sensitivity(
    df: DataFrame, label: str, score: str, ratios: Sequence[float] = (1, 5, 10, 20, 50), points: int = K.GRID_POINTS
) -> DataFrame:
    """Best threshold and approval rate for each cost ratio, from one set of grid counts."""
    counts = with_rates(sweep_counts(df, label, score, grid(points)))
    per_ratio = counts.withColumn("cost_ratio", F.explode(F.array(*[F.lit(float(r)) for r in ratios])))
    priced = per_ratio.withColumn("cost", F.col("fn") * F.col("cost_ratio") + F.col("fp"))
    best = F.min(F.struct("cost", "threshold", "approval_rate", "default_rate_approved"))
    return priced.groupBy("cost_ratio").agg(best.alias("b")).select(
        "cost_ratio", "b.threshold", "b.cost", "b.approval_rate", "b.default_rate_approved"
    )


# ---------------------------------------------------------------- ranking quality


def auc_of_cells(cells: DataFrame, by: Sequence[str] = (), edges: Sequence[float] | None = None) -> DataFrame:
    """Exact AUC with half credit for ties, per group."""
    ranked = ranking.running_sums(cells, "score", ["nonevents"], by, edges)
    won = F.col("events").cast("double") * (F.col("below_nonevents") + F.col("nonevents") / 2.0)
    return ranked.groupBy(*by).agg(
        F.sum("events").alias("n_events"),
        F.sum("nonevents").alias("n_nonevents"),
        F.sum(won).alias("_won"),
    ).select(
        *by,
        "n_events",
        "n_nonevents",
        C.safe_div("_won", F.col("n_events").cast("double") * F.col("n_nonevents")).alias("auc"),
    )


def auc(df: DataFrame, label: str, score: str, by: Sequence[str] = ()) -> DataFrame:
    return auc_of_cells(score_cells(df, label, score, by), by)


def curve_counts(df: DataFrame, label: str, score: str, by: Sequence[str] = ()) -> DataFrame:
    """Per distinct score: counts at or above it, position from the top, totals and rates."""
    cells = score_cells(df, label, score, by).withColumn("_one", F.lit(1))
    ranked = ranking.running_sums(cells, "score", ["events", "nonevents", "_one"], by)
    return ranked.select(
        *by,
        F.col("score").alias("threshold"),
        (F.col("total__one") - F.col("below__one")).alias("position"),
        F.col("total__one").alias("n_scores"),
        (F.col("total_events") - F.col("below_events")).alias("tp"),
        (F.col("total_nonevents") - F.col("below_nonevents")).alias("fp"),
        F.col("total_events").alias("n_events"),
        F.col("total_nonevents").alias("n_nonevents"),
    ).withColumns({"tpr": C.safe_div("tp", "n_events"), "fpr": C.safe_div("fp", "n_nonevents")})


def roc_curve(df: DataFrame, label: str, score: str, points: int | None = None) -> DataFrame:
    """ROC points from the top score down, with the origin (null threshold) first."""
    curve = curve_counts(df, label, score)
    origin = df.sparkSession.createDataFrame(
        [(None, 0, 0.0, 0.0)], "threshold double, position long, tpr double, fpr double"
    )
    if points:
        curve = curve.filter(ranking.evenly_spaced(F.col("position"), F.col("n_scores") + 1, points))
    return curve.select("threshold", "position", "tpr", "fpr").unionByName(origin)


def ks_curve(df: DataFrame, label: str, score: str, points: int | None = None) -> DataFrame:
    return roc_curve(df, label, score, points).withColumn("ks", F.col("tpr") - F.col("fpr"))


def ks(df: DataFrame, label: str, score: str, by: Sequence[str] = ()) -> DataFrame:
    """Largest gap between the two cumulative shares and the highest score that reaches it."""
    curve = curve_counts(df, label, score, by).withColumn("gap", F.col("tpr") - F.col("fpr"))
    best = curve.groupBy(*by).agg(F.max(F.struct("gap", "threshold")).alias("b"))
    return best.select(
        *by,
        F.greatest(F.col("b.gap"), F.lit(0.0)).alias("ks"),
        F.when(F.col("b.gap") > 0, F.col("b.threshold")).alias("ks_threshold"),
    )


def precision_recall_curve(df: DataFrame, label: str, score: str) -> DataFrame:
    curve = curve_counts(df, label, score)
    return curve.select(
        "threshold",
        C.safe_div("tp", F.col("tp") + F.col("fp")).alias("precision"),
        F.col("tpr").alias("recall"),
    )


def auc_summary(df: DataFrame, label: str, score: str) -> DataFrame:
    return auc(df, label, score).withColumn("gini", 2 * F.col("auc") - 1)


def split_quality(
    df: DataFrame, label: str, score: str = K.SCORE, baseline: str = K.BASELINE_SCORE, split: str = K.SPLIT
) -> DataFrame:
    """AUC per split, overfit gap (train - test) and lift over the baseline on test, in one row."""
    long = df.select(
        split, label, F.explode(F.create_map(
            F.lit("champion"), F.col(score).cast("double"), F.lit("baseline"), F.col(baseline).cast("double")
        )).alias("model", "score"),
    )
    per = auc(long, label, "score", [split, "model"])

    def pick(s: str, m: str) -> Column:
        return F.max(F.when((F.col(split) == s) & (F.col("model") == m), F.col("auc")))

    row = per.agg(
        pick("train", "champion").alias("auc_train"),
        pick("valid", "champion").alias("auc_valid"),
        pick("test", "champion").alias("auc_test"),
        pick("test", "baseline").alias("auc_baseline"),
    )
    return row.withColumns(
        {
            "overfit_gap": F.col("auc_train") - F.col("auc_test"),
            "lift_vs_baseline": F.col("auc_test") - F.col("auc_baseline"),
        }
    )


# ---------------------------------------------------------------- deciles and calibration


def decile_table(df: DataFrame, label: str, score: str, key: str, q: int = 10) -> DataFrame:
    """Risk deciles by position (1 = highest score; ties broken by the key).

    Group d starts at floor(n * d / q) of the falling order. Only the q - 1 cut keys are
    searched for; rows are then labelled by comparison and aggregated in one pass.
    """
    kept = df.filter(F.col(score).isNotNull() & F.col(label).isNotNull()).select(
        key, label, F.col(score).cast("double").alias("score")
    )
    # the falling score with rising key is the rising negated score with rising key
    turned = kept.withColumn("_s", -F.col("score"))
    n = kept.count()
    starts = [(n * d) // q for d in range(q)]
    live = sorted(set(starts))
    labelled = ranking.rank_groups(turned, "_s", key, live, "_g")
    # an empty decile (fewer rows than groups) has no row
    number = F.element_at(
        F.array(*[F.lit(max(i for i, s in enumerate(starts) if s == v) + 1) for v in live]),
        F.col("_g") + 1,
    )
    table = labelled.groupBy(number.alias("decile")).agg(
        F.count(F.lit(1)).alias("n"),
        F.min("score").alias("min_score"),
        F.max("score").alias("max_score"),
        F.avg("score").alias("avg_score"),
        F.count_if(F.col(label) == 1).alias("events"),
    )
    upto = Window.orderBy("decile").rowsBetween(Window.unboundedPreceding, 0)
    ne = F.col("n") - F.col("events")
    return table.withColumns(
        {
            "event_rate": C.div_or_zero("events", "n"),
            "lift": C.div_or_zero(
                C.div_or_zero("events", "n"),
                C.safe_div(F.sum("events").over(whole()), F.sum("n").over(whole())),
            ),
            "cum_event_pct": C.div_or_zero(F.sum("events").over(upto), F.sum("events").over(whole())),
            "cum_nonevent_pct": C.div_or_zero(F.sum(ne).over(upto), F.sum(ne).over(whole())),
        }
    ).withColumn("ks", F.abs(F.col("cum_event_pct") - F.col("cum_nonevent_pct")))


def brier(label: str, score: str) -> Column:
    """Aggregate: mean squared distance of score and label."""
    return F.avg(F.pow(F.col(score) - F.col(label), 2))


def brier_score(df: DataFrame, label: str, score: str, by: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(*by).agg(brier(label, score).alias("brier"), F.count(F.col(score) + F.col(label)).alias("n"))


def bin_edges(df: DataFrame, score: str, bins: int, strategy: str) -> list[float]:
    """Distinct reliability-bin edges, both ends included."""
    if strategy == "quantile":
        found = ranking.quantiles(df, score, [i / bins for i in range(bins + 1)])
        return sorted(set(found))
    low, high = df.agg(F.min(F.col(score).cast("double")), F.max(F.col(score).cast("double"))).first()
    return [float(x) for x in np.linspace(low, high, bins + 1)]


def calibration_curve(
    df: DataFrame, label: str, score: str, bins: int = 10, strategy: str = "quantile"
) -> DataFrame:
    """Predicted against observed rate per score bin, and their gap."""
    kept = df.filter(F.col(score).isNotNull() & F.col(label).isNotNull()).select(label, score)
    edges = bin_edges(kept, score, bins, strategy)
    binned = ranking.with_bins(kept, score, edges[1:-1], "bin")
    return binned.groupBy("bin").agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(score).alias("mean_predicted"),
        F.avg(label).alias("observed_rate"),
    ).withColumn("gap", F.col("mean_predicted") - F.col("observed_rate"))


def grouped_calibration_curve(
    df: DataFrame, label: str, score: str, by: str, bins: int = 5
) -> DataFrame:
    """Quantile reliability curve inside every group; edges per group travel as a small table."""
    kept = df.filter(F.col(score).isNotNull() & F.col(label).isNotNull() & F.col(by).isNotNull())
    probs = [i / bins for i in range(bins + 1)]
    edges = ranking.quantile_table(kept, score, probs, [by]).select(
        by, F.array_distinct("q").alias("_e")
    )
    inner = F.slice("_e", 2, F.greatest(F.size("_e") - 2, F.lit(0)))
    index = F.size(F.filter("_i", lambda e: e <= F.col(score)))
    return (
        kept.select(by, label, score)
        .join(edges.withColumn("_i", inner), by)
        .groupBy(by, index.alias("bin"))
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.avg(score).alias("mean_predicted"),
            F.avg(label).alias("observed_rate"),
        )
        .withColumn("gap", F.col("mean_predicted") - F.col("observed_rate"))
    )


# ---------------------------------------------------------------- groups


def won_inside(cells: pa.Table, by: str, block: int) -> pa.Table:
    """Won pairs of every two groups of one score range, by a merge in the order of the scores.

    ``block`` distinct scores at a time: each score's events meet the non-events below it, and half of those that tie.
    """
    names = cells.column(by).combine_chunks().dictionary_encode()
    who, k = names.indices.to_numpy(), len(names.dictionary)
    _, at = np.unique(cells.column("score").to_numpy(), return_inverse=True)
    order = np.argsort(at, kind="stable")
    at, who = at[order], who[order]
    events, nonevents = (cells.column(c).to_numpy()[order].astype(float) for c in ("events", "nonevents"))
    won, below = np.zeros((k, k)), np.zeros(k)
    for first in range(0, int(at[-1]) + 1, block):
        begin, end = np.searchsorted(at, [first, first + block])
        part = np.zeros((2, block, k))
        np.add.at(part[0], (at[begin:end] - first, who[begin:end]), events[begin:end])
        np.add.at(part[1], (at[begin:end] - first, who[begin:end]), nonevents[begin:end])
        upto = below + np.cumsum(part[1], axis=0)
        won += part[0].T @ (upto - part[1] / 2)
        below = upto[-1]
    i, j = np.nonzero(won)
    return pa.table({
        "event_group": names.dictionary.take(pa.array(i)), "nonevent_group": names.dictionary.take(pa.array(j)), "won": won[i, j],
    })


def auc_matrix(df: DataFrame, label: str, score: str, by: str, block: int = 256) -> DataFrame:
    """AUC of the events of group i against the non-events of group j, with the pair counts, for any number of groups.

    Groups stay in rows. Inside a score range the groups are merged by score; across ranges a range's events of i meet
    the running sum of j's non-events in the lower ranges, so no rows are paired up and no name reaches the driver.
    """
    ship_package(df.sparkSession)
    cells = staged(score_cells(df, label, score, [by]).select(
        F.col(by).alias("_group"), F.col("score").cast("double").alias("score"), "events", "nonevents"), "matrix-cells")
    edges = ranking.range_edges(cells, "score")
    ranged = ranking.with_bins(cells, "score", edges, "_range")
    sums = ranged.groupBy("_group", "_range").agg(F.sum("events").alias("_e"), F.sum("nonevents").alias("_n"))
    totals = sums.groupBy("_group").agg(F.sum("_e").alias("_events"), F.sum("_n").alias("_nonevents"))
    # one row per group and range, also where a group has no cell
    every = totals.select("_group", F.explode(F.sequence(F.lit(0), F.lit(len(edges)))).alias("_range"))
    lower = Window.partitionBy("_group").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    below = every.join(sums, ["_group", "_range"], "left").select(
        "_range", F.col("_group").alias("nonevent_group"), F.coalesce(F.sum("_n").over(lower), F.lit(0)).alias("_below"))
    across = sums.filter("_e > 0").select("_range", F.col("_group").alias("event_group"), "_e").join(below, "_range").select(
        "event_group", "nonevent_group", (F.col("_e").cast("double") * F.col("_below")).alias("won"))
    kind = cells.schema["_group"].dataType.simpleString()
    inside = ranged.groupBy("_range").applyInArrow(
        lambda part: won_inside(part, "_group", block), f"event_group {kind}, nonevent_group {kind}, won double")
    won = across.unionByName(inside).groupBy("event_group", "nonevent_group").agg(F.sum("won").alias("won"))
    sized = won.join(totals.select(F.col("_group").alias("event_group"), "_events"), "event_group").join(
        totals.select(F.col("_group").alias("nonevent_group"), "_nonevents"), "nonevent_group")
    pairs = F.col("_events").cast("double") * F.col("_nonevents")
    out = sized.select("event_group", "nonevent_group", pairs.alias("pairs"), "won").filter("pairs > 0")
    return out.withColumn("auc", F.col("won") / F.col("pairs"))


def auc_within_between(matrix: DataFrame) -> DataFrame:
    """Overall AUC split exactly into pairs inside one group and pairs across groups."""
    same = F.col("event_group") == F.col("nonevent_group")
    row = matrix.agg(
        F.sum("pairs").alias("pairs_total"),
        F.sum("won").alias("_w"),
        F.sum(F.when(same, F.col("pairs")).otherwise(0.0)).alias("_pi"),
        F.sum(F.when(same, F.col("won")).otherwise(0.0)).alias("_wi"),
    )
    return row.select(
        C.safe_div("_w", "pairs_total").alias("auc_overall"),
        C.safe_div("_wi", "_pi").alias("auc_within"),
        C.safe_div(F.col("_w") - F.col("_wi"), F.col("pairs_total") - F.col("_pi")).alias("auc_between"),
        C.safe_div("_pi", "pairs_total").alias("w_within"),
        C.safe_div(F.col("pairs_total") - F.col("_pi"), "pairs_total").alias("w_between"),
        "pairs_total",
    )


def group_quality(
    df: DataFrame, label: str, score: str, by: Sequence[str], threshold: float, min_count: int = K.MIN_GROUP
) -> DataFrame:
    """Point figures per group: size, AUC, approval, default rate, mean score, Brier, calibration gap.

    Everything comes from the (group, score) cells, so the rows are shuffled once.
    """
    return quality_of_cells(score_cells(df, label, score, by), by, threshold, min_count)


def quality_of_cells(
    cells: DataFrame, by: Sequence[str], threshold: float, min_count: int = K.MIN_GROUP,
    edges: Sequence[float] | None = None,
) -> DataFrame:
    ranked = ranking.running_sums(cells, "score", ["nonevents"], by, edges)
    e, ne, s = F.col("events"), F.col("nonevents"), F.col("score")
    agg = ranked.groupBy(*by).agg(
        F.sum(e + ne).alias("n"),
        F.sum(e).alias("n_events"),
        F.sum(ne).alias("_ne"),
        F.sum(e.cast("double") * (F.col("below_nonevents") + ne / 2.0)).alias("_won"),
        F.sum(F.when(s < threshold, e + ne).otherwise(0)).alias("_ok"),
        F.sum((e + ne) * s).alias("_s"),
        F.sum(e * F.pow(s - 1, 2) + ne * F.pow(s, 2)).alias("_b"),
    )
    kept = agg.filter(F.col("n") >= min_count)
    return kept.select(
        *by,
        "n",
        "n_events",
        C.safe_div("_won", F.col("n_events").cast("double") * F.col("_ne")).alias("auc"),
        (F.col("_ok") / F.col("n")).alias("approval_rate"),
        (F.col("n_events") / F.col("n")).alias("default_rate"),
        (F.col("_s") / F.col("n")).alias("avg_score"),
        (F.col("_b") / F.col("n")).alias("brier"),
        ((F.col("_s") - F.col("n_events")) / F.col("n")).alias("calibration_gap"),
    )


def unpivot_dimensions(df: DataFrame, axes: dict[str, Column], keep: Sequence[str]) -> DataFrame:
    """Rows repeated once per axis as (dimension, group)."""
    named = df.select(*keep, *[c.cast("string").alias(f"_{n}") for n, c in axes.items()])
    pairs = F.array(*[F.struct(F.lit(n).alias("dimension"), F.col(f"_{n}").alias("group")) for n in axes])
    return named.select(*keep, F.explode(pairs).alias("_p")).select(*keep, "_p.dimension", "_p.group")


def segment_axes() -> dict[str, Column]:
    """The three sensitive axes of the segment report."""
    return {"gender": F.col("CODE_GENDER"), "age_band": C.age_band(), "thin_file": C.thin_file()}


def segment_points(
    df: DataFrame, label: str, score: str, threshold: float, axes: dict[str, Column] | None = None,
    min_count: int = K.MIN_GROUP,
) -> DataFrame:
    long = unpivot_dimensions(df, axes or segment_axes(), [label, score])
    points = group_quality(long, label, score, ["dimension", "group"], threshold, min_count)
    total = df.filter(F.col(score).isNotNull() & F.col(label).isNotNull()).agg(F.count(F.lit(1)))
    return points.withColumn("_all", total.scalar()).withColumn(
        "share_of_base", F.col("n") / F.col("_all")
    ).drop("_all")


def tie_cost(
    df: DataFrame, label: str, calibrated: str, raw: str, by: str, min_count: int = K.MIN_GROUP
) -> DataFrame:
    """AUC of the calibrated and the raw score per group, and their distinct values."""
    long = df.filter(F.col(by).isNotNull()).select(
        by, label, F.explode(F.create_map(
            F.lit("calibrated"), F.col(calibrated).cast("double"), F.lit("raw"), F.col(raw).cast("double")
        )).alias("kind", "score"),
    )
    cells = score_cells(long, label, "score", [by, "kind"])
    ranked = ranking.running_sums(cells, "score", ["nonevents"], [by, "kind"])
    won = F.col("events").cast("double") * (F.col("below_nonevents") + F.col("nonevents") / 2.0)
    per = ranked.groupBy(by, "kind").agg(
        F.sum("events").alias("e"), F.sum("nonevents").alias("ne"), F.sum(won).alias("w"),
        F.count(F.lit(1)).alias("d"),
    ).withColumn("auc", C.safe_div("w", F.col("e").cast("double") * F.col("ne")))

    def of(kind: str, c: str) -> Column:
        return F.max(F.when(F.col("kind") == kind, F.col(c)))

    return per.groupBy(by).agg(
        of("calibrated", "e").alias("_e"), of("calibrated", "ne").alias("_ne"),
        of("calibrated", "auc").alias("auc_calibrated"), of("raw", "auc").alias("auc_raw"),
        of("calibrated", "d").alias("distinct_calibrated"), of("raw", "d").alias("distinct_raw"),
    ).filter((F.col("_e") + F.col("_ne") >= min_count) & F.col("auc_calibrated").isNotNull()).select(
        by, (F.col("_e") + F.col("_ne")).alias("n"), "auc_calibrated", "auc_raw",
        (F.col("auc_calibrated") - F.col("auc_raw")).alias("delta"),
        "distinct_calibrated", "distinct_raw",
    )


def feature_profile(
    df: DataFrame, label: str, by: str, features: Sequence[str], min_count: int = K.MIN_GROUP
) -> DataFrame:
    """Coverage, orientation-free AUC, AUC of absence and spread of each feature inside each group.

    Overall coverage and spread are those of all rows, with or without a group.
    """
    pairs = F.array(*[
        F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("value")) for c in features
    ])
    every = df.select(by, label, F.explode(pairs).alias("_p")).select(by, label, "_p.feature", "_p.value")
    overall = every.groupBy("feature").agg(
        (F.count("value") / F.count(F.lit(1))).alias("overall_coverage"), F.stddev_pop("value").alias("_sd_all")
    )
    long = every.filter(F.col(by).isNotNull())
    event = F.col(label) == 1
    here = F.col("value").isNotNull()
    keys = ["feature", by]
    shape = long.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_all"),
        F.count_if(here).alias("n_usable"),
        F.count_if(event & here).alias("e_here"),
        F.count_if(event).alias("e_all"),
        F.stddev_pop("value").alias("sd"),
    )
    absent_e, absent_n = F.col("e_all") - F.col("e_here"), F.col("n_all") - F.col("n_usable")
    ne_here = F.col("n_usable") - F.col("e_here")
    ne_absent = absent_n - absent_e
    absence = C.safe_div(
        absent_e * (ne_here + ne_absent / 2.0) + F.col("e_here") * (ne_here / 2.0),
        F.col("e_all").cast("double") * (F.col("n_all") - F.col("e_all")),
    )
    shape = shape.join(overall, "feature").withColumns({
        "coverage": F.col("n_usable") / F.col("n_all"),
        "std_ratio": C.safe_div("sd", "_sd_all"),
        "_abs": F.when((absent_n > 0) & (F.col("n_usable") > 0), absence),
    })
    power = auc(long, label, "value", keys).select(*keys, F.col("auc").alias("_a"))
    return (
        shape.join(power, keys)
        .filter((F.col("n_usable") >= min_count) & F.col("_a").isNotNull())
        .select(
            *keys, "n_usable", "coverage", "overall_coverage",
            F.greatest(F.col("_a"), 1 - F.col("_a")).alias("auc_univariate"),
            F.greatest(F.col("_abs"), 1 - F.col("_abs")).alias("auc_of_absence"),
            "std_ratio",
        )
    )
