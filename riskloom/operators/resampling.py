"""Bootstrap on reduced cells.

Rows are reduced to (group, score) cells first. In a Poisson bootstrap every row gets an
independent Poisson(rate) weight, so a cell of n equal rows gets the sum of n such draws, drawn
block by block of its rows. The draws come from an integer mix of the cell key, the block's number
and the replica, which makes replicas reproducible, independent of partitioning and safe to
recompute after a lost executor.

Cells are shuffled once, by group and score range (a range holds a bounded number of cells,
whatever the number of rows behind them). Each task turns its range into one partial row per
replica; the partial rows are then combined with running sums over the ranges. No row is ever
multiplied by the number of replicas across the network.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.functions import columns as C
from riskloom.functions import constants as K
from riskloom.operators import evaluation, ranking
from riskloom.session import staged

REPLICA_BLOCK = 64
# cells a task draws weights for: smaller ranges than a plain running sum needs
CELLS_PER_TASK = 20_000
# weights or draws held at once by a task (rows x replicas)
MAX_WEIGHTS = 4_000_000
# rows of a cell that one draw stands for at most: n rows are n // 256 draws of 256 rows and one per binary digit left
BLOCK_ROWS = 256
# a Poisson distribution is tabulated this many deviations around its mean; a uniform of 31 bits reaches seven
TABLE_WIDTH = 12

# Multipliers of the integer mix (shared with the SQL checks).
MIX = {"key": 48271, "unit": 69621, "replica": 16807, "offset": 12345, "replica2": 40692, "unit2": 3}


def mix_uniform(key: np.ndarray, unit: np.ndarray, replica: np.ndarray, seed: int) -> np.ndarray:
    """Uniform in [0, 1) for every ((key, unit), replica) pair."""
    p = C.MIX_PRIME
    unit = (np.broadcast_to(np.asarray(unit, dtype="int64"), key.shape) % p)[:, None]
    a = (key[:, None] * MIX["key"] + unit * MIX["unit"] + replica[None, :] * MIX["replica"] + seed) % p
    b = (a * a + MIX["offset"]) % p
    c = (b * MIX["key"] + replica[None, :] * MIX["replica2"] + unit * MIX["unit2"]) % p
    return ((c * c + a) % p) / float(p)


def poisson_table(mean: float) -> tuple[int, np.ndarray]:
    """First tabulated value and the distribution function from there on."""
    reach = TABLE_WIDTH * math.sqrt(mean) + TABLE_WIDTH
    first = max(0, math.floor(mean - reach))
    k = np.arange(first, math.ceil(mean + reach) + 1)
    log_factorial = np.array([math.lgamma(x + 1.0) for x in k])
    return first, np.cumsum(np.exp(k * math.log(mean) - mean - log_factorial))


def poisson_quantile(u: np.ndarray, mean: np.ndarray) -> np.ndarray:
    """Smallest k whose Poisson(mean) distribution function exceeds u (mean per row)."""
    out = np.zeros(u.shape)
    values, which = np.unique(mean, return_inverse=True)
    for i, value in enumerate(values):
        if value > 0:
            first, upto = poisson_table(float(value))
            rows = which == i
            out[rows] = first + np.searchsorted(upto, u[rows], side="right")
    return out


def draw_list(count: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Cell, unit number and rows of every draw: whole blocks first, then the binary digits of what is left."""
    blocks = count // BLOCK_ROWS
    cell = [np.repeat(np.arange(len(count)), blocks)]
    starts = np.repeat(np.cumsum(blocks) - blocks, blocks)
    unit = [np.arange(len(starts)) - starts + 1]
    rows = [np.full(len(starts), BLOCK_ROWS)]
    for digit in range(BLOCK_ROWS.bit_length() - 1):
        has = np.flatnonzero((count >> digit) & 1)
        cell.append(has)
        unit.append(blocks[has] + 1 + digit)
        rows.append(np.full(len(has), 1 << digit))
    return np.concatenate(cell), np.concatenate(unit), np.concatenate(rows)


def cell_weights(
    key: np.ndarray, count: np.ndarray, rate: np.ndarray, replica: np.ndarray, seed: int
) -> np.ndarray:
    """Weight of every cell in every replica: the sum of ``count`` Poisson(rate) draws.

    The sum of m such draws is one Poisson(m * rate) draw, so a cell draws once per block of its
    rows. The same rule holds for a cell of one row and for one of a billion.
    """
    out = np.zeros((len(key), len(replica)))
    cell, unit, rows = draw_list(count.astype("int64"))
    step = max(1, MAX_WEIGHTS // max(1, len(replica)))
    for start in range(0, len(cell), step):
        part = slice(start, start + step)
        own = cell[part]
        u = mix_uniform(key[own], unit[part], replica, seed)
        np.add.at(out, own, poisson_quantile(u, rows[part] * rate[own]))
    return out


def range_partials(cells: pd.DataFrame, replicas: int, seed: int) -> Iterator[dict]:
    """Weighted totals and the inner pair count of one score range, per replica."""
    cells = cells.sort_values(["score", "key_event"], kind="stable")
    score = cells["score"].to_numpy("float64")
    first = np.flatnonzero(np.r_[True, score[1:] != score[:-1]])
    arrays = {c: cells[c].to_numpy("int64") for c in ("key_event", "key_nonevent", "events", "nonevents")}
    rate = cells["rate"].to_numpy("float64")
    block = max(1, min(REPLICA_BLOCK, MAX_WEIGHTS // len(cells)))
    for start in range(0, replicas, block):
        replica = np.arange(start, min(start + block, replicas), dtype="int64")
        we = cell_weights(arrays["key_event"], arrays["events"], rate, replica, seed)
        wn = cell_weights(arrays["key_nonevent"], arrays["nonevents"], rate, replica, seed)
        mass = ((we + wn) * score[:, None]).sum(axis=0)
        e = np.add.reduceat(we, first, axis=0)
        n = np.add.reduceat(wn, first, axis=0)
        below = np.cumsum(n, axis=0) - n
        yield {
            "replica": replica,
            "events": e.sum(axis=0),
            "nonevents": n.sum(axis=0),
            "won": (e * (below + n / 2.0)).sum(axis=0),
            "mass": mass,
        }


def keyed_cells(
    df: DataFrame, label: str, score: str, by: Sequence[str], stratum: str | None = None, rate: str | None = None
) -> DataFrame:
    """Score cells with a draw key for their events and for their non-events.

    With a stratum column, cells are also split by it and draw at its rate.
    """
    extra = [] if stratum is None else [stratum]
    cells = evaluation.score_cells(df, label, score, [*by, *extra, *([] if rate is None else [rate])])
    level = F.round(F.col("score") * 1e9).cast("long")
    return cells.withColumns(
        {
            "key_event": C.hash_key(*by, *extra, level, F.lit(1)),
            "key_nonevent": C.hash_key(*by, *extra, level, F.lit(0)),
            "rate": F.lit(1.0) if rate is None else F.col(rate),
        }
    )


def shared_cells(df: DataFrame, label: str, score: str, by: Sequence[str]) -> tuple[DataFrame, list[float]]:
    """Keyed cells and their range edges, made once for every figure that reads them."""
    cells = staged(keyed_cells(df, label, score, by), "score-cells")
    return cells, ranking.range_edges(cells, "score", CELLS_PER_TASK)


def replicate_cells(
    cells: DataFrame, by: Sequence[str], replicas: int, seed: int = 42, edges: Sequence[float] | None = None
) -> DataFrame:
    """(group, replica) -> weighted events, non-events, AUC and calibration gap."""
    by = list(by)
    edges = ranking.range_edges(cells, "score", CELLS_PER_TASK) if edges is None else edges
    ranged = ranking.with_bins(cells, "score", edges, ranking.RANGE)
    keys = [*by, ranking.RANGE]
    schema = T.StructType(
        [ranged.schema[c] for c in keys]
        + [T.StructField("replica", T.IntegerType())]
        + [T.StructField(c, T.DoubleType()) for c in ("events", "nonevents", "won", "mass")]
    )

    def partials(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        parts = []
        for block in range_partials(pdf, replicas, seed):
            frame = pd.DataFrame(block)
            for name, value in zip(keys, key):
                frame[name] = value
            parts.append(frame)
        return pd.concat(parts)[[f.name for f in schema.fields]]

    partial = ranged.groupBy(*keys).applyInPandas(partials, schema)
    before = (
        Window.partitionBy(*by, "replica").orderBy(ranking.RANGE).rowsBetween(Window.unboundedPreceding, -1)
    )
    lower = F.coalesce(F.sum("nonevents").over(before), F.lit(0.0))
    whole = partial.withColumn("_won", F.col("won") + F.col("events") * lower)
    return whole.groupBy(*by, "replica").agg(
        F.sum("events").alias("events"),
        F.sum("nonevents").alias("nonevents"),
        F.sum("_won").alias("_won"),
        F.sum("mass").alias("_mass"),
    ).select(
        *by,
        "replica",
        "events",
        "nonevents",
        C.safe_div("_won", F.col("events") * F.col("nonevents")).alias("auc"),
        C.safe_div(F.col("_mass") - F.col("events"), F.col("events") + F.col("nonevents")).alias("gap"),
    )


def interval(c: str, alpha: float) -> Column:
    """Aggregate: both ends of the percentile interval over the replicas (a bounded set)."""
    return F.percentile(c, F.array(F.lit(alpha / 2), F.lit(1 - alpha / 2)))


def auc_interval_of(
    replicas: DataFrame, points: DataFrame, by: Sequence[str], alpha: float = 0.05
) -> DataFrame:
    by = list(by)
    spread = replicas.groupBy(*by).agg(interval("auc", alpha).alias("_ci"), F.count("auc").alias("n_boot"))
    n = F.col("n_events") + F.col("n_nonevents")
    if by:
        joined = points.join(spread, by, "left")
    else:
        joined = points.withColumn("_s", spread.select(F.struct("_ci", "n_boot")).scalar()).select(
            "*", "_s.*"
        )
    usable = F.col("auc").isNotNull()
    return joined.select(
        *by,
        n.alias("n"),
        "n_events",
        "auc",
        F.when(usable, F.col("_ci")[0]).alias("ci_low"),
        F.when(usable, F.col("_ci")[1]).alias("ci_high"),
        F.when(usable, F.col("_ci")[1] - F.col("_ci")[0]).alias("ci_width"),
        F.when(usable, F.col("n_boot")).alias("n_boot"),
        F.when(~usable, F.lit(K.NOTE_ONE_CLASS)).alias("note"),
    )


def auc_interval(
    df: DataFrame, label: str, score: str, by: Sequence[str] = (), replicas: int = 1000,
    alpha: float = 0.05, seed: int = 42,
) -> DataFrame:
    """AUC with a bootstrap interval per group; a one-class group has nulls and a note."""
    cells, edges = shared_cells(df, label, score, by)
    points = evaluation.auc_of_cells(cells, by, edges)
    return auc_interval_of(replicate_cells(cells, by, replicas, seed, edges), points, by, alpha)


def auc_differences_of(
    replicas: DataFrame, points: DataFrame, group: str, axis: Sequence[str] = (), alpha: float = 0.05
) -> DataFrame:
    """Each group's AUC minus the pair-weighted AUC of the other groups of its axis.

    Weights are frozen at the observed pair counts; all groups share the replicas.
    """
    axis = list(axis)
    pairs = F.col("n_events").cast("double") * F.col("n_nonevents")
    usable = points.filter(F.col("auc").isNotNull()).select(
        *axis, group, F.col("auc").alias("auc_target"), pairs.alias("_w")
    )
    around = Window.partitionBy(*axis)
    others_w = F.sum("_w").over(around) - F.col("_w")
    others = F.sum(F.col("_w") * F.col("auc_target")).over(around) - F.col("_w") * F.col("auc_target")
    base = usable.withColumns(
        {"auc_reference": C.safe_div(others, others_w), "_groups": F.count(F.lit(1)).over(around)}
    ).filter(F.col("_groups") >= 2)

    rep = replicas.select(*axis, group, "replica", "auc").join(usable, [*axis, group])
    here = Window.partitionBy(*axis, "replica")
    have = F.col("auc").isNotNull()
    w = F.when(have, F.col("_w")).otherwise(0.0)
    rep = rep.withColumns(
        {
            "_sw": F.sum(w).over(here) - w,
            "_swa": F.sum(w * F.coalesce("auc", F.lit(0.0))).over(here) - w * F.coalesce("auc", F.lit(0.0)),
        }
    ).withColumn("diff", F.when(have, F.col("auc") - C.safe_div("_swa", "_sw")))
    spread = rep.groupBy(*axis, group).agg(
        interval("diff", alpha).alias("_ci"),
        F.count("diff").alias("n_boot"),
        F.count_if(F.col("diff") >= 0).alias("_ge"),
        F.count_if(F.col("diff") <= 0).alias("_le"),
    )
    one_sided = (F.least("_ge", "_le") + 1) / (F.col("n_boot") + 1)
    return base.join(spread, [*axis, group], "left").select(
        *axis,
        group,
        "auc_target",
        "auc_reference",
        (F.col("auc_target") - F.col("auc_reference")).alias("diff"),
        F.col("_ci")[0].alias("diff_ci_low"),
        F.col("_ci")[1].alias("diff_ci_high"),
        F.least(F.lit(1.0), one_sided * 2).alias("p_value"),
        "n_boot",
        ((F.col("_ci")[1] < 0) | (F.col("_ci")[0] > 0)).alias("significant"),
        (F.col("_ci")[1] < 0).alias("worse_than_reference"),
    )


def auc_differences(
    df: DataFrame, label: str, score: str, group: str, replicas: int = 1000, alpha: float = 0.05, seed: int = 42
) -> DataFrame:
    cells, edges = shared_cells(df, label, score, [group])
    points = evaluation.auc_of_cells(cells, [group], edges)
    return auc_differences_of(replicate_cells(cells, [group], replicas, seed, edges), points, group, (), alpha)


def auc_difference_of_group(
    df: DataFrame, label: str, score: str, group: str, target: str, replicas: int = 1000,
    alpha: float = 0.05, seed: int = 42,
) -> DataFrame:
    """One group against the pair-weighted mean of the others."""
    return auc_differences(df, label, score, group, replicas, alpha, seed).filter(F.col(group) == target)


def calibration_gaps(
    df: DataFrame, label: str, score: str, by: str, replicas: int = 500, min_count: int = K.MIN_GROUP,
    alpha: float = 0.05, seed: int = 42,
) -> DataFrame:
    """Predicted minus observed rate per group with its bootstrap interval and Brier score."""
    cells, edges = shared_cells(df, label, score, [by])
    points = evaluation.quality_of_cells(cells, [by], 1.0, min_count, edges)
    reps = replicate_cells(cells, [by], replicas, seed, edges)
    spread = reps.groupBy(by).agg(interval("gap", alpha).alias("_ci"))
    return points.join(spread, by, "left").select(
        by,
        "n",
        F.col("avg_score").alias("predicted"),
        F.col("default_rate").alias("observed"),
        F.col("calibration_gap").alias("gap"),
        F.col("_ci")[0].alias("gap_ci_low"),
        F.col("_ci")[1].alias("gap_ci_high"),
        ((F.col("_ci")[1] < 0) | (F.col("_ci")[0] > 0)).alias("gap_significant"),
        "brier",
    )


def segment_report(
    df: DataFrame, label: str, score: str, threshold: float, replicas: int = 500,
    axes: dict[str, Column] | None = None, min_count: int = K.MIN_GROUP, alpha: float = 0.05, seed: int = 42,
) -> DataFrame:
    """Point figures, AUC interval and verdict against the rest of the axis, for every segment."""
    long = evaluation.unpivot_dimensions(df, axes or evaluation.segment_axes(), [label, score])
    by = ["dimension", "group"]
    cells, edges = shared_cells(long, label, score, by)
    points = evaluation.auc_of_cells(cells, by, edges)
    reps = replicate_cells(cells, by, replicas, seed, edges)
    ci = auc_interval_of(reps, points, by, alpha).select(*by, "ci_low", "ci_high", "n_boot")
    diffs = auc_differences_of(reps, points, "group", ["dimension"], alpha).select(
        *by, "auc_reference", "diff", "diff_ci_low", "diff_ci_high", "p_value", "worse_than_reference"
    )
    figures = evaluation.quality_of_cells(cells, by, threshold, min_count, edges)
    return (
        figures.join(ci, by, "left")
        .join(diffs, by, "left")
        .withColumn("confirmed_weakness", F.coalesce("worse_than_reference", F.lit(False)))
        .drop("worse_than_reference")
    )


def overall_quality(
    df: DataFrame, label: str, score: str, threshold: float, replicas: int = 500, alpha: float = 0.05, seed: int = 42
) -> DataFrame:
    """The same point figures and interval for the whole set (one row)."""
    whole = df.withColumn("_all", F.lit("all"))
    cells, edges = shared_cells(whole, label, score, ["_all"])
    points = evaluation.quality_of_cells(cells, ["_all"], threshold, 1, edges)
    reps = replicate_cells(cells, ["_all"], replicas, seed, edges)
    ci = auc_interval_of(reps, evaluation.auc_of_cells(cells, ["_all"], edges), ["_all"], alpha).select(
        "_all", "ci_low", "ci_high", "ci_width", "n_boot")
    return points.join(ci, "_all", "left").drop("_all")


def matched_cohort(
    df: DataFrame, label: str, score: str, group: str, target: str, reference: Sequence[str],
    strata: Sequence[str], replicas: int = 500, alpha: float = 0.05, seed: int = 42,
) -> DataFrame:
    """AUC of a cohort drawn from the reference groups with the target's mix of strata.

    A pool row of stratum s gets Poisson(target count / pool count) weights, so every replica
    reproduces the target's strata in expectation without listing single draws.
    """
    slim = df.filter(F.col(score).isNotNull() & F.col(label).isNotNull()).select(
        label, score, group, F.concat_ws("|", *[F.col(s).cast("string") for s in strata]).alias("stratum")
    )
    is_target, in_pool = F.col(group) == target, F.col(group).isin(list(reference))
    mix = slim.filter(is_target | in_pool).groupBy("stratum").agg(
        F.count_if(is_target).alias("n_target"), F.count_if(in_pool).alias("n_pool")
    ).filter(F.col("n_target") > 0)
    pool = slim.filter(in_pool).join(
        mix.filter(F.col("n_pool") > 0).select("stratum", (F.col("n_target") / F.col("n_pool")).alias("_rate")), "stratum"
    )
    cells = staged(keyed_cells(pool, label, score, (), "stratum", "_rate"), "cohort-cells")
    reps = replicate_cells(cells, (), replicas, seed)
    own = evaluation.auc(slim.filter(is_target), label, score).select("auc")
    cover = mix.agg(
        F.count(F.lit(1)).alias("n_strata"),
        C.safe_div(F.sum(F.when(F.col("n_pool") > 0, F.col("n_target")).otherwise(0)), F.sum("n_target")).alias("coverage"),
        F.sum("n_target").alias("n_target"),
    )
    scored = reps.withColumn("_own", own.scalar())
    spread = scored.agg(
        F.first("_own").alias("auc_target"),
        F.avg("auc").alias("auc_cohort"),
        interval("auc", alpha).alias("_ci"),
        F.avg((F.col("_own") < F.col("auc")).cast("double")).alias("p_target_worse"),
        F.count("auc").alias("n_boot"),
    )
    return spread.withColumn("_c", cover.select(F.struct("n_strata", "coverage", "n_target")).scalar()).select(
        "auc_target", "auc_cohort", F.col("_ci")[0].alias("ci_low"), F.col("_ci")[1].alias("ci_high"),
        (F.col("auc_target") - F.col("auc_cohort")).alias("diff"), "p_target_worse", "n_boot",
        "_c.n_strata", "_c.coverage", "_c.n_target",
    )


def profile_strata(df: DataFrame, with_score_level: bool = False) -> tuple[DataFrame, list[str]]:
    """Stratum columns of the matched cohort: history, scores present, employment, instalments."""
    out = df.withColumns(
        {
            "_thin": F.col("BUREAU_COUNT").isNull().cast("int"),
            "_ext": F.greatest(F.least(F.coalesce("N_EXT_SOURCE_PRESENT", F.lit(0)), F.lit(3)), F.lit(0)),
            # Right-closed limits of employment years and instalment counts.
            "_job": right_closed(F.coalesce("YEARS_EMPLOYED", F.lit(-1.0)), (0, 2, 5, 10)),
            "_inst": right_closed(F.coalesce("INST_COUNT", F.lit(0)), (5, 15, 30, 60)),
        }
    )
    names = ["_thin", "_ext", "_job", "_inst"]
    if with_score_level:
        out = ranking.octiles(out, "EXT_SOURCE_MEAN", K.ID, "_level")
        names.append("_level")
    return out, names


def right_closed(x: Column, limits: Sequence[float]) -> Column:
    """Index of the right-closed interval: the number of limits strictly below the value."""
    out = F.lit(0)
    for limit in limits:
        out = out + (x > F.lit(limit)).cast("int")
    return out


def flag_inside_bands(
    df: DataFrame, label: str, score: str, band: str, flag: str, replicas: int = 500, min_count: int = 50,
    alpha: float = 0.05, seed: int = 42,
) -> DataFrame:
    """AUC interval and default rate for both states of a flag inside every band."""
    by = [band, flag]
    ci = auc_interval(df, label, score, by, replicas, alpha, seed)
    share = F.col("n") / F.sum("n").over(Window.partitionBy(band))
    shaped = ci.withColumns(
        {"share_of_band": share, "default_rate": F.col("n_events") / F.col("n")}
    )
    return shaped.filter((F.col("n") >= min_count) & F.col("auc").isNotNull()).drop("note")
