"""Distributed order: running sums, exact quantiles and cut keys without a global window.

A window ordered over a whole table is one task. Here the values are first reduced to one
row per distinct value, split into value ranges by quantile edges (a sketch over distinct
values, so a value shared by a third of the rows weighs as one), and each range is ordered
on its own. Only the per-range totals, at most ``ranges`` rows per group, meet in one window.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskloom.session import staged

RANGE = "_range"
CELLS_PER_RANGE = 250_000


def range_edges(df: DataFrame, value: str, per_range: int | None = None) -> list[float]:
    """Ascending inner edges that split the values of ``df`` into about equal ranges.

    The number of ranges follows the number of cells, so a range stays near ``CELLS_PER_RANGE``
    cells however many there are. Only the edges reach the driver.
    """
    x = F.col(value).cast("double")
    n = df.agg(F.count(x)).first()[0]
    wanted = -(-n // min(CELLS_PER_RANGE, per_range or CELLS_PER_RANGE))
    if wanted < 2:
        return []
    probs = [i / wanted for i in range(1, wanted)]
    return sorted(set(df.agg(F.percentile_approx(x, probs, max(1000, 20 * wanted))).first()[0]))


def with_bins(df: DataFrame, value: str, edges: Sequence[float], out: str) -> DataFrame:
    """Add the number of edges at or below ``value`` by binary search; null stays null."""
    if not edges:
        return df.withColumn(out, F.when(F.col(value).isNotNull(), F.lit(0)))
    tmp = out + "_d"
    splits = [float("-inf"), *[float(e) for e in edges], float("inf")]
    binned = Bucketizer(splits=splits, inputCol=tmp + "_v", outputCol=tmp, handleInvalid="keep")
    shaped = df.withColumn(tmp + "_v", F.col(value).cast("double"))
    return binned.transform(shaped).withColumn(
        out, F.when(F.col(tmp + "_v").isNotNull(), F.col(tmp).cast("int"))
    ).drop(tmp, tmp + "_v")


def value_cells(df: DataFrame, value: str, by: Sequence[str] = (), **counts) -> DataFrame:
    """One row per (group, distinct non-null value) with the given aggregates (default ``n``)."""
    aggs = [c.alias(k) for k, c in counts.items()] or [F.count(F.lit(1)).alias("n")]
    kept = df.filter(F.col(value).isNotNull())
    for g in by:
        kept = kept.filter(F.col(g).isNotNull())
    return kept.groupBy(*by, value).agg(*aggs)


def running_sums(
    cells: DataFrame,
    value: str,
    measures: Sequence[str],
    by: Sequence[str] = (),
    edges: Sequence[float] | None = None,
) -> DataFrame:
    """Add ``below_<m>`` (sum over smaller values of the group) and ``total_<m>`` to each cell.

    The cells are written to the shared folder first: counting them, finding their ranges and
    adding them up then read the reduced table and not the rows behind it. ``edges`` of an earlier
    call over the same (staged) cells spare all that.
    """
    by = list(by)
    if edges is None:
        cells = staged(cells, "value-cells")
        edges = range_edges(cells, value)
    if not edges:
        # few cells: each group is one range, and its running sums are the answer
        group = Window.partitionBy(*by)
        lower = group.orderBy(value).rowsBetween(Window.unboundedPreceding, -1)
        return cells.select(
            "*",
            *[F.coalesce(F.sum(m).over(lower), F.lit(0)).alias(f"below_{m}") for m in measures],
            *[F.sum(m).over(group).alias(f"total_{m}") for m in measures],
        )
    ranged = with_bins(cells, value, edges, RANGE)
    totals = ranged.groupBy(*by, RANGE).agg(*[F.sum(m).alias(f"_sum_{m}") for m in measures])
    before = Window.partitionBy(*by).orderBy(RANGE).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*by)
    offsets = totals.select(
        *by,
        RANGE,
        *[F.coalesce(F.sum(f"_sum_{m}").over(before), F.lit(0)).alias(f"_off_{m}") for m in measures],
        *[F.sum(f"_sum_{m}").over(whole).alias(f"total_{m}") for m in measures],
    )
    inside = (
        Window.partitionBy(*by, RANGE).orderBy(value).rowsBetween(Window.unboundedPreceding, -1)
    )
    joined = ranged.join(offsets, [*by, RANGE])
    for m in measures:
        joined = joined.withColumn(
            f"below_{m}", F.coalesce(F.sum(m).over(inside), F.lit(0)) + F.col(f"_off_{m}")
        )
    return joined.drop(RANGE, *[f"_off_{m}" for m in measures])


def quantile_table(
    df: DataFrame, value: str, probs: Sequence[float], by: Sequence[str] = ()
) -> DataFrame:
    """Exact linear-interpolated quantiles: one row per group with ``n`` and array ``q``."""
    cells = value_cells(df.select(*by, value), value, by)
    return quantiles_of_cells(cells, value, probs, by)


def quantiles_of_cells(
    cells: DataFrame, value: str, probs: Sequence[float], by: Sequence[str] = ()
) -> DataFrame:
    ranked = running_sums(cells, value, ["n"], by)
    x = F.col(value).cast("double")
    picks = []
    for i, p in enumerate(probs):
        pos = F.lit(float(p)) * (F.col("total_n") - 1)
        upto = F.col("below_n") + F.col("n")
        picks.append(F.min(F.when(upto > F.floor(pos), x)).alias(f"_lo{i}"))
        picks.append(F.min(F.when(upto > F.ceil(pos), x)).alias(f"_hi{i}"))
    picked = ranked.groupBy(*by).agg(F.first("total_n").alias("n"), *picks)
    out = []
    for i, p in enumerate(probs):
        pos = F.lit(float(p)) * (F.col("n") - 1)
        out.append(
            F.col(f"_lo{i}") + (F.col(f"_hi{i}") - F.col(f"_lo{i}")) * (pos - F.floor(pos))
        )
    return picked.select(*by, "n", F.array(*out).alias("q"))


def quantiles(df: DataFrame, value: str, probs: Sequence[float]) -> list[float]:
    """Exact quantiles of one column as numbers (at most ``len(probs)`` values reach the driver)."""
    row = quantile_table(df, value, probs).first()
    return [] if row is None or row["n"] is None else list(row["q"])


Key = tuple[float, int]


def cut_keys(df: DataFrame, value: str, tie: str, positions: Sequence[int]) -> list[Key]:
    """The (value, tie) keys found at the given 0-based positions of the ascending order."""
    one = df.withColumn("_one", F.lit(1))
    found = cut_keys_by(one, value, tie, "_one", {1: positions})[1]
    return [found[p] for p in sorted(found)]


def cut_keys_by(
    df: DataFrame, value: str, tie: str, by: str, positions: Mapping[object, Sequence[int]]
) -> dict[object, dict[int, Key]]:
    """The keys at the given positions of every group, all groups in the same passes.

    The value at each position comes from the distinct-value counts; the tie column is then
    looked at only inside those few values, in the same way.
    """
    wanted = [(i, g, int(p)) for i, (g, p) in enumerate((g, p) for g, ps in positions.items() for p in sorted(set(ps)))]
    out: dict[object, dict[int, Key]] = {g: {} for g in positions}
    if not wanted:
        return out
    ranked = running_sums(value_cells(df.select(by, value), value, [by]), value, ["n"], [by])
    upto = F.col("below_n") + F.col("n")
    row = ranked.agg(*[
        F.min(F.when((F.col(by) == F.lit(g)) & (upto > p), F.struct(F.col(value), F.col("below_n"), F.col("n")))).alias(f"p{i}")
        for i, g, p in wanted
    ]).first()
    hits = [(i, g, p, *row[f"p{i}"]) for i, g, p in wanted if row[f"p{i}"] is not None]
    if not hits:
        return out
    tied = df.filter(F.col(value).isin(sorted({h[3] for h in hits}))).select(by, value, tie)
    ties = running_sums(value_cells(tied, tie, [by, value]), tie, ["n"], [by, value])
    found = ties.agg(*[
        F.min(
            F.when((F.col(by) == F.lit(g)) & (F.col(value) == F.lit(v)) & (F.col("below_n") + F.col("n") > p - below), F.col(tie))
        ).alias(f"p{i}")
        for i, g, p, v, below, _n in hits
    ]).first()
    for i, g, p, v, _below, _n in hits:
        out[g][p] = (v, found[f"p{i}"])
    return out


def at_or_after_key(value: str, tie: str, key: Key):
    """True where (value, tie) sorts at or after the key."""
    v, t = key
    return (F.col(value) > F.lit(v)) | ((F.col(value) == F.lit(v)) & (F.col(tie) >= F.lit(t)))


def rank_groups(df: DataFrame, value: str, tie: str, starts: Sequence[int], out: str) -> DataFrame:
    """Group number by position: group k begins at ``starts[k]`` (``starts[0]`` is 0).

    Every row is labelled by comparing its key with the cut keys, so nothing is sorted or shuffled.
    """
    keys = cut_keys(df, value, tie, [s for s in starts if s > 0])
    label = F.lit(0)
    for key in keys:
        label = label + at_or_after_key(value, tie, key).cast("int")
    return df.withColumn(out, F.when(F.col(value).isNotNull(), label))


def octiles(df: DataFrame, value: str, tie: str, out: str = "octile", q: int = 8) -> DataFrame:
    """Equal-frequency bins of the first-come rank, closed on the right as quantile cuts are."""
    n = df.filter(F.col(value).isNotNull()).count()
    starts = [0]
    for k in range(1, q):
        # first 0-based position r-1 whose bin ceil((r-1)*q/(n-1)) exceeds k
        starts.append((k * (n - 1)) // q + 1 if n > 1 else n)
    return rank_groups(df, value, tie, starts, out)


def sextiles(df: DataFrame, value: str, out: str = "sextile") -> tuple[DataFrame, list[float]]:
    """Six equal-frequency bands, right-closed, labelled from their rounded limits."""
    cuts = quantiles(df, value, [i / 6 for i in range(1, 6)])
    whole = [f"{c:.0f}" for c in cuts]
    labels = [f"S1 ate {whole[0]}"]
    labels += [f"S{i + 1} {whole[i - 1]}-{whole[i]}" for i in range(1, 5)]
    labels.append(f"S6 {whole[-1]}+")
    label = F.when(F.col(value).isNull(), F.lit(None).cast("string"))
    for cut, name in zip(cuts, labels):
        label = label.when(F.col(value) <= F.lit(cut), F.lit(name))
    return df.withColumn(out, label.otherwise(F.lit(labels[-1]))), cuts


def evenly_spaced(position, n, points: int):
    """True for the positions an even down-sampling to ``points`` rows keeps (both ends stay)."""
    steps = F.ceil(position * F.lit(points - 1) / F.nullif(n - 1, F.lit(0)))
    hit = F.floor(steps * (n - 1) / F.lit(points - 1)) == position
    return F.coalesce((n <= F.lit(points)) | hit, F.lit(True))


def share_at_or_below(df: DataFrame, value: str, out: str = "percentile") -> DataFrame:
    """For each distinct value, the share of non-null rows at or below it."""
    ranked = running_sums(value_cells(df.select(value), value), value, ["n"])
    return ranked.select(value, ((F.col("below_n") + F.col("n")) / F.col("total_n")).alias(out))
