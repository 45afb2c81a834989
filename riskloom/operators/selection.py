"""Exact quantiles of many columns in two scans, without moving (column, value) rows.

The first scan sketches every column; the sketches give a bracket of values around each wanted position. The second scan
counts the rows between the brackets and, inside them, the rows of each distinct value; both are added up in the map
tasks, so a value held by a third of all rows travels as one row per task. Only the bracket that holds a position is
put in order. A position that a sketch missed is found by ordering that column's distinct values.
"""

from __future__ import annotations

import bisect
import math
from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.functions import columns as C
from riskloom.operators import ranking, sketches
from riskloom.session import staged

# half width of a bracket as a share of the rows
MARGIN = 2 * sketches.RANK_ERROR


def brackets(lows: Sequence[float], highs: Sequence[float]) -> list[float]:
    """Ascending edges of the merged closed ranges [low, high]: rows with an odd number of edges at or below are inside."""
    edges: list[float] = []
    for low, high in sorted(zip(lows, highs)):
        beyond = math.nextafter(high, math.inf)
        if edges and low <= edges[-1]:
            edges[-1] = max(edges[-1], beyond)
        else:
            edges += [low, beyond]
    return [e for e in edges if e < math.inf]


def sketched_columns(df: DataFrame, columns: Sequence[str], probs: Sequence[float]) -> tuple[dict, dict[str, list[float]]]:
    """First scan: the profile row of every column with values, and its bracket edges."""
    wanted = [min(max(p + s * MARGIN, 0.0), 1.0) for p in probs for s in (-1, 1)]
    found = sketches.merged_profile(sketches.profile_parts(df, None, columns), wanted).collect()
    rows = {r["column_name"]: r for r in found}
    return rows, {c: brackets(r["q"][0::2], r["q"][1::2]) for c, r in rows.items() if r["n"]}


def bracket_cells(df: DataFrame, edges: dict[str, list[float]]) -> DataFrame:
    """Second scan: (feature, bucket, value) -> rows; the value is null outside the brackets."""
    binned = Bucketizer(
        splitsArray=[[-math.inf, *e, math.inf] for e in edges.values()], inputCols=[f"_x{i}" for i in range(len(edges))],
        outputCols=[f"_b{i}" for i in range(len(edges))], handleInvalid="keep",
    ).transform(df.select(*[C.finite(f"`{c}`").alias(f"_x{i}") for i, c in enumerate(edges)]))
    slots = []
    for i, c in enumerate(edges):
        x, bucket = F.col(f"_x{i}"), F.col(f"_b{i}").cast("int")
        inside = F.when(bucket % 2 == 1, x)
        slots.append(F.when(x.isNotNull(), F.struct(
            F.lit(c).alias("feature"), bucket.alias("bucket"), inside.alias("value"))))
    long = binned.select(F.explode(F.array(*slots)).alias("s")).filter("s IS NOT NULL")
    return long.groupBy("s.feature", "s.bucket", "s.value").agg(F.count(F.lit(1)).alias("n"))


def values_at(cells: DataFrame, positions: dict[str, list[int]]) -> dict[tuple[str, int], float]:
    """Values at 0-based positions of each column, for the positions that lie inside a bracket."""
    sizes: dict[str, list[tuple[int, int]]] = {}
    per_bucket = cells.groupBy("feature", "bucket").agg(F.sum("n").alias("n"))
    for r in per_bucket.collect():
        sizes.setdefault(r["feature"], []).append((r["bucket"], r["n"]))
    targets = []
    for c, wanted in positions.items():
        buckets = sorted(sizes[c])
        ends, total = [], 0
        for _bucket, n in buckets:
            total += n
            ends.append(total)
        for p in sorted(set(wanted)):
            i = bisect.bisect_right(ends, p)
            if buckets[i][0] % 2:
                targets.append((c, buckets[i][0], p, p - (ends[i] - buckets[i][1])))
    if not targets:
        return {}
    spark = cells.sparkSession
    inside = cells.filter(F.col("value").isNotNull())
    ranked = ranking.running_sums(inside, "value", ["n"], ["feature", "bucket"], ranking.range_edges(inside, "value"))
    asked = spark.createDataFrame(targets, "feature string, bucket int, position long, offset long")
    hit = (F.col("below_n") <= F.col("offset")) & (F.col("offset") < F.col("below_n") + F.col("n"))
    found = ranked.join(asked, ["feature", "bucket"]).filter(hit).select("feature", "position", "value").collect()
    return {(r["feature"], r["position"]): r["value"] for r in found}


def quantiles_of_columns(
    df: DataFrame, columns: Sequence[str], probs: Sequence[float], sketched: tuple[dict, dict] | None = None
) -> dict[str, list[float]]:
    """Exact linear-interpolated quantiles of every column over its finite values; none for a column without any.

    ``columns x probs`` numbers reach the driver. ``sketched`` is the result of an earlier first scan.
    """
    rows, edges = sketched or sketched_columns(df, columns, probs)
    out: dict[str, list[float]] = {c: [] for c in columns}
    if not edges:
        return out
    cells = staged(bracket_cells(df, edges), "bracket-cells")
    places = {c: [p * (rows[c]["n"] - 1) for p in probs] for c in edges}
    values = values_at(cells, {c: [f(x) for x in xs for f in (math.floor, math.ceil)] for c, xs in places.items()})
    for c, xs in places.items():
        pairs = [(values.get((c, math.floor(x))), values.get((c, math.ceil(x)))) for x in xs]
        if any(low is None or high is None for low, high in pairs):
            out[c] = ranking.quantiles(df.select(C.finite(f"`{c}`").alias("x")), "x", probs)
        else:
            out[c] = [low + (high - low) * (x - math.floor(x)) for (low, high), x in zip(pairs, xs)]
    return out
