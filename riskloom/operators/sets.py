"""Set comparisons of keys and names."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def symmetric_difference(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Keys on exactly one side, with the side they came from; one shuffle for both directions."""
    tagged = left.select(key, F.lit(1).alias("_l"), F.lit(0).alias("_r")).unionByName(
        right.select(key, F.lit(0).alias("_l"), F.lit(1).alias("_r"))
    )
    sides = tagged.groupBy(key).agg(F.max("_l").alias("_l"), F.max("_r").alias("_r"))
    return sides.filter(F.col("_l") != F.col("_r")).select(
        key, F.when(F.col("_l") == 1, "left").otherwise("right").alias("side")
    )


def distinct_sorted(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).filter(F.col(column).isNotNull()).distinct().orderBy(column)


def known_and_unknown(df: DataFrame, names: str, expected: Sequence[str]) -> DataFrame:
    """Split an array of names into the known and the unknown ones."""
    known = F.array(*[F.lit(e) for e in expected])
    return df.withColumns(
        {
            "known": F.array_sort(F.array_intersect(names, known)),
            "unknown": F.array_sort(F.array_except(names, known)),
        }
    )


def align_two(before: DataFrame, after: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Full outer alignment of two keyed value tables with 0 for the absent side."""
    left = before.select(*keys, F.col(value).alias("before"))
    right = after.select(*keys, F.col(value).alias("after"))
    joined = left.join(right, list(keys), "full_outer")
    return joined.select(
        *keys,
        F.coalesce("before", F.lit(0.0)).alias("before"),
        F.coalesce("after", F.lit(0.0)).alias("after"),
    ).withColumn("difference", F.col("after") - F.col("before"))
