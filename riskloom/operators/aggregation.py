"""History tables to one row per key: wide numeric and categorical aggregation, roll-ups, joins."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.functions import constants as K
from riskloom.functions.columns import clean_name
from riskloom.operators.cleaning import numeric_columns

AGGREGATES = {
    "mean": lambda x: F.avg(x),
    # an all-null group sums to zero, as a numeric reduction does
    "sum": lambda x: F.coalesce(F.sum(x), F.lit(0)),
    "max": lambda x: F.max(x),
    "min": lambda x: F.min(x),
    "count": lambda x: F.count(x),
}


def restrict_to(df: DataFrame, parents: DataFrame, key: str) -> DataFrame:
    """Keep child rows whose key exists among the parents."""
    return df.join(parents.select(key), key, "left_semi")


def numeric_expressions(
    columns: Sequence[str], prefix: str, funcs: Sequence[str], where: Column | None = None
) -> list[Column]:
    out = []
    for c in columns:
        x = F.col(c) if where is None else F.when(where, F.col(c))
        out += [AGGREGATES[f](x).alias(f"{prefix}_{c}_{f}".upper()) for f in funcs]
    rows = F.count(F.lit(1)) if where is None else F.count_if(where)
    return [*out, rows.alias(f"{prefix}_COUNT".upper())]


def group_wide(df: DataFrame, key: str, exprs: Sequence[Column], chunk: int = 600) -> DataFrame:
    """One grouped pass; very wide lists go in chunks that share the key partitioning."""
    parts = [df.groupBy(key).agg(*exprs[i : i + chunk]) for i in range(0, len(exprs), chunk)]
    return reduce(lambda a, b: a.join(b, key), parts)


def aggregate_numeric(
    df: DataFrame,
    key: str,
    prefix: str,
    funcs: Sequence[str] = K.NUMERIC_AGGREGATES,
    parents: DataFrame | None = None,
    skip: Sequence[str] = K.KEY_COLUMNS,
) -> DataFrame:
    """Every numeric non-key column under every function, plus the row count, per key.

    With ``parents`` the filter runs on the one-row-per-key result: it keeps the same keys as
    filtering first, and no raw row is shuffled for it.
    """
    names = numeric_columns(df, skip=(key, *skip))
    wide = group_wide(df, key, numeric_expressions(names, prefix, funcs))
    return wide if parents is None else restrict_to(wide, parents, key)


def aggregate_recent(
    df: DataFrame,
    key: str,
    prefix: str,
    window_column: str,
    months: int,
    funcs: Sequence[str] = K.NUMERIC_AGGREGATES,
    skip: Sequence[str] = K.KEY_COLUMNS,
) -> DataFrame:
    """The same aggregation over the recent window only, under its own prefix."""
    recent = df.filter(F.col(window_column) >= recent_cut(window_column, months))
    return aggregate_numeric(recent, key, f"{prefix}_R{months}", funcs, skip=skip)


def recent_cut(window_column: str, months: int) -> int:
    """Relative lower bound: months back, in days for a day column."""
    return -abs(months) * (K.DAYS_PER_MONTH if window_column.startswith("DAYS_") else 1)


def top_values(
    df: DataFrame, columns: Sequence[str], k: int = K.MAX_CATEGORIES,
    key: str | None = None, parents: DataFrame | None = None,
) -> dict[str, list[str]]:
    """The k most frequent non-null values per column (count descending, then value).

    One job for all columns; the ranked filter is cut to k rows per column inside every
    task before the rows meet, so a column with many values never gathers in one place.
    With ``parents`` only rows of known keys count: rows are reduced to (key, value) counts
    before that join.
    """
    keys = [] if parents is None else [key]
    long = df.select(*keys, *[F.col(c).cast("string").alias(f"_c_{c}") for c in columns]).unpivot(
        keys, [f"_c_{c}" for c in columns], "column_name", "value"
    ).withColumn("column_name", F.substring("column_name", 4, 1000)).filter(F.col("value").isNotNull())
    if parents is None:
        counts = long.groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("count"))
    else:
        per_key = long.groupBy(key, "column_name", "value").agg(F.count(F.lit(1)).alias("_n"))
        known = restrict_to(per_key, parents, key)
        counts = known.groupBy("column_name", "value").agg(F.sum("_n").alias("count"))
    order = Window.partitionBy("column_name").orderBy(F.desc("count"), F.asc("value"))
    best = counts.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    out: dict[str, list[str]] = {c: [] for c in columns}
    for row in sorted(best.collect(), key=lambda r: (r["column_name"], r["rank"])):
        out[row["column_name"]].append(row["value"])
    return out


def lump_tail(c: str, kept: Sequence[str], other: str = K.OTHER_CATEGORY) -> Column:
    """Values outside the kept list, and nulls, fall into the same bucket."""
    return F.when(F.col(c).isin(list(kept)), F.col(c).cast("string")).otherwise(F.lit(other))


def categorical_expressions(
    kept: Mapping[str, Sequence[str]], prefix: str, other: str = K.OTHER_CATEGORY
) -> list[Column]:
    names: dict[str, Column] = {}
    for c, values in kept.items():
        bucket = lump_tail(c, values, other)
        for value in [*values, *([] if other in values else [other])]:
            hit = F.when(bucket == value, 1.0).otherwise(0.0)
            for func, expr in (("SUM", F.sum(hit)), ("MEAN", F.avg(hit))):
                name = clean_name(f"{prefix}_{c}_{value}_{func}")
                if name in names:
                    raise ValueError(f"two categories of {c} map to the column {name}")
                names[name] = expr.alias(name)
    return list(names.values())


def aggregate_categorical(
    df: DataFrame,
    key: str,
    prefix: str,
    columns: Sequence[str],
    max_categories: int = K.MAX_CATEGORIES,
    parents: DataFrame | None = None,
) -> DataFrame:
    """Count and share of each frequent value (tail and nulls lumped) per key."""
    have = [c for c in columns if c in df.columns]
    kept = top_values(df, have, max_categories, key, parents)
    wide = group_wide(df, key, categorical_expressions(kept, prefix))
    return wide if parents is None else restrict_to(wide, parents, key)


def aggregate_history(
    df: DataFrame,
    key: str,
    prefix: str,
    categories: Sequence[str] = (),
    recent: tuple[str, int] | None = None,
    funcs: Sequence[str] = K.NUMERIC_AGGREGATES,
    max_categories: int = K.MAX_CATEGORIES,
    skip: Sequence[str] = K.KEY_COLUMNS,
    parents: DataFrame | None = None,
) -> DataFrame:
    """Lifetime, categorical and recent-window aggregates of one table in a single grouped pass.

    ``parents`` decides which rows count for the frequent values; keys outside it stay in the
    result, to be dropped by the left join that attaches it.
    """
    names = numeric_columns(df, skip=(key, *skip))
    exprs = numeric_expressions(names, prefix, funcs)
    have = [c for c in categories if c in df.columns]
    if have:
        exprs += categorical_expressions(top_values(df, have, max_categories, key, parents), prefix)
    if recent:
        column, months = recent
        inside = F.coalesce(F.col(column) >= recent_cut(column, months), F.lit(False))
        tagged = f"{prefix}_R{months}".upper()
        twin = numeric_expressions(names, tagged, funcs, inside)
        some = F.count_if(inside) > 0
        # a key with no recent row has no recent features at all
        exprs += [F.when(some, e).alias(n) for e, n in zip(twin, recent_names(names, tagged, funcs))]
    return group_wide(df, key, exprs)


def recent_names(names: Sequence[str], prefix: str, funcs: Sequence[str]) -> list[str]:
    return [f"{prefix}_{c}_{f}".upper() for c in names for f in funcs] + [f"{prefix}_COUNT"]


def roll_up(
    parents: DataFrame,
    child: DataFrame,
    grandchild: DataFrame,
    parent_key: str,
    child_key: str,
    child_prefix: str,
    grandchild_prefix: str,
    child_categories: Sequence[str] = (),
    grandchild_categories: Sequence[str] = (),
    funcs: Sequence[str] = K.NUMERIC_AGGREGATES,
) -> DataFrame:
    """Grandchild -> child -> parent: each level is reduced before its join.

    Unknown keys fall away at the joins, so no raw grandchild row is shuffled to be filtered.
    """
    skip = (parent_key, child_key, *K.KEY_COLUMNS)
    known_children = restrict_to(child, parents, parent_key).select(child_key)
    inner_wide = aggregate_history(
        grandchild, child_key, grandchild_prefix, grandchild_categories, funcs=funcs, skip=skip,
        parents=known_children,
    )
    joined = child.join(inner_wide, child_key, "left")
    outer = aggregate_history(
        joined, parent_key, child_prefix, child_categories, funcs=funcs, skip=skip, parents=parents
    )
    return restrict_to(outer, parents, parent_key)


def attach(base: DataFrame, parts: Sequence[DataFrame], key: str) -> DataFrame:
    """Left-join aggregated parts, one row per key each; clients without history get nulls."""
    return reduce(lambda left, part: left.join(part, key, "left"), parts, base)


def join_report(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Inner-join loss as counts: left rows, matched, lost."""
    marked = left.join(right.select(key).distinct().withColumn("_hit", F.lit(1)), key, "left")
    return marked.agg(
        F.count(F.lit(1)).alias("n_left"),
        F.count("_hit").alias("n_matched"),
        F.count_if(F.col("_hit").isNull()).alias("n_lost"),
    )
