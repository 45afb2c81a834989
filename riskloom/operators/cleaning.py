"""Cleaning steps as DataFrame -> DataFrame transforms (chain with ``df.transform``)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.functions import columns as C
from riskloom.functions import constants as K
from riskloom.operators import ranking

NUMERIC = (T.NumericType,)


def numeric_columns(df: DataFrame, skip: Sequence[str] = ()) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NUMERIC) and f.name not in skip]


def string_columns(df: DataFrame, skip: Sequence[str] = ()) -> list[str]:
    return [
        f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType) and f.name not in skip
    ]


def null_values(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    """Sentinels and invalid categories become null; absent columns are ignored."""
    return df.withColumns(
        {c: C.null_if_value(c, v) for c, v in values.items() if c in df.columns}
    )


def nan_to_null(df: DataFrame) -> DataFrame:
    """NaN and infinity become null in every floating column."""
    floats = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return df.withColumns({c: C.finite(c) for c in floats}) if floats else df


def cap_upper_tail(df: DataFrame, column: str, quantile: float = K.INCOME_CAP_QUANTILE) -> DataFrame:
    """Winsorise the upper tail at the exact quantile of the column."""
    cap = ranking.quantiles(df, column, [quantile])
    if not cap or cap[0] is None:
        return df
    return df.withColumn(column, C.upper_cap(F.col(column).cast("double"), cap[0]))


def add_years(df: DataFrame, pairs: Mapping[str, str] | None = None) -> DataFrame:
    pairs = K.YEARS_FROM_DAYS if pairs is None else pairs
    return df.withColumns({n: C.days_to_years(d) for n, d in pairs.items() if d in df.columns})


def trim_strings(df: DataFrame) -> DataFrame:
    names = string_columns(df)
    return df.withColumns({c: F.trim(c) for c in names}) if names else df


def sanitize(df: DataFrame, cap_quantile: float | None = K.INCOME_CAP_QUANTILE) -> DataFrame:
    """The five cleaning steps in order."""
    out = null_values(df, {"DAYS_EMPLOYED": K.EMPLOYED_SENTINEL, "CODE_GENDER": K.UNKNOWN_GENDER})
    if cap_quantile and "AMT_INCOME_TOTAL" in out.columns:
        out = cap_upper_tail(out, "AMT_INCOME_TOTAL", cap_quantile)
    return trim_strings(add_years(out))


def reproducible_sample(df: DataFrame, n: int, key: str, seed: int = 42) -> DataFrame:
    """The ``n`` rows with the smallest keyed hash (a sampling operator).

    The hash at position ``n`` is searched for and every row compared with it, so a sample of any size moves no rows.
    """
    hashed = df.withColumn("_u", C.hash_unit(key, seed=seed))
    cut = ranking.cut_keys(hashed, "_u", key, [n])
    return (hashed.filter(~ranking.at_or_after_key("_u", key, cut[0])) if cut else hashed).drop("_u")


def numeric_text_report(df: DataFrame) -> DataFrame:
    """Per string column: non-null values, how many read as numbers, and a warning flag."""
    names = string_columns(df)
    aggs = []
    for c in names:
        aggs.append(F.count(c).alias(f"v_{c}"))
        aggs.append(F.count(F.expr(f"try_cast(`{c}` AS double)")).alias(f"n_{c}"))
    rows = ", ".join(f"'{c}', `v_{c}`, `n_{c}`" for c in names)
    return df.agg(*aggs).selectExpr(
        f"stack({len(names)}, {rows}) AS (column_name, n_values, n_numeric)"
    ).withColumn("holds_numbers", F.col("n_numeric") > 0)


def align_to_model(
    df: DataFrame, numeric: Sequence[str], categories: Mapping[str, Sequence[str]]
) -> DataFrame:
    """Select the model columns: absent -> null, bad text -> null, unseen category -> null."""
    out = [c for c in df.columns if c not in set(numeric) | set(categories)]
    cols = [F.col(c) for c in out]
    for c in numeric:
        cols.append(
            F.expr(f"try_cast(`{c}` AS double)").alias(c)
            if c in df.columns
            else F.lit(None).cast("double").alias(c)
        )
    for c, levels in categories.items():
        cols.append(
            F.when(F.col(c).isin(list(levels)), F.col(c)).alias(c)
            if c in df.columns
            else F.lit(None).cast("string").alias(c)
        )
    return df.select(*cols)


def payload_quality(df: DataFrame, payload: str, expected: Sequence[str]) -> DataFrame:
    """From a map column: informed features, coverage and unknown names."""
    names = F.array(*[F.lit(e) for e in expected])
    given = F.map_keys(F.map_filter(payload, lambda k, v: v.isNotNull()))
    informed = F.size(F.array_intersect(given, names))
    return df.withColumns(
        {
            "features_informed": informed,
            "features_expected": F.lit(len(expected)),
            "coverage": informed / F.lit(float(max(len(expected), 1))),
            "unknown_features": F.array_sort(F.array_except(F.map_keys(payload), names)),
        }
    )
