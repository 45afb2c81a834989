"""Derived columns of the client table and the behaviour columns of its child tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.functions import columns as C
from riskloom.functions import constants as K


def ratio_columns(ratios: Mapping[str, tuple[str, str]] = K.RATIOS) -> dict[str, Column]:
    return {name: C.safe_div(num, den) for name, (num, den) in ratios.items()}


def add_ratios(df: DataFrame, ratios: Mapping[str, tuple[str, str]] = K.RATIOS) -> DataFrame:
    """Every ratio whose two source columns exist; null on a zero denominator."""
    have = set(df.columns)
    usable = {n: p for n, p in ratios.items() if set(p) <= have}
    return df.withColumns(ratio_columns(usable)) if usable else df


def nullable_stats(names: Sequence[str], prefix: str) -> dict[str, Column]:
    """Row-wise mean, max, min, sample deviation, product-if-all and count over nullable columns."""
    values = [F.col(c).cast("double") for c in names]
    present = reduce(lambda a, b: a + b, [v.isNotNull().cast("int") for v in values])
    total = reduce(lambda a, b: a + b, [F.coalesce(v, F.lit(0.0)) for v in values])
    mean = C.safe_div(total, present)
    squares = reduce(
        lambda a, b: a + b, [F.coalesce(F.pow(v - mean, 2), F.lit(0.0)) for v in values]
    )
    extremes = (F.greatest(*values), F.least(*values)) if len(values) > 1 else (values[0], values[0])
    return {
        f"{prefix}_MEAN": mean,
        f"{prefix}_MAX": extremes[0],
        f"{prefix}_MIN": extremes[1],
        f"{prefix}_STD": F.when(present >= 2, F.sqrt(squares / (present - 1))),
        f"{prefix}_PROD": reduce(lambda a, b: a * b, values),
        f"N_{prefix}_PRESENT": present.cast("byte"),
    }


def add_external_score_stats(df: DataFrame, names: Sequence[str] = K.EXTERNAL_SCORES) -> DataFrame:
    have = [c for c in names if c in df.columns]
    return df.withColumns(nullable_stats(have, "EXT_SOURCE")) if have else df


def add_presence_flags(
    df: DataFrame,
    flags: Mapping[str, str] = K.PRESENCE_FLAGS,
    internal: Sequence[str] = K.INTERNAL_FLAGS,
) -> DataFrame:
    """One flag per history source, the number of internal and all sources, and no-history."""
    made = {
        flag: (F.coalesce(F.col(count), F.lit(0)) > 0).cast("byte")
        if count in df.columns
        else F.lit(0).cast("byte")
        for flag, count in flags.items()
    }
    inner = reduce(lambda a, b: a + b, [made[f].cast("int") for f in internal])
    outer = reduce(lambda a, b: a + b, [made[f].cast("int") for f in flags if f not in internal])
    return df.withColumns(
        {
            **made,
            "N_INTERNAL_SOURCES": inner.cast("byte"),
            "N_SOURCES": (inner + outer).cast("byte"),
            "NO_HISTORY": (inner + outer == 0).cast("byte"),
        }
    )


def add_payment_behaviour(
    df: DataFrame,
    paid: str = "AMT_PAYMENT",
    due: str = "AMT_INSTALMENT",
    paid_day: str = "DAYS_ENTRY_PAYMENT",
    due_day: str = "DAYS_INSTALMENT",
) -> DataFrame:
    """Paid ratio, shortfall, days late, days early and late flag (0, not null, without a delay)."""
    delay = F.col(paid_day) - F.col(due_day)
    return df.withColumns(
        {
            "PAYMENT_RATIO": C.safe_div(paid, due),
            "PAYMENT_DIFF": F.col(due) - F.col(paid),
            "DPD": F.when(delay.isNotNull(), F.greatest(delay, F.lit(0))),
            "DBD": F.when(delay.isNotNull(), F.greatest(-delay, F.lit(0))),
            "LATE_FLAG": F.coalesce((delay > 0).cast("float"), F.lit(0.0).cast("float")),
        }
    )


def add_limit_use(
    df: DataFrame,
    balance: str = "AMT_BALANCE",
    drawings: str = "AMT_DRAWINGS_CURRENT",
    limit: str = "AMT_CREDIT_LIMIT_ACTUAL",
) -> DataFrame:
    return df.withColumns(
        {"UTILIZATION": C.safe_div(balance, limit), "DRAWING_RATIO": C.safe_div(drawings, limit)}
    )


def derived_columns(df: DataFrame) -> dict[str, Column]:
    """Every derived column that the base columns of ``df`` allow."""
    have = set(df.columns)
    out = ratio_columns({n: p for n, p in K.RATIOS.items() if set(p) <= have})
    out |= {n: C.days_to_years(d) for n, d in K.YEARS_FROM_DAYS.items() if d in have}
    ext = [c for c in K.EXTERNAL_SCORES if c in have]
    if ext:
        stats = nullable_stats(ext, "EXT_SOURCE")
        if len(ext) < len(K.EXTERNAL_SCORES):
            stats["EXT_SOURCE_PROD"] = F.lit(None).cast("double")
        out |= stats
    return out


def recompute(df: DataFrame, only_present: bool = True) -> DataFrame:
    """Refresh derived columns from their bases for the whole table at once."""
    fresh = derived_columns(df)
    if only_present:
        fresh = {n: c for n, c in fresh.items() if n in df.columns}
    return df.withColumns(fresh) if fresh else df


def apply_changes(df: DataFrame, changes: Mapping[str, object]) -> DataFrame:
    """Set base columns, then carry the change into the derived columns that exist."""
    values = {c: v if isinstance(v, Column) else F.lit(v) for c, v in changes.items()}
    return recompute(df.withColumns(values) if values else df)


def consistency(df: DataFrame, tolerance: float = 1e-6) -> DataFrame:
    """Per derived column: rows compared and rows whose stored value differs from its bases."""
    fresh = {n: c for n, c in derived_columns(df).items() if n in df.columns}
    aggs, rows = [], []
    for name, expr in fresh.items():
        stored, live = F.col(name).cast("double"), expr.cast("double")
        differs = (stored.isNull() != live.isNull()) | (
            F.abs(stored - live) > tolerance * F.greatest(F.abs(live), F.lit(1.0))
        )
        aggs += [F.count(F.lit(1)).alias(f"n_{name}"), F.count_if(differs).alias(f"d_{name}")]
        rows.append(f"'{name}', `n_{name}`, `d_{name}`")
    return df.agg(*aggs).selectExpr(
        f"stack({len(rows)}, {', '.join(rows)}) AS (column_name, n_compared, n_different)"
    )


def segment_weights(label: Column | str, weights: Mapping[str, float]) -> Column:
    """Row weight by segment label, 1 elsewhere."""
    out = F.lit(1.0)
    for segment, weight in weights.items():
        out = F.when(C.col(label) == segment, F.lit(float(weight))).otherwise(out)
    return out
