"""One filter specification, turned into one predicate, shared by every portfolio statistic."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, fields
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.functions import constants as K

Values = str | Sequence[str] | None

# Filter name -> column.
RANGES = {
    "age": "AGE_YEARS",
    "income": "AMT_INCOME_TOTAL",
    "credit": "AMT_CREDIT",
    "annuity": "AMT_ANNUITY",
    "children": "CNT_CHILDREN",
    "employed_years": "YEARS_EMPLOYED",
    "score": K.SCORE,
}
MEMBERSHIPS = {
    "contract_type": "NAME_CONTRACT_TYPE",
    "education": "NAME_EDUCATION_TYPE",
    "income_type": "NAME_INCOME_TYPE",
    "family_status": "NAME_FAMILY_STATUS",
    "housing_type": "NAME_HOUSING_TYPE",
    "occupation": "OCCUPATION_TYPE",
}


@dataclass(frozen=True)
class ClientFilters:
    """Optional bounds and values, combined by AND. An unknown name is a TypeError."""

    age_min: float | None = None
    age_max: float | None = None
    income_min: float | None = None
    income_max: float | None = None
    credit_min: float | None = None
    credit_max: float | None = None
    annuity_min: float | None = None
    annuity_max: float | None = None
    children_min: int | None = None
    children_max: int | None = None
    employed_years_min: float | None = None
    employed_years_max: float | None = None
    score_min: float | None = None
    score_max: float | None = None
    gender: str | None = None
    target: int | None = None
    split: str | None = None
    contract_type: Values = None
    education: Values = None
    income_type: Values = None
    family_status: Values = None
    housing_type: Values = None
    occupation: Values = None
    thin_file: bool | None = None
    decision: str | None = None

    def applied(self) -> dict:
        return {f.name: getattr(self, f.name) for f in fields(self) if getattr(self, f.name) is not None}

    def predicate(self, threshold: float | None = None) -> Column:
        conditions: list[Column] = []
        for name, column in RANGES.items():
            low, high = getattr(self, f"{name}_min"), getattr(self, f"{name}_max")
            if low is not None:
                conditions.append(F.col(column) >= low)
            if high is not None:
                conditions.append(F.col(column) <= high)
        for value, column in (
            (self.gender, "CODE_GENDER"),
            (self.target, K.TARGET),
            (self.split, K.SPLIT),
        ):
            if value is not None:
                conditions.append(F.col(column) == value)
        for name, column in MEMBERSHIPS.items():
            wanted = split_values(getattr(self, name))
            if wanted:
                conditions.append(F.col(column).isin(wanted))
        if self.thin_file is not None:
            missing = F.col("BUREAU_COUNT").isNull()
            conditions.append(missing if self.thin_file else ~missing)
        if self.decision is not None and threshold is not None:
            below = F.col(K.SCORE) < threshold
            if self.decision == K.APPROVE:
                conditions.append(below)
            elif self.decision == K.DENY:
                conditions.append(F.col(K.SCORE) >= threshold)
        return reduce(lambda a, b: a & b, conditions, F.lit(True))

    def apply(self, df: DataFrame, threshold: float | None = None) -> DataFrame:
        return df.filter(self.predicate(threshold)) if self.applied() else df


def split_values(value: Values) -> list[str] | None:
    """Comma text or a list to trimmed, non-empty values."""
    if value is None:
        return None
    parts = value.split(",") if isinstance(value, str) else list(value)
    return [p.strip() for p in parts if str(p).strip()] or None


def scored(df: DataFrame, split: str | None = None, score: str = K.SCORE) -> DataFrame:
    """Rows of one split whose score is present."""
    out = df.filter(F.col(score).isNotNull())
    return out if split is None else out.filter(F.col(K.SPLIT) == split)


def by_ids(df: DataFrame, ids: DataFrame, key: str = K.ID) -> DataFrame:
    return df.join(ids.select(key), key, "left_semi")


def modulus_sample(df: DataFrame, divisor: int, key: str = K.ID) -> DataFrame:
    """Deterministic key-modulus sample (a sampling operator of its own)."""
    return df.filter(F.col(key) % divisor == 0)


def select_columns(
    df: DataFrame, wanted: Values, default: Sequence[str], key: str = K.ID, limit: int = K.MAX_SELECTED_COLUMNS
) -> DataFrame:
    """Validated projection: unknown names are refused, the key always comes along."""
    names = split_values(wanted)
    if names is None:
        return df.select(*[c for c in default if c in df.columns])
    if len(names) > limit:
        raise ValueError(f"at most {limit} columns, {len(names)} were asked for")
    unknown = [n for n in names if n not in df.columns]
    if unknown:
        raise ValueError(f"unknown columns: {', '.join(unknown)}")
    return df.select(*([] if key in names else [key]), *names)
