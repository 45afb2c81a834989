"""Column expressions; everything here stays inside whole-stage code generation."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from riskloom.functions import constants as K

Name = str | Column


def col(c: Name) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_div(num: Name, den: Name) -> Column:
    """Quotient as double; null when the denominator is zero or null."""
    return F.try_divide(col(num).cast("double"), col(den).cast("double"))


def div_or_zero(num: Name, den: Name) -> Column:
    return F.coalesce(safe_div(num, den), F.lit(0.0))


def share(condition: Column) -> Column:
    """Aggregate: share of rows where the condition holds (null counts as no)."""
    return F.avg(F.when(condition, 1.0).otherwise(0.0))


def finite(c: Name) -> Column:
    """NaN and infinities become null."""
    x = col(c).cast("double")
    return F.when(~F.isnan(x) & (F.abs(x) < float("inf")), x)


def null_if_value(c: Name, value) -> Column:
    return F.nullif(col(c), F.lit(value))


def upper_cap(c: Name, cap: Name | float) -> Column:
    """Clip the upper tail; nulls stay null (a bare ``least`` would skip them)."""
    limit = F.lit(cap) if isinstance(cap, (int, float)) else col(cap)
    return F.when(col(c).isNotNull(), F.least(col(c), limit))


def days_to_years(c: Name) -> Column:
    """Negative relative days to positive years, one decimal, half to even, no minus zero."""
    return F.bround(-col(c).cast("double") / K.DAYS_PER_YEAR, 1) + F.lit(0.0)


def clean_name(name: str) -> str:
    """Upper-case identifier of letters, digits and single underscores."""
    squeezed = re.sub("_+", "_", re.sub("[^0-9A-Za-z_]+", "_", str(name).strip().upper()))
    return squeezed.strip("_")


def clean_name_column(c: Name) -> Column:
    """The same rule as :func:`clean_name` over a column of names."""
    replaced = F.regexp_replace(F.upper(F.trim(col(c))), "[^0-9A-Za-z_]+", "_")
    return F.regexp_replace(F.regexp_replace(replaced, "_+", "_"), "^_|_$", "")


# ---------------------------------------------------------------- bands


def band(c: Name, bands: tuple, missing: str = K.UNKNOWN) -> Column:
    """Label by ascending exclusive upper limits."""
    limits, top = bands
    x = col(c)
    out = F.when(x.isNull(), F.lit(missing))
    for limit, label in limits:
        out = out.when(x < F.lit(limit), F.lit(label))
    return out.otherwise(F.lit(top))


def age_band(c: Name = "AGE_YEARS") -> Column:
    return band(c, K.AGE_BANDS)


def score_band(c: Name = K.SCORE, missing: str = K.NO_SCORE) -> Column:
    return band(c, K.SCORE_BANDS, missing)


def thin_file(c: Name = "BUREAU_COUNT") -> Column:
    return F.when(col(c).isNull(), F.lit(K.THIN_FILE)).otherwise(F.lit(K.WITH_HISTORY))


def five_year_window(c: Name) -> Column:
    low = (F.floor(col(c) / 5) * 5).cast("int")
    return F.when(low.isNotNull(), F.concat(low.cast("string"), F.lit("-"), (low + 5).cast("string")))


DERIVED_DIMENSIONS = {
    "target": lambda: F.col(K.TARGET).cast("string"),
    "children": lambda: upper_cap("CNT_CHILDREN", K.MAX_CHILDREN).cast("int").cast("string"),
    "age_band": lambda: age_band(),
    "income_band": lambda: band("AMT_INCOME_TOTAL", K.INCOME_BANDS),
    "credit_band": lambda: band("AMT_CREDIT", K.CREDIT_BANDS),
    "score_band": lambda: score_band(),
    "thin_file": lambda: thin_file(),
}


def dimension(by: str) -> Column:
    """One of the named grouping dimensions of the client table."""
    if by in K.PLAIN_DIMENSIONS:
        return F.col(K.PLAIN_DIMENSIONS[by])
    if by in DERIVED_DIMENSIONS:
        return DERIVED_DIMENSIONS[by]()
    raise ValueError(f"unknown dimension {by!r}; known: {', '.join(sorted(K.DIMENSION_LABELS))}")


def dimensions() -> dict[str, Column]:
    return {by: dimension(by) for by in K.DIMENSION_LABELS}


def origin_table(c: Name) -> Column:
    """Origin of a feature name by its longest known prefix."""
    out = None
    for prefix, source in K.SOURCE_PREFIXES:
        hit = col(c).startswith(prefix)
        out = F.when(hit, F.lit(source)) if out is None else out.when(hit, F.lit(source))
    return out.otherwise(F.lit(K.DEFAULT_SOURCE))


# ---------------------------------------------------------------- decisions


def decide(p: Name, threshold: float, width: Name | float = 0.0) -> Column:
    """Approve below the threshold, deny at or above it; a positive band adds a review zone."""
    x = col(p)
    half = (F.lit(float(width)) if isinstance(width, (int, float)) else col(width)) / 2
    return F.when(x.isNull(), F.lit(None).cast("string")).otherwise(
        F.when(
            half <= 0,
            F.when(x >= threshold, F.lit(K.DENY)).otherwise(F.lit(K.APPROVE)),
        )
        .when(x < F.lit(threshold) - half, F.lit(K.APPROVE))
        .when(x >= F.lit(threshold) + half, F.lit(K.DENY))
        .otherwise(F.lit(K.REVIEW))
    )


def band_width(weak: Mapping[str, Sequence[str]], base: float = K.DEFAULT_BAND) -> Column:
    """Grey-band width: doubled when a client's age band or thin-file state is a weak segment."""
    labels = {"age_band": F.when(F.col("AGE_YEARS").isNotNull(), age_band()), "thin_file": thin_file()}
    hits = [labels[d].isin(list(v)) for d, v in weak.items() if d in labels and v]
    wide = reduce(lambda a, b: a | b, [F.coalesce(h, F.lit(False)) for h in hits], F.lit(False))
    return F.when(wide, F.lit(base * K.LOW_CONFIDENCE_FACTOR)).otherwise(F.lit(float(base)))


# ---------------------------------------------------------------- hashing

# Modulus of the integer mix and size of the md5 prefix.
MIX_PRIME = 2147483647
HASH_RANGE = 4294967296


def hash_unit(*parts: Name, seed: int = 42) -> Column:
    """Reproducible uniform in [0, 1) from md5 of the joined parts and a seed."""
    text = F.concat_ws("|", *[col(p).cast("string") for p in parts], F.lit(str(seed)))
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long") / F.lit(float(HASH_RANGE))


def hash_key(*parts: Name) -> Column:
    """Reproducible key in [0, MIX_PRIME) from md5 of the joined parts."""
    text = F.concat_ws("|", *[col(p).cast("string") for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long") % F.lit(MIX_PRIME)
