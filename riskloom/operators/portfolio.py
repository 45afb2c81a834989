"""Portfolio statistics over the client table: one scan and one small shuffle each."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.functions import columns as C
from riskloom.functions import constants as K
from riskloom.operators import positions, ranking, selection

def whole():
    """One frame over a result that is already bounded."""
    return Window.partitionBy()


def approval(score: str, threshold: float) -> Column:
    """Aggregate: share below the threshold among the scored rows."""
    return F.avg(F.when(F.col(score) < threshold, 1.0).when(F.col(score).isNotNull(), 0.0))


def defaults(target: str = K.TARGET) -> Column:
    return F.count_if(F.col(target) == 1)


def overview(df: DataFrame, threshold: float, score: str = K.SCORE) -> DataFrame:
    """Key figures of the (filtered) portfolio in one row."""
    middle = ranking.quantile_table(df, "AMT_INCOME_TOTAL", [0.5]).select(F.col("q")[0])
    row = df.agg(
        F.count(F.lit(1)).alias("n_clients"),
        defaults().alias("n_defaults"),
        F.coalesce(F.avg(K.TARGET), F.lit(0.0)).alias("default_rate"),
        F.coalesce(C.share(F.col("BUREAU_COUNT").isNull()), F.lit(0.0)).alias("thin_file_rate"),
        F.avg("AGE_YEARS").alias("avg_age"),
        F.avg("AMT_CREDIT").alias("avg_credit"),
        F.avg("CREDIT_INCOME_RATIO").alias("avg_credit_income_ratio"),
        F.coalesce(C.share(F.col("EXT_SOURCE_1").isNull()), F.lit(0.0)).alias("missing_ext_source_1_rate"),
        F.coalesce(C.share(F.col("EXT_SOURCE_3").isNull()), F.lit(0.0)).alias("missing_ext_source_3_rate"),
        F.count(score).alias("scored"),
        F.avg(score).alias("avg_score"),
        approval(score, threshold).alias("approval_rate"),
    )
    return row.withColumns({"median_income": middle.scalar(), "threshold": F.lit(threshold)})


SORT_MODES: Mapping[str, tuple] = {
    "default_rate": (F.desc_nulls_last, "default_rate"),
    "n": (F.desc, "n"),
    "value": (F.asc_nulls_last, "value"),
}


def first_rows(df: DataFrame, n: int | None) -> DataFrame:
    """The first ``n`` rows of a sorted table, or all of them."""
    return df if n is None else df.limit(n)


def default_rate(
    df: DataFrame,
    by: str | Column,
    threshold: float,
    min_count: int = K.MIN_GROUP,
    order_by: str = "default_rate",
    limit: int | None = None,
    score: str = K.SCORE,
) -> DataFrame:
    """Rate, approval and lift per dimension value; lift is against the whole filtered set.

    The overall rate comes from the group counts themselves, so the data is read once.
    """
    expr = C.dimension(by) if isinstance(by, str) else by
    groups = df.groupBy(expr.cast("string").alias("value")).agg(
        F.count(F.lit(1)).alias("n"),
        defaults().alias("defaults"),
        F.count(K.TARGET).alias("_labelled"),
        F.sum(K.TARGET).alias("_target"),
        F.avg(K.TARGET).alias("default_rate"),
        F.avg(score).alias("avg_score"),
        approval(score, threshold).alias("approval_rate"),
    )
    overall = C.safe_div(F.sum("_target").over(whole()), F.sum("_labelled").over(whole()))
    ranked = (
        groups.withColumn("overall_default_rate", overall)
        .withColumn("lift", C.safe_div("default_rate", "overall_default_rate"))
        .filter(F.col("n") >= min_count)
        .drop("_labelled", "_target")
    )
    direction, column = SORT_MODES[order_by]
    return first_rows(ranked.orderBy(direction(column), F.asc_nulls_last("value")), limit)


def is_numeric(df: DataFrame, column: str) -> bool:
    return isinstance(df.schema[column].dataType, T.NumericType)


def categorical_distribution(df: DataFrame, column: str, top: int | None = None, score: str = K.SCORE) -> DataFrame:
    groups = df.groupBy(F.col(column).cast("string").alias("value")).agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(K.TARGET).alias("default_rate"),
        F.avg(score).alias("avg_score"),
    )
    return first_rows(groups.orderBy(F.desc("n"), F.asc_nulls_last("value")), top)


QUARTILES = (0.25, 0.5, 0.75)


def numeric_summaries(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Count, mean, deviation, extremes, exact quartiles and missing share of many columns in two scans.

    Only finite numbers count; the rest is missing. A table without rows gives zero counts and nulls.
    """
    rows, edges = sketched = selection.sketched_columns(df, columns, QUARTILES)
    found = selection.quantiles_of_columns(df, columns, QUARTILES, sketched)
    out = []
    for c in columns:
        r = rows.get(c)
        total, n = (r["n_rows"], r["n"]) if r else (0, 0)
        moments = [r[k] for k in ("avg", "std", "low", "high")] if n else [None] * 4
        out.append((c, total, n, *moments, *(found[c] or [None] * 3), total - n, (total - n) / total if total else 0.0))
    numbers = "mean double, std double, min double, max double, p25 double, p50 double, p75 double"
    return df.sparkSession.createDataFrame(
        out, f"column_name string, n_total long, count long, {numbers}, missing long, missing_rate double")


def numeric_summary(df: DataFrame, column: str) -> DataFrame:
    """The summary of one column."""
    return numeric_summaries(df, [column]).drop("column_name")


def extremes(df: DataFrame, column: str) -> tuple[float, float] | None:
    low, high = df.agg(F.min(F.col(column).cast("double")), F.max(F.col(column).cast("double"))).first()
    return None if low is None else (low, high)


def equal_width_bin(column: str, low: float, high: float, bins: int) -> Column:
    width = (high - low) / bins
    index = F.floor((F.col(column).cast("double") - F.lit(low)) / F.lit(width)).cast("int")
    return F.greatest(F.least(index, F.lit(bins - 1)), F.lit(0))


def histogram(df: DataFrame, column: str, bins: int = 20, target: str = K.TARGET) -> DataFrame:
    """Equal-width bins; the maximum falls in the last one. Constant columns give no rows."""
    found = extremes(df, column)
    schema_only = df.filter(F.col(column).isNotNull())
    low, high = found if found else (0.0, 0.0)
    if low == high:
        schema_only, high = schema_only.filter(F.lit(False)), low + 1.0
    width = (high - low) / bins
    counted = schema_only.groupBy(equal_width_bin(column, low, high, bins).alias("bin")).agg(
        F.count(F.lit(1)).alias("n"), F.avg(target).alias("default_rate")
    )
    return counted.select(
        "bin",
        (F.lit(low) + F.col("bin") * F.lit(width)).alias("lower"),
        (F.lit(low) + (F.col("bin") + 1) * F.lit(width)).alias("upper"),
        "n",
        (F.col("n") / F.sum("n").over(whole())).alias("pct"),
        "default_rate",
    )


def density_by_class(df: DataFrame, column: str, bins: int = 20, target: str = K.TARGET) -> DataFrame:
    """Histogram density of a column inside each class: share of the class over bin width."""
    found = extremes(df, column)
    low, high = found if found and found[0] < found[1] else (0.0, 1.0)
    width = (high - low) / bins
    inside = Window.partitionBy(target)
    return (
        df.filter(F.col(column).isNotNull())
        .groupBy(target, equal_width_bin(column, low, high, bins).alias("bin"))
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("density", F.col("n") / F.sum("n").over(inside) / F.lit(width))
    )


def crosstab(
    df: DataFrame,
    rows: str,
    cols: str,
    metric: str = "default_rate",
    min_count: int = K.MIN_GROUP,
) -> DataFrame:
    """Two dimensions, count or rate per cell, small cells left out."""
    if rows == cols:
        raise ValueError("rows and cols must be different dimensions")
    cells = (
        df.groupBy(
            C.dimension(rows).cast("string").alias("row_value"),
            C.dimension(cols).cast("string").alias("col_value"),
        )
        .agg(F.count(F.lit(1)).alias("n"), F.avg(K.TARGET).alias("default_rate"))
        .filter(F.col("n") >= min_count)
    )
    value = F.col("n").cast("double") if metric == "count" else F.col("default_rate")
    return cells.withColumn("value", value)


def crosstab_labels(cells: DataFrame) -> DataFrame:
    """Total and sorted row and column labels of a cross table (bounded by its dimensions)."""
    return cells.agg(
        F.sum("n").alias("n_total"),
        F.sort_array(F.collect_set("row_value")).alias("row_values"),
        F.sort_array(F.collect_set("col_value")).alias("col_values"),
    )


def column_profile(df: DataFrame, chunk: int = 150) -> DataFrame:
    """Type, extremes, approximate distinct count, moments, approximate quartiles and null share per column.

    Columns go in chunks so the aggregate stays compilable; each pass reads only its columns.
    """
    kinds = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    parts = []
    names = [f.name for f in df.schema.fields if not isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType))]
    for start in range(0, len(names), chunk):
        some = names[start : start + chunk]
        aggs, rows = [F.count(F.lit(1)).alias("_n")], []
        for i, c in enumerate(some):
            aggs += [
                F.min(c).cast("string").alias(f"_lo{i}"),
                F.max(c).cast("string").alias(f"_hi{i}"),
                F.approx_count_distinct(c).alias(f"_u{i}"),
                F.count_if(F.col(c).isNull()).alias(f"_m{i}"),
            ]
            extra = ", ".join(["CAST(NULL AS DOUBLE)"] * 5)
            if is_numeric(df, c):
                x = F.col(c).cast("double")
                aggs += [
                    F.avg(x).alias(f"_a{i}"),
                    F.stddev_samp(x).alias(f"_s{i}"),
                    F.percentile_approx(x, [0.25, 0.5, 0.75], 1000).alias(f"_q{i}"),
                ]
                extra = f"_a{i}, _s{i}, get(_q{i}, 0), get(_q{i}, 1), get(_q{i}, 2)"
            rows.append(f"'{c}', '{kinds[c]}', _lo{i}, _hi{i}, _u{i}, {extra}, _m{i}, _n")
        parts.append(
            df.select(*some).agg(*aggs).selectExpr(
                f"stack({len(some)}, {', '.join(rows)}) AS "
                "(column_name, column_type, min_value, max_value, approx_unique, avg, std, q25, q50, q75, n_null, n_rows)"
            )
        )
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out.withColumn("null_rate", C.div_or_zero("n_null", "n_rows"))


def missing_report(
    profile: DataFrame, top: int | None = None, prefix: str | None = None, min_rate: float = 0.0
) -> DataFrame:
    """Columns by falling null share, from a stored profile."""
    kept = profile.filter(F.col("null_rate") >= min_rate)
    if prefix:
        kept = kept.filter(F.col("column_name").startswith(prefix))
    kept = kept.withColumn(
        "columns_with_missing", F.count_if(F.col("null_rate") > 0).over(whole())
    )
    return first_rows(kept.orderBy(F.desc("null_rate"), "column_name"), top)


def granularity(df: DataFrame, key: str = K.ID) -> DataFrame:
    """Rows, distinct keys and whether there is one row per key."""
    per_key = df.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    return per_key.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("n_rows"),
        F.count(key).alias("n_keys"),
    ).withColumn("one_row_per_key", F.col("n_rows") == F.col("n_keys"))


def value_shares(df: DataFrame, column: str) -> DataFrame:
    """Count and share of every non-null value (any number of values)."""
    counts = (
        df.filter(F.col(column).isNotNull())
        .groupBy(F.col(column).cast("string").alias("value"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return counts.withColumn("share", F.col("n") / counts.agg(F.sum("n")).scalar())


def group_means(df: DataFrame, by: str, value: str = K.TARGET) -> DataFrame:
    return df.groupBy(by).agg(F.avg(value).alias("mean"), F.count(F.lit(1)).alias("n")).orderBy(F.desc("mean"), by)


def target_correlations(df: DataFrame, columns: Sequence[str], target: str = K.TARGET) -> DataFrame:
    """Pairwise non-null correlation with the target and the null share, one pass."""
    aggs, rows = [], []
    for i, c in enumerate(columns):
        x = F.col(c).cast("double")
        y = F.when(x.isNotNull(), F.col(target).cast("double"))
        aggs += [F.corr(x, y).alias(f"_c{i}"), C.share(x.isNull()).alias(f"_m{i}")]
        rows.append(f"'{c}', _c{i}, _m{i}")
    return df.agg(*aggs).selectExpr(
        f"stack({len(columns)}, {', '.join(rows)}) AS (column_name, correlation, null_rate)"
    )


def decision_distribution(df: DataFrame, threshold: float, base: float = K.DEFAULT_BAND, score: str = K.SCORE) -> DataFrame:
    """Approve / review / deny counts and shares among the scored clients."""
    decided = df.filter(F.col(score).isNotNull()).select(C.decide(score, threshold, base).alias("decision"))
    return (
        decided.groupBy("decision")
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("pct", F.col("n") / F.sum("n").over(whole()))
    )


def score_percentiles(df: DataFrame, key: str = K.ID, score: str = K.SCORE) -> DataFrame:
    """Each scored client with the share of the portfolio at or below its score."""
    per_value = ranking.share_at_or_below(df, score)
    return df.filter(F.col(score).isNotNull()).select(key, score).join(per_value, score)


def importance_ranking(features: DataFrame, name: str = "feature", value: str = "importance") -> DataFrame:
    """Features by falling importance with share, rank and origin table (one row per feature)."""
    return features.select(
        F.col(name).alias("feature"),
        F.col(value).alias("importance"),
        C.div_or_zero(F.col(value), F.sum(value).over(whole())).alias("importance_pct"),
        C.origin_table(name).alias("source_table"),
        F.row_number().over(Window.orderBy(F.desc(value), F.asc(name))).alias("rank"),
    )


def importance_by_source(ranking_table: DataFrame) -> DataFrame:
    return ranking_table.groupBy("source_table").agg(
        F.sum("importance_pct").alias("importance_pct"), F.count(F.lit(1)).alias("n_features")
    )


def page(
    df: DataFrame, number: int, size: int, sort: str, ascending: bool = True, key: str = K.ID
) -> DataFrame:
    """One page of a listing sorted by a column of any type, nulls last, the key as tie-break.

    The key of the page's first row is found by position, then the first ``size`` rows from there on are taken, so the
    cost does not grow with the depth. A page beyond the last row is empty.
    """
    if sort not in df.columns:
        raise ValueError(f"unknown column {sort!r}")
    columns, ups = ([sort], [ascending]) if sort == key else ([sort, key], [ascending, True])
    keys = [(F.asc_nulls_last if up else F.desc_nulls_last)(c) for c, up in zip(columns, ups)]
    skipped = (number - 1) * size
    if skipped == 0:
        return df.orderBy(*keys).limit(size)
    first = positions.key_at(df, columns, skipped, ups)
    if first is None:
        return df.limit(0)
    rest = df.filter(positions.at_or_after(df, columns, first, ups)).orderBy(*keys)
    # rows that share the whole key with the first one can lie on the page before
    return rest.offset(skipped - first.before).limit(size)


def page_meta(df: DataFrame, number: int, size: int) -> DataFrame:
    pages = F.ceil(F.col("total") / F.lit(size))
    return df.agg(F.count(F.lit(1)).alias("total")).withColumns(
        {
            "page": F.lit(number),
            "page_size": F.lit(size),
            "total_pages": pages,
            "has_next": F.lit(number) < pages,
            "has_prev": F.lit(number > 1),
        }
    )


def client_sheet(df: DataFrame, threshold: float, width: Column | float = 0.0, everything: bool = False) -> DataFrame:
    """Client sheets as nested blocks, for any number of clients at once."""
    have = set(df.columns)
    out = [F.col(K.ID), F.col("BUREAU_COUNT").isNull().alias("thin_file")]
    for block, names in K.SHEET_BLOCKS.items():
        cols = [F.col(c) for c in names if c in have]
        if block == "scores_externos":
            n = sum((c.isNotNull().cast("int") for c in cols), F.lit(0))
            cols.append(n.alias("n_disponiveis"))
        out.append(F.struct(*cols).alias(block))
    out.append(
        F.when(
            F.col(K.SCORE).isNotNull(),
            F.struct(
                F.col(K.SCORE).alias("probability_default"),
                F.lit(threshold).alias("threshold"),
                C.decide(K.SCORE, threshold, width).alias("decision"),
                C.score_band(K.SCORE).alias("score_band"),
                F.col(K.TARGET).alias("target"),
                F.col(K.BASELINE_SCORE).alias("baseline_probability"),
            ),
        ).alias("score")
    )
    if everything:
        hidden = {K.ID, K.TARGET, K.SPLIT, "y_true", K.SCORE, K.BASELINE_SCORE}
        out.append(F.struct(*[F.col(c) for c in df.columns if c not in hidden]).alias("features"))
    return df.select(*out)


def dimension_catalogue(spark) -> DataFrame:
    rows = list(K.DIMENSION_LABELS.items())
    return spark.createDataFrame(rows, "dimension string, label string")
