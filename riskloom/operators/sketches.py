"""Column profiles that merge without the rows: counts, moments, distinct sketch and quantile sketch per part.

A part is a group of input tasks, a file or any other key. One row per (part, column) is stored; the profile of a table
that grew is the merge of the stored parts and those of the new files.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.functions import columns as C

# tasks whose partial results meet before the last merge, so that no task holds one sketch per input task
PARTS = 64
COLUMNS_PER_PASS = 150
# relative standard error of distinct counts: 1.04 / sqrt(2 ** DISTINCT_BITS); rank error of quantiles: about RANK_ERROR
DISTINCT_BITS, QUANTILE_SIZE = 12, 1600
RANK_ERROR = 0.003
PART_SCHEMA = (
    "part string, column_name string, column_type string, n_rows long, n_null long, n long, mean double, m2 double, "
    "low double, high double, low_text string, high_text string, distinct_sketch binary, quantile_sketch binary"
)


def plain_columns(df: DataFrame) -> list[T.StructField]:
    nested = (T.ArrayType, T.MapType, T.StructType, T.VariantType)
    return [f for f in df.schema.fields if not isinstance(f.dataType, nested)]


def profile_parts(df: DataFrame, part: Column | None = None, columns: Sequence[str] | None = None) -> DataFrame:
    """One row per (part, column) of ``PART_SCHEMA``; non-finite numbers count as rows with a value but have no moments.

    An empty table has no parts. Without ``part`` the input tasks are dealt to ``PARTS`` groups.
    """
    key = F.pmod(F.spark_partition_id(), F.lit(PARTS)) if part is None else part
    fields = [f for f in plain_columns(df) if columns is None or f.name in columns]
    out = None
    for start in range(0, len(fields), COLUMNS_PER_PASS):
        some = fields[start : start + COLUMNS_PER_PASS]
        aggs, rows = [F.count(F.lit(1)).alias("_n")], []
        shaped = [key.cast("string").alias("part")]
        for i, f in enumerate(some):
            c = C.col(f"`{f.name}`")
            number = isinstance(f.dataType, T.NumericType)
            shaped += [c.alias(f"_v{i}"), C.finite(c).alias(f"_x{i}")] if number else [c.alias(f"_v{i}")]
            text = F.col(f"_v{i}").cast("string")
            aggs += [F.count(f"_v{i}").alias(f"_c{i}"), F.hll_sketch_agg(text, DISTINCT_BITS).alias(f"_h{i}")]
            if number:
                x = f"_x{i}"
                aggs += [
                    F.count(x).alias(f"_k{i}"), F.avg(x).alias(f"_a{i}"), (F.var_pop(x) * F.count(x)).alias(f"_s{i}"),
                    F.min(x).alias(f"_l{i}"), F.max(x).alias(f"_u{i}"),
                    F.kll_sketch_agg_double(x, QUANTILE_SIZE).alias(f"_q{i}"),
                ]
                numbers = f"_k{i}, _a{i}, _s{i}, _l{i}, _u{i}, CAST(NULL AS STRING), CAST(NULL AS STRING)"
                sketch = f"_q{i}"
            else:
                aggs += [F.min(text).alias(f"_l{i}"), F.max(text).alias(f"_u{i}")]
                null = "CAST(NULL AS DOUBLE)"
                numbers, sketch = f"0L, {null}, {null}, {null}, {null}, _l{i}, _u{i}", "CAST(NULL AS BINARY)"
            name = f.name.replace("\\", "\\\\").replace("'", "\\'")
            rows.append(f"'{name}', '{f.dataType.simpleString()}', _n, _n - _c{i}, {numbers}, _h{i}, {sketch}")
        names = ", ".join(n.split()[0] for n in PART_SCHEMA.split(", ")[1:])
        found = df.select(*shaped).groupBy("part").agg(*aggs).selectExpr(
            "part", f"stack({len(some)}, {', '.join(rows)}) AS ({names})")
        out = found if out is None else out.unionByName(found)
    return df.sparkSession.createDataFrame([], PART_SCHEMA) if out is None else out


def append_profile(df: DataFrame, path: str, part: Column | None = None) -> str:
    """Store the parts of new rows beside those stored before; the older rows are not read."""
    profile_parts(df, part).write.mode("append").option("compression", "zstd").parquet(path)
    return path


def stored_profile(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(PART_SCHEMA).parquet(path)


def merged_profile(parts: DataFrame, probs: Sequence[float] = (0.25, 0.5, 0.75)) -> DataFrame:
    """One row per column from any number of parts: counts, moments, extremes, distinct count and quantiles.

    Counts, moments and extremes are exact; ``approx_unique`` and ``q`` carry the error of their sketches.
    """
    centre = parts.groupBy("column_name").agg(C.safe_div(F.sum(F.col("n") * F.col("mean")), F.sum("n")).alias("avg"))
    apart = F.col("mean") - F.col("avg")
    merged = parts.join(centre, "column_name").groupBy("column_name").agg(
        F.max("column_type").alias("column_type"), F.sum("n_rows").alias("n_rows"), F.sum("n_null").alias("n_null"),
        F.sum("n").alias("n"), F.first("avg").alias("avg"),
        F.sum(F.col("m2") + F.col("n") * apart * apart).alias("_m2"),
        F.min("low").alias("low"), F.max("high").alias("high"),
        F.min("low_text").alias("low_text"), F.max("high_text").alias("high_text"),
        F.hll_sketch_estimate(F.hll_union_agg("distinct_sketch")).alias("approx_unique"),
        F.kll_merge_agg_double("quantile_sketch").alias("_q"),
    )
    levels = F.array(*[F.lit(float(p)) for p in probs])
    return merged.select(
        "column_name", "column_type", "n_rows", "n_null", C.div_or_zero("n_null", "n_rows").alias("null_rate"), "n", "avg",
        F.when(F.col("n") > 1, F.sqrt(F.col("_m2") / (F.col("n") - 1))).alias("std"),
        "low", "high", "low_text", "high_text", "approx_unique",
        F.when(F.col("n") > 0, F.kll_sketch_get_quantile_double("_q", levels)).alias("q"),
    )
