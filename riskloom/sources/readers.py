"""Sources: CSV, Parquet and JSON scans, optional inputs, catalogues and input checks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.operators.cleaning import nan_to_null


class SourceError(FileNotFoundError):
    """One or more inputs are missing or too small; the message lists them all."""


def read_csv(spark: SparkSession, path: str | Sequence[str], schema: T.StructType | str | None = None) -> DataFrame:
    """CSV with a header. With a schema nothing is inferred; without, the whole file decides types."""
    reader = spark.read.option("header", True).option("nullValue", "").option("nanValue", "NaN")
    reader = reader.option("escape", '"').option("multiLine", False)
    if schema is not None:
        return nan_to_null(reader.schema(schema).csv(path))
    return nan_to_null(reader.option("inferSchema", True).option("samplingRatio", 1.0).csv(path))


def read_parquet(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Parquet scan; with ``columns``, only those that exist reach the scan."""
    df = spark.read.parquet(path)
    return df if columns is None else df.select(*[c for c in dict.fromkeys(columns) if c in df.columns])


def register_view(df: DataFrame, name: str) -> DataFrame:
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether the path (any file system Spark can reach) exists."""
    from pyspark.errors import AnalysisException

    try:
        spark.read.format("binaryFile").load(path).limit(0).collect()
        return True
    except AnalysisException:
        return False


def read_preferred(
    spark: SparkSession, parquet: str, csv: str, schema: T.StructType | str | None = None
) -> DataFrame:
    """Parquet when it exists, the CSV otherwise."""
    return read_parquet(spark, parquet) if path_exists(spark, parquet) else read_csv(spark, csv, schema)


def with_optional(df: DataFrame, extra: DataFrame | None, key: str, columns: Mapping[str, str]) -> DataFrame:
    """Left-join an optional table, or add its columns as typed nulls when it is missing."""
    if extra is None:
        return df.withColumns({c: F.lit(None).cast(kind) for c, kind in columns.items()})
    return df.join(extra.select(key, *columns), key, "left")


def read_json(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """JSON records under a fixed schema; corrupt lines are kept aside, a missing path is empty."""
    shaped = schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)
    full = T.StructType([*shaped.fields, T.StructField("_corrupt", T.StringType())])
    if not path_exists(spark, path):
        return spark.createDataFrame([], full)
    return spark.read.schema(full).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt").json(path)


def column_catalogue(
    df: DataFrame, profile: DataFrame | None = None, search: str | None = None, prefix: str | None = None,
    limit: int | None = None,
) -> DataFrame:
    """Name and type of every column, optionally with its stored profile, searched and cut."""
    rows = [(i, f.name, f.dataType.simpleString()) for i, f in enumerate(df.schema.fields)]
    if search:
        rows = [r for r in rows if search.lower() in r[1].lower()]
    if prefix:
        rows = [r for r in rows if r[1].startswith(prefix)]
    rows = rows[:limit] if limit else rows
    out = df.sparkSession.createDataFrame(rows, "position int, name string, type string")
    if profile is None:
        return out
    known = profile.select(F.col("column_name").alias("name"), F.col("null_rate").alias("missing_rate"), "approx_unique")
    return out.join(known, "name", "left")


def input_sizes(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """Files and total bytes below every path, from the listing (contents are not read)."""
    parts = None
    for path in paths:
        if path_exists(spark, path):
            listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("length")
            part = listed.agg(F.count(F.lit(1)).alias("n_files"), F.coalesce(F.sum("length"), F.lit(0)).alias("bytes"))
        else:
            part = spark.createDataFrame([(0, 0)], "n_files long, bytes long")
        part = part.select(F.lit(path).alias("path"), "n_files", "bytes")
        parts = part if parts is None else parts.unionByName(part)
    return parts


def check_inputs(spark: SparkSession, paths: Sequence[str], min_bytes: int = 1_000_000) -> DataFrame:
    """Raise when any input is absent or below the minimum size; else return the sizes."""
    sizes = input_sizes(spark, paths)
    bad = [f"{r['path']} ({r['bytes']} bytes)" for r in sizes.filter(F.col("bytes") < min_bytes).collect()]
    if bad:
        raise SourceError("missing or too small: " + "; ".join(bad))
    return sizes


def read_client_batch(spark: SparkSession, path: str, expected: Sequence[str]) -> DataFrame:
    """A CSV of clients as text columns; refused when no header matches a model column."""
    df = spark.read.option("header", True).option("escape", '"').csv(path)
    if not set(df.columns) & set(expected):
        raise ValueError(f"no column of {path} is a model column")
    return df
