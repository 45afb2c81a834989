"""Helpers shared by the operators: staged tables, batch limits and seeded column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.session import scratch_path, ship_package

#: ASCII white space, the separator class of every text operator here.
SPACES = " \t\n\x0b\x0c\r"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write a reduced table to the cluster's shared folder and read it back.

    Later jobs start from the files, so a lost executor costs one task and not the steps before it.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def python_ready(spark: SparkSession, rows: int = 256) -> None:
    """Give workers the package, and hold Arrow batches to a few hundred rows, so one batch of texts fits a worker."""
    ship_package(spark)
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(spark.conf.get(key))
    if now <= 0 or now > rows:
        spark.conf.set(key, str(rows))


def fresh(df: DataFrame, name: str) -> str:
    """A column name that `df` does not use yet."""
    used = {c.lower() for c in df.columns}
    while name.lower() in used:
        name += "_"
    return name


def matching_rows(documents: DataFrame, keys: DataFrame, **columns: Column) -> DataFrame:
    """The rows of `documents`, with all their columns, whose values are among the rows of `keys`.

    columns: for each column of `keys`, the expression over `documents` that it is compared with; nulls are equal.
    """
    names = {k: fresh(documents, f"_{k}") for k in columns}
    wanted = keys.select(*(F.col(k).alias(n) for k, n in names.items())).distinct()
    on = [columns[k].eqNullSafe(F.col(n)) for k, n in names.items()]
    return documents.join(wanted, on, "left_semi")


def ascii_lower(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def fold(doc_id: Column, parts: int) -> Column:
    """crc32 of the id as text, modulo parts; null for a null id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % parts


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
