"""Sinks: CSV, Parquet, JSON, verified conversion, score snapshots and run-tagged outputs."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.functions import columns as C
from riskloom.functions import constants as K
from riskloom.operators import features, gates, learning, portfolio
from riskloom.operators.learning import Bundle
from riskloom.sources import publication, readers


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists") -> str:
    df.write.mode(mode).option("header", True).option("escape", '"').csv(path)
    return path


def write_parquet(df: DataFrame, path: str, mode: str = "errorifexists", partition_by: tuple[str, ...] = ()) -> str:
    """Parquet with ZSTD."""
    writer = df.write.mode(mode).option("compression", "zstd")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
    return path


def write_json(df: DataFrame, path: str, mode: str = "errorifexists") -> str:
    df.write.mode(mode).json(path)
    return path


def fingerprint(df: DataFrame, key: str, target: str) -> DataFrame:
    """Rows, columns, target sum and key uniqueness as one row."""
    per_key = df.groupBy(key).agg(F.count(F.lit(1)).alias("_n"), F.sum(target).alias("_t"))
    return per_key.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("n_rows"),
        F.lit(len(df.columns)).alias("n_columns"),
        F.sum("_t").alias("target_sum"),
        F.coalesce(F.max("_n") == 1, F.lit(True)).alias("key_unique"),
    )


def conversion_checks(source: DataFrame, written: DataFrame, key: str = K.ID, target: str = K.TARGET) -> DataFrame:
    """Source against written table: one aggregate per side, compared as rows (check, ok)."""
    a = fingerprint(source, key, target).select(F.struct("*").alias("a"))
    b = fingerprint(written, key, target).select(F.struct("*").alias("b"))
    sides = a.withColumn("b", b.scalar())
    same = [
        F.struct(
            F.lit(name).alias("check"), F.col(f"a.{name}").cast("string").alias("source"),
            F.col(f"b.{name}").cast("string").alias("written"),
            F.col(f"a.{name}").eqNullSafe(F.col(f"b.{name}")).alias("ok"),
        )
        for name in ("n_rows", "n_columns", "target_sum")
    ]
    unique = F.struct(
        F.lit("key_unique").alias("check"), F.col("a.key_unique").cast("string").alias("source"),
        F.col("b.key_unique").cast("string").alias("written"), F.col("b.key_unique").alias("ok"),
    )
    return sides.select(F.explode(F.array(*same, unique)).alias("c")).select("c.*")


def written_checks(seen: Mapping, n_columns: int, written: DataFrame, key: str = K.ID, target: str = K.TARGET) -> DataFrame:
    """Facts seen while writing against the written table, as rows (check, source, written, ok)."""
    facts = fingerprint(written, key, target)
    kinds = {f.name: f.dataType for f in facts.schema.fields}
    known = {"n_rows": seen["rows"], "n_columns": n_columns, "target_sum": seen["target_sum"]}
    same = []
    for name, value in known.items():
        expected = F.lit(value).cast(kinds[name])
        same.append(F.struct(
            F.lit(name).alias("check"), expected.cast("string").alias("source"), F.col(name).cast("string").alias("written"),
            expected.eqNullSafe(F.col(name)).alias("ok")))
    # a key that repeats in the source repeats in the copy
    unique = F.col("key_unique").cast("string")
    same.append(F.struct(
        F.lit("key_unique").alias("check"), unique.alias("source"), unique.alias("written"), F.col("key_unique").alias("ok")))
    return facts.select(F.explode(F.array(*same)).alias("c")).select("c.*")


def convert_csv(
    spark: SparkSession, csv: str, parquet: str, key: str = K.ID, target: str = K.TARGET, schema=None,
    profile_path: str | None = None,
) -> DataFrame:
    """CSV to ZSTD Parquet; raises when any check fails. Optional profile.

    The facts of the source are taken by the writing job, so the CSV rows are read once for them and the copy.
    """
    source = readers.read_csv(spark, csv, schema)
    seen = publication.write_observed(source, parquet, F.sum(target).alias("target_sum"))
    written = readers.read_parquet(spark, parquet)
    if schema is None and written.schema.names != source.schema.names:
        raise gates.GateError(f"conversion of {csv} differs in columns")
    checks = written_checks(seen, len(source.columns), written, key, target)
    failed = [r["check"] for r in checks.filter(~F.col("ok")).collect()]
    if failed:
        raise gates.GateError(f"conversion of {csv} differs in {', '.join(failed)}")
    if written.agg(*publication.content(written)).first()["checksum"] != seen["checksum"]:
        raise gates.GateError(f"conversion of {csv} differs in content")
    if profile_path:
        write_parquet(portfolio.column_profile(written), profile_path)
    return checks


def write_scores(scores: DataFrame, path: str, mode: str = "errorifexists") -> str:
    """Score table, one folder per split."""
    return write_parquet(scores, path, mode, (K.SPLIT,))


def snapshot(scores: DataFrame, path: str, run_id: str) -> str:
    """Keep a run's scores as the next run's reference; every run has its own folder."""
    write_parquet(scores.withColumn("run_id", F.lit(run_id)), path, "append", ("run_id",))
    return path


def previous_snapshot(spark: SparkSession, path: str, run_id: str) -> DataFrame | None:
    """Scores of the newest run before ``run_id``, or None (partition values only are listed)."""
    if not readers.path_exists(spark, path):
        return None
    stored = spark.read.option("basePath", path).schema(spark.read.parquet(path).schema).parquet(path)
    stored = stored.withColumn("run_id", F.col("run_id").cast("string"))
    before = stored.filter(F.col("run_id") < run_id).agg(F.max("run_id")).first()[0]
    return None if before is None else stored.filter(F.col("run_id") == before).drop("run_id")


def run_path(root: str, run_tag: str, sample: bool) -> str:
    """Sample runs live in their own branch and cannot reach the official output."""
    return f"{root.rstrip('/')}/{'demo/' if sample else ''}{run_tag}"


def write_report(tables: Mapping[str, DataFrame], root: str, run_tag: str, sample: bool = False) -> dict[str, str]:
    """All named tables of a run as JSON; an existing run is never overwritten."""
    base = run_path(root, run_tag, sample)
    return {name: write_json(df, f"{base}/{name}") for name, df in tables.items()}


def score_csv(
    spark: SparkSession, source: str, target: str, bundle: Bundle, threshold: float | None = None
) -> DataFrame:
    """Batch file in, the same rows and columns plus probability, decision and score band out."""
    spec = bundle.spec
    batch = readers.read_client_batch(spark, source, learning.input_names(spec))
    scored = score_batch(batch, bundle, threshold)
    write_csv(scored, target)
    return scored


def score_batch(batch: DataFrame, bundle: Bundle, threshold: float | None = None) -> DataFrame:
    """Text columns are kept as they came; numbers are read and derived columns refreshed beside them."""
    spec = bundle.spec
    limit = bundle.threshold if threshold is None else threshold
    kept = F.struct(*[F.col(c) for c in batch.columns]).alias("_in")
    bases = {c for pair in K.RATIOS.values() for c in pair} | set(K.YEARS_FROM_DAYS.values()) | set(K.EXTERNAL_SCORES)
    numbers = [c for c in batch.columns if c in bases or c in spec.numeric]
    shaped = batch.select(
        kept,
        *[F.expr(f"try_cast(`{c}` AS double)").alias(c) for c in numbers],
        *[F.nullif(F.col(c), F.lit("")).alias(c) for c in spec.categorical if c in batch.columns],
    )
    scored = learning.score(features.recompute(shaped, only_present=False), bundle)
    return scored.select(
        "_in.*",
        F.format_string("%.6f", F.col(K.SCORE)).alias("probability_default"),
        C.decide(K.SCORE, limit).alias("decision"),
        C.score_band(K.SCORE).alias("score_band"),
    )
