"""Quality gates (each a table of checks that can also raise) and run history."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.functions import constants as K
from riskloom.operators import portfolio


class GateError(ValueError):
    """A gate failed; the message lists every problem."""


def leaky_columns(names: DataFrame, column: str = "column_name", patterns: Sequence[str] = K.LEAK_PATTERNS) -> DataFrame:
    """Column names that look like the outcome."""
    return names.filter(F.upper(F.col(column)).rlike("|".join(patterns)))


def table_checks(
    df: DataFrame, key: str = K.ID, required: Sequence[str] = (K.ID, K.TARGET),
    min_rows: int = K.MIN_TABLE_ROWS, min_columns: int = K.MIN_TABLE_COLUMNS,
) -> DataFrame:
    """All checks of a feature table as rows (check, ok, detail), with no early stop."""
    spark = df.sparkSession
    schema_rows = [
        ("columns", len(df.columns) >= min_columns, f"{len(df.columns)} of at least {min_columns}")
    ]
    for name in required:
        schema_rows.append((f"has_{name}", name in df.columns, name))
    leaks = [c for c in df.columns if any(p in c.upper() for p in K.LEAK_PATTERNS)]
    schema_rows.append(("no_leaky_names", not leaks, ", ".join(leaks[:5])))
    static = spark.createDataFrame(schema_rows, "check string, ok boolean, detail string")
    if key not in df.columns:
        return static
    counts = portfolio.granularity(df, key)
    rows, keys = F.col("n_rows"), F.col("n_keys")
    live = counts.select(
        F.explode(
            F.array(
                F.struct(F.lit("one_row_per_key").alias("check"), (rows == keys).alias("ok"),
                         F.concat_ws(" ", rows.cast("string"), F.lit("rows,"), keys.cast("string"), F.lit("keys")).alias("detail")),
                F.struct(F.lit("rows").alias("check"), (rows >= min_rows).alias("ok"),
                         F.concat_ws(" ", rows.cast("string"), F.lit(f"of at least {min_rows}")).alias("detail")),
            )
        ).alias("c")
    ).select("c.*")
    return live.unionByName(static)


def enforce(checks: DataFrame) -> list[str]:
    """Raise with every failed check (the check list is a handful of rows)."""
    failed = [f"{r['check']}: {r['detail']}" for r in checks.filter(~F.col("ok")).collect()]
    if failed:
        raise GateError("; ".join(failed))
    return [r["check"] for r in checks.collect()]


def accepted(runs: DataFrame) -> DataFrame:
    """Official accepted runs: not a sample; a missing status counts as accepted."""
    return runs.filter(
        F.col("sample").isNull() & (F.coalesce("status", F.lit(K.ACCEPTED)) == K.ACCEPTED)
    )


def latest(runs: DataFrame, order: str = "trained_at", by: Sequence[str] = ()) -> DataFrame:
    """The newest run (per group): an aggregate, not a sort."""
    newest = F.max_by(F.struct(*[F.col(c) for c in runs.columns]), F.col(order))
    return runs.groupBy(*by).agg(newest.alias("_r")).filter(F.col("_r").isNotNull()).select("_r.*")


def metric_gate(
    runs: DataFrame, run_id: str, metric: str = "auc", tolerance: float = K.MAX_AUC_DROP
) -> DataFrame:
    """Current run against the newest other accepted run: baseline, better, tolerated or regression."""
    other = (
        F.col("sample").isNull()
        & (F.coalesce("status", F.lit(K.ACCEPTED)) == K.ACCEPTED)
        & (F.col("run_id") != run_id)
    )
    pick = F.struct("run_id", F.col(metric).alias("m"))
    row = runs.agg(
        F.max(F.when(F.col("run_id") == run_id, pick)).alias("c"),
        F.max_by(F.when(other, pick), F.when(other, F.col("trained_at"))).alias("r"),
    ).filter(F.col("c").isNotNull())
    delta = F.col("current") - F.col("reference")
    return row.select(
        F.col("c.run_id").alias("run_id"), F.col("c.m").alias("current"),
        F.col("r.run_id").alias("reference_run"), F.col("r.m").alias("reference"),
    ).withColumns(
        {
            "delta": delta,
            "status": F.when(F.col("reference").isNull(), K.STATUS_BASELINE)
            .when(delta < -tolerance, K.STATUS_REGRESSION)
            .when(delta >= 0, K.STATUS_BETTER)
            .otherwise(K.STATUS_TOLERATED),
        }
    )


def enforce_metric(gate: DataFrame) -> str:
    row = gate.first()
    if row["status"] == K.STATUS_REGRESSION:
        raise GateError(f"{row['run_id']}: fell by {-row['delta']:.4f} against {row['reference_run']}")
    return row["status"]


def split_integrity(stored: DataFrame, derived: DataFrame, key: str = K.ID, split: str = K.SPLIT) -> DataFrame:
    """Stored against re-derived partition: rows on one side only, and keys in several slices."""
    tagged = stored.select(key, split, F.lit(1).alias("_s"), F.lit(0).alias("_d")).unionByName(
        derived.select(key, split, F.lit(0).alias("_s"), F.lit(1).alias("_d"))
    )
    per = tagged.groupBy(key, split).agg(F.sum("_s").alias("_s"), F.sum("_d").alias("_d"))
    keyed = per.groupBy(key).agg(
        F.sum(F.greatest(F.col("_s") - F.col("_d"), F.lit(0))).alias("_only_s"),
        F.sum(F.greatest(F.col("_d") - F.col("_s"), F.lit(0))).alias("_only_d"),
        F.count_if(F.col("_s") > 0).alias("_slices"),
    )
    return keyed.agg(
        F.sum("_only_s").alias("only_stored"),
        F.sum("_only_d").alias("only_derived"),
        F.count_if(F.col("_slices") > 1).alias("keys_in_several_slices"),
    ).withColumn("ok", F.col("only_stored") + F.col("only_derived") + F.col("keys_in_several_slices") == 0)


def upsert_runs(log: DataFrame, entry: DataFrame, tag: str = "tag") -> DataFrame:
    """Replace the run of the same tag, keeping the status it had."""
    old = log.withColumn("_new", F.lit(0))
    new = entry.withColumn("_new", F.lit(1))
    both = old.unionByName(new, allowMissingColumns=True)
    per_tag = Window.partitionBy(tag)
    kept_status = F.max(F.when(F.col("_new") == 0, F.struct("trained_at", "status"))).over(per_tag)
    newest = F.row_number().over(Window.partitionBy(tag).orderBy(F.desc("_new"), F.desc("trained_at")))
    replaced = F.max("_new").over(per_tag) == 1
    return (
        both.withColumns({"_status": kept_status, "_rn": newest, "_hit": replaced})
        .filter((F.col("_rn") == 1) | ~F.col("_hit"))
        .withColumn("status", F.coalesce("_status.status", "status", F.lit(K.ACCEPTED)))
        .drop("_new", "_status", "_rn", "_hit")
    )


def run_deltas(runs: DataFrame, metrics: Sequence[str] = ("auc", "ks", "brier", "approval_rate"), order: str = "trained_at") -> DataFrame:
    """First against last accepted run, one row per metric."""
    kept = accepted(runs)
    everything = F.struct(order, "tag", *metrics)
    ends = kept.agg(F.min(everything).alias("f"), F.max(everything).alias("l"))
    rows = F.array(*[
        F.struct(
            F.lit(m).alias("metric"), F.col(f"f.{m}").cast("double").alias("before"),
            F.col(f"l.{m}").cast("double").alias("after"),
        )
        for m in metrics
    ])
    return ends.select(
        F.col("f.tag").alias("baseline_tag"), F.col("l.tag").alias("latest_tag"), F.explode(rows).alias("m")
    ).select("baseline_tag", "latest_tag", "m.*").withColumn("delta", F.col("after") - F.col("before"))


def segment_deltas(segments: DataFrame, order: str = "trained_at", keys: Sequence[str] = ("dimension", "group")) -> DataFrame:
    """First against last accepted run for every (dimension, group) present in both."""
    kept = accepted(segments)
    ends = kept.agg(F.min(order).alias("a"), F.max(order).alias("b"))
    first, last = ends.select("a").scalar(), ends.select("b").scalar()
    edge = kept.filter((F.col(order) == first) | (F.col(order) == last)).filter(F.col("auc").isNotNull())
    per = edge.groupBy(*keys).agg(
        F.max(F.when(F.col(order) == first, F.col("auc"))).alias("before"),
        F.max(F.when(F.col(order) == last, F.col("auc"))).alias("after"),
        F.max(F.when(F.col(order) == last, F.col("n"))).alias("n"),
    )
    return per.filter(F.col("before").isNotNull() & F.col("after").isNotNull()).withColumn(
        "delta", F.col("after") - F.col("before")
    )


def rejected(runs: DataFrame) -> DataFrame:
    return runs.filter(F.col("sample").isNull() & (F.col("status") == K.REJECTED))


def weak_segments(report: DataFrame, overall_low: Column | float | None = None) -> DataFrame:
    """Segments with a confirmed weakness; dimensions without the verdict use the old interval rule."""
    has_verdict = F.max(F.col("confirmed_weakness").isNotNull().cast("int")).over(Window.partitionBy("dimension")) == 1
    old_rule = F.lit(False) if overall_low is None else F.coalesce(F.col("ci_high") < overall_low, F.lit(False))
    weak = F.when(has_verdict, F.coalesce("confirmed_weakness", F.lit(False))).otherwise(old_rule)
    return report.withColumn("_weak", weak).filter("_weak").select("dimension", "group")


def overlap_flags(report: DataFrame, low: Column | float, high: Column | float) -> DataFrame:
    """Whether a segment's interval overlaps the overall interval (kept for old reports)."""
    apart = (F.col("ci_high") < low) | (F.col("ci_low") > high)
    return report.withColumn("overlaps_overall", ~apart)


def weak_map(weak: DataFrame) -> dict[str, list[str]]:
    """The (bounded) weak list in the form the band-width rule takes."""
    out: dict[str, list[str]] = {}
    for r in weak.orderBy("dimension", "group").collect():
        out.setdefault(r["dimension"], []).append(r["group"])
    return out
