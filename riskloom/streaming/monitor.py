"""Windowed monitoring of scored decisions; every function takes a streaming or a batch DataFrame.

A stream keeps per open window and label one row of counts (score and latency distributions as
fixed-edge bucket counts), so state does not grow with the traffic. Partial aggregation runs
before the shuffle, so a hot label costs one row per task and window.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.functions import columns as C
from riskloom.functions import constants as K

DELAY = "10 minutes"
# Latency edges in seconds and alert limits.
LATENCY_EDGES = (0.1, 0.5, 1.0, 2.5, 5.0, 10.0)
MAX_P95_SECONDS = 1.0
MAX_ERROR_SHARE = 0.05
MIN_RATE = 0.001


def timed(df: DataFrame, ts: str = "ts", delay: str = DELAY) -> DataFrame:
    """Event time as a zoned timestamp; a watermark on streams."""
    typed = df.withColumn(ts, F.col(ts).cast("timestamp"))
    return typed.withWatermark(ts, delay) if typed.isStreaming else typed


def windowed(df: DataFrame, by: Sequence[str], ts: str, length: str, slide: str | None, *aggs: Column) -> DataFrame:
    frame = F.window(ts, length, slide) if slide else F.window(ts, length)
    grouped = timed(df, ts).groupBy(frame.alias("window"), *by).agg(*aggs)
    return grouped.select(
        F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), *by,
        *[c for c in grouped.columns if c not in ("window", *by)],
    )


def event_rate(df: DataFrame, by: Sequence[str], ts: str = "ts", length: str = "1 minute") -> DataFrame:
    """Events per tumbling window and label (per minute by default)."""
    return windowed(df, by, ts, length, None, F.count(F.lit(1)).alias("n"))


def bucket_counts(value: str, edges: Sequence[float]) -> list[Column]:
    """Aggregates: cumulative counts at every edge, and the total."""
    return [
        *[F.count_if(F.col(value) <= e).alias(f"le_{i}") for i, e in enumerate(edges)],
        F.count(value).alias("n"),
    ]


def bucket_quantile(q: float, edges: Sequence[float]) -> Column:
    """Quantile from cumulative counts, linear inside its bucket; above the last edge, that edge."""
    rank = F.lit(q) * F.col("n")
    out = None
    for i, edge in enumerate(edges):
        low = 0.0 if i == 0 else float(edges[i - 1])
        below = F.lit(0) if i == 0 else F.col(f"le_{i - 1}")
        inside = F.col(f"le_{i}") - below
        value = F.lit(low) + (float(edge) - low) * C.div_or_zero(rank - below, inside)
        hit = F.col(f"le_{i}") >= rank
        out = F.when(hit, value) if out is None else out.when(hit, value)
    return F.when(F.col("n") > 0, out.otherwise(F.lit(float(edges[-1]))))


def score_quantiles(
    df: DataFrame, score: str, ts: str = "ts", edges: Sequence[float] = K.SCORE_EDGES,
    length: str = "5 minutes", slide: str = "1 minute",
) -> DataFrame:
    """Score bucket counts and p50, p90, p99 per sliding window."""
    counts = windowed(df, [], ts, length, slide, *bucket_counts(score, edges))
    return counts.withColumns({f"p{int(q * 100)}": bucket_quantile(q, edges) for q in (0.5, 0.9, 0.99)})


def latency_p95(
    df: DataFrame, handler: str, seconds: str, ts: str = "ts", edges: Sequence[float] = LATENCY_EDGES,
    limit: float = MAX_P95_SECONDS, length: str = "5 minutes", slide: str = "1 minute",
) -> DataFrame:
    """p95 latency per handler and sliding window, and whether it is over the limit."""
    counts = windowed(df, [handler], ts, length, slide, *bucket_counts(seconds, edges))
    out = counts.withColumn("p95", bucket_quantile(0.95, edges))
    return out.select("window_start", "window_end", handler, "n", "p95", (F.col("p95") > limit).alias("firing"))


def error_share(
    df: DataFrame, failed: Column, ts: str = "ts", limit: float = MAX_ERROR_SHARE, min_rate: float = MIN_RATE,
    minutes: int = 5, slide: str = "1 minute",
) -> DataFrame:
    """Share of failed requests per sliding window, with a floor under the request rate."""
    seconds = minutes * 60.0
    counts = windowed(
        df.withColumn("_failed", failed), [], ts, f"{minutes} minutes", slide,
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("_failed")).alias("n_failed"),
    )
    share = (F.col("n_failed") / seconds) / F.greatest(F.col("n") / seconds, F.lit(min_rate))
    return counts.withColumn("error_share", share).withColumn("firing", F.col("error_share") > limit)


def readiness(
    df: DataFrame, component: str, up: str, ts: str = "ts", length: str = "1 minute", expected: Sequence[str] = ()
) -> DataFrame:
    """Ready in a window only if every reporting component was up throughout it and every expected one reported.

    A window without any report has no row; ``alerts.component_states`` tells the silence by timers.
    """
    name = F.col(component).cast("string")
    reported = [F.max((name == e).cast("int")) for e in expected]
    return windowed(
        df, [], ts, length, None,
        F.coalesce(F.least(F.min(F.col(up).cast("int")), *reported, F.lit(1)), F.lit(0)).alias("ready"), F.count(component).alias("n"),
    )


def minute_summary(df: DataFrame, source: str, ts: str = "ts", length: str = "1 minute", more: Sequence[Column] = ()) -> DataFrame:
    """First and last event per source and window: all the absence rule needs from the raw events."""
    grouped = timed(df, ts).groupBy(F.window(ts, length).alias("window"), source).agg(
        F.min(ts).alias("first_ts"), F.max(ts).alias("last_ts"), F.count(F.lit(1)).alias("n"), *more
    )
    return grouped.select(
        source, F.window_time("window").alias("event_time"), "first_ts", "last_ts", "n", *grouped.columns[5:])
