"""Streaming queries: each drains a file stream of the events and is checked against batch SQL.

The stream closes a window when the watermark (latest event minus ten minutes) passes its end,
so the SQL side keeps exactly those windows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.functions import constants as K
from riskloom.operators import drift, learning
from riskloom.plans import training
from riskloom.plans.queries_cleaning import rounded
from riskloom.plans.queries_gates import EVENT_HALVES, VERDICT, psi_ctes
from riskloom.plans.registry import Tables, query
from riskloom.session import scratch_path
from riskloom.sources import writers
from riskloom.streaming import alerts, jobs, monitor

CLOSED = "(SELECT date_trunc('millisecond', max(ts)) - INTERVAL 10 MINUTE FROM events)"


def stream(t: Tables) -> DataFrame:
    """The events as a stream, with a score, a latency in seconds and a status class."""
    source = jobs.parquet_stream(t.spark, t.root, t.events.schema, "events.parquet")
    return shaped(source)


def shaped(df: DataFrame) -> DataFrame:
    return df.withColumns({
        "score": F.col("value") / 100.0, "seconds": F.col("value") / 20.0,
        "status": F.when(F.col("event_type") == "error", "5xx").otherwise("2xx")})


SHAPED = "SELECT *, value / 100e0 AS score, value / 20e0 AS seconds, CASE WHEN event_type = 'error' THEN '5xx' ELSE '2xx' END AS status FROM events"


def plain_times(df: DataFrame) -> DataFrame:
    """Zoned timestamps (UTC) as plain ones, as the tables have them."""
    kinds = dict(df.dtypes)
    return df.select(*[F.col(c).cast("timestamp_ntz").alias(c) if kinds[c] == "timestamp" else F.col(c) for c in df.columns])


def tumbling_sql(by: str) -> str:
    return f"""SELECT date_trunc('minute', ts) AS window_start, date_trunc('minute', ts) + INTERVAL 1 MINUTE AS window_end, {by}, count(*) AS n
     FROM ({SHAPED}) GROUP BY 1, 2, {by} HAVING date_trunc('minute', ts) + INTERVAL 1 MINUTE <= {CLOSED}"""


def sliding(source: str = SHAPED) -> str:
    return f"""SELECT *, date_trunc('minute', ts) - k * INTERVAL 1 MINUTE AS window_start, date_trunc('minute', ts) + (5 - k) * INTERVAL 1 MINUTE AS window_end
     FROM ({source}), (SELECT unnest(range(5)) AS k)"""


def bucket_quantile_sql(q: float, edges, value: str) -> str:
    """Quantile of a window from bucket counts, written over the raw values of the group."""
    def le(e: float) -> str:
        return f"count(CASE WHEN {value} <= {e}e0 THEN 1 END)"

    rank = f"{q}e0 * count({value})"
    out = ""
    for i, e in enumerate(edges):
        low, below = (0.0, "0") if i == 0 else (edges[i - 1], le(edges[i - 1]))
        out += f" WHEN {le(e)} >= {rank} THEN {low}e0 + ({e}e0 - {low}e0) * coalesce(({rank} - {below}) / nullif(CAST({le(e)} - {below} AS DOUBLE), 0), 0)"
    return f"CASE{out} ELSE {edges[-1]}e0 END"


@query("stream_decisions_per_minute", tumbling_sql("event_type"))
def _(t: Tables) -> DataFrame:
    return plain_times(jobs.drain(monitor.event_rate(stream(t), ["event_type"])))


@query("stream_requests_by_status", tumbling_sql("status"))
def _(t: Tables) -> DataFrame:
    return plain_times(jobs.drain(monitor.event_rate(stream(t), ["status"])))


@query("stream_score_quantiles", f"""
SELECT window_start, window_end, count(score) AS n, {", ".join(f"count(CASE WHEN score <= {e}e0 THEN 1 END) AS le_{i}" for i, e in enumerate(K.SCORE_EDGES))},
 {", ".join(f"round({bucket_quantile_sql(q, K.SCORE_EDGES, 'score')}, 9) AS p{int(q * 100)}" for q in (0.5, 0.9, 0.99))}
FROM ({sliding()}) GROUP BY 1, 2 HAVING window_end <= {CLOSED}
""")
def _(t: Tables) -> DataFrame:
    return rounded(plain_times(jobs.drain(monitor.score_quantiles(stream(t), "score"))), 9)


LATENCY = f"""SELECT window_start, window_end, event_type, count(seconds) AS n, round({bucket_quantile_sql(0.95, monitor.LATENCY_EDGES, 'seconds')}, 9) AS p95,
 {bucket_quantile_sql(0.95, monitor.LATENCY_EDGES, 'seconds')} > 1e0 AS firing FROM ({sliding()}) GROUP BY 1, 2, 3"""


@query("stream_latency_p95", f"{LATENCY} HAVING window_end <= {CLOSED}")
def _(t: Tables) -> DataFrame:
    return rounded(plain_times(jobs.drain(monitor.latency_p95(stream(t), "event_type", "seconds"))), 9)


ERRORS = f"""SELECT window_start, window_end, count(*) AS n, count(CASE WHEN status = '5xx' THEN 1 END) AS n_failed,
 round((count(CASE WHEN status = '5xx' THEN 1 END) / 300e0) / greatest(count(*) / 300e0, 0.001e0), 9) AS error_share,
 (count(CASE WHEN status = '5xx' THEN 1 END) / 300e0) / greatest(count(*) / 300e0, 0.001e0) > 0.05e0 AS firing FROM ({sliding()}) GROUP BY 1, 2"""


@query("stream_error_share", f"{ERRORS} HAVING window_end <= {CLOSED}")
def _(t: Tables) -> DataFrame:
    return rounded(plain_times(jobs.drain(monitor.error_share(stream(t), F.col("status") == "5xx"))), 9)


@query("stream_readiness", f"""
SELECT date_trunc('minute', ts) AS window_start, date_trunc('minute', ts) + INTERVAL 1 MINUTE AS window_end, min(CAST(event_type <> 'error' AS INTEGER)) AS ready, count(user_id) AS n
FROM events GROUP BY 1, 2 HAVING date_trunc('minute', ts) + INTERVAL 1 MINUTE <= {CLOSED}
""")
def _(t: Tables) -> DataFrame:
    up = stream(t).withColumn("up", F.col("event_type") != "error")
    return plain_times(jobs.drain(monitor.readiness(up, "user_id", "up")))


WATCHED = ("click", "error", "purchase", "signup", "view", "scheduler")


@query("stream_expected_readiness", f"""
SELECT date_trunc('hour', ts) AS window_start, date_trunc('hour', ts) + INTERVAL 1 HOUR AS window_end,
 CASE WHEN min(CAST(value >= 5 AS INTEGER)) = 1 AND count(DISTINCT event_type) = 5 THEN 1 ELSE 0 END AS ready, count(event_type) AS n
FROM events GROUP BY 1, 2 HAVING date_trunc('hour', ts) + INTERVAL 1 HOUR <= {CLOSED}
""")
def _(t: Tables) -> DataFrame:
    up = stream(t).withColumn("up", F.col("value") >= 5)
    return plain_times(jobs.drain(monitor.readiness(up, "event_type", "up", length="1 hour", expected=WATCHED[:5])))


@query("stream_component_states", f"""
WITH w AS (SELECT unnest({list(WATCHED)}) AS component, TIMESTAMP '2024-01-01' AS since),
 m AS (SELECT event_type AS component, min(ts) AS first_ts, max(ts) AS last_ts, min(CAST(value >= 10 AS INTEGER)) AS up FROM events
  WHERE date_trunc('minute', ts) + INTERVAL 1 MINUTE <= {CLOSED} GROUP BY event_type, date_trunc('minute', ts)),
 p AS (SELECT m.*, coalesce(lag(last_ts) OVER (PARTITION BY component ORDER BY first_ts), since) AS last FROM m JOIN w USING (component)),
 e AS (SELECT component, CASE WHEN up = 1 THEN 'up' ELSE 'down' END AS state, first_ts AS at FROM p
  UNION ALL SELECT component, 'silent', last + INTERVAL 2 HOUR FROM p WHERE first_ts - last > INTERVAL 2 HOUR
  UNION ALL SELECT component, 'silent', coalesce(max(last_ts), max(since)) + INTERVAL 2 HOUR FROM w LEFT JOIN m USING (component) GROUP BY component
   HAVING coalesce(max(last_ts), max(since)) + INTERVAL 2 HOUR < {CLOSED})
SELECT component, state, e.at AS at FROM e QUALIFY state IS DISTINCT FROM lag(state) OVER (PARTITION BY component ORDER BY e.at)
""")
def _(t: Tables) -> DataFrame:
    # one watched component never reports
    watched = t.spark.createDataFrame([(c,) for c in WATCHED], "component string").withColumn("since", F.lit("2024-01-01 00:00:00").cast("timestamp"))
    reports = stream(t).withColumn("up", F.col("value") >= 10)
    return plain_times(jobs.drain(alerts.component_states(reports, "event_type", "up", watched, 2 * 3600)))


# two minutes of an error share over the limit
HELD = f"""
WITH s AS (SELECT 'all' AS label, window_end AS ts, firing FROM ({ERRORS}) WHERE window_end <= {CLOSED}),
 l AS (SELECT *, CASE WHEN firing AND NOT coalesce(lag(firing) OVER (ORDER BY ts), false) THEN 1 ELSE 0 END AS st FROM s),
 i AS (SELECT *, sum(st) OVER (ORDER BY ts) AS isl FROM l), f AS (SELECT label, isl, ts, min(ts) OVER (PARTITION BY isl) AS since FROM i WHERE firing)
SELECT label, since, min(ts) AS at FROM f WHERE ts - since >= INTERVAL 2 MINUTE GROUP BY label, isl, since"""


def error_samples(t: Tables) -> DataFrame:
    """Closed error-share windows as samples, from the streaming job."""
    closed = jobs.drain(monitor.error_share(stream(t), F.col("status") == "5xx"))
    return closed.select(F.lit("all").alias("label"), F.col("window_end").alias("ts"), "firing")


@query("held_alerts_batch", HELD)
def _(t: Tables) -> DataFrame:
    return plain_times(alerts.held_alerts_batch(error_samples(t), "label", 120))


@query("stream_held_alerts", HELD)
def _(t: Tables) -> DataFrame:
    # several files in no order of time, then one sample that moves the watermark past them all
    found = error_samples(t)
    path = scratch_path(t.spark, "samples")
    for part in range(3):
        found.filter(F.pmod(F.xxhash64("ts"), F.lit(3)) == part).write.mode("append").parquet(path)
    late = 60 * 86400
    mark = found.agg((F.max("ts") + F.make_dt_interval(F.lit(61))).alias("ts")).filter("ts IS NOT NULL")
    mark.select(F.lit("end").alias("label"), "ts", F.lit(False).alias("firing")).write.mode("append").parquet(path)
    samples = jobs.parquet_stream(t.spark, path, t.spark.read.parquet(path).schema, per_batch=4)
    return plain_times(jobs.drain(alerts.held_alerts(samples, "label", 120, late)))


GAPS = """SELECT CAST(user_id AS VARCHAR) AS source, ts AS last_seen, next AS next_seen
 FROM (SELECT user_id, ts, lead(ts) OVER (PARTITION BY user_id ORDER BY ts) AS next FROM events{where}) WHERE next - ts > INTERVAL 2 DAY"""


@query("absence_gaps_batch", GAPS.format(where=""))
def _(t: Tables) -> DataFrame:
    return plain_times(alerts.absence_gaps(t.events, "user_id", 2 * 86400))


@query("stream_absence_alerts", GAPS.format(where=f" WHERE date_trunc('minute', ts) + INTERVAL 1 MINUTE <= {CLOSED}") + f"""
UNION ALL SELECT CAST(user_id AS VARCHAR), max(ts), NULL FROM events WHERE date_trunc('minute', ts) + INTERVAL 1 MINUTE <= {CLOSED}
GROUP BY user_id HAVING max(ts) + INTERVAL 2 DAY < {CLOSED}""")
def _(t: Tables) -> DataFrame:
    # gaps that a later event closed, and sources still silent when the stream ends
    return plain_times(jobs.drain(alerts.absence_alerts(stream(t), "user_id", 2 * 86400)))


@query("stream_score_queue")
def _(t: Tables) -> DataFrame:
    bundle = training.trained(t)
    names = [K.ID, "AMT_CREDIT", "EXT_SOURCE_1", "EXT_SOURCE_2", "NAME_EDUCATION_TYPE"]
    folder = writers.write_csv(training.applications(t).select(*names), scratch_path(t.spark, "queue"))
    return jobs.drain(jobs.score_queue(jobs.csv_stream(t.spark, folder, names), bundle))


@query("stream_queue_and_table_scores_agree", "SELECT count(*) AS n_compared, true AS agree FROM clients")
def _(t: Tables) -> DataFrame:
    bundle = training.trained(t)
    df = training.applications(t)
    names = training.base_inputs(df, bundle.spec)
    folder = scratch_path(t.spark, "queue")
    for part in range(2):
        df.select(K.ID, *names).filter(F.col(K.ID) % 2 == part).write.mode("append").option("header", True).csv(folder)
    queue = jobs.csv_stream(t.spark, folder, [K.ID, *names])
    queued = jobs.drain(jobs.score_queue(queue, bundle)).select(F.col(K.ID).cast("long"), F.col("probability_default").cast("double").alias("queued"))
    both = learning.predict(df, bundle).select(K.ID, "probability_default").join(queued, K.ID)
    gap = F.abs(F.col("probability_default") - F.col("queued"))
    return both.agg(F.count(gap).alias("n_compared"), (F.max(gap) <= 5.1e-7).alias("agree"))


@query("stream_drift_per_batch", f"""
WITH {psi_ctes(EVENT_HALVES)} SELECT feature, round(psi, 9) AS psi, {VERDICT} AS verdict, te AS n_expected, tt AS n_observed, CAST(0 AS BIGINT) AS batch_id FROM s JOIN t USING (feature)
""")
def _(t: Tables) -> DataFrame:
    late = F.col("ts") >= F.lit("2024-01-16").cast("timestamp_ntz")
    reference = t.events.filter(~late).select("value")
    cuts = drift.reference_cuts(reference, ["value"])
    path = scratch_path(t.spark, "drift")
    incoming = jobs.parquet_stream(t.spark, t.root, t.events.schema, "events.parquet").filter(late)
    frozen = drift.frozen_counts(reference, cuts)
    jobs.drift_per_batch(incoming, cuts, frozen, path, scratch_path(t.spark, "drift-checkpoint")).awaitTermination()
    out = t.spark.read.option("recursiveFileLookup", True).parquet(path)
    return rounded(out.select("feature", "psi", "verdict", "n_expected", "n_observed", F.col("batch_id").cast("long")), 9)
