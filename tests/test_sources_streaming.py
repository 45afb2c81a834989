import datetime as dt

import pytest
from pyspark.sql import functions as F

from riskloom.operators import drift, gates
from riskloom.sources import readers, writers
from riskloom.streaming import alerts, jobs, monitor

T0 = dt.datetime(2024, 1, 1)


def test_conversion_fails_on_a_repeated_key(spark, tmp_path):
    df = spark.createDataFrame([(1, 0), (1, 1)], "SK_ID_CURR long, TARGET int")
    csv = writers.write_csv(df, str(tmp_path / "c"))
    with pytest.raises(gates.GateError, match="key_unique"):
        writers.convert_csv(spark, csv, str(tmp_path / "p"))


def test_csv_nulls_and_quotes_survive(spark, tmp_path):
    df = spark.createDataFrame([(1, 'a "b", c', None), (2, None, 2.5)], "k long, s string, v double")
    back = readers.read_csv(spark, writers.write_csv(df, str(tmp_path / "c")), df.schema)
    assert sorted(back.collect()) == sorted(df.collect())


def test_missing_inputs_are_all_listed(spark, tmp_path):
    writers.write_csv(spark.range(3), str(tmp_path / "small"))
    with pytest.raises(readers.SourceError) as found:
        readers.check_inputs(spark, [str(tmp_path / "small"), str(tmp_path / "none")], 1_000_000)
    assert "small" in str(found.value) and "none" in str(found.value)


def test_runs_are_never_overwritten(spark, tmp_path):
    writers.write_report({"a": spark.range(2)}, str(tmp_path), "v1")
    writers.write_report({"a": spark.range(2)}, str(tmp_path), "v1", sample=True)
    with pytest.raises(Exception, match="already exists"):
        writers.write_report({"a": spark.range(2)}, str(tmp_path), "v1")


def test_snapshots_return_the_run_before(spark, tmp_path):
    path = str(tmp_path / "s")
    assert writers.previous_snapshot(spark, path, "b") is None
    for run, n in (("a", 2), ("b", 3), ("c", 4)):
        writers.snapshot(spark.range(n), path, run)
    assert writers.previous_snapshot(spark, path, "c").count() == 3
    assert writers.previous_snapshot(spark, path, "a") is None


def test_missing_json_is_empty(spark, tmp_path):
    assert readers.read_json(spark, str(tmp_path / "no"), "a int").count() == 0


def write_minutes(spark, folder, parts, schema):
    """One file per part, so the stream takes several micro-batches."""
    for i, rows in enumerate(parts):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(folder)
    return folder


def at(minutes, seconds=0):
    return T0 + dt.timedelta(minutes=minutes, seconds=seconds)


def test_rates_over_several_batches_equal_the_batch_answer(spark, tmp_path):
    schema = "ts timestamp, kind string"
    parts = [[(at(m, 5 * m), "ab"[m % 2]) for m in range(s, s + 10)] for s in (0, 10, 20, 40)]
    folder = write_minutes(spark, str(tmp_path / "e"), parts, schema)
    stream = jobs.parquet_stream(spark, folder, spark.read.parquet(folder).schema, per_batch=1)
    got = jobs.drain(monitor.event_rate(stream, ["kind"]))
    batch = monitor.event_rate(spark.read.parquet(folder), ["kind"])
    closed = batch.filter(F.col("window_end") <= F.lit(at(49, 245) - dt.timedelta(minutes=10)))
    assert sorted(got.collect()) == sorted(closed.collect())


def test_bucket_quantile_interpolates(spark):
    df = spark.createDataFrame([(T0, v) for v in (0.05, 0.05, 0.3, 0.3, 20.0)], "ts timestamp, s double")
    row = monitor.latency_p95(df.withColumn("h", F.lit("x")), "h", "s").first()
    assert row["p95"] == 10.0 and row["firing"]
    half = monitor.windowed(df, [], "ts", "5 minutes", None, *monitor.bucket_counts("s", monitor.LATENCY_EDGES))
    assert half.select(monitor.bucket_quantile(0.5, monitor.LATENCY_EDGES)).first()[0] == pytest.approx(0.2)


SAMPLES = [("a", 0, True), ("a", 1, True), ("a", 2, True), ("a", 3, True), ("a", 4, False), ("a", 5, True), ("a", 6, True),
           ("a", 7, True), ("b", 0, True), ("b", 1, False), ("b", 2, True)]


def test_held_alerts_carry_state_across_batches(spark, tmp_path):
    rows = [(label, at(m), firing) for label, m, firing in SAMPLES]
    schema = "label string, ts timestamp, firing boolean"
    want = sorted((r["label"], r["since"], r["at"]) for r in alerts.held_alerts_batch(spark.createDataFrame(rows, schema), "label", 120).collect())
    assert want == [("a", at(0), at(2)), ("a", at(5), at(7))]
    parts = [[r for r in rows if r[1] == at(m)] for m in range(8)]
    folder = write_minutes(spark, str(tmp_path / "s"), parts, schema)
    # files are taken in the order they were written
    stream = jobs.parquet_stream(spark, folder, spark.read.parquet(folder).schema, per_batch=1)
    got = jobs.drain(alerts.held_alerts(stream, "label", 120, late_seconds=0))
    assert sorted((r["label"], r["since"], r["at"]) for r in got.collect()) == want


def test_held_alerts_take_late_samples_in_the_order_of_their_time(spark, tmp_path):
    rows = [(label, at(m), firing) for label, m, firing in SAMPLES] + [("c", at(0), True), ("c", at(1), False), ("c", at(2), True)]
    schema = "label string, ts timestamp, firing boolean"
    want = sorted((r["label"], r["since"], r["at"]) for r in alerts.held_alerts_batch(spark.createDataFrame(rows, schema), "label", 120).collect())
    order = [3, 0, 5, 1, 7, 2, 6, 4]
    parts = [[r for r in rows if r[1] == at(m)] for m in order] + [[("end", at(90), False)]]
    folder = write_minutes(spark, str(tmp_path / "s"), parts, schema)
    stream = jobs.parquet_stream(spark, folder, spark.read.parquet(folder).schema, per_batch=1)
    got = jobs.drain(alerts.held_alerts(stream, "label", 120, late_seconds=1800))
    assert sorted((r["label"], r["since"], r["at"]) for r in got.collect()) == want


def test_absence_is_reported_open_and_closed(spark, tmp_path):
    schema = "ts timestamp, src string"
    parts = [[(at(0), "a"), (at(1), "b")], [(at(2), "a"), (at(3), "b")], [(at(40), "a"), (at(41), "c")], [(at(60), "c"), (at(75), "c")]]
    folder = write_minutes(spark, str(tmp_path / "e"), parts, schema)
    closed = alerts.absence_gaps(spark.read.parquet(folder), "src", 1800).collect()
    assert [(r["source"], r["last_seen"], r["next_seen"]) for r in closed] == [("a", at(2), at(40))]
    stream = jobs.parquet_stream(spark, folder, spark.read.parquet(folder).schema, per_batch=1)
    got = {(r["source"], r["last_seen"], r["next_seen"]) for r in jobs.drain(alerts.absence_alerts(stream, "src", 1800)).collect()}
    assert ("b", at(3), None) in got
    assert ("a", at(2), at(40)) in got or ("a", at(2), None) in got


def test_drift_per_batch_writes_one_report_per_batch(spark, tmp_path):
    reference = spark.range(1000).selectExpr("double(id) AS v")
    folder = write_minutes(spark, str(tmp_path / "e"), [[(float(i),) for i in range(0, 1000, 7)], [(float(i),) for i in range(900, 1000)]], "v double")
    cuts = drift.reference_cuts(reference, ["v"])
    stream = jobs.parquet_stream(spark, folder, reference.schema, per_batch=1)
    frozen = drift.frozen_counts(reference, cuts)
    jobs.drift_per_batch(stream, cuts, frozen, str(tmp_path / "r"), str(tmp_path / "k")).awaitTermination()
    out = spark.read.option("recursiveFileLookup", True).parquet(str(tmp_path / "r")).orderBy("batch_id").collect()
    assert len(out) == 2 and {r["verdict"] for r in out} == {"estável", "mudança relevante"}


def test_readiness_needs_every_component(spark):
    df = spark.createDataFrame([(at(0), "model", True), (at(0, 5), "data", False), (at(1), "model", True), (at(1), "data", True)], "ts timestamp, c string, up boolean")
    assert [r["ready"] for r in monitor.readiness(df, "c", "up").orderBy("window_start").collect()] == [0, 1]


def test_a_component_that_stops_reporting_is_not_ready(spark, tmp_path):
    rows = [[("model", at(0), True), ("data", at(0), True)], [("model", at(1), True)], [("data", at(2), True), ("model", at(2), None)]]
    df = spark.createDataFrame(sum(rows, []), "c string, ts timestamp, up boolean")
    ready = monitor.readiness(df, "c", "up", expected=["model", "data"]).orderBy("window_start")
    assert [r["ready"] for r in ready.collect()] == [1, 0, 1]
    assert monitor.readiness(df, "c", "up", expected=["model", "other"]).agg(F.max("ready")).first()[0] == 0


def test_component_states_tell_silence_and_return_across_batches(spark, tmp_path):
    schema = "c string, ts timestamp, up boolean"
    parts = [[("a", at(0), True), ("b", at(0), True)], [("a", at(5), False)], [("a", at(9), True)], [("a", at(60), True), ("b", at(61), True)], [("z", at(200), True)]]
    folder = write_minutes(spark, str(tmp_path / "in"), parts, schema)
    stream = jobs.parquet_stream(spark, folder, spark.read.parquet(folder).schema, per_batch=1)
    expected = spark.createDataFrame([("a", at(0)), ("b", at(0)), ("never", at(0))], "component string, since timestamp")
    found = jobs.drain(alerts.component_states(stream, "c", "up", expected, 1800)).collect()
    got = {c: [(r["state"], r["at"]) for r in sorted(found, key=lambda r: r["at"]) if r["component"] == c] for c in ("a", "b", "never")}
    assert got["a"] == [("up", at(0)), ("down", at(5)), ("up", at(9)), ("silent", at(39)), ("up", at(60)), ("silent", at(90))]
    assert got["b"] == [("up", at(0)), ("silent", at(30)), ("up", at(61)), ("silent", at(91))]
    assert got["never"] == [("silent", at(30))]
