"""Runs become visible as a whole; interrupted writers and changed files are found."""

import glob
import time

import pytest
from pyspark.sql import functions as F

from riskloom.operators import gates
from riskloom.sources import publication as P
from riskloom.sources import writers


def test_an_interrupted_writer_changes_nothing_for_readers(spark, tmp_path):
    root = str(tmp_path / "out")
    assert P.committed_runs(spark, root).count() == 0 and P.newest_run(spark, root) is None
    assert P.publish({"a": spark.range(5), "b": spark.range(0)}, root, "v1", 1, {"auc": 0.7}) == 1
    failing = spark.range(4).select(F.raise_error(F.lit("lost")).cast("long").alias("id"))
    with pytest.raises(Exception, match="lost"):
        P.publish({"a": spark.range(9), "b": failing}, root, "v2", 2, {"auc": 0.9})
    assert P.read_table(spark, root, "a").count() == 5
    left = P.uncommitted(spark, root)
    assert len(left) == 1 and next(iter(left)).startswith("v2-")
    assert P.sweep(spark, root, 0) == []
    assert P.sweep(spark, root, int(time.time() * 1000) + 60_000) == list(left)
    assert P.uncommitted(spark, root) == {} and P.read_table(spark, root, "b").count() == 0


def test_a_number_is_given_once_and_samples_stay_apart(spark, tmp_path):
    root = str(tmp_path / "out")
    staged = [P.stage_run({"a": spark.range(n)}, root, "v1") for n in (1, 2)]
    assert P._new_file(spark, f"{root}/commits", "000000000001.json", "{}")
    assert not P._new_file(spark, f"{root}/commits", "000000000001.json", "{}")
    assert [P.commit_run(spark, s, root, i, {}) for i, s in enumerate(staged)] == [2, 3]
    P.publish({"a": spark.range(7)}, root, "v1", 9, {}, sample=True)
    assert P.read_table(spark, root, "a").count() == 2 and P.read_table(spark, root, "a", sample=True).count() == 7
    assert not [f for f in glob.glob(f"{root}/commits/.0*") if not f.endswith(".crc")]
    with pytest.raises(P.PublicationError):
        P.read_table(spark, root, "other")


def test_checksum_ignores_order_and_layout_and_sees_a_change(spark, tmp_path):
    root = str(tmp_path / "out")
    df = spark.range(300, numPartitions=7).selectExpr("id", "if(id % 3 = 0, NULL, double(id)) AS v", "array(id) AS a", "map('k', id) AS m")
    P.publish({"t": df}, root, "v1", 1, {})
    run = P.newest_run(spark, root)
    assert P.verify_run(spark, root, run).filter("NOT ok").count() == 0
    assert df.agg(*P.content(df)).first() == df.orderBy(F.desc("id")).coalesce(1).agg(*P.content(df)).first()
    path = f"{root}/{run['folder']}/t"
    df.withColumn("v", F.when(F.col("id") != 7, F.col("v"))).write.mode("overwrite").parquet(path)
    bad = P.verify_run(spark, root, run).filter("NOT ok").collect()
    assert [r["check"] for r in bad] == ["checksum"]


def test_conversion_sees_content_that_keeps_rows_and_sums(spark, tmp_path, monkeypatch):
    df = spark.createDataFrame([(1, 0, "a"), (2, 1, "b")], "SK_ID_CURR long, TARGET int, s string")
    csv = writers.write_csv(df, str(tmp_path / "c"))
    assert writers.convert_csv(spark, csv, str(tmp_path / "good")).filter("NOT ok").count() == 0
    real = writers.readers.read_parquet
    monkeypatch.setattr(writers.readers, "read_parquet", lambda s, p: real(s, p).withColumn("s", F.lit("a")))
    with pytest.raises(gates.GateError, match="content"):
        writers.convert_csv(spark, csv, str(tmp_path / "bad"))


def test_a_tag_published_again_keeps_its_status(spark, tmp_path):
    root = str(tmp_path / "out")
    P.publish({"a": spark.range(1)}, root, "v1", 1, {"auc": 0.8}, status="rejeitada")
    P.publish({"a": spark.range(1)}, root, "v1", 2, {"auc": 0.9})
    P.publish({"a": spark.range(1)}, root, "v2", 3, {"auc": 0.7})
    log = {r["tag"]: (r["status"], r["auc"]) for r in P.run_log(spark, root, ["auc"]).collect()}
    assert log == {"v1": ("rejeitada", 0.9), "v2": ("aceita", 0.7)}
