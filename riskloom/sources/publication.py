"""Publication of a run: all its tables become visible together, by one commit file, or not at all.

A writer puts the tables of a run into a folder of its own; nobody looks there until a commit file names it. Rows and an
order-free checksum are counted by the writing jobs themselves. Commit files are numbered, and a number is taken by a
rename that fails when the name exists, so of two writers one goes on to the next number. A writer that stops half-way
leaves a folder without a commit, which readers never see and ``sweep`` removes.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.functions import constants as K
from riskloom.operators import gates

RUN_SCHEMA = (
    "sequence long, run_id string, tag string, sample string, status string, trained_at long, folder string, "
    "tables array<struct<name: string, rows: long, checksum: string>>, metrics map<string, double>"
)


class PublicationError(gates.GateError):
    """A published table does not hold what its commit says."""


# ---------------------------------------------------------------- checks of a written table


def _hashable(field: T.StructField) -> Column:
    c = F.col(f"`{field.name}`")
    return F.to_json(c) if isinstance(field.dataType, (T.MapType, T.StructType, T.ArrayType)) else c


def content(df: DataFrame) -> list[Column]:
    """Aggregates: rows, and a sum of row hashes that no order, file layout or number of tasks changes."""
    row = F.xxhash64(*[_hashable(f) for f in df.schema.fields]) if df.columns else F.lit(0)
    return [F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(row.cast("decimal(38,0)")), F.lit(0)).alias("checksum")]


def write_observed(df: DataFrame, path: str, *more: Column) -> dict:
    """Write ZSTD Parquet and return the facts of the rows on their way: rows, checksum and the aggregates given."""
    seen = Observation(f"write-{uuid.uuid4().hex}")
    df.observe(seen, *content(df), *more).write.option("compression", "zstd").parquet(path)
    return seen.get


# ---------------------------------------------------------------- files


def _file_context(spark: SparkSession, path: str):
    jvm = spark._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), spark._jsc.hadoopConfiguration()), target


def _children(spark: SparkSession, path: str) -> dict[str, int]:
    """Names below a folder with their modification times in milliseconds; none when there is no such folder."""
    context, target = _file_context(spark, path)
    if not context.util().exists(target):
        return {}
    return {s.getPath().getName(): s.getModificationTime() for s in context.util().listStatus(target)}


def _new_file(spark: SparkSession, path: str, name: str, text: str) -> bool:
    """Create a whole file under a name that is still free; False when another writer was first."""
    jvm = spark._jvm
    temporary = f"{path}/.{name}-{uuid.uuid4().hex}"
    context, source = _file_context(spark, temporary)
    system = source.getFileSystem(spark._jsc.hadoopConfiguration())
    stream = system.create(source, False)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    target = jvm.org.apache.hadoop.fs.Path(f"{path}/{name}")
    if not context.util().exists(target):
        none = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
        try:
            context.rename(source, target, none)
            return True
        except Exception as e:  # noqa: BLE001
            if "AlreadyExists" not in str(e):
                raise
    context.delete(source, False)
    return False


# ---------------------------------------------------------------- writer


def stage_run(tables: Mapping[str, DataFrame], root: str, tag: str) -> dict:
    """Write the tables of a run where no reader looks yet; returns what a commit needs."""
    run_id = f"{tag}-{uuid.uuid4().hex}"
    folder = f"{root.rstrip('/')}/runs/{run_id}"
    written = []
    for name, df in tables.items():
        seen = write_observed(df, f"{folder}/{name}")
        written.append({"name": name, "rows": seen["rows"], "checksum": str(seen["checksum"])})
    return {"run_id": run_id, "tag": tag, "folder": f"runs/{run_id}", "tables": written}


def commit_run(
    spark: SparkSession, staged: Mapping, root: str, trained_at: int, metrics: Mapping[str, float],
    sample: bool = False, status: str | None = None,
) -> int:
    """Make a staged run visible and return its number."""
    commits = f"{root.rstrip('/')}/commits"
    while True:
        taken = [int(n.split(".")[0]) for n in _children(spark, commits) if n.endswith(".json") and not n.startswith(".")]
        sequence = max(taken, default=0) + 1
        entry = {**staged, "sequence": sequence, "trained_at": trained_at, "metrics": dict(metrics), "status": status,
                 "sample": "demo" if sample else None}
        if _new_file(spark, commits, f"{sequence:012d}.json", json.dumps(entry)):
            return sequence


def publish(
    tables: Mapping[str, DataFrame], root: str, tag: str, trained_at: int, metrics: Mapping[str, float],
    sample: bool = False, status: str | None = None,
) -> int:
    """Write and commit a run of one or more tables; a failure before the commit leaves all readers as they were."""
    spark = next(iter(tables.values())).sparkSession
    return commit_run(spark, stage_run(tables, root, tag), root, trained_at, metrics, sample, status)


# ---------------------------------------------------------------- readers


def committed_runs(spark: SparkSession, root: str) -> DataFrame:
    """One row per committed run of ``RUN_SCHEMA``; a folder without commits is an empty history."""
    commits = f"{root.rstrip('/')}/commits"
    if not _children(spark, commits):
        return spark.createDataFrame([], RUN_SCHEMA)
    return spark.read.schema(RUN_SCHEMA).json(commits)


def newest_run(spark: SparkSession, root: str, tag: str | None = None, sample: bool = False):
    """The newest committed run (of a tag) as a row, or None; sample runs are a history of their own."""
    runs = committed_runs(spark, root).filter(F.col("sample").isNotNull() if sample else F.col("sample").isNull())
    if tag is not None:
        runs = runs.filter(F.col("tag") == tag)
    return runs.orderBy(F.desc("sequence")).first()


def read_table(spark: SparkSession, root: str, table: str, tag: str | None = None, sample: bool = False) -> DataFrame:
    """A table of the newest committed run."""
    run = newest_run(spark, root, tag, sample)
    if run is None or table not in {t["name"] for t in run["tables"]}:
        raise PublicationError(f"no committed run holds {table}")
    return spark.read.parquet(f"{root.rstrip('/')}/{run['folder']}/{table}")


def verify_run(spark: SparkSession, root: str, run) -> DataFrame:
    """The tables of a committed run read again: (table, check, expected, found, ok)."""
    rows = []
    for table in run["tables"]:
        df = spark.read.parquet(f"{root.rstrip('/')}/{run['folder']}/{table['name']}")
        found = df.agg(*content(df)).first()
        for check in ("rows", "checksum"):
            expected, got = str(table[check]), str(found[check])
            rows.append((table["name"], check, expected, got, expected == got))
    return spark.createDataFrame(rows, "table string, check string, expected string, found string, ok boolean")


def run_log(spark: SparkSession, root: str, metrics: Sequence[str]) -> DataFrame:
    """The history that gates and comparisons read: the last commit of every tag, with the status the tag had before."""
    runs = committed_runs(spark, root).select(
        "sequence", "run_id", "tag", "sample", "status", "trained_at", *[F.col("metrics")[m].alias(m) for m in metrics])
    last = gates.latest(runs, "sequence", ["tag", "sample"])
    decided = runs.filter(F.col("status").isNotNull()).groupBy("tag", F.col("sample").alias("_sample")).agg(
        F.max_by("status", "sequence").alias("_status"))
    same = (F.col("l.tag") == F.col("d.tag")) & F.col("sample").eqNullSafe(F.col("_sample"))
    joined = last.alias("l").join(decided.alias("d"), same, "left")
    return joined.select("l.*", "_status").withColumn(
        "status", F.coalesce("status", "_status", F.lit(K.ACCEPTED))).drop("_status", "sequence")


def uncommitted(spark: SparkSession, root: str) -> dict[str, int]:
    """Run folders that no commit names, with the time of their last change."""
    known = {r["run_id"] for r in committed_runs(spark, root).select("run_id").collect()}
    return {name: at for name, at in _children(spark, f"{root.rstrip('/')}/runs").items() if name not in known}


def sweep(spark: SparkSession, root: str, before_ms: int) -> list[str]:
    """Remove what interrupted writers left before the given time; younger folders may belong to a writer at work."""
    old = sorted(name for name, at in uncommitted(spark, root).items() if at < before_ms)
    for name in old:
        context, target = _file_context(spark, f"{root.rstrip('/')}/runs/{name}")
        context.delete(target, True)
    return old
