"""Running streams: file sources, scoring a queue, drift per micro-batch, draining to a table."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from riskloom.operators import drift
from riskloom.operators.learning import Bundle
from riskloom.session import scratch_path
from riskloom.sources import writers


def parquet_stream(spark: SparkSession, folder: str, schema: T.StructType, files: str = "*.parquet", per_batch: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(schema).option("pathGlobFilter", files)
    if per_batch:
        reader = reader.option("maxFilesPerTrigger", per_batch)
    return reader.parquet(folder)


def start_to_parquet(df: DataFrame, path: str, checkpoint: str, available_now: bool = True) -> StreamingQuery:
    writer = df.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start(path)


def drain(df: DataFrame, name: str = "stream") -> DataFrame:
    """Process everything available, then read the sink back."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    start_to_parquet(df, path, scratch_path(spark, f"{name}-checkpoint")).awaitTermination()
    return spark.read.schema(df.schema).parquet(path)


def score_queue(stream: DataFrame, bundle: Bundle, threshold: float | None = None) -> DataFrame:
    """Incoming client rows (text columns) with probability, decision and score band."""
    return writers.score_batch(stream, bundle, threshold)


def drift_per_batch(
    stream: DataFrame, cuts: dict[str, list[float]], frozen: Sequence[tuple[str, int, int]], path: str, checkpoint: str,
) -> StreamingQuery:
    """PSI of every micro-batch against frozen reference cuts and counts, appended to a table."""

    def measure(batch: DataFrame, batch_id: int) -> None:
        report = drift.psi_against(batch, cuts, frozen).withColumn("batch_id", F.lit(batch_id))
        # one folder per batch: a repeated batch replaces its own rows
        report.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return for_each_batch(stream, measure, checkpoint)


def for_each_batch(stream: DataFrame, work: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    return stream.writeStream.foreachBatch(work).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def csv_stream(spark: SparkSession, folder: str, columns: Sequence[str]) -> DataFrame:
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    return spark.readStream.schema(schema).option("header", True).option("escape", '"').csv(folder)
