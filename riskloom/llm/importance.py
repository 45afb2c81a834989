"""Importance resampling towards a target: hashed n-gram counts from overlapped regex scans."""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import python_ready, stage

#: What lies between words: all of ASCII but digits and lower-case letters (texts are lower-cased before).
SEPARATORS = regex.compile(rb"[\x00-\x2F\x3A-\x60\x7B-\x7F]+")
#: Ranges of ids that the rows of one score are dealt into to be numbered, and ids looked at to cut them.
RANGES, LOOKED_AT = 64, 4096
#: Parts of the rows that share score and id.
PARTS = 64


def scans(longest: int) -> list:
    """One pattern for each number of words; it matches at every begin of a word."""
    return [
        regex.compile(rb"(?<![^ ])[^ ]++" + rb"(?: [^ ]++){%d}" % (k - 1) + rb"(?![^ ])") for k in range(1, longest + 1)
    ]


def features(text: str | None, patterns: Sequence) -> tuple[int, list[int]]:
    """Number of words, and the crc32 of every run of words."""
    flat = SEPARATORS.sub(b" ", (text or "").encode().lower()).strip(b" ")  # bytes are lower-cased in A-Z only
    crc = zlib.crc32
    found = [[crc(m[0]) for m in p.finditer(flat, overlapped=True)] for p in patterns]
    return len(found[0]), [c for own in found for c in own]


def bucketed(rows: DataFrame, buckets: int, longest: int, with_id: bool) -> DataFrame:
    """n_words and buckets (unsigned 32-bit or, for few buckets, 16-bit numbers) of each text. rows: [doc_id,] text."""
    patterns = scans(longest)
    width = np.dtype("<u2") if buckets <= 1 << 16 else np.dtype("<u4")

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_words, packed = [], []
            for text in batch.column(batch.num_columns - 1).to_pylist():
                n, codes = features(text, patterns)
                n_words.append(n)
                packed.append((np.array(codes, np.uint32) % np.uint32(buckets)).astype(width).tobytes())
            arrays = [*batch.columns[:-1], pa.array(n_words, pa.int64()), pa.array(packed, pa.binary())]
            yield pa.RecordBatch.from_arrays(arrays, names=[*batch.schema.names[:-1], "n_words", "buckets"])

    ids = f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, " if with_id else ""
    return rows.mapInArrow(scan, ids + "n_words long, buckets binary")


def bucket_totals(scanned: DataFrame, buckets: int) -> np.ndarray:
    """How often each bucket stands in all texts: summed in the tasks, then by bucket."""
    width = "<u2" if buckets <= 1 << 16 else "<u4"

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for b in batch.column(0).to_pylist():
                total += np.bincount(np.frombuffer(b, width), minlength=buckets)
        there = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(there), pa.array(total[there])], names=["bucket", "n"])

    sums = scanned.select("buckets").mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(buckets, np.int64)
    for r in sums.collect():  # at most `buckets` rows
        out[r.bucket] = r.n
    return out


def gains_of(own: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 * log of target share to own share), every bucket counted once more."""
    buckets = len(own)
    s_all, t_all = float(own.sum() + buckets), float(target.sum() + buckets)
    return np.array(
        [math.floor(1000 * math.log((t + 1.0) * s_all / ((s + 1.0) * t_all))) for s, t in zip(own.tolist(), target.tolist())],
        np.int64,
    )


def weighed(scanned: DataFrame, gains: np.ndarray) -> DataFrame:
    """doc_id, n_words, n_features and weight, the floored mean of the gains of a document's features."""
    shared = scanned.sparkSession.sparkContext.broadcast(gains)
    width = "<u2" if len(gains) <= 1 << 16 else "<u4"

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gain = shared.value
        for batch in batches:
            found = [np.frombuffer(b, width) for b in batch.column(2).to_pylist()]
            n = [len(b) for b in found]
            weight = [int(gain[b].sum()) // len(b) if len(b) else 0 for b in found]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(n, pa.int64()), pa.array(weight, pa.int64())],
                names=["doc_id", "n_words", "n_features", "weight"],
            )

    kind = scanned.schema["doc_id"].dataType.simpleString()
    rows = scanned.select("doc_id", "n_words", "buckets")
    return rows.mapInArrow(weigh, f"doc_id {kind}, n_words long, n_features long, weight long")


def gumbel(doc_id: Column, seed: int) -> Column:
    """Noise of a document in thousandths, from a hash of seed and id; a null id hashes as an empty one."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))


def numbered(rows: DataFrame, row: str) -> DataFrame:
    """rows with `_at`, the place by (score descending, doc_id, nulls last, `row`) from 1 on.

    No range is larger than a score's share of one id range: counts of scores (whole numbers, so few) and of ranges
    within a score are added up, and rows that share both score and id are dealt into parts.
    """
    spark = rows.sparkSession
    seen = [r.doc_id for r in rows.where("doc_id is not null").select("doc_id", F.xxhash64("doc_id").alias("h"))
            .distinct().orderBy("h").limit(LOOKED_AT).collect()]
    cuts = sorted(seen)[:: max(1, len(seen) // RANGES)]
    # cuts steer only how the work is dealt, never the order
    span = F.when(F.col("doc_id").isNull(), F.lit(len(cuts) + 1)).otherwise(
        sum((F.col("doc_id") >= F.lit(c)).cast("int") for c in cuts) if cuts else F.lit(0))
    dealt = rows.withColumns({"_span": span, "_part": F.pmod(F.xxhash64(row), F.lit(PARTS))})
    cells = dealt.groupBy("score", "_span", "doc_id", "_part").agg(F.count(F.lit(1)).alias("_n"))
    scores = rows.groupBy("score").count().orderBy(F.desc("score")).collect()
    above, upto = [], 0
    for r in scores:  # a score is a whole number within the bounds of the gains and the noise
        above.append((r["score"], upto))
        upto += r["count"]
    above = spark.createDataFrame(above, "score long, _above long")
    spans = dealt.groupBy("score", "_span").agg(F.count(F.lit(1)).alias("_n"))
    before = F.expr("coalesce(sum(_n) over (partition by score order by _span rows between unbounded preceding and 1 preceding), 0)")
    spans = spans.withColumn("_before", before).join(above, "score").select(
        "score", "_span", (F.col("_above") + F.col("_before")).alias("_base"))
    inside = F.expr("""coalesce(sum(_n) over (partition by score, _span order by doc_id nulls last, _part
        rows between unbounded preceding and 1 preceding), 0)""")
    cells = cells.withColumn("_inside", inside).join(spans, ["score", "_span"])
    cells = cells.select("score", F.col("doc_id").alias("_id"), F.col("_part").alias("_p"), (F.col("_base") + F.col("_inside")).alias("_first"))
    own = F.expr(f"row_number() over (partition by score, doc_id, _part order by `{row}`)")
    last = dealt.withColumn("_own", own).join(
        cells.withColumnRenamed("score", "_s"),
        (F.col("score") == F.col("_s")) & F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_part") == F.col("_p")))
    return last.withColumn("_at", F.col("_first") + F.col("_own")).drop(
        "_span", "_part", "_s", "_id", "_p", "_first", "_own")


def importance_resample(
    documents: DataFrame,
    target: DataFrame,
    percent: int = 25,
    longest: int = 2,
    buckets: int = 10_000,
    min_words: int = 20,
    seed: int = 7,
    id_col: str = "doc_id",
    text_col: str = "text",
    target_col: str = "text",
) -> DataFrame:
    """One row per document: doc_id, n_words, n_features, weight, score, rank.

    Words are runs of digits, of letters (A-Z lower-cased) and of characters beyond ASCII. Features are the runs of 1
    to `longest` words, as often as they stand there, in `buckets` by crc32. A bucket's gain compares its share of all
    target texts with its share of all documents; weight is the floored mean gain of a document's features. To that
    comes noise from a hash of seed and id, which turns the highest scores into a draw without replacement. Of the
    documents with `min_words` words or more, floor(percent / 100) are drawn: rank 1, 2, ... by score, ties to the
    smaller id, null ids last. Documents that are not drawn have a null rank.

    Null and empty texts have no features and weight 0. Whole texts are read; each of some repeated rows is a document
    of its own and they take consecutive ranks; a null id gets the noise of an empty one. Other columns are ignored,
    an empty table gives no rows, and without target texts every bucket stands there equally.
    """
    spark = documents.sparkSession
    python_ready(spark)
    rows = documents.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    scanned = stage(bucketed(rows, buckets, longest, True), "importance-buckets")
    aims = bucketed(target.select(F.col(target_col).alias("text")), buckets, longest, False)
    gains = gains_of(bucket_totals(scanned, buckets), bucket_totals(aims, buckets))
    marked = weighed(scanned, gains).withColumn("score", F.col("weight") + gumbel(F.col("doc_id"), seed))
    scored = stage(marked.withColumn("_row", F.monotonically_increasing_id()), "importance-scores")
    usable = scored.where(F.col("n_words") >= min_words)
    counts = sorted(usable.groupBy("score").count().collect(), key=lambda r: -r["score"])
    drawn = percent * sum(r["count"] for r in counts) // 100
    upto, cut = 0, None
    for r in counts:
        if upto >= drawn:
            break
        upto, cut = upto + r["count"], r["score"]
    if cut is None:
        return scored.withColumn("rank", F.lit(None).cast("long")).drop("_row")
    near = numbered(usable.where(F.col("score") >= cut), "_row")
    rank = F.when(F.col("_at") <= drawn, F.col("_at"))
    rest = scored.where((F.col("n_words") < min_words) | (F.col("score") < cut))
    out = near.withColumn("rank", rank.cast("long")).drop("_at").unionByName(rest.withColumn("rank", F.lit(None).cast("long")))
    return out.select("doc_id", "n_words", "n_features", "weight", "score", "rank")
