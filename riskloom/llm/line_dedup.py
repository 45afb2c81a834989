"""Line dedup: sorted line hashes, streamed once, give a compressed keep bitmap per document."""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from riskloom.llm.common import LOWER, SPACES, UPPER, python_ready, stage

#: Kinds of marks: a line to drop, a line whose run of equal keys may go on in a neighbouring task, and the summary of
#: such a run.
DROP, OPEN, EDGE = 0, 1, 2
MARKS = pa.schema([
    ("kind", pa.int32()), ("doc_id", pa.int64()), ("text_hash", pa.int64()), ("pos", pa.int32()),
    ("n_lines", pa.int32()), ("key_hash", pa.binary()), ("starts", pa.bool_()), ("part", pa.int32()),
    ("docs", pa.int64()), ("last_doc", pa.int64()),
])
MARKS_SQL = (
    "kind int, doc_id long, text_hash long, pos int, n_lines int, key_hash binary, starts boolean, part int, "
    "docs long, last_doc long"
)
ROWS_PER_BATCH = 8192


def line_key(line: Column) -> Column:
    """White space stripped at both ends, A-Z lower-cased."""
    return F.translate(F.btrim(line, F.lit(SPACES)), UPPER, LOWER)


def lines_of(documents: DataFrame, min_chars: int) -> DataFrame:
    """doc_id, text_hash, n_lines, pos, key_hash of every line whose key has min_chars code points or more."""
    lines = F.split(F.coalesce("text", F.lit("")), "\n", -1)
    rows = documents.select("doc_id", F.xxhash64("text").alias("text_hash"), lines.alias("lines"))
    rows = rows.select("doc_id", "text_hash", F.size("lines").alias("n_lines"), F.posexplode("lines").alias("pos", "line"))
    rows = rows.withColumn("key", line_key(F.col("line"))).where(F.length("key") >= min_chars)
    return rows.select(
        "doc_id", "text_hash", "n_lines", "pos", F.unhex(F.md5(F.col("key").cast("binary"))).alias("key_hash")
    )


class Marks:
    """Collects marks and hands them out in batches."""

    def __init__(self, part: int):
        self.part = part
        self.rows: list[tuple] = []

    def line(self, kind: int, row: tuple, starts: bool) -> None:
        key, doc, text_hash, pos, n_lines = row
        self.rows.append((kind, doc, text_hash, pos, n_lines, key if kind == OPEN else None, starts, self.part, 0, None))

    def edge(self, key: bytes, docs: int, first_doc, last_doc) -> None:
        self.rows.append((EDGE, first_doc, 0, 0, 0, key, False, self.part, docs, last_doc))

    def batch(self) -> pa.RecordBatch:
        columns = list(zip(*self.rows)) if self.rows else [()] * len(MARKS)
        self.rows = []
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, MARKS)], schema=MARKS)


def marker(min_docs: int, keep_first: bool):
    """Streams one range of (key hash, document, position) and marks the lines to drop.

    Held in memory are only lines of a run that has fewer than min_docs documents so far. The first and the last run of
    a range can reach into the neighbouring ranges: what is undecided there goes out as OPEN, with an EDGE summary.
    """

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marks = Marks(TaskContext.get().partitionId())
        key, docs, first_doc, last_doc, first_run, waiting = None, 0, None, None, True, []

        def close(edge: bool) -> None:
            if edge and key is not None:
                for row in waiting:
                    marks.line(OPEN, row, False)
                marks.edge(key, docs, first_doc, last_doc)
            waiting.clear()

        for batch in batches:
            for row in zip(*(batch.column(k).to_pylist() for k in range(5))):
                starts = row[0] != key
                if starts:
                    close(first_run)
                    first_run = key is None
                    key, docs, first_doc, last_doc = row[0], 1, row[1], row[1]
                elif row[1] != last_doc:
                    docs, last_doc = docs + 1, row[1]
                if first_run:
                    marks.line(OPEN, row, starts)
                elif not (starts and keep_first):
                    if docs < min_docs:
                        waiting.append(row)
                    else:
                        for held in waiting:
                            marks.line(DROP, held, False)
                        waiting.clear()
                        marks.line(DROP, row, False)
                if len(marks.rows) >= ROWS_PER_BATCH:
                    yield marks.batch()
        close(True)
        yield marks.batch()

    return mark


def dropped_lines(documents: DataFrame, min_docs: int, min_chars: int, keep_first: bool) -> DataFrame:
    """doc_id, text_hash, n_lines, pos of every line that goes. documents: doc_id, text."""
    python_ready(documents.sparkSession)
    lines = stage(lines_of(documents, min_chars), "lines")
    order = ["key_hash", "doc_id", "pos"]
    sorted_lines = lines.repartitionByRange(*order).sortWithinPartitions(*order)
    marks = stage(
        sorted_lines.select("key_hash", "doc_id", "text_hash", "pos", "n_lines").mapInArrow(
            marker(min_docs, keep_first), MARKS_SQL
        ),
        "marks",
    )
    # two summaries a range at most
    in_order = Window.partitionBy("key_hash").orderBy("part")
    shares = F.col("doc_id").eqNullSafe(F.lag("last_doc").over(in_order)) & (F.row_number().over(in_order) > 1)
    edges = (
        marks.where(F.col("kind") == EDGE)
        .withColumn("own", F.col("docs") - F.when(shares, 1).otherwise(0))
        .groupBy("key_hash")
        .agg(F.sum("own").alias("run_docs"), F.min("part").alias("first_part"))
    )
    really_first = F.col("starts") & (F.col("part") == F.col("first_part"))
    goes = F.col("run_docs") >= min_docs
    if keep_first:
        goes &= ~really_first
    settled = marks.where(F.col("kind") == OPEN).join(F.broadcast(edges), "key_hash").where(goes)
    columns = ["doc_id", "text_hash", "n_lines", "pos"]
    return marks.where(F.col("kind") == DROP).select(columns).unionByName(settled.select(columns))


def pack_bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        packed = []
        for n, places in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
            keep = np.ones(n, np.uint8)
            keep[places] = 0
            packed.append(zlib.compress(np.packbits(keep).tobytes()))
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(k) for k in range(3)), pa.array(packed, pa.binary())],
            names=["doc_id", "text_hash", "n_lines", "keep_bitmap"],
        )


def keep_bitmaps(
    documents: DataFrame,
    min_docs: int = 2,
    min_chars: int = 1,
    keep_first: bool = True,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """doc_id, text_hash, n_lines, keep_bitmap of each document that loses a line.

    A line's key is the line stripped of ASCII white space with A-Z lower-cased. Lines whose key has at least
    `min_chars` code points and stands in at least `min_docs` documents go; with keep_first the first of them by
    (doc_id, position) stays. keep_bitmap is the zlib-compressed bits of the document's lines, 1 for a line that stays.
    A document without a bitmap keeps every line. No text leaves the scan: only 128-bit hashes are sorted.

    Lines are ranged by (hash, document, position), so one line that a third of all rows share is spread over tasks.
    Null text is one empty line. Documents are told apart by id: rows that repeat an id count once, and all rows
    without an id count as one document; each row's bitmap is found by its id and text hash. Other columns are ignored.
    """
    rows = documents.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    gone = dropped_lines(rows, min_docs, min_chars, keep_first)
    places = gone.groupBy("doc_id", "text_hash", "n_lines").agg(F.collect_set("pos").alias("pos"))
    return places.mapInArrow(pack_bits, "doc_id long, text_hash long, n_lines int, keep_bitmap binary")


def apply_bitmaps(
    documents: DataFrame, bitmaps: DataFrame, id_col: str = "doc_id", text_col: str = "text", digest: bool = False
) -> DataFrame:
    """doc_id, n_lines, n_dropped, kept (the text of the lines that stay; digest: kept_sha256) of every row."""
    python_ready(documents.sparkSession)
    rows = documents.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    rows = rows.withColumn("text_hash", F.xxhash64("text"))
    bits = bitmaps.select(F.col("doc_id").alias("bit_doc"), F.col("text_hash").alias("bit_hash"), "keep_bitmap")
    # bitmaps have no bound, so they are merged by key at every size and never broadcast
    joined = rows.join(
        bits.hint("merge"), F.col("doc_id").eqNullSafe(F.col("bit_doc")) & (F.col("text_hash") == F.col("bit_hash")), "left"
    ).select("doc_id", "text", "keep_bitmap")
    name = "kept_sha256" if digest else "kept"

    def keep(batches):
        for batch in batches:
            total, dropped, kept = [], [], []
            for text, bitmap in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                lines = (text or "").split("\n")
                n = len(lines)
                if bitmap is not None:
                    stays = np.unpackbits(np.frombuffer(zlib.decompress(bitmap), np.uint8), count=n).tolist()
                    lines = [line for line, stay in zip(lines, stays) if stay]
                text = "\n".join(lines)
                total.append(n)
                dropped.append(n - len(lines))
                kept.append(hashlib.sha256(text.encode()).hexdigest() if digest else text)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(total, pa.int64()), pa.array(dropped, pa.int64()), pa.array(kept, pa.string())],
                names=["doc_id", "n_lines", "n_dropped", name],
            )

    return joined.mapInArrow(keep, f"doc_id long, n_lines long, n_dropped long, {name} string")
