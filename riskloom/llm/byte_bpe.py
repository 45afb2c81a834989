"""Byte-level BPE encoding and decoding on length-bucketed padded matrices."""

from __future__ import annotations

import hashlib
import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm import bpe
from riskloom.llm.common import python_ready

#: Cells of one padded matrix.
CELLS = 1 << 19
#: Pieces of more bytes, such as a file without a space, merge from a heap: one round a merge would be quadratic.
WIDEST = 4096

_UNITS: dict[object, bpe.Units] = {}


def encode_pieces(vocabulary: bpe.Vocabulary, pieces: list[bytes]) -> list[bytes]:
    """The ids of each piece as little-endian unsigned 32-bit integers."""
    out: list[bytes] = [b""] * len(pieces)
    lengths = np.fromiter(map(len, pieces), np.int64, len(pieces))
    order = np.argsort(lengths, kind="stable")
    order = order[lengths[order] > 0]
    width = np.int64(2) ** np.ceil(np.log2(np.maximum(lengths[order], 1))).astype(np.int64)
    for bucket in np.unique(width):
        members = order[width == bucket]
        if bucket > WIDEST:
            for k in members:
                out[k] = merge_by_heap(vocabulary, pieces[k])
            continue
        rows = max(1, CELLS // int(bucket))
        for begin in range(0, len(members), rows):
            chunk = members[begin : begin + rows]
            for k, ids in zip(chunk, merge_matrix(vocabulary, [pieces[k] for k in chunk])):
                out[k] = ids
    return out


def merge_matrix(vocabulary: bpe.Vocabulary, pieces: list[bytes]) -> list[bytes]:
    """Every unfinished row merges its leftmost pair of least rank each round, and loses one cell by it."""
    pairs, n = vocabulary.pairs, len(pieces)
    lengths = np.fromiter(map(len, pieces), np.int64, n)
    wide = int(lengths.max())
    inside = np.arange(wide) < lengths[:, None]
    ids = np.full((n, wide), -1, np.int32)
    ids[inside] = vocabulary.of_byte[np.frombuffer(b"".join(pieces), np.uint8)]
    out: list[bytes] = [b""] * n
    rank = np.full((n, wide), bpe.NONE, np.int32)
    merged = np.zeros((n, wide), np.int32)
    r, c = np.nonzero(inside[:, 1:])
    rank[r, c], merged[r, c] = pairs.find(ids[r, c], ids[r, c + 1])
    row = np.arange(n)
    while len(row):
        at = rank.argmin(axis=1)
        here = np.arange(len(row))
        over = rank[here, at] == bpe.NONE
        if over.any():
            whole = ids[over].astype("<u4").tobytes()
            begin = 4 * ids.shape[1]
            for k, (r, size) in zip(row[over].tolist(), enumerate(lengths[over].tolist())):
                out[k] = whole[r * begin : r * begin + 4 * size]
            stay = ~over
            row, ids, rank, merged, lengths, at = (
                row[stay], ids[stay], rank[stay], merged[stay], lengths[stay], at[stay]
            )
            if not len(row):
                break
            here = np.arange(len(row))
        ids[here, at] = merged[here, at]
        keep = np.ones(ids.shape, bool)
        keep[here, at + 1] = False
        shape = (len(row), ids.shape[1] - 1)
        ids, rank, merged = ids[keep].reshape(shape), rank[keep].reshape(shape), merged[keep].reshape(shape)
        lengths = lengths - 1
        for place in (at, at - 1):
            there = (place >= 0) & (place + 1 < lengths)
            r, c = here[there], place[there]
            found, into = pairs.find(ids[r, c], ids[r, c + 1])
            rank[r, c], merged[r, c] = found, into
        last = at + 1 >= lengths
        rank[here[last], at[last]] = bpe.NONE
        # rows only get shorter: cells that no row uses any more go
        used = int(lengths.max())
        if used <= ids.shape[1] // 2:
            ids, rank, merged = ids[:, :used].copy(), rank[:, :used].copy(), merged[:, :used].copy()
    return out


def merge_by_heap(vocabulary: bpe.Vocabulary, piece: bytes) -> bytes:
    """The same order of merges for one long piece: least rank first, leftmost first."""
    pairs = vocabulary.pairs
    ids = vocabulary.of_byte[np.frombuffer(piece, np.uint8)]
    rank, into = pairs.find(ids[:-1], ids[1:])
    ids = ids.tolist()
    n = len(ids)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    known: dict[tuple[int, int], tuple[int, int]] = {}
    heap = [
        (int(r), k, ids[k], ids[k + 1], int(m)) for k, (r, m) in enumerate(zip(rank, into)) if r != bpe.NONE
    ]
    heapq.heapify(heap)

    def offer(k: int) -> None:
        if k < 0 or after[k] >= n:
            return
        pair = (ids[k], ids[after[k]])
        if pair not in known:
            found = pairs.find(np.array([pair[0]], np.int32), np.array([pair[1]], np.int32))
            known[pair] = int(found[0][0]), int(found[1][0])
        if known[pair][0] != bpe.NONE:
            heapq.heappush(heap, (known[pair][0], k, *pair, known[pair][1]))

    while heap:
        _, k, left, right, new = heapq.heappop(heap)
        if ids[k] != left or after[k] >= n or ids[after[k]] != right:
            continue
        gone = after[k]
        ids[k], ids[gone], after[k] = new, -1, after[gone]
        if after[k] < n:
            before[after[k]] = k
        offer(k)
        offer(before[k])
    return np.array([x for x in ids if x >= 0], "<u4").tobytes()


def decode(vocabulary: bpe.Vocabulary, ids: bytes) -> bytes:
    return b"".join(map(vocabulary.symbols.__getitem__, np.frombuffer(ids, "<u4").tolist()))


def units_of(key, vocabulary: bpe.Vocabulary, pattern: str) -> bpe.Units:
    if key not in _UNITS:
        _UNITS.clear()
        _UNITS[key] = bpe.Units(pattern, lambda p: encode_pieces(vocabulary, p), b"".join)
    return _UNITS[key]


def encode_and_decode(
    documents: DataFrame,
    ranks_path: str,
    pattern: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    digests: bool = False,
) -> DataFrame:
    """doc_id, n_tokens, ids (little-endian unsigned 32-bit), decoded (bytes) of every row; digests: SHA-256 of both.

    Every match of `pattern` is encoded by itself, without special tokens. Null text counts as empty, a null id stays
    null, repeated rows are encoded each, other columns are ignored and an empty table gives no rows.
    """
    spark = documents.sparkSession
    python_ready(spark)
    shared = spark.sparkContext.broadcast(bpe.from_ranks(ranks_path))
    key = (ranks_path, pattern)
    names = ["ids_sha256", "decoded_sha256"] if digests else ["ids", "decoded"]

    def encode(batches):
        vocabulary = shared.value
        units = units_of(key, vocabulary, pattern)
        for batch in batches:
            ids = units.values([t or "" for t in batch.column(1).to_pylist()])
            decoded = [decode(vocabulary, x) for x in ids]
            n = pa.array([len(x) // 4 for x in ids], pa.int64())
            if digests:
                ids, decoded = ([hashlib.sha256(x).hexdigest() for x in v] for v in (ids, decoded))
            kind = pa.string() if digests else pa.binary()
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), n, pa.array(ids, kind), pa.array(decoded, kind)],
                names=["doc_id", "n_tokens", *names],
            )

    rows = documents.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    value = "string" if digests else "binary"
    return rows.mapInArrow(encode, f"doc_id {kind}, n_tokens long, {names[0]} {value}, {names[1]} {value}")
