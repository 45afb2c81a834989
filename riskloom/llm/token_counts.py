"""Token counts by rank-synchronous merging of ragged numpy arrays."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm import bpe
from riskloom.llm.common import python_ready

#: Symbols that are merged together in one ragged array.
SYMBOLS_PER_CALL = 1 << 20

_UNITS: dict[object, bpe.Units] = {}


def merge_ragged(vocabulary: bpe.Vocabulary, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Token ids of all pieces in one array, and the number of tokens of each piece.

    Each round every unfinished piece applies its own lowest-rank pair to all places where it stands. That equals
    merging one place at a time wherever a merged symbol only takes part in later merges, as in a merge list.
    """
    counts = np.zeros(len(pieces), np.int64)
    done_ids, done_piece = [], []
    begin = 0
    while begin < len(pieces):
        end, held = begin, 0
        while end < len(pieces) and (held == 0 or held + len(pieces[end]) <= SYMBOLS_PER_CALL):
            held += len(pieces[end])
            end += 1
        for ids, piece in _merge(vocabulary, pieces[begin:end]):
            done_ids.append(ids)
            done_piece.append(piece + begin)
        begin = end
    if not done_ids:
        return np.zeros(0, np.int32), counts
    ids, piece = np.concatenate(done_ids), np.concatenate(done_piece)
    np.add.at(counts, piece, 1)
    return ids[np.argsort(piece, kind="stable")], counts


def _merge(vocabulary: bpe.Vocabulary, pieces: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(ids, piece of each id) of the pieces that a round finds finished."""
    pairs = vocabulary.pairs
    lengths = np.fromiter(map(len, pieces), np.int64, len(pieces))
    ids = vocabulary.of_byte[np.frombuffer(b"".join(pieces), np.uint8)]
    piece = np.repeat(np.arange(len(pieces)), lengths)
    rank = np.full(len(ids), bpe.NONE, np.int32)
    merged = np.zeros(len(ids), np.int32)
    same = np.flatnonzero(piece[1:] == piece[:-1])
    rank[same], merged[same] = pairs.find(ids[same], ids[same + 1])
    while len(ids):
        starts = np.flatnonzero(np.concatenate(([True], piece[1:] != piece[:-1])))
        sizes = np.diff(np.append(starts, len(ids)))
        lowest = np.minimum.reduceat(rank, starts)
        over = lowest == bpe.NONE
        if over.any():
            gone = np.repeat(over, sizes)
            yield ids[gone], piece[gone]
            stay = ~gone
            ids, piece, rank, merged = ids[stay], piece[stay], rank[stay], merged[stay]
            sizes, lowest = sizes[~over], lowest[~over]
            if not len(ids):
                return
        at = np.flatnonzero(rank == np.repeat(lowest, sizes))
        # of places that overlap, as in "aaa", every second one counts from the left
        joined = np.concatenate(([False], (at[1:] == at[:-1] + 1) & (piece[at[1:]] == piece[at[:-1]])))
        run = np.flatnonzero(~joined)
        offset = np.arange(len(at)) - np.repeat(run, np.diff(np.append(run, len(at))))
        at = at[offset % 2 == 0]
        ids[at] = merged[at]
        keep = np.ones(len(ids), bool)
        keep[at + 1] = False
        place = at - np.arange(len(at))  # each merge before it removed one symbol
        ids, piece, rank, merged = ids[keep], piece[keep], rank[keep], merged[keep]
        changed = np.concatenate((place, place[place > 0] - 1))
        rank[changed] = bpe.NONE
        changed = changed[changed + 1 < len(ids)]
        changed = changed[piece[changed] == piece[changed + 1]]
        rank[changed], merged[changed] = pairs.find(ids[changed], ids[changed + 1])


def count_pieces(vocabulary: bpe.Vocabulary, pieces: list[bytes]) -> list[int]:
    return merge_ragged(vocabulary, pieces)[1].tolist()


def units_of(key, vocabulary: bpe.Vocabulary, pattern: str) -> bpe.Units:
    """The worker's table of counts for one vocabulary."""
    if key not in _UNITS:
        _UNITS.clear()
        _UNITS[key] = bpe.Units(pattern, lambda p: count_pieces(vocabulary, p), sum, dict.fromkeys(vocabulary.special, 1))
    return _UNITS[key]


def token_counts(
    documents: DataFrame,
    vocabulary_path: str,
    pattern: str,
    limit: int = 1024,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per input row: doc_id, n_bytes, n_tokens, over_limit.

    Counts are those of the byte-level .json vocabulary without added tokens; its special strings inside a text count
    as one token. Null text counts as empty with 0 tokens, a null id stays null, repeated rows are counted each, other
    columns are ignored and an empty table gives no rows. A text is never cut.
    """
    spark = documents.sparkSession
    python_ready(spark)
    shared = spark.sparkContext.broadcast(bpe.from_json(vocabulary_path))
    key = (vocabulary_path, pattern)

    def count(batches):
        units = units_of(key, shared.value, pattern)
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            n = np.array(units.values(texts), np.int64)
            size = np.array([len(t.encode()) for t in texts], np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(size), pa.array(n), pa.array(n > limit)],
                names=["doc_id", "n_bytes", "n_tokens", "over_limit"],
            )

    rows = documents.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(count, f"doc_id {kind}, n_bytes long, n_tokens long, over_limit boolean")
