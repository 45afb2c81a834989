"""Hierarchical multi-length packing of token ids into power-of-two windows, without a shuffle."""

from __future__ import annotations

import zlib
from bisect import bisect_right, insort
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm import bpe
from riskloom.llm.common import python_ready
from riskloom.llm.token_counts import merge_ragged

#: Context sizes of the tiers; the longest is the window of long documents.
TIERS = (256, 512, 1024, 2048)
#: Pieces that wait in one task before windows are closed.
WAITING = 4096
#: Windows of the longest tier whose tokens make one step.
STEP_WINDOWS = 32
#: Step groups that fill side by side.
OPEN_STEPS = 4
#: Bits of an id below the partition's number.
LOCAL_BITS = 33

_UNITS: dict[object, bpe.Units] = {}


def ids_of_pieces(vocabulary: bpe.Vocabulary, pieces: list[bytes]) -> list[bytes]:
    ids, counts = merge_ragged(vocabulary, pieces)
    whole, ends = ids.astype("<u4").tobytes(), (4 * np.cumsum(counts)).tolist()
    return [whole[a:b] for a, b in zip([0, *ends], ends)]


class Piece:
    """Some ids of one document, from `start` on."""

    __slots__ = ("doc", "doc_tokens", "start", "ids")

    def __init__(self, doc, doc_tokens: int, start: int, ids: bytes):
        self.doc, self.doc_tokens, self.start, self.ids = doc, doc_tokens, start, ids

    def __len__(self) -> int:
        return len(self.ids) // 4

    def cut(self, size: int) -> tuple[Piece, Piece]:
        return (
            Piece(self.doc, self.doc_tokens, self.start, self.ids[: 4 * size]),
            Piece(self.doc, self.doc_tokens, self.start + size, self.ids[4 * size :]),
        )


class Pool:
    """Waiting pieces of one tier, ordered by length."""

    def __init__(self):
        self.sizes: list[tuple[int, int]] = []
        self.pieces: dict[int, Piece] = {}
        self.next = 0

    def __len__(self) -> int:
        return len(self.sizes)

    def add(self, piece: Piece) -> None:
        insort(self.sizes, (len(piece), self.next))
        self.pieces[self.next] = piece
        self.next += 1

    def take(self, at: int = -1) -> Piece:
        return self.pieces.pop(self.sizes.pop(at)[1])

    def largest_within(self, size: int) -> Piece | None:
        at = bisect_right(self.sizes, (size, self.next)) - 1
        return self.take(at) if at >= 0 else None


class Packer:
    """Packs the documents of one partition; finished sequences come out as lists of pieces."""

    def __init__(self, tiers: Sequence[int]):
        self.tiers = sorted(tiers)
        self.pools = [Pool() for _ in self.tiers]

    def add(self, doc, ids: bytes) -> Iterator[list[Piece]]:
        """Whole windows of a long document go out as they are; what is left waits in the tier it fits."""
        whole = Piece(doc, len(ids) // 4, 0, ids)
        longest = self.tiers[-1]
        n = len(whole)
        for start in range(0, n - longest + 1, longest):
            yield [Piece(doc, n, start, ids[4 * start : 4 * (start + longest)])]
        rest = n % longest
        if rest:
            self.wait(Piece(doc, n, n - rest, ids[4 * (n - rest) :]))
        if sum(map(len, self.pools)) >= WAITING:
            yield from self.close(WAITING // 4)

    def wait(self, piece: Piece) -> None:
        self.pools[next(k for k, t in enumerate(self.tiers) if len(piece) <= t)].add(piece)

    def close(self, leave: int) -> Iterator[list[Piece]]:
        """Fill windows, longest tier first, until no more than `leave` pieces wait."""
        while sum(map(len, self.pools)) > leave:
            tier = max(k for k, pool in enumerate(self.pools) if len(pool))
            window = [self.pools[tier].take()]
            gap = self.tiers[tier] - len(window[0])
            while gap and (piece := self.filler(tier, gap)):
                window.append(piece)
                gap -= len(piece)
            if gap:  # nothing else waits in this partition
                yield from self.rest(window)
            else:
                yield window

    def filler(self, tier: int, gap: int) -> Piece | None:
        """The largest piece of a shorter tier that fits the gap, else the begin of one that is cut for it."""
        for k in range(tier - 1, -1, -1):
            if piece := self.pools[k].largest_within(gap):
                return piece
        if piece := self.pools[tier].largest_within(gap):
            return piece
        for pool in self.pools[: tier + 1]:
            if len(pool):
                piece, after = pool.take(0).cut(gap)
                self.wait(after)
                return piece
        return None

    def rest(self, window: list[Piece]) -> Iterator[list[Piece]]:
        """The last ids of a partition, in sequences of a power of two."""
        left = sum(map(len, window))
        while left:
            size = 1 << (left.bit_length() - 1)
            left -= size
            out = []
            while size:
                piece = window.pop(0)
                if len(piece) > size:
                    piece, after = piece.cut(size)
                    window.insert(0, after)
                out.append(piece)
                size -= len(piece)
            yield out


class Steps:
    """Deals finished sequences to step groups: the open group with the fewest tokens gets the next one."""

    def __init__(self, tokens: int):
        self.tokens = tokens
        self.open = {k: 0 for k in range(OPEN_STEPS)}
        self.next = OPEN_STEPS

    def group(self, size: int) -> int:
        k = min(self.open, key=lambda g: (self.open[g], g))
        self.open[k] += size
        if self.open[k] >= self.tokens:
            del self.open[k]
            self.open[self.next] = 0
            self.next += 1
        return k


NAMES = (
    "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "sequence_tokens", "step_group",
)


def units_of(key, vocabulary: bpe.Vocabulary, pattern: str) -> bpe.Units:
    if key not in _UNITS:
        _UNITS.clear()
        special = {s: int(k).to_bytes(4, "little") for s, k in vocabulary.special.items()}
        _UNITS[key] = bpe.Units(pattern, lambda p: ids_of_pieces(vocabulary, p), b"".join, special)
    return _UNITS[key]


def pack(
    documents: DataFrame,
    vocabulary_path: str,
    pattern: str,
    end_id: int,
    tiers: Sequence[int] = TIERS,
    id_col: str = "doc_id",
    text_col: str = "text",
    with_ids: bool = False,
) -> DataFrame:
    """One row per piece: the ids `start` to `start + length` of a document lie at `offset` of `sequence_id`.

    Every text is tokenised with the .json vocabulary and ends with `end_id`. Whole windows of the longest tier are cut
    from long documents; the rest of each goes to the tier it fits, each tier's windows are filled with the largest
    pieces of shorter tiers that fit, and the last gap is closed by cutting one piece. The last ids of a partition
    become sequences of powers of two, so no sequence needs padding. Sequences belong to step groups of equal tokens.

    Each input partition is packed by itself in one pass, so nothing is shuffled, and a task that runs again gives the
    same ids. Null and empty texts are the end id alone; null ids and repeated rows are documents like any other;
    other columns are ignored. An empty table gives no rows. with_ids: also the ids of each piece.
    """
    spark = documents.sparkSession
    python_ready(spark)
    shared = spark.sparkContext.broadcast(bpe.from_json(vocabulary_path))
    key = (vocabulary_path, pattern)
    end = int(end_id).to_bytes(4, "little")
    rows = documents.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    names = [*NAMES, "ids"] if with_ids else list(NAMES)

    def packed(batches):
        units = units_of(key, shared.value, pattern)
        packer, steps = Packer(tiers), Steps(STEP_WINDOWS * max(tiers))
        first = TaskContext.get().partitionId() << LOCAL_BITS
        number, kind = 0, None

        def batch_of(sequences: list[list[Piece]]) -> pa.RecordBatch:
            nonlocal number
            columns: list[list] = [[] for _ in names]
            for pieces in sequences:
                size = sum(map(len, pieces))
                step, offset = first + steps.group(size), 0
                for p in pieces:
                    values = (
                        p.doc, p.start, len(p), zlib.crc32(p.ids), p.doc_tokens, first + number, offset, size, step, p.ids
                    )
                    for column, value in zip(columns, values):
                        column.append(value)
                    offset += len(p)
                number += 1
            kinds = [kind, *[pa.int64()] * (len(NAMES) - 1), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

        for batch in batches:
            kind = batch.column(0).type
            found = []
            ids = units.values([t or "" for t in batch.column(1).to_pylist()])
            for doc, own in zip(batch.column(0).to_pylist(), ids):
                found.extend(packer.add(doc, own + end))
            yield batch_of(found)
        if kind is not None:
            yield batch_of(list(packer.close(0)))

    kind = rows.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, " + ", ".join(f"{n} long" for n in NAMES[1:]) + ", ids binary" * with_ids
    return rows.mapInArrow(packed, schema)
