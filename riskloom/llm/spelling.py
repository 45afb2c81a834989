"""Spelling variants: words one edit apart, found in tries of letter-group counts."""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import python_ready, stage

#: Letters fall into this many groups by their code point; the order in which a trie asks for the groups' counts.
GROUPS = 16
ORDER = (5, 1, 14, 9, 4, 15, 2, 3, 8, 12, 13, 7, 6, 0, 10, 11)
#: Words of a trie node that are verified one by one instead of being split further.
LEAF = 24
#: Words, and words looked up, of one trie at most.
BLOCK = 20_000
#: Distinct words a task counts before it hands them on.
HELD = 500_000
#: Bytes that one comparison of words takes at most.
COMPARED = 1 << 22

#: Every letter of a word: a-z and U+00C0 to U+00FF. One code point is one byte of Latin-1.
LETTERS = "".join(map(chr, [*range(0x61, 0x7B), *range(0xC0, 0x100)]))


# ---------------------------------------------------------------- words


def word_counts(
    documents: DataFrame, min_chars: int, lost_every: int | None, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """word, n: how often each run of letters of at least `min_chars` code points stands in the texts.

    Only A-Z are lower-cased. lost_every: where it divides the crc32 of `<id>:<run>`, the run loses one code point, at
    that crc32 modulo its length; rows without an id lose none.
    """
    runs = re.compile("[a-zÀ-ÿ]{%d,}" % min_chars)
    rows = documents.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).where("text is not null")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(list(seen), pa.string()), pa.array(list(seen.values()), pa.int64())], names=["word", "n"])

        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                own = Counter(runs.findall(text.encode().lower().decode()))  # bytes are lower-cased in A-Z only
                if lost_every and doc is not None:
                    begin = zlib.crc32(f"{doc}:".encode())
                    for run, n in list(own.items()):
                        h = zlib.crc32(run.encode(), begin)
                        if h % lost_every == 0:
                            at = h % len(run)
                            left = run[:at] + run[at + 1 :]
                            del own[run]
                            if len(left) >= min_chars:
                                seen[left] += n
                seen.update(own)
            if len(seen) > HELD:
                yield out()
                seen = Counter()
        yield out()

    return rows.mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


# ---------------------------------------------------------------- tries


def letter_matrix(words: list[str], size: int) -> np.ndarray:
    return np.frombuffer("".join(words).encode("latin-1"), np.uint8).reshape(len(words), size)


def group_counts(letters: np.ndarray) -> np.ndarray:
    """Letters of each word in each group, groups in the order of the trie."""
    n, size = letters.shape
    counts = np.zeros((n, GROUPS), np.int32)
    rows = max(1, COMPARED // max(1, size))
    for begin in range(0, n, rows):
        part = letters[begin : begin + rows].astype(np.int64) % GROUPS + GROUPS * np.arange(len(letters[begin : begin + rows]))[:, None]
        counts[begin : begin + rows] = np.bincount(part.ravel(), minlength=GROUPS * len(part)).reshape(-1, GROUPS)
    return counts[:, ORDER]


def one_replaced(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a != b).sum(axis=1) == 1


def one_inserted(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """b is a with one more letter: what differs from the left begins after what differs from the right has ended."""
    size = a.shape[1]
    left, right = a != b[:, :-1], a != b[:, 1:]
    first = np.where(left.any(axis=1), left.argmax(axis=1), size)
    last = np.where(right.any(axis=1), size - right[:, ::-1].argmax(axis=1), 0)
    return last <= first


class Trie:
    """Words of one length in the order of their group counts; a node is a range of them that agrees so far."""

    def __init__(self, letters: np.ndarray):
        counts = group_counts(letters)
        self.order = np.lexsort(counts.T[::-1])
        self.counts, self.letters = counts[self.order], letters[self.order]

    def near(self, letters: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(query, word) pairs one edit apart. letters: queries of the words' length, or of one letter less.

        One edit makes at most one group larger and one smaller, so a depth-first walk goes to a child as long as the
        counts of a query lie one surplus and one deficit off at most (a shorter query has no deficit).
        """
        wanted = group_counts(letters)
        same = letters.shape[1] == self.letters.shape[1]
        check, deficit = (one_replaced, 1) if same else (one_inserted, 0)
        everyone = np.arange(len(letters))
        stack = [(0, 0, len(self.letters), everyone, np.zeros(len(letters), np.int8), np.zeros(len(letters), np.int8))]
        while stack:
            level, low, high, who, more, less = stack.pop()
            if level == GROUPS or high - low <= LEAF:
                yield from self.verified(letters, wanted, who, low, high, check, deficit)
                continue
            counts = self.counts[low:high, level]
            cuts = low + np.concatenate([[0], np.flatnonzero(np.diff(counts)) + 1, [high - low]])
            asked = wanted[who, level]
            for begin, end in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
                off = self.counts[begin, level] - asked
                up, down = more + np.maximum(off, 0), less + np.maximum(-off, 0)
                go = (up <= 1) & (down <= deficit)
                if go.any():
                    stack.append((level + 1, begin, end, who[go], up[go].astype(np.int8), down[go].astype(np.int8)))

    def verified(self, letters, wanted, who, low, high, check, deficit) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """The pairs of queries with the words of a leaf that are one edit apart, some at a time."""
        some = max(1, COMPARED // (GROUPS * 4 * LEAF))
        for at in range(0, len(who), some):
            own = who[at : at + some]
            for begin in range(low, high, LEAF):
                off = self.counts[None, begin : min(high, begin + LEAF)] - wanted[own][:, None]
                up, down = np.maximum(off, 0).sum(axis=2), np.maximum(-off, 0).sum(axis=2)
                q, w = np.nonzero((up <= 1) & (down <= deficit))
                q, w = own[q], w + begin
                rows = max(1, COMPARED // self.letters.shape[1])
                for k in range(0, len(q), rows):
                    hit = check(letters[q[k : k + rows]], self.letters[w[k : k + rows]])
                    yield q[k : k + rows][hit], self.order[w[k : k + rows][hit]]


def near_in_block(table: pa.Table) -> pa.Table:
    """Both directions of the near pairs of one block. table: asks (true for a word looked up), word, n."""
    asks = table.column("asks").to_numpy().astype(bool)
    words = np.array(table.column("word").to_pylist(), object)
    n = table.column("n").to_numpy()
    out: list[list] = [[], [], []]
    held = np.flatnonzero(~asks)
    if len(held):
        size = len(words[held[0]])
        trie = Trie(letter_matrix(words[held].tolist(), size))
        for length in (size, size - 1):
            own = np.flatnonzero(asks & (np.fromiter(map(len, words), np.int64, len(words)) == length))
            if not len(own) or length < 1:
                continue
            for q, w in trie.near(letter_matrix(words[own].tolist(), length)):
                a, b = own[q], held[w]
                if length == size:  # words of one key meet twice
                    keep = keep_once(table, a, b, words)
                    a, b = a[keep], b[keep]
                for x, y in ((a, b), (b, a)):
                    out[0].extend(words[x])
                    out[1].extend(words[y])
                    out[2].extend(n[y].tolist())
    return pa.table(
        {"word": pa.array(out[0], pa.string()), "near": pa.array(out[1], pa.string()), "near_n": pa.array(out[2], pa.int64())})


def keep_once(table: pa.Table, a: np.ndarray, b: np.ndarray, words: np.ndarray) -> np.ndarray:
    """Of the two meetings of words that share a key, the one that asks for the later word."""
    home = table.column("home").to_numpy().astype(bool)
    return np.fromiter((not home[x] or words[x] < words[y] for x, y in zip(a, b)), bool, len(a))


# ---------------------------------------------------------------- sharding


def depth_for(words: int) -> int:
    """Groups whose counts are part of a shard's key: more for larger vocabularies."""
    return min(8, 3 + max(0, math.ceil(math.log(max(1, words) / 1e6, 12))))


def group_count(word: Column, group: int) -> Column:
    members = "".join(c for c in LETTERS if ord(c) % GROUPS == group)
    return F.length(word) - F.length(F.translate(word, members, ""))


def key_of(length: Column, counts: list[Column]) -> Column:
    return F.concat_ws("-", length, *counts)


def near_words(words: DataFrame, depth: int) -> DataFrame:
    """word, near, near_n: both directions of every pair one edit apart. words: word, n, each word once.

    The first `depth` levels of the trie are dealt out as keys: a word is held under its length and its first counts,
    and looked up under each key that one edit can lead to. Of a pair of one length the side with the smaller key
    asks, of two lengths the shorter word. Keys with more than BLOCK words on a side are dealt into blocks.
    """
    length = F.length("word")
    counts = [F.col("_c")[k] for k in range(depth)]
    rows = words.select("word", "n", F.array(*[group_count(F.col("word"), ORDER[k]) for k in range(depth)]).alias("_c"))

    def moved(step: int, up: int | None = None, down: int | None = None) -> Column:
        return key_of(length + step, [c + int(k == up) - int(k == down) for k, c in enumerate(counts)])

    home = moved(0)
    targets = [home, *(moved(0, i) for i in range(depth))]
    targets += [moved(0, i, j) for i in range(depth) for j in range(i + 1, depth)]
    targets += [moved(1), *(moved(1, i) for i in range(depth))]
    held = rows.select(home.alias("key"), "word", "n")
    asking = rows.select(F.explode(F.array(*targets)).alias("key"), home.alias("_home"), "word", "n")
    asking = asking.select("key", (F.col("key") == F.col("_home")).alias("home"), "word", "n")
    sizes = held.groupBy("key").agg(F.count(F.lit(1)).alias("n_held")).join(
        asking.groupBy("key").agg(F.count(F.lit(1)).alias("n_asking")), "key")
    blocks = stage(sizes.select(
        "key", F.ceil(F.col("n_held") / BLOCK).alias("_s"), F.ceil(F.col("n_asking") / BLOCK).alias("_r")), "spelling-keys")
    part = F.xxhash64("word")
    held = held.join(blocks, "key").select(
        "key", F.pmod(part, "_s").alias("a"), F.explode(F.sequence(F.lit(0), F.col("_r") - 1)).alias("b"),
        F.lit(False).alias("asks"), F.lit(False).alias("home"), "word", "n")
    asking = asking.join(blocks, "key").select(
        "key", F.explode(F.sequence(F.lit(0), F.col("_s") - 1)).alias("a"), F.pmod(part, "_r").alias("b"),
        F.lit(True).alias("asks"), "home", "word", "n")
    both = held.unionByName(asking)
    return both.groupBy("key", "a", "b").applyInArrow(near_in_block, "word string, near string, near_n long")


# ---------------------------------------------------------------- groups


def spelling_variants(
    documents: DataFrame,
    min_chars: int = 6,
    min_count: int = 5,
    ratio: int = 5,
    lost_every: int | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per word: word, n, form, form_n, n_near, root.

    Words are the runs of letters of `word_counts` that occur `min_count` times or more. A word's form is the most
    frequent of the words one inserted, deleted or replaced code point away (ties: the first in code-point order), if
    it is at least `ratio` times as frequent; its root is where the forms lead. Every pair one edit apart is found, and
    there is no bound on the neighbours of a word.

    Null and empty texts have no words; runs of any length are whole words; repeated rows count each; other columns are
    ignored, and an empty table gives no rows.
    """
    if ratio < 2:
        raise ValueError("forms must grow, or they could lead in a circle")
    python_ready(documents.sparkSession)
    counted = word_counts(documents, min_chars, lost_every, id_col, text_col)
    words = stage(counted.where(F.col("n") >= min_count), "spelling-words")
    size = words.agg(F.count(F.lit(1)).alias("n"), F.max("n").alias("most")).first()
    pairs = near_words(words, depth_for(size["n"]))
    best = pairs.groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("n"), "near")).alias("_b"))
    large = -F.col("_b.n") >= ratio * F.col("n")
    formed = stage(words.join(best, "word", "left").select(
        "word", "n", F.when(large, F.col("_b.near")).alias("form"), F.when(large, -F.col("_b.n")).alias("form_n"),
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near")), "spelling-forms")
    # counts grow by the ratio from form to form, so chains are short; each round doubles the way
    hops = int(math.log(max(1, (size["most"] or 1) / min_count)) / math.log(ratio)) + 1
    links = formed.where("form is not null").select("word", F.col("form").alias("root"))
    for _ in range(max(0, math.ceil(math.log2(hops)))):
        links = stage(links, "spelling-links")
        further = links.select(F.col("word").alias("_w"), F.col("root").alias("_r"))
        links = links.join(further, F.col("root") == F.col("_w"), "left").select(
            "word", F.coalesce("_r", "root").alias("root"))
    out = formed.join(links, "word", "left")
    return out.select("word", "n", "form", "form_n", "n_near", F.coalesce("root", "word").alias("root"))
