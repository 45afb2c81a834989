"""Language identification: known words by log frequency, unseen words by shorter and shorter runs of characters."""

from __future__ import annotations

import math
import uuid
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.llm.bpe import NONE, PairTable
from riskloom.llm.common import fresh, python_ready, stage

#: Characters of the longest run that an unseen word falls back to.
LONGEST_GRAM = 5
#: Bounds of the model, not of what is counted: words and runs it keeps, and numbers in each of its two matrices.
WORDS, GRAMS, CELLS = 100_000, 300_000, 1 << 23
#: Longer words are never kept, so the model's text has a bound too; they are scored by their runs.
LONGEST_WORD = 40
#: Distinct (word, language) pairs a task counts before it hands them on; characters hashed at a time.
HELD, CHARACTERS = 300_000, 1 << 20
#: Unseen words whose scores a worker remembers.
REMEMBERED = 300_000
#: Count added to every word and run.
SMOOTH = 0.5
#: Steps of a share's histogram in a halving.
STEPS = 8
UNKNOWN = "und"

WORD = regex.compile(r"\p{L}[\p{L}\p{M}]*")


def words_of(text: str) -> list[str]:
    return WORD.findall(text.lower())


# ---------------------------------------------------------------- runs of characters


def padded(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of `<word>` one after the other, and the word of each."""
    codes = np.frombuffer("".join(f"<{w}>" for w in words).encode("utf-32-le"), np.uint32).astype(np.uint64)
    lengths = np.fromiter(map(len, words), np.int64, len(words)) + 2
    return codes, np.repeat(np.arange(len(words)), lengths)


def gram_hashes(codes: np.ndarray, of: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hash of the run of `size` characters that begins at each place, and whether it stays in its word."""
    n = len(codes)
    inside = np.zeros(n, bool)
    if n >= size:
        inside[: n - size + 1] = of[size - 1 :] == of[: n - size + 1]
    code = np.full(n, size, np.uint64)
    for k in range(size):
        code[: n - k] = (code[: n - k] ^ codes[k:]) * np.uint64(0x100000001B3)
        code ^= code >> np.uint64(29)
    return (code * np.uint64(0x9E3779B97F4A7C15)).view(np.int64), inside


# ---------------------------------------------------------------- counting


def count_words(rows: DataFrame, number: dict[str, int]) -> DataFrame:
    """word, langs, counts: how often each word stands in each language. rows: text, lang.

    Words are counted in the tasks first, so the most frequent ones are a few rows of each task.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, Counter] = {}

        def out() -> pa.RecordBatch:
            words = [w for c in held.values() for w in c]
            langs = np.repeat(np.array(list(held), np.int32), [len(c) for c in held.values()])
            counts = [n for c in held.values() for n in c.values()]
            return pa.RecordBatch.from_arrays(
                [pa.array(words, pa.string()), pa.array(langs, pa.int32()), pa.array(counts, pa.int64())],
                names=["word", "lang", "n"],
            )

        for batch in batches:
            for text, lang in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                held.setdefault(number[lang], Counter()).update(words_of(text))
            if sum(map(len, held.values())) > HELD:
                yield out()
                held = {}
        yield out()

    parts = rows.mapInArrow(count, "word string, lang int, n long")
    # one exchange serves both groupings
    each = parts.repartition("word").groupBy("word", "lang").agg(F.sum("n").alias("n"))
    return listed(each, "word")


def listed(each: DataFrame, key: str) -> DataFrame:
    """One row per key, with its languages and their counts side by side."""
    pairs = each.groupBy(key).agg(F.sort_array(F.collect_list(F.struct("lang", "n"))).alias("p"))
    return pairs.select(key, F.col("p.lang").alias("langs"), F.col("p.n").alias("counts"))


def flat(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, language and count of every entry of the lists of a batch of `listed` rows."""
    lists, counts = batch.column("langs"), batch.column("counts")
    sizes = np.diff(lists.offsets.to_numpy())
    return np.repeat(np.arange(len(sizes)), sizes), lists.flatten().to_numpy(), counts.flatten().to_numpy()


def count_grams(words: DataFrame) -> DataFrame:
    """gram, size, langs, counts: runs of characters of all words, each as often as its word. words: `count_words`."""

    def counted(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
        row, lang, n = flat(table)
        codes, of = padded(table.column("word").to_pylist())
        for size in range(1, LONGEST_GRAM + 1):
            code, inside = gram_hashes(codes, of, size)
            code, owner = code[inside], of[inside]
            for k in np.unique(lang):
                weight = np.zeros(len(table), np.int64)
                weight[row[lang == k]] = n[lang == k]
                own = weight[owner] > 0
                grams, place = np.unique(code[own], return_inverse=True)
                sums = np.zeros(len(grams), np.int64)
                np.add.at(sums, place, weight[owner[own]])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(grams), pa.array(np.full(len(grams), size, np.int32)),
                     pa.array(np.full(len(grams), k, np.int32)), pa.array(sums)],
                    names=["gram", "size", "lang", "n"],
                )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            if not len(batch):
                continue
            held.append(batch)
            size += batch.column(0).nbytes
            if size > CHARACTERS:
                yield from counted(held)
                held, size = [], 0
        if held:
            yield from counted(held)

    parts = words.select("word", "langs", "counts").mapInArrow(count, "gram long, size int, lang int, n long")
    each = parts.repartition("gram").groupBy("gram", "lang").agg(F.sum("n").alias("n"), F.first("size").alias("size"))
    out = each.groupBy("gram").agg(
        F.sort_array(F.collect_list(F.struct("lang", "n"))).alias("p"), F.first("size").alias("size"))
    return out.select("gram", "size", F.col("p.lang").alias("langs"), F.col("p.n").alias("counts"))


def kept(counted: DataFrame, per: str | None, room: int) -> tuple[DataFrame, dict]:
    """The rows with the largest share in any language, at most `room` of them, and the totals of all rows.

    The cut is found in a histogram of shares (some hundred rows), so nothing is sorted. per: a column whose values
    have totals of their own.
    """
    size = F.col(per) if per else F.lit(0)
    each = counted.select(size.alias("size"), F.explode(F.arrays_zip("langs", "counts")).alias("e"))
    sums = each.groupBy("size", "e.langs").agg(F.sum("e.counts").alias("n")).collect()
    totals = {(r["size"], r["langs"]): r["n"] for r in sums}
    known = 1 + max((k for _, k in totals), default=0)
    table = [[float(totals.get((s, k), 1)) for k in range(known)] for s in range(LONGEST_GRAM + 1)]
    share = F.array_max(F.zip_with("langs", "counts", lambda k, n: n / F.get(F.get(F.lit(table), size), k)))
    ranked = counted.withColumn("_step", F.floor(-STEPS * F.log2(share)).cast("int"))
    upto, cut = 0, -1
    for r in sorted(ranked.groupBy("_step").count().collect(), key=lambda r: r["_step"]):
        if upto + r["count"] > room:
            break
        upto, cut = upto + r["count"], r["_step"]
    return ranked.where(F.col("_step") <= cut).drop("_step"), totals


# ---------------------------------------------------------------- model


@dataclass
class Model:
    languages: list[str]
    prior: np.ndarray  # log share of each language
    words: list[str]
    word_logs: np.ndarray  # (word, language)
    grams: np.ndarray
    gram_logs: np.ndarray


def log_matrix(rows: int, row: np.ndarray, lang: np.ndarray, n: np.ndarray, totals: np.ndarray) -> np.ndarray:
    """Log of the smoothed frequency; totals: what each cell's count is a share of."""
    counts = np.full((rows, totals.shape[1]), SMOOTH)
    counts[row, lang] += n
    return np.log(counts / totals).astype(np.float32)


def collected(rows: DataFrame) -> pa.RecordBatch | None:
    batches = rows.toArrow().combine_chunks().to_batches()
    return batches[0] if batches else None


def fit(labelled: DataFrame) -> Model:
    """Count words and runs of characters over every row. labelled: text, lang, both never null."""
    spark = labelled.sparkSession
    languages = sorted(r.lang for r in labelled.select("lang").distinct().collect())
    empty = np.zeros((0, len(languages)), np.float32)
    model = Model(languages, np.zeros(len(languages)), [], empty, np.zeros(0, np.int64), empty)
    if not languages:
        return model
    python_ready(spark)
    share = {r.lang: r["count"] for r in labelled.groupBy("lang").count().collect()}
    model.prior = np.log(np.array([share[k] for k in languages], float) / sum(share.values()))
    counted = stage(count_words(labelled, {k: i for i, k in enumerate(languages)}), "language-words")
    room = max(1, CELLS // len(languages))
    held, totals = kept(counted.where(F.length("word") <= LONGEST_WORD), None, min(WORDS, room))
    if batch := collected(held.select("word", "langs", "counts")):
        of = np.array([[totals.get((0, k), 0) + SMOOTH * len(batch) for k in range(len(languages))]])
        model.words, model.word_logs = batch.column(0).to_pylist(), log_matrix(len(batch), *flat(batch), of)
    grams = stage(count_grams(counted), "language-grams")
    held, totals = kept(grams, "size", min(GRAMS, room))
    if batch := collected(held.select("gram", "size", "langs", "counts")):
        sizes = batch.column("size").to_numpy()
        of = np.array([[totals.get((s, k), 0) for k in range(len(languages))] for s in range(LONGEST_GRAM + 1)], float)
        of += SMOOTH * np.bincount(sizes, minlength=LONGEST_GRAM + 1)[:, None]
        model.grams, model.gram_logs = batch.column("gram").to_numpy(), log_matrix(len(batch), *flat(batch), of[sizes])
    return model


class Scorer:
    """A worker's model with the scores of the unseen words it has met."""

    def __init__(self, model: Model):
        self.model = model
        grams = model.grams
        place = np.arange(len(grams), dtype=np.int32)
        self.grams = PairTable((grams >> 32).astype(np.int32), grams.astype(np.int32), place, place)
        self.forget()

    def forget(self) -> None:
        self.rows = {w: k for k, w in enumerate(self.model.words)}
        self.logs = self.model.word_logs

    def backed_off(self, words: list[str]) -> np.ndarray:
        """Scores of unseen words: at each place the longest known run that begins there, averaged over the places."""
        codes, of = padded(words)
        found = np.full(len(codes), -1, np.int64)
        for size in range(LONGEST_GRAM, 0, -1):
            code, inside = gram_hashes(codes, of, size)
            at = np.flatnonzero(inside & (found < 0))
            rank, row = self.grams.find((code[at] >> 32).astype(np.int32), code[at].astype(np.int32))
            hit = rank != NONE
            found[at[hit]] = row[hit]
        at = np.flatnonzero(found >= 0)
        sums = np.zeros((len(words), len(self.model.languages)))
        np.add.at(sums, of[at], self.model.gram_logs[found[at]])
        return (sums / np.maximum(1, np.bincount(of[at], minlength=len(words)))[:, None]).astype(np.float32)

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        words = [words_of(t) if t else [] for t in texts]
        if len(self.rows) > len(self.model.words) + REMEMBERED:
            self.forget()
        new = list(set().union(*words).difference(self.rows)) if self.model.languages else []
        if new:
            self.rows.update(zip(new, range(len(self.rows), len(self.rows) + len(new))))
            self.logs = np.concatenate([self.logs, self.backed_off(new)])
        names, scores = [], []
        for own in words:
            if not own or not self.model.languages:
                names.append(UNKNOWN)
                scores.append(0.0)
                continue
            rows = np.fromiter(map(self.rows.__getitem__, own), np.int64, len(own))
            total = self.model.prior + self.logs[rows].sum(axis=0, dtype=np.float64)
            best = int(total.argmax())
            names.append(self.model.languages[best])
            scores.append(1.0 / math.fsum(np.exp(total - total[best]).tolist()))
        return names, scores


_SCORERS: dict[str, Scorer] = {}


def identify(
    documents: DataFrame,
    labelled: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang_pred",
    score_col: str = "score",
) -> DataFrame:
    """All columns and rows of `documents`, with the predicted language and its chance among the learned ones.

    labelled: text, lang. Rows that lack one of them teach nothing. A text is lower-cased and cut into runs of letters.
    A known word adds the log of its frequency in each language, an unseen one the mean over its places of the log
    frequency of the longest known run of at most LONGEST_GRAM characters, and the shares of the languages are added as
    prior. Every word of every labelled row is counted; the model keeps the WORDS words and GRAMS runs with the largest
    share in a language, fewer with many languages, so what is broadcast has a bound.

    Null, empty and letterless texts are `und` at 0, and so is every text where nothing is learned; equal chances go to
    the first language in order; words whose characters were never seen leave the prior. Whole texts are read. Rows
    that repeat are each scored; other columns pass through, but for one named like a result. An empty table gives no
    rows.
    """
    spark = documents.sparkSession
    python_ready(spark)
    model = fit(labelled.select("text", "lang").where("text is not null and lang is not null"))
    rows = documents.drop(lang_col, score_col)
    shared, key = spark.sparkContext.broadcast(model), uuid.uuid4().hex
    # the text is copied, so that it can bear the name of a result
    own = fresh(rows, "_text")
    inputs = documents.withColumn(own, F.col(text_col)).select(*rows.columns, own)

    def run(batches):
        if key not in _SCORERS:
            _SCORERS.clear()
            _SCORERS[key] = Scorer(shared.value)
        for batch in batches:
            names, scores = _SCORERS[key].predict(batch.column(batch.num_columns - 1).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                names=[*batch.schema.names[:-1], lang_col, score_col],
            )

    schema = T.StructType(
        [*rows.schema.fields, T.StructField(lang_col, T.StringType()), T.StructField(score_col, T.DoubleType())])
    return inputs.mapInArrow(run, schema)
