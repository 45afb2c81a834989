"""Quality classifier: random Fourier features of document statistics, ridge scores and isotonic calibration."""

from __future__ import annotations

import operator
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import python_ready, stage

#: Random features, ridge weight and seed of the kernel approximation.
FEATURES, RIDGE, SEED = 384, 1.0, 11
#: Scores are calibrated in steps of 1 / STEPS.
STEPS = 2000
#: Partial sums of one matrix row that meet in one task first.
FAN_IN = 64


def byte_classes() -> np.ndarray:
    """Class of each byte: lower, upper, digit, blank, newline, sentence mark, bracket or bar, other symbol, high."""
    kinds = np.full(256, 7)
    kinds[128:] = 8
    for k, members in enumerate(("abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", " \t\r",
                                 "\n", ".,;:?'\"-", "|[]{}()<>")):
        kinds[[ord(c) for c in members]] = k
    return kinds


KINDS = byte_classes()


def statistics(text: str) -> list[float]:
    """Numbers that describe a whole text; all are 0 for an empty one."""
    raw = np.frombuffer(text.encode(), np.uint8)
    if not len(raw):
        return [0.0] * N_STATISTICS
    kinds = KINDS[raw]
    shares = np.bincount(kinds, minlength=9) / len(raw)
    twice = (raw[1:] == raw[:-1]) & (kinds[1:] != 3)
    symbol_runs = np.count_nonzero(twice & (kinds[1:] >= 5) & (kinds[1:] <= 7)) / len(raw)
    words = text.split()
    n = max(1, len(words))
    lengths = np.fromiter(map(len, words), np.float64, len(words)) if words else np.zeros(1)
    counts = Counter(words)
    lines = text.split("\n")
    most = counts.most_common(1)[0][1] if counts else 0
    return [
        *shares.tolist(),
        symbol_runs,
        np.count_nonzero(twice) / len(raw),
        np.log1p(len(raw)),
        np.log1p(len(words)),
        float(lengths.mean()),
        float(lengths.std()),
        float(np.log1p(lengths.max())),
        len(counts) / n,
        np.log1p(len(counts)) / np.log(n + 1.0),
        most / n,
        sum(map(operator.eq, words, words[1:])) / n,
        sum(map(str.isupper, words)) / n,
        sum(map(str.istitle, words)) / n,
        sum(w[-1] in ".!?" for w in words) / n,
        sum(not any(map(str.isalnum, w)) for w in words) / n,
        len(set(lines)) / len(lines),
        np.log1p(len(lines)),
    ]


N_STATISTICS = 26


def document_statistics(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, text_hash, stats (array of double) of every row; a null text counts as empty."""
    python_ready(documents.sparkSession)
    text = F.col(text_col)
    rows = documents.select(F.col(id_col).alias("doc_id"), F.xxhash64(text).alias("text_hash"), text.alias("text"))

    def describe(batches):
        for batch in batches:
            stats = [statistics(t or "") for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(stats, pa.list_(pa.float64()))],
                names=["doc_id", "text_hash", "stats"],
            )

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(describe, f"doc_id {kind}, text_hash long, stats array<double>")


def matrix(column: pa.Array) -> np.ndarray:
    values = column.flatten().to_numpy(zero_copy_only=False)
    return values.reshape(len(column), -1) if len(column) else np.zeros((0, N_STATISTICS))


@dataclass
class Model:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    knots: np.ndarray
    values: np.ndarray

    def features(self, stats: np.ndarray) -> np.ndarray:
        return fourier((stats - self.mean) / self.scale)

    def score(self, stats: np.ndarray) -> np.ndarray:
        if not len(self.knots):
            return np.full(len(stats), 0.5)
        return np.interp(self.features(stats) @ self.weights, self.knots, self.values)


def fourier(standard: np.ndarray) -> np.ndarray:
    """cos(w x + b) with random w and b: their products approximate a Gaussian kernel. The last column is 1."""
    d = standard.shape[1]
    rng = np.random.default_rng(SEED)
    w = rng.standard_normal((d, FEATURES)) / np.sqrt(d)
    b = rng.uniform(0, 2 * np.pi, FEATURES)
    waves = np.sqrt(2.0 / FEATURES) * np.cos(np.clip(standard, -6, 6) @ w + b)
    return np.hstack([waves, np.ones((len(standard), 1))])


def summed(partial: DataFrame) -> list:
    """Adds arrays by key, in two steps: no task gets more than FAN_IN arrays of a key or the sums of those."""

    def add(rows: pd.DataFrame) -> pd.DataFrame:
        total = np.sum(np.stack(rows.sort_values("part")["row"].to_numpy()), axis=0)
        return pd.DataFrame({"part": [int(rows["part"].min()) // FAN_IN], "i": [rows["i"].iloc[0]], "row": [total.tolist()]})

    schema = "part long, i int, row array<double>"
    some = partial.groupBy("i", F.floor(F.col("part") / FAN_IN)).applyInPandas(lambda rows: add(rows), schema)
    return some.groupBy("i").applyInPandas(lambda rows: add(rows), schema).collect()


def per_partition(labelled: DataFrame, sums) -> DataFrame:
    """One row per partition and key: what `sums(stats, labels, halves)` adds up, a dict of arrays."""
    from pyspark import TaskContext

    def run(batches):
        part, total = TaskContext.get().partitionId(), {}
        for batch in batches:
            x = matrix(batch.column(0))
            y = batch.column(1).to_numpy(zero_copy_only=False).astype(float)
            half = batch.column(2).to_numpy(zero_copy_only=False)
            for key, row in sums(x, y, half).items():
                total[key] = total[key] + row if key in total else row
        if total:
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([part] * len(total), pa.int64()),
                    pa.array(list(total), pa.int32()),
                    pa.array([r.tolist() for r in total.values()], pa.list_(pa.float64())),
                ],
                names=["part", "i", "row"],
            )

    return labelled.select("stats", "label", "half").mapInArrow(run, "part long, i int, row array<double>")


def moments(x: np.ndarray, y: np.ndarray, half: np.ndarray) -> dict[int, np.ndarray]:
    return {0: np.concatenate([[len(x)], x.sum(axis=0), (x * x).sum(axis=0)])} if len(x) else {}


def isotonic(score: np.ndarray, good: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators over scores in order; returns block means of score and of label."""
    blocks: list[list[float]] = []
    for s, g, m in zip(score.tolist(), good.tolist(), n.tolist()):
        blocks.append([s * m, g, m])
        while len(blocks) > 1 and blocks[-2][1] * blocks[-1][2] >= blocks[-1][1] * blocks[-2][2]:
            last = blocks.pop()
            blocks[-1] = [a + b for a, b in zip(blocks[-1], last)]
    return np.array([b[0] / b[2] for b in blocks]), np.array([b[1] / b[2] for b in blocks])


def fit(labelled: DataFrame) -> Model:
    """labelled: doc_id, stats, label (0 or 1). Every row takes part; only sums reach the driver.

    The rows are halved by a hash of the id. Ridge weights come from both halves; the calibration sees each row's score
    under the weights of the other half, so it is not fitted to scores of a row's own fit.
    """
    none = Model(np.zeros(N_STATISTICS), np.ones(N_STATISTICS), np.zeros(FEATURES + 1), np.zeros(0), np.zeros(0))
    labelled = labelled.withColumn("half", F.pmod(F.xxhash64("doc_id"), F.lit(2)).cast("int"))
    found = summed(per_partition(labelled, moments))
    if not found:
        return none
    total = np.array(found[0].row)
    n, mean = total[0], total[1 : N_STATISTICS + 1] / total[0]
    spread = np.sqrt(np.maximum(total[N_STATISTICS + 1 :] / n - mean**2, 0))
    scale = np.where(spread > 1e-9, spread, 1.0)

    def normal_equations(x, y, half):
        out = {}
        for h in (0, 1):
            own = fourier((x[half == h] - mean) / scale)
            if len(own):
                both = own.T @ np.column_stack([own, y[half == h]])
                out |= {h * (FEATURES + 1) + k: row for k, row in enumerate(both)}
        return out

    sums = np.zeros((2, FEATURES + 1, FEATURES + 2))
    for row in summed(per_partition(labelled, normal_equations)):
        sums[row.i // (FEATURES + 1), row.i % (FEATURES + 1)] = row.row

    def solve(part: np.ndarray) -> np.ndarray:
        penalty = RIDGE * np.eye(FEATURES + 1)
        penalty[-1, -1] = 1e-6
        return np.linalg.solve(part[:, :-1] + penalty, part[:, -1])

    weights = solve(sums.sum(axis=0))
    other = [solve(sums[1]) if sums[1].any() else weights, solve(sums[0]) if sums[0].any() else weights]

    def histogram(x, y, half):
        wave = fourier((x - mean) / scale)
        score = np.where(half == 0, wave @ other[0], wave @ other[1])
        step = np.clip(((score + 1) / 3 * STEPS).astype(int), 0, STEPS - 1)
        return {
            0: np.bincount(step, minlength=STEPS).astype(float),
            1: np.bincount(step, y, minlength=STEPS),
            2: np.bincount(step, score, minlength=STEPS),
        }

    counts = {row.i: np.array(row.row) for row in summed(per_partition(labelled, histogram))}
    seen = counts[0] > 0
    knots, values = isotonic(counts[2][seen] / counts[0][seen], counts[1][seen], counts[0][seen])
    return Model(mean, scale, weights, knots, values)


def score(stats: DataFrame, model: Model) -> DataFrame:
    """doc_id, text_hash, score of every row."""
    shared = stats.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = np.clip(shared.value.score(matrix(batch.column(2))), 0, 1)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(scores)], names=["doc_id", "text_hash", "score"]
            )

    kind = stats.schema["doc_id"].dataType.simpleString()
    return stats.select("doc_id", "text_hash", "stats").mapInArrow(run, f"doc_id {kind}, text_hash long, score double")


def quality_scores(
    documents: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id, text_hash, score of every row. labels: doc_id, label (0 or 1; other rows are left out).

    text_hash tells rows apart that repeat an id. The score is the chance of label 1. Null text counts as empty, which is scored like any text; null ids are scored
    and never learnt from; an id with several labels is learnt from once per label. Without any labelled document every
    score is 0.5; with labels of one kind it is that kind. Other columns are ignored.
    """
    stats = stage(document_statistics(documents, id_col, text_col), "statistics")
    marked = labels.where("label in (0, 1)").select(F.col("doc_id").alias("label_id"), F.col("label").cast("int"))
    labelled = stage(stats.join(marked, F.col("doc_id") == F.col("label_id")).select("doc_id", "stats", "label"), "labelled")
    return score(stats, fit(labelled))
