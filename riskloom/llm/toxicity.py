"""Toxicity: a bidirectional gated recurrent network with attention pooling over overlapping windows of words."""

from __future__ import annotations

import pickle
import re
import uuid
from collections.abc import Iterable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.llm.common import python_ready, stage

#: Words of a window, and words from one window's begin to the next.
WINDOW, STRIDE = 48, 24
#: Sizes: word vector, character vector, state of each direction, attention.
WORD, CHAR, STATE, ATTENTION = 12, 12, 12, 12
#: Buckets of runs of characters; words of the vocabulary; share of known words a step of training takes as unknown.
GRAMS, VOCABULARY, DROPPED = 16384, 8192, 0.3
#: Documents of each label the network is trained on at most: those with the smallest hash of their id.
SAMPLE = 1500
#: Training: steps, the share of them before windows are chosen by their logit, windows of a document in a round before
#: and after that, windows of a step, and step size.
STEPS, WARM, WINDOWS_BEFORE, WINDOWS_AFTER, BATCH, RATE = 200, 0.5, 6, 2, 256, 0.01
#: One in so many sampled documents is kept for the calibration.
KEPT_OUT = 4
SEED = 5
#: Words that are projected at a time.
PROJECTED = 20_000
#: Words whose projections a worker remembers.
REMEMBERED = 200_000

WORDS = re.compile(r"\w+")


def words_of(text: str) -> list[str]:
    return WORDS.findall(text.lower())


def windows_of(n: int) -> np.ndarray:
    """Begins of the windows over n words: every word lies in one, inner words in two."""
    return np.arange(0, max(1, n - WINDOW + STRIDE), STRIDE) if n > WINDOW else np.zeros(1, int)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -30, 30)))


def gram_buckets(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of every run of 3 and of 5 bytes of `^word$`, and the word of each, in the order of words."""
    raw = [b"^" + w.encode() + b"$" for w in words]
    lengths = np.fromiter(map(len, raw), np.int64, len(raw))
    flat = np.frombuffer(b"".join(raw) + b"    ", np.uint8).astype(np.uint64)
    of = np.repeat(np.arange(len(raw)), lengths)
    left = np.repeat(np.cumsum(lengths), lengths) - np.arange(len(of))  # bytes to the end of the word
    buckets, owners = [], []
    for size in (3, 5):
        code = np.zeros(len(of), np.uint64)
        for k in range(size):
            code = code * np.uint64(257) + flat[k : k + len(of)]
        code = (code + np.uint64(size)) * np.uint64(0x9E3779B97F4A7C15)
        inside = left >= size
        buckets.append((code[inside] >> np.uint64(40)).astype(np.int64) % GRAMS)
        owners.append(of[inside])
    owner = np.concatenate(owners)
    order = np.argsort(owner, kind="stable")
    return np.concatenate(buckets)[order].astype(np.int32), owner[order].astype(np.int32)


def word_features(words: list[str], known: dict[str, int]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Row in the word table (0 for unknown), character buckets, their word, and the buckets of each word."""
    rows = np.array([known.get(w, 0) for w in words], np.int64)
    buckets, owner = gram_buckets(words)
    return rows, buckets, owner, np.bincount(owner, minlength=len(words))


class Network:
    """Parameters and passes. Windows come as rows of word numbers, -1 where a short text leaves a place empty."""

    def __init__(self, known: dict[str, int]):
        rng = np.random.default_rng(SEED)
        size = WORD + CHAR

        def start(*shape, by=0.1):
            return (rng.standard_normal(shape) * by).astype(np.float32)

        self.known = known
        self.p = {
            "words": start(len(known) + 1, WORD), "grams": start(GRAMS, CHAR),
            "attend": start(2 * STATE, ATTENTION, by=0.3), "attend_bias": start(ATTENTION), "query": start(ATTENTION, by=0.3),
            "out": start(2 * STATE, by=0.3), "bias": np.zeros(1, np.float32),
        }
        for side in "fb":  # forward and backward: update, reset and candidate side by side
            self.p |= {
                f"in_{side}": start(size, 3 * STATE, by=size**-0.5),
                f"state_{side}": start(STATE, 3 * STATE, by=STATE**-0.5),
                f"bias_{side}": np.zeros(3 * STATE, np.float32),
            }
        self.p["words"][0] = 0

    def inputs(self, features) -> np.ndarray:
        """Word vector beside the mean of the vectors of its runs of characters."""
        rows, buckets, _, sizes = features
        starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
        mean = np.add.reduceat(self.p["grams"][buckets], starts, axis=0) / sizes[:, None]
        return np.hstack([self.p["words"][rows], mean.astype(np.float32)])

    def projected(self, features) -> tuple[np.ndarray, np.ndarray]:
        """What the gates of both directions get from each word."""
        rows, buckets, _, sizes = features
        ends = np.concatenate([[0], np.cumsum(sizes)])
        out = [np.zeros((len(rows), 3 * STATE), np.float32) for _ in "fb"]
        for begin in range(0, len(rows), PROJECTED):
            end = min(len(rows), begin + PROJECTED)
            x = self.inputs((rows[begin:end], buckets[ends[begin] : ends[end]], None, sizes[begin:end]))
            for gates, side in zip(out, "fb"):
                gates[begin:end] = x @ self.p[f"in_{side}"] + self.p[f"bias_{side}"]
        return out[0], out[1]

    def recur(self, gates: np.ndarray, place: np.ndarray, side: str, keep: bool):
        """States of one direction, time first; where a place is empty the state stays."""
        steps, n = place.shape
        weight = self.p[f"state_{side}"]
        both, cand = weight[:, : 2 * STATE], weight[:, 2 * STATE :]
        h = np.zeros((n, STATE), np.float32)
        states = np.zeros((steps, n, STATE), np.float32)
        trace = []
        for t in range(steps) if side == "f" else range(steps - 1, -1, -1):
            there = (place[t] >= 0)[:, None]
            x = gates[place[t]]
            zr = sigmoid(x[:, : 2 * STATE] + h @ both)
            z, r = zr[:, :STATE], zr[:, STATE:]
            c = np.tanh(x[:, 2 * STATE :] + (r * h) @ cand)
            new = np.where(there, h + z * (c - h), h)
            if keep:
                trace.append((t, h, z, r, c, there))
            h = states[t] = new
        return states, trace

    def forward(self, gates, place: np.ndarray, keep: bool = False):
        """Logit of each window. place: word numbers, time first."""
        hf, tf = self.recur(gates[0], place, "f", keep)
        hb, tb = self.recur(gates[1], place, "b", keep)
        states = np.concatenate([hf, hb], axis=2)
        hidden = np.tanh(states @ self.p["attend"] + self.p["attend_bias"])
        energy = np.where(place >= 0, hidden @ self.p["query"], np.float32(-1e9))
        energy = np.exp(energy - energy.max(axis=0))
        share = energy / energy.sum(axis=0)
        context = (share[:, :, None] * states).sum(axis=0)
        logit = context @ self.p["out"] + self.p["bias"][0]
        return logit, (states, hidden, share, context, tf, tb)

    def gradients(self, features, place: np.ndarray, label: np.ndarray, weight: np.ndarray) -> dict[str, np.ndarray]:
        """Of the weighted log loss, by back-propagation through time."""
        x = self.inputs(features)
        gates = [x @ self.p[f"in_{s}"] + self.p[f"bias_{s}"] for s in "fb"]
        logit, (states, hidden, share, context, tf, tb) = self.forward(gates, place, keep=True)
        g = {k: np.zeros_like(v) for k, v in self.p.items()}
        d_logit = ((sigmoid(logit) - label) * weight / weight.sum()).astype(np.float32)
        g["out"], g["bias"][0] = context.T @ d_logit, d_logit.sum()
        d_context = d_logit[:, None] * self.p["out"]
        d_states = share[:, :, None] * d_context
        d_share = (states * d_context).sum(axis=2)
        d_energy = share * (d_share - (share * d_share).sum(axis=0))
        g["query"] = np.einsum("tn,tna->a", d_energy, hidden)
        d_hidden = d_energy[:, :, None] * self.p["query"] * (1 - hidden**2)
        g["attend"] = np.einsum("tns,tna->sa", states, d_hidden)
        g["attend_bias"] = d_hidden.sum(axis=(0, 1))
        d_states += d_hidden @ self.p["attend"].T
        d_x = np.zeros_like(x)
        for side, trace, own in (("f", tf, d_states[:, :, :STATE]), ("b", tb, d_states[:, :, STATE:])):
            weight_s = self.p[f"state_{side}"]
            both, cand = weight_s[:, : 2 * STATE], weight_s[:, 2 * STATE :]
            d_gates = np.zeros((len(x), 3 * STATE), np.float32)
            d_h = np.zeros_like(own[0])
            for t, h, z, r, c, there in reversed(trace):
                d_h = d_h + own[t]
                d_new = np.where(there, d_h, 0)
                d_c = d_new * z * (1 - c**2)
                d_z = d_new * (c - h) * z * (1 - z)
                d_rh = d_c @ cand.T
                d_r = d_rh * h * r * (1 - r)
                d_zr = np.concatenate([d_z, d_r], axis=1)
                g[f"state_{side}"][:, : 2 * STATE] += h.T @ d_zr
                g[f"state_{side}"][:, 2 * STATE :] += (r * h).T @ d_c
                d_h = np.where(there, d_new * (1 - z) + d_rh * r + d_zr @ both.T, d_h)
                filled = there[:, 0]
                np.add.at(d_gates, place[t][filled], np.concatenate([d_zr, d_c], axis=1)[filled])
            g[f"in_{side}"] = x.T @ d_gates
            g[f"bias_{side}"] = d_gates.sum(axis=0)
            d_x += d_gates @ self.p[f"in_{side}"].T
        rows, buckets, of_word, sizes = features
        np.add.at(g["words"], rows, d_x[:, :WORD])
        g["words"][0] = 0
        np.add.at(g["grams"], buckets, (d_x[:, WORD:] / sizes[:, None])[of_word])
        return g


@dataclass
class Model:
    network: Network | None
    weights: np.ndarray  # of the window summary, then the bias
    prior: float

    def summary(self, logits: np.ndarray) -> np.ndarray:
        """What a document's windows say: the highest, the mean of the two highest, and the mean chance."""
        top = np.sort(logits)[::-1]
        return np.array([top[0], top[:2].mean(), sigmoid(logits).mean()])

    def score(self, logits: np.ndarray) -> float:
        return float(sigmoid(self.summary(logits) @ self.weights[:-1] + self.weights[-1]))


class Windows:
    """All windows of some documents, which are laid out as columns of word numbers only when they are asked for."""

    def __init__(self, numbers: list[np.ndarray]):
        sizes = np.array([len(x) for x in numbers], np.int64)
        begins = [windows_of(n) for n in sizes.tolist()]
        counts = np.array([len(b) for b in begins], np.int64)
        self.words = np.concatenate([*numbers, np.zeros(1, np.int32)]).astype(np.int32, copy=False)
        self.owner = np.repeat(np.arange(len(numbers)), counts)
        ends = np.cumsum(sizes)
        self.begin = np.concatenate([*begins, np.zeros(0, np.int64)]) + np.repeat(ends - sizes, counts)
        self.size = np.minimum(WINDOW, np.repeat(ends, counts) - self.begin)  # words in each window

    def __len__(self) -> int:
        return len(self.owner)

    def place(self, which) -> np.ndarray:
        """Word numbers of some windows, time first, -1 behind the last word of a short text."""
        inside = np.arange(WINDOW)[:, None] < self.size[which]
        at = np.where(inside, self.begin[which] + np.arange(WINDOW)[:, None], len(self.words) - 1)
        return np.where(inside, self.words[at], -1).astype(np.int64)


def logits_of(network: Network, gates, windows: Windows) -> np.ndarray:
    """Logits of many windows, some thousand at a time; windows without words are left at the bias."""
    out = np.full(len(windows), network.p["bias"][0], np.float32)
    for begin in range(0, len(windows), 1024):
        part = windows.place(slice(begin, begin + 1024))
        out[begin : begin + 1024] = network.forward(gates, part)[0]
    return np.where(windows.size > 0, out, network.p["bias"][0])


def numbered(texts: Iterable[str]) -> tuple[list[str], list[np.ndarray]]:
    """The distinct words, and each text as numbers into them; a text is let go before the next one is read."""
    table: dict[str, int] = {}
    numbers = [np.array([table.setdefault(w, len(table)) for w in words_of(t)], np.int32) for t in texts]
    return list(table), numbers


def train(texts: Iterable[str], labels: list[int], counts: dict[int, int], steps_to_take: int, batch: int) -> Model:
    """Fit on a bounded sample. counts: how many labelled documents of each label the sample stands for.

    Texts are read one by one; what is held is four bytes for each of their words, and the distinct words.

    A document is toxic by some of its windows only, so after the first rounds the network learns from the windows of
    a document that it scores highest. Every KEPT_OUT-th document takes no part in that: on those a logistic curve from
    the windows' logits to the document's label is fitted, weighted back to the shares of all labelled documents.
    """
    names, numbers = numbered(texts)
    y = np.array(labels)
    prior = counts.get(1, 0) / max(1, sum(counts.values()))
    if not len(y) or y.min() == y.max():
        return Model(None, np.zeros(4), prior if len(y) else 0.0)
    rng = np.random.default_rng(SEED)
    fit = np.ones(len(y), bool)
    for k in (0, 1):  # the same share of each label
        fit[rng.permutation(np.flatnonzero(y == k))[::KEPT_OUT][1:]] = False
    if not names:
        return Model(None, np.zeros(4), prior)
    seen = np.zeros(len(names), np.int64)  # documents each word stands in
    for k in np.flatnonzero(fit):
        seen[np.unique(numbers[k])] += 1
    often = [names[k] for k in sorted(np.flatnonzero(seen >= 3), key=lambda k: (-seen[k], names[k]))[:VOCABULARY]]
    network = Network({w: k + 1 for k, w in enumerate(often)})
    features = word_features(names, network.known)
    windows = Windows(numbers)
    del numbers
    owner, filled = windows.owner, windows.size > 0
    moving = {k: [np.zeros_like(v), np.zeros_like(v)] for k, v in network.p.items()}
    steps = 0
    usable = fit[owner] & filled
    while steps < steps_to_take and usable.any():
        chance = rng.random(len(owner))
        warm = steps < WARM * steps_to_take
        if not warm:  # the most telling windows, and now and then another one
            logits = logits_of(network, network.projected(features), windows)
            chance = np.where(chance > 0.95, 1e9, logits)
        order = np.lexsort((-chance, owner))
        rank = np.arange(len(owner)) - np.searchsorted(owner[order], owner[order])
        chosen = order[(rank < (WINDOWS_BEFORE if warm else WINDOWS_AFTER)) & usable[order]]
        if not len(chosen):
            break
        rng.shuffle(chosen)
        for begin in range(0, len(chosen), batch):
            part = chosen[begin : begin + batch]
            own, place_now = np.unique(windows.place(part), return_inverse=True)
            place_now = place_now.reshape(WINDOW, -1)
            if own[0] == -1:
                own, place_now = own[1:], place_now - 1
            now = y[owner[part]]
            weight = np.where(now == 1, 0.5 / max(1, (now == 1).sum()), 0.5 / max(1, (now == 0).sum()))
            own_features = word_features([names[k] for k in own], network.known)
            own_features[0][rng.random(len(own)) < DROPPED] = 0
            grads = network.gradients(own_features, place_now, now, weight)
            rate = RATE * min(1.0, 2.0 * (1.05 - min(1.0, steps / steps_to_take)))
            steps += 1
            for k, grad in grads.items():
                grad = np.clip(grad, -1, 1)
                m, v = moving[k]
                m += 0.1 * (grad - m)
                v += 0.01 * (grad * grad - v)
                network.p[k] -= (rate * (m / (1 - 0.9**steps)) / (np.sqrt(v / (1 - 0.99**steps)) + 1e-8)).astype(np.float32)
    model = Model(network, np.zeros(4), prior)
    logits = logits_of(network, network.projected(features), windows)
    each = np.split(logits, np.searchsorted(owner, np.arange(1, len(y))))
    x = np.array([np.append(model.summary(z), 1.0) for z in each])
    held = ~fit if 0 < y[~fit].mean() < 1 else np.ones(len(y), bool)
    share = np.array([counts[k] / max(1, (y[held] == k).sum()) for k in (0, 1)])[y[held]]
    model.weights = logistic(x[held], y[held], share / share.sum())
    return model


def logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Weighted logistic regression with a small ridge, by Newton steps."""
    w = np.zeros(x.shape[1])
    penalty = 1e-3 * np.eye(x.shape[1])
    for _ in range(50):
        p = sigmoid(x @ w)
        hessian = (x * (weight * p * (1 - p))[:, None]).T @ x + penalty
        w = w + np.clip(np.linalg.solve(hessian, x.T @ (weight * (y - p)) - penalty @ w), -2, 2)
    return w


class Scorer:
    """A worker's model with the projections of the words it has seen."""

    def __init__(self, model: Model):
        self.model = model
        self.rows: dict[str, int] = {}
        self.gates = [np.zeros((0, 3 * STATE), np.float32)] * 2

    def scores(self, texts: list[str]) -> list[float]:
        if self.model.network is None:
            return [self.model.prior] * len(texts)
        words = [words_of(t) for t in texts]
        if len(self.rows) > REMEMBERED:
            self.rows, self.gates = {}, [g[:0] for g in self.gates]
        new = list(set().union(*words).difference(self.rows))
        if new:
            self.rows.update(zip(new, range(len(self.rows), len(self.rows) + len(new))))
            fresh = self.model.network.projected(word_features(new, self.model.network.known))
            self.gates = [np.concatenate([g, f.astype(np.float32)]) for g, f in zip(self.gates, fresh)]
        get = self.rows.__getitem__
        if not self.rows:
            self.gates = [np.zeros((1, 3 * STATE), np.float32)] * 2
        windows = Windows([np.fromiter(map(get, w), np.int32, len(w)) for w in words])
        logits = logits_of(self.model.network, self.gates, windows)
        return [self.model.score(z) for z in np.split(logits, np.searchsorted(windows.owner, np.arange(1, len(texts))))]


def training_sample(documents: DataFrame, labels: DataFrame) -> tuple[DataFrame, dict[int, int]]:
    """Texts and labels of at most SAMPLE documents of each label, with their turn, and the counts of labels."""
    counts = {r.label: r["count"] for r in labels.groupBy("label").count().collect()}
    by_hash = F.xxhash64("doc_id", F.lit(SEED))
    chosen = [labels.where(F.col("label") == k).withColumn("turn", by_hash).orderBy("turn", "doc_id").limit(SAMPLE) for k in (0, 1)]
    ids = chosen[0].unionByName(chosen[1]).select(F.col("doc_id").alias("label_id"), "label", "turn")
    # at most 2 * SAMPLE ids
    rows = documents.join(F.broadcast(ids), F.col("doc_id") == F.col("label_id")).select("turn", "doc_id", "label", "text")
    # an id can stand in many rows: one of its texts is enough
    return rows.groupBy("turn", "doc_id", "label").agg(F.min("text").alias("text")), counts


def trained(documents: DataFrame, labels: DataFrame) -> Model:
    """The model of the sample, fitted in one task, so that neither texts nor the fit burden the driver."""
    sample, counts = training_sample(documents, labels)
    steps, batch = STEPS, BATCH

    def fit(batches):
        marks: list[int] = []

        def texts():
            for part in batches:
                marks.extend(part.column(0).to_pylist())
                for text in part.column(1):
                    yield text.as_py() or ""

        # labels are known when the last text has been read
        model = train(texts(), marks, counts, steps, batch)
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(model)], pa.binary())], names=["model"])

    ordered = sample.repartition(1).sortWithinPartitions("turn", "doc_id", "label").select("label", "text")
    rows = ordered.mapInArrow(fit, "model binary").collect()
    return pickle.loads(rows[0].model) if rows else Model(None, np.zeros(4), 0.0)  # no rows, no task


_SCORERS: dict[str, Scorer] = {}


def toxicity_scores(
    documents: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    score_col: str = "score",
) -> DataFrame:
    """All columns and rows of `documents`, with the chance of label 1 in `score_col` (which replaces one of that name).

    labels: doc_id, label (0 or 1, others are left out). The network is trained on at most SAMPLE documents of each
    label, which is the one bound here, in one task of an executor; every window of every whole text is scored. Null and empty texts are scored as
    one empty window. Null ids are scored and never learnt from; rows that repeat an id are scored each. With labels
    of one kind every score is that kind, without labels 0.
    """
    spark = documents.sparkSession
    python_ready(spark)
    rows = documents.drop(score_col)
    marked = labels.where("label in (0, 1) and doc_id is not null").select("doc_id", F.col("label").cast("int")).distinct()
    own = documents.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    model = trained(own, stage(marked, "toxic-labels"))
    key = uuid.uuid4().hex
    shared = spark.sparkContext.broadcast(model)
    place = rows.columns.index(text_col)

    def run(batches):
        if key not in _SCORERS:
            _SCORERS.clear()
            _SCORERS[key] = Scorer(shared.value)
        scorer = _SCORERS[key]
        for batch in batches:
            scores = scorer.scores([t or "" for t in batch.column(place).to_pylist()])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(scores, pa.float64())], names=[*batch.schema.names, score_col]
            )

    schema = T.StructType([*rows.schema.fields, T.StructField(score_col, T.DoubleType())])
    return rows.mapInArrow(run, schema)
