"""Boosted trees that take missing values and categories as they are, grown on gradient sums that Spark aggregates.

Columns are binned once and the binned rows are written to the shared folder. For every round of a tree the tasks sum
gradients per (leaf, column, bin); only these sums, whose number is bound by the settings, reach the driver, which
picks the splits. Bin 0 of every column holds the missing values. A split is the set of bins that go left, so a
number's cut, a group of categories and the learned side of the missing values are one thing.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.functions import columns as C
from riskloom.functions import constants as K
from riskloom.operators import aggregation, evaluation, explain, features
from riskloom.session import ship_package, staged


@dataclass(frozen=True)
class BoostSpec:
    """Columns and settings. patience: trees without a better validation AUC after which growing stops."""

    numeric: Sequence[str]
    categorical: Sequence[str] = ()
    label: str = K.TARGET
    key: str = K.ID
    trees: int = 200
    leaves: int = 34
    depth: int = 8
    step: float = 0.05
    min_rows: int = 70
    ridge: float = 1.0
    row_share: float = 0.8
    column_share: float = 0.8
    bins: int = 63
    max_categories: int = 60
    patience: int = 100
    # trees between two looks at the validation rows
    stride: int = 10
    seed: int = 42

    @property
    def columns(self) -> list[str]:
        return [*self.numeric, *self.categorical]


@dataclass
class Tree:
    """Nodes in order of their making; -1 as column marks a leaf."""

    column: list[int] = field(default_factory=list)
    left_bins: list[tuple[int, ...]] = field(default_factory=list)
    left: list[int] = field(default_factory=list)
    right: list[int] = field(default_factory=list)
    value: list[float] = field(default_factory=list)
    gain: list[float] = field(default_factory=list)
    rows: list[int] = field(default_factory=list)

    def add(self, value: float, rows: int) -> int:
        for values, given in zip(
            (self.column, self.left_bins, self.left, self.right, self.value, self.gain, self.rows),
            (-1, (), -1, -1, value, 0.0, rows),
        ):
            values.append(given)
        return len(self.column) - 1

    def nodes_of(self, bins: np.ndarray) -> np.ndarray:
        """The leaf of each row."""
        at = np.zeros(len(bins), np.int32)
        for node, column in enumerate(self.column):  # a child is made after its parent
            if column >= 0:
                here = np.flatnonzero(at == node)
                goes = np.zeros(256, bool)
                goes[list(self.left_bins[node])] = True
                at[here] = np.where(goes[bins[here, column]], self.left[node], self.right[node])
        return at

    def margins(self, bins: np.ndarray) -> np.ndarray:
        return np.array(self.value)[self.nodes_of(bins)]


@dataclass
class BoostedTrees:
    spec: BoostSpec
    edges: dict[str, list[float]]
    levels: dict[str, list[str]]
    base: float
    trees: list[Tree] = field(default_factory=list)
    valid_auc: list[float] = field(default_factory=list)

    @property
    def best_iteration(self) -> int:
        return best_prefix(self.valid_auc, self.spec.patience)[0] if self.valid_auc else len(self.trees)


def best_prefix(aucs: Sequence[float], patience: int) -> tuple[int, bool]:
    """Number of trees of the best prefix (the first of equals), and whether patience ended before the list does."""
    best = 0
    for k, auc in enumerate(aucs):
        if auc > aucs[best]:
            best = k
        elif k - best >= patience:
            return best + 1, True
    return best + 1, False


# ---------------------------------------------------------------- binning


def number(df: DataFrame, c: str) -> Column:
    return F.expr(f"try_cast(`{c}` AS double)") if c in df.columns else F.lit(None).cast("double")


def find_edges(df: DataFrame, spec: BoostSpec) -> dict[str, list[float]]:
    """Cuts of each number column at equal shares of its rows, from one pass of mergeable sketches."""
    shares = [k / spec.bins for k in range(1, spec.bins)]
    found = [F.percentile_approx(F.nanvl(number(df, c), F.lit(None)), shares, 10_000).alias(c) for c in spec.numeric]
    row = df.agg(*found).first() if found else {}
    return {c: sorted(set(row[c] or [])) for c in spec.numeric}


def as_bins(df: DataFrame, edges: Mapping[str, Sequence[float]], levels: Mapping[str, Sequence[str]], spec: BoostSpec) -> list[Column]:
    """A number column stays a double (NaN counts as missing); a category is its level from 1, or one more if unknown."""
    out = [F.nanvl(number(df, c), F.lit(None)).alias(f"x_{i}") for i, c in enumerate(spec.numeric)]
    for i, c in enumerate(spec.categorical, len(spec.numeric)):
        known = [F.lit(v) for v in levels[c]]
        place = F.array_position(F.array(*known), F.col(c).cast("string")) if c in df.columns and known else F.lit(0)
        given = F.col(c).isNotNull() if c in df.columns else F.lit(False)
        level = F.when(place > 0, place).otherwise(len(known) + 1)
        out.append(F.when(given, level).cast("double").alias(f"x_{i}"))
    return out


def bin_matrix(batch: pa.RecordBatch, names: Sequence[str], edges: Sequence[np.ndarray], n_numeric: int) -> np.ndarray:
    bins = np.zeros((len(batch), len(names)), np.uint8)
    for i, name in enumerate(names):
        x = batch.column(name).to_numpy(zero_copy_only=False).astype(float)
        there = ~np.isnan(x)
        bins[there, i] = 1 + np.searchsorted(edges[i], x[there]) if i < n_numeric else x[there]
    return bins


# ---------------------------------------------------------------- splits


def split_of(g: np.ndarray, h: np.ndarray, n: np.ndarray, categorical: bool, spec: BoostSpec) -> tuple[float, tuple[int, ...]]:
    """Best gain of one column in one leaf, and the bins that go left. Arrays go over the bins, missing first."""
    g_all, h_all, n_all = g.sum(), h.sum(), n.sum()
    used = 1 + np.flatnonzero(n[1:])
    if categorical:  # in the order of their mean gradient, the best grouping is a prefix
        used = used[np.lexsort((used, g[used] / (h[used] + spec.ridge)))]
    if not len(used):
        return 0.0, ()
    best, cut = 0.0, ()
    whole = g_all**2 / (h_all + spec.ridge)
    for missing_left in ((False, True) if n[0] else (False,)):
        gl, hl, nl = (np.cumsum(a[used]) + (a[0] if missing_left else 0) for a in (g, h, n))
        gain = gl**2 / (hl + spec.ridge) + (g_all - gl) ** 2 / (h_all - hl + spec.ridge) - whole
        gain[(nl < spec.min_rows) | (n_all - nl < spec.min_rows)] = -np.inf
        k = int(gain.argmax())
        if gain[k] > best + 1e-12:
            best, cut = float(gain[k]), (*((0,) if missing_left else ()), *used[: k + 1].tolist())
    if cut and not n[0] and 2 * n[list(cut)].sum() > n_all:
        cut = (0, *cut)  # no missing value was seen here: they go with most of the rows
    if cut and not categorical:  # bins that nobody of this leaf is in go by their place
        last = max(cut)
        cut = (*((0,) if 0 in cut else ()), *range(1, last + 1))
    return best, cut


def open_splits(tree: Tree, depth: dict[int, int], sums: Mapping[int, tuple], columns: Sequence[int], spec: BoostSpec) -> list:
    """(gain, node, column, left bins) of the best split of every leaf with sums that may be split."""
    out = []
    for node, (g, h, n) in sums.items():
        if depth[node] >= spec.depth:
            continue
        best = (0.0, -1, ())
        for c in columns:
            gain, cut = split_of(g[c], h[c], n[c], c >= len(spec.numeric), spec)
            if gain > best[0] + 1e-12:
                best = (gain, c, cut)
        if best[1] >= 0:
            out.append((best[0], node, best[1], best[2]))
    return sorted(out, key=lambda s: (-s[0], s[1]))


def grow(sums_of, columns: Sequence[int], spec: BoostSpec) -> Tree:
    """One tree, leaves with the largest gains first: each round splits up to half of what the limit still allows.

    sums_of(tree, nodes) gives each node's gradient, curvature and row sums as (column, bin) arrays.
    """
    tree, depth, waiting = Tree(), {0: 0}, {}
    tree.add(0.0, 0)
    fresh, leaves = [0], 1
    while fresh:
        for node, (g, h, n) in sums_of(tree, fresh).items():
            tree.value[node] = -spec.step * float(g[0].sum() / (h[0].sum() + spec.ridge))
            tree.rows[node] = int(n[0].sum())
            waiting[node] = (g, h, n)
        fresh = []
        for gain, node, column, cut in open_splits(tree, depth, waiting, columns, spec)[: max(1, (spec.leaves - leaves + 1) // 2)]:
            if leaves >= spec.leaves:
                break
            left, right = tree.add(0.0, 0), tree.add(0.0, 0)
            tree.column[node], tree.left_bins[node], tree.gain[node] = column, cut, gain
            tree.left[node], tree.right[node] = left, right
            depth[left] = depth[right] = depth[node] + 1
            del waiting[node]
            fresh += [left, right]
            leaves += 1
    return tree


def kept_rows(turn: np.ndarray, tree: int, spec: BoostSpec) -> np.ndarray:
    """The rows that a tree learns from, by their hash and the tree's number."""
    x = turn.view(np.uint64) + np.uint64((tree + spec.seed) * 0x9E3779B97F4A7C15 % 2**64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return (x >> np.uint64(11)).astype(float) / 2**53 < spec.row_share


def tree_columns(tree: int, spec: BoostSpec) -> list[int]:
    n = len(spec.columns)
    rng = np.random.default_rng((spec.seed, tree))
    return sorted(rng.permutation(n)[: max(1, math.ceil(spec.column_share * n))].tolist())


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-x))


def histogram(bins: np.ndarray, place: np.ndarray, weights: np.ndarray, width: int, nodes: int) -> np.ndarray:
    """Sums of `weights` by (node, column, bin); place: the number of each row's node."""
    n, columns = bins.shape
    cell = (place[:, None] * columns + np.arange(columns)) * width + bins
    return np.bincount(cell.ravel(), np.repeat(weights, columns), nodes * columns * width).reshape(nodes, columns, width)


# ---------------------------------------------------------------- fitting


def fit(train: DataFrame, valid: DataFrame, spec: BoostSpec, balanced: bool = True) -> BoostedTrees:
    """Boosted trees of the log loss, stopped by the exact AUC of the validation rows.

    Edges, levels and weights come from `train` alone. Rows without a label are left out. balanced: both classes weigh
    the same. With one class only, or without rows, there are no trees. Every `stride` trees the margins that each
    validation row has after each new tree are reduced to (tree, margin) cells, and one plan gives the AUC of every
    prefix; the prefix with the best AUC within `patience` is kept.
    """
    spark = train.sparkSession
    ship_package(spark)
    labelled = train.filter(F.col(spec.label).isNotNull())
    counts = {int(r[0]): r[1] for r in labelled.groupBy(spec.label).count().collect()}
    edges = find_edges(labelled, spec)
    levels = aggregation.top_values(labelled, list(spec.categorical), spec.max_categories) if spec.categorical else {}
    total = sum(counts.values())
    weight = {k: total / (2 * n) if balanced else 1.0 for k, n in counts.items()}
    if set(counts) != {0, 1}:
        return BoostedTrees(spec, edges, levels, 0.0)
    mass = {k: weight[k] * counts[k] for k in counts}
    model = BoostedTrees(spec, edges, levels, math.log(mass[1] / mass[0]))

    def binned(df: DataFrame, name: str) -> DataFrame:
        y = F.col(spec.label).cast("double")
        rows = df.filter(F.col(spec.label).isNotNull()).select(
            y.alias("y"), F.xxhash64(spec.key).alias("turn"), *as_bins(df, edges, levels, spec))
        return staged(packed_bins(rows, model), name)

    fitted, held = binned(train, "boost-train"), binned(valid, "boost-valid")
    width = max([spec.bins + 1, *(len(v) + 2 for v in levels.values())])
    while len(model.trees) < spec.trees:
        for _ in range(min(spec.stride, spec.trees - len(model.trees))):
            if (len(model.trees) + 1) % spec.stride == 0:  # margins so far are written, so trees are not walked again
                fitted = staged(with_margins(fitted, model), "boost-train")
            k = len(model.trees)
            model.trees.append(grow(lambda tree, nodes: node_sums(fitted, model, tree, nodes, weight, width), tree_columns(k, spec), spec))
        model.valid_auc += prefix_aucs(held, model, len(model.valid_auc))
        held = staged(with_margins(held, model), "boost-valid")
        if best_prefix(model.valid_auc, spec.patience)[1]:
            break
    model.trees = model.trees[: model.best_iteration]
    return model


BINNED = "y double, turn long, bins binary, margin double, walked int"


def packed_bins(rows: DataFrame, model: BoostedTrees) -> DataFrame:
    """y, turn, one byte per column, and the margin at the start."""
    names = [f"x_{i}" for i in range(len(model.spec.columns))]
    edges, n_numeric, base = edge_arrays(model), len(model.spec.numeric), model.base

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bins = [r.tobytes() for r in bin_matrix(batch, names, edges, n_numeric)]
            n = len(batch)
            yield pa.RecordBatch.from_arrays(
                [batch.column("y"), batch.column("turn"), pa.array(bins, pa.binary()), pa.array(np.full(n, base)),
                 pa.array(np.zeros(n, np.int32))], names=["y", "turn", "bins", "margin", "walked"])

    return rows.mapInArrow(pack, BINNED)


def edge_arrays(model: BoostedTrees) -> list[np.ndarray]:
    return [np.array(model.edges[c]) for c in model.spec.numeric]


def unpacked(batch: pa.RecordBatch, trees: Sequence[Tree]) -> tuple[np.ndarray, np.ndarray]:
    """Bins, and margins after all trees that the stored margin lacks."""
    bins = np.frombuffer(b"".join(batch.column("bins").to_pylist()), np.uint8).reshape(len(batch), -1)
    margin = batch.column("margin").to_numpy().copy()
    if len(batch):
        for tree in trees[batch.column("walked")[0].as_py() :]:
            margin += tree.margins(bins)
    return bins, margin


def with_margins(rows: DataFrame, model: BoostedTrees) -> DataFrame:
    trees = list(model.trees)

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            margin = unpacked(batch, trees)[1]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array(margin), pa.array(np.full(len(batch), len(trees), np.int32))], names=batch.schema.names)

    return rows.mapInArrow(walk, BINNED)


def node_sums(rows: DataFrame, model: BoostedTrees, tree: Tree, nodes: Sequence[int], weight: Mapping[int, float], width: int) -> dict:
    """Sums of the gradients of the asked nodes: per task, then by (node, column, bin)."""
    spec, trees, number_of = model.spec, list(model.trees), len(model.trees)
    slot = np.full(len(tree.column), -1)
    slot[list(nodes)] = np.arange(len(nodes))
    shape = (len(nodes), len(spec.columns), width)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((3, *shape))
        for batch in batches:
            if not len(batch):
                continue
            bins, margin = unpacked(batch, trees)
            place = slot[tree.nodes_of(bins)]
            mine = (place >= 0) & kept_rows(batch.column("turn").to_numpy(), number_of, spec)
            y = batch.column("y").to_numpy()[mine]
            p, w = sigmoid(margin[mine]), np.where(y == 1, weight[1], weight[0])
            for k, values in enumerate((w * (p - y), w * p * (1 - p), np.ones(len(y)))):
                total[k] += histogram(bins[mine], place[mine], values, width, len(nodes))
        cell = np.flatnonzero(total[2])
        parts = total.reshape(3, -1)[:, cell]
        yield pa.RecordBatch.from_arrays([pa.array(cell), *map(pa.array, parts)], names=["cell", "g", "h", "n"])

    found = rows.mapInArrow(sums, "cell long, g double, h double, n double").groupBy("cell").agg(
        F.sum("g").alias("g"), F.sum("h").alias("h"), F.sum("n").alias("n"))
    out = np.zeros((3, math.prod(shape)))
    for r in found.collect():  # at most new leaves x columns x bins
        out[:, r["cell"]] = r["g"], r["h"], r["n"]
    g, h, n = out.reshape(3, *shape)
    return {node: (g[i], h[i], n[i]) for i, node in enumerate(nodes)}


def prefix_aucs(rows: DataFrame, model: BoostedTrees, done: int) -> list[float]:
    """AUC of the validation rows after each tree from `done` on, in one plan."""
    trees = list(model.trees)

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bins, margin = unpacked(batch, trees[:done])
            y = batch.column("y").to_numpy()
            for k in range(done, len(trees)):
                margin = margin + trees[k].margins(bins)
                scores, at = np.unique(margin, return_inverse=True)
                events = np.bincount(at, y, len(scores)).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(scores), k, np.int32)), pa.array(scores), pa.array(events),
                     pa.array(np.bincount(at, minlength=len(scores)) - events)], names=["tree", "score", "events", "nonevents"])

    parts = rows.mapInArrow(cells, "tree int, score double, events long, nonevents long")
    summed = staged(parts.groupBy("tree", "score").agg(F.sum("events").alias("events"), F.sum("nonevents").alias("nonevents")), "boost-cells")
    found = {r["tree"]: r["auc"] for r in evaluation.auc_of_cells(summed, ["tree"]).collect()}
    return [found.get(k) or 0.5 for k in range(done, len(trees))]  # one class: no prefix is better than another


# ---------------------------------------------------------------- using a model


def mapped(df: DataFrame, model: BoostedTrees, out: T.StructType, work, before: Sequence[str] = ()) -> DataFrame:
    """All columns of `df` and those that work(bins) gives for each batch.

    before: columns with an earlier state of the inputs; work then gets both states' bins, and the columns go.
    """
    spec, edges, n_numeric = model.spec, edge_arrays(model), len(model.spec.numeric)
    ship_package(df.sparkSession)
    prefix = "_bin_"
    while any(c.lower().startswith(prefix) for c in df.columns):
        prefix = "_" + prefix
    names = [f"{prefix}{i}" for i in range(len(spec.columns))]
    own = [c for c in df.columns if c not in out.names and c not in before]
    inputs = [*(x.alias(n) for x, n in zip(as_bins(df, model.edges, model.levels, spec), names)), *before]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            states = [bin_matrix(batch, n, edges, n_numeric) for n in (names, before) if n]
            made = work(*states)
            arrays = [pa.array(v, f.type) for v, f in zip(made, to_arrow)]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(own)], *arrays], names=[*own, *out.names])

    to_arrow = [pa.field(f.name, pa.list_(pa.float64()) if isinstance(f.dataType, T.ArrayType) else pa.float64()) for f in out]
    rows = df.select(*own, *inputs)
    return rows.mapInArrow(run, T.StructType([*(df.schema[c] for c in own), *out]))


def score(df: DataFrame, model: BoostedTrees, out: str = K.RAW_SCORE) -> DataFrame:
    """The event probability in a column of its own; unknown categories, bad text and absent columns are scored too."""
    trees, base = list(model.trees), model.base

    def work(bins: np.ndarray) -> list:
        return [sigmoid(base + sum((t.margins(bins) for t in trees), np.zeros(len(bins))))]

    return mapped(df, model, T.StructType([T.StructField(out, T.DoubleType())]), work)


def trees_reading(model: BoostedTrees) -> dict[str, list[int]]:
    """Column -> the trees that split on it."""
    out: dict[str, list[int]] = {c: [] for c in model.spec.columns}
    for k, tree in enumerate(model.trees):
        for c in sorted({c for c in tree.column if c >= 0}):
            out[model.spec.columns[c]].append(k)
    return out


def split_columns(model: BoostedTrees) -> list[np.ndarray]:
    """Per tree, a mask of the columns that it reads."""
    reads = np.zeros((len(model.trees), len(model.spec.columns)), bool)
    for column, trees in zip(model.spec.columns, trees_reading(model).values()):
        reads[trees, model.spec.columns.index(column)] = True
    return list(reads)


TWO_STATES = T.StructType([T.StructField(n, T.DoubleType()) for n in ("base_probability", "changed_probability", "trees_walked")])


def simulate(df: DataFrame, model: BoostedTrees, changes: Mapping[str, object], threshold: float, width: float = 0.0) -> DataFrame:
    """Key, score before and after the changes, difference, decisions, and how many trees the second score walked.

    Both states of a row lie side by side, so nothing is shuffled. After the change only the trees that read a column
    whose bin moved are walked, derived columns included; the others keep their value. The scores are those of `score`.
    """
    trees, base, reads = list(model.trees), model.base, split_columns(model)
    prefix = "_before_"
    while any(c.lower().startswith(prefix) for c in df.columns):
        prefix = "_" + prefix
    inputs = [x.alias(f"{prefix}{i}") for i, x in enumerate(as_bins(df, model.edges, model.levels, model.spec))]
    before = [f"{prefix}{i}" for i in range(len(inputs))]
    changed = features.apply_changes(df.select("*", *inputs), changes)

    def work(bins: np.ndarray, old: np.ndarray) -> list:
        moved = bins != old
        first, second, walked = (np.zeros(len(bins)) for _ in range(3))
        for tree, columns in zip(trees, reads):
            values = tree.margins(old)
            first += values
            at = np.flatnonzero(moved[:, columns].any(axis=1))
            values[at] = tree.margins(bins[at])
            second += values
            walked[at] += 1
        return [sigmoid(base + first), sigmoid(base + second), walked]

    out = mapped(changed, model, TWO_STATES, work, before)
    p, q = F.col("base_probability"), F.col("changed_probability")
    was, now = C.decide(p, threshold, width), C.decide(q, threshold, width)
    return out.select(
        model.spec.key, "base_probability", was.alias("base_decision"), "changed_probability", now.alias("changed_decision"),
        (q - p).alias("delta_probability"), (was != now).alias("decision_changed"), F.col("trees_walked").cast("long"))


SWEPT = T.StructType([T.StructField(n, T.DoubleType()) for n in ("probability_default", "trees_walked")])


def sweep(
    df: DataFrame, model: BoostedTrees, column: str, values: Sequence[float], threshold: float,
    changes: Mapping[str, object] | None = None,
) -> DataFrame:
    """Key, value, probability, decision and trees walked, for every row at every value of one column.

    The points of a row follow one another in a task. A tree's value hangs on the bins it reads alone, so a tree is
    walked only where one of them differs from the row before; two values in one bin cost nothing. This holds for any
    order of the rows: order decides how much is walked, never the score.
    """
    if len(values) > explain.MAX_SWEEP:
        raise ValueError(f"a sweep takes at most {explain.MAX_SWEEP} values")
    if column not in df.columns:
        raise ValueError(f"unknown column {column!r}")
    trees, base, reads = list(model.trees), model.base, split_columns(model)
    point = "_value"
    while point in (c.lower() for c in df.columns):
        point = "_" + point
    grown = df.withColumn(point, F.explode(F.array(*[F.lit(float(v)) for v in sorted(values)]).cast("array<double>")))
    changed = features.apply_changes(grown, {**(changes or {}), column: F.col(point)})

    def work(bins: np.ndarray) -> list:
        total, walked = np.zeros(len(bins)), np.zeros(len(bins))
        if len(bins):
            moved = np.ones(bins.shape, bool)
            moved[1:] = bins[1:] != bins[:-1]
            for tree, columns in zip(trees, reads):
                need = moved[:, columns].any(axis=1)
                need[0] = True
                total += tree.margins(bins[need])[np.cumsum(need) - 1]
                walked += need
        return [sigmoid(base + total), walked]

    out = mapped(changed, model, SWEPT, work)
    return out.select(
        model.spec.key, F.col(point).alias("value"), "probability_default",
        C.decide("probability_default", threshold).alias("decision"), F.col("trees_walked").cast("long"))


def leaves_of(model: BoostedTrees) -> list[dict]:
    """Per leaf its value and, per column on the way, the share of rows that follow and the conditions on the bins."""
    out = []
    for tree in model.trees:
        stack = [(0, {})]
        while stack:
            node, path = stack.pop()
            c = tree.column[node]
            if c < 0:
                out.append({"value": tree.value[node], "path": path})
                continue
            for child, goes_left in ((tree.left[node], True), (tree.right[node], False)):
                ratio, tests = path.get(c, (1.0, ()))
                cover = tree.rows[child] / max(tree.rows[node], 1)
                stack.append((child, {**path, c: (ratio * cover, (*tests, (tree.left_bins[node], True, goes_left)))}))
    return out


def contributions(df: DataFrame, model: BoostedTrees) -> DataFrame:
    """Key, raw probability, base value, margin and one contribution in log-odds per column."""
    leaves, base, key = leaves_of(model), model.base, model.spec.key
    fields = [T.StructField(n, T.DoubleType()) for n in ("raw_probability", "base_value", "margin")]
    schema = T.StructType([*fields, T.StructField("_phi", T.ArrayType(T.DoubleType()))])
    trees = list(model.trees)

    def work(bins: np.ndarray) -> list:
        phi, mean = explain.tree_shapley(bins.astype(float), leaves)
        p = sigmoid(base + sum((t.margins(bins) for t in trees), np.zeros(len(bins))))
        return [p, np.full(len(bins), base + mean), base + mean + phi.sum(axis=1), list(phi)]

    found = mapped(df, model, schema, work).select(key, *schema.names)
    named = F.array(*[
        F.struct(F.lit(n).alias("feature"), F.col("_phi")[i].alias("shap_value")) for i, n in enumerate(model.spec.columns)])
    return found.withColumn("contributions", named).drop("_phi")


def importance(spark, model: BoostedTrees) -> DataFrame:
    """Column, summed gain and number of splits."""
    gain, splits = dict.fromkeys(model.spec.columns, 0.0), dict.fromkeys(model.spec.columns, 0)
    for tree in model.trees:
        for c, g in zip(tree.column, tree.gain):
            if c >= 0:
                gain[model.spec.columns[c]] += g
                splits[model.spec.columns[c]] += 1
    return spark.createDataFrame([(c, gain[c], splits[c]) for c in gain], "feature string, gain double, splits long")
