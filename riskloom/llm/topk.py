"""Exact top-k by integer inner product: a ball tree per shard, searched by branch and bound."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from riskloom.llm.common import python_ready, stage

#: Vectors of one shard, queries of one block, vectors of one leaf.
SHARD_ROWS = 8192
BLOCK_QUERIES = 2048
LEAF_ROWS = 64
#: Products below this are exact in double precision.
EXACT = float(2**52)


def integer_vector(vector: Column, scale: int = 256) -> Column:
    """floor(scale * x) of every component; null where the vector or a component is null or not finite."""
    wide = F.transform(vector, lambda x: x.cast("double"))
    bad = F.exists(wide, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    whole = F.transform(wide, lambda x: F.floor(x * float(scale)).cast("double"))
    return F.when(vector.isNotNull() & ~bad, whole)


@dataclass
class Tree:
    """Balls over rows of one array: leaf rows lie side by side."""

    rows: np.ndarray  # the vectors, in leaf order
    ids: np.ndarray
    center: np.ndarray
    radius: np.ndarray
    child: np.ndarray  # index of the first of two children, -1 for a leaf
    begin: np.ndarray
    end: np.ndarray


def build(ids: np.ndarray, rows: np.ndarray) -> Tree:
    """Halve along the line between two far vectors until a ball holds LEAF_ROWS."""
    order = np.arange(len(ids))
    center, radius, child, begin, end = [], [], [], [], []

    def ball(a: int, b: int) -> int:
        own = rows[order[a:b]]
        mid = own.mean(axis=0)
        center.append(mid)
        radius.append(float(np.sqrt(((own - mid) ** 2).sum(axis=1).max())))
        child.append(-1)
        begin.append(a)
        end.append(b)
        return len(center) - 1

    waiting = [ball(0, len(ids))]
    while waiting:
        node = waiting.pop()
        a, b = begin[node], end[node]
        if b - a <= LEAF_ROWS or radius[node] == 0:
            continue
        own = rows[order[a:b]]
        far = own[((own - center[node]) ** 2).sum(axis=1).argmax()]
        other = own[((own - far) ** 2).sum(axis=1).argmax()]
        middle = (b - a) // 2
        along = np.argpartition(own @ (other - far), middle)
        order[a:b] = order[a:b][along]
        child[node] = ball(a, a + middle)
        ball(a + middle, b)
        waiting += [child[node], child[node] + 1]
    return Tree(
        rows[order], ids[order], np.array(center), np.array(radius), np.array(child), np.array(begin), np.array(end)
    )


def inner(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Integer inner products; Python integers where doubles are not exact."""
    if left.size and right.size and np.abs(left).max() * np.abs(right).max() * left.shape[1] >= EXACT:
        return left.astype(object).dot(np.vectorize(int, otypes=[object])(right).T)
    return left @ right.T


def search(tree: Tree, query_ids: np.ndarray, queries: np.ndarray, known: np.ndarray, k: int) -> pd.DataFrame:
    """The rows of the tree that can be among each query's k best: query_id, vec_id, score.

    known: a score that k candidates elsewhere already reach, for each query. Balls whose upper bound
    q . center + |q| radius lies below the current k-th score are left out with all they hold; the leaves that stay are
    visited in the order of their bounds.
    """
    length = np.sqrt((queries**2).sum(axis=1))
    slack = 1 + 1e-9 * length * (np.abs(tree.center).max(initial=0) + tree.radius.max(initial=0))
    floor = known.astype(float).copy()
    pair_q, pair_n = np.arange(len(queries)), np.zeros(len(queries), int)
    leaves = []
    while len(pair_q):
        bound = (
            np.einsum("ij,ij->i", queries[pair_q], tree.center[pair_n]) + length[pair_q] * tree.radius[pair_n] + slack[pair_q]
        )
        stay = bound >= floor[pair_q]
        pair_q, pair_n, bound = pair_q[stay], pair_n[stay], bound[stay]
        leaf = tree.child[pair_n] < 0
        leaves.append((pair_q[leaf], pair_n[leaf], bound[leaf]))
        down = tree.child[pair_n[~leaf]]
        pair_q, pair_n = np.repeat(pair_q[~leaf], 2), np.stack((down, down + 1), axis=1).ravel()
    at_q, at_n, bound = (np.concatenate(x) for x in zip(*leaves))
    order = np.lexsort((-bound, at_q))
    at_q, at_n, bound = at_q[order], at_n[order], bound[order]
    first = np.searchsorted(at_q, at_q)
    wave = np.arange(len(at_q)) - first
    best: list[list[tuple]] = [[] for _ in queries]
    for turn in range(int(wave.max(initial=-1)) + 1):
        now = (wave == turn) & (bound >= floor[at_q])
        if not now.any():
            continue
        own_q, own_n = at_q[now], at_n[now]
        for node in np.unique(own_n):
            asking = own_q[own_n == node]
            a, b = tree.begin[node], tree.end[node]
            scores = inner(queries[asking], tree.rows[a:b])
            for q, row in zip(asking.tolist(), scores):
                hits = np.flatnonzero((row >= floor[q]) & (tree.ids[a:b] != query_ids[q]))
                if len(hits):
                    found = best[q] + [(-int(row[h]), int(tree.ids[a + h])) for h in hits]
                    found.sort()
                    best[q] = found[:k]
                    if len(best[q]) == k:
                        floor[q] = max(floor[q], -best[q][-1][0])
    rows = [(int(query_ids[q]), vec, max(-(2**63), min(2**63 - 1, -score))) for q, found in enumerate(best) for score, vec in found]
    return pd.DataFrame(rows, columns=["query_id", "vec_id", "score"])


FOUND = "query_id long, vec_id long, score long"


def searcher(k: int):
    def run(key, shard: pd.DataFrame, block: pd.DataFrame) -> pd.DataFrame:
        if shard.empty or block.empty:
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype("int64")
        queries = np.stack(block["vector"].to_numpy())
        rows = np.stack(shard["vector"].to_numpy())
        known = block["known"].fillna(-np.inf).to_numpy(float)
        if not rows.shape[1]:
            rows, queries = np.zeros((len(rows), 1)), np.zeros((len(queries), 1))
        return search(build(shard["vec_id"].to_numpy(), rows), block["vec_id"].to_numpy(), queries, known, k).astype("int64")

    return run


def top_k(
    vectors: DataFrame,
    is_query: Column,
    k: int = 5,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """query_id, rank, vec_id, score: each query's k best candidates by integer inner product, ties to smaller ids.

    Vectors are dealt to shards and queries to blocks, both of bounded size, and every block meets every shard. A first
    round searches one shard for each query; its k-th score is where the search of all other shards starts, so most of
    their balls are never opened. Every row of the table is a candidate of every query but of itself.

    Vectors that are null or hold a null or non-finite component take no part, nor do rows without an id; only vectors
    of equal length are compared. Components and scores beyond 64 bits stand at that limit. Rows that repeat an id are each a candidate once per different vector. A query
    without candidates gives no rows, nor does an empty table.
    """
    python_ready(vectors.sparkSession)
    rows = vectors.select(
        F.col(id_col).cast("long").alias("vec_id"), integer_vector(F.col(vector_col)).alias("vector"),
        F.coalesce(is_query, F.lit(False)).alias("asks"),
    ).where("vec_id is not null and vector is not null")
    rows = stage(rows.withColumn("dim", F.size("vector")), "vectors")
    sizes = rows.agg(F.count(F.lit(1)).alias("n"), F.count_if("asks").alias("asking")).first()
    shards = max(1, -(-sizes.n // SHARD_ROWS))
    blocks = max(1, -(-sizes.asking // BLOCK_QUERIES))
    shard = F.pmod(F.xxhash64("vec_id"), F.lit(shards)).cast("int")
    block = F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(blocks)).cast("int")
    asking = stage(rows.where("asks").distinct().withColumn("block", block).withColumn("home", shard), "queries")
    # a vector that stands twice under one id is one candidate
    stored = rows.select("vec_id", "vector", "dim").distinct().withColumn("shard", shard)
    stored = stored.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))

    def round_of(queries: DataFrame) -> DataFrame:
        own = ["dim", "shard", "block"]
        return (
            stored.groupBy(*own)
            .cogroup(queries.select(*own, "vec_id", "vector", "known").groupBy(*own))
            .applyInPandas(searcher(k), FOUND)
        )

    home = asking.withColumn("shard", F.col("home")).withColumn("known", F.lit(None).cast("double"))
    first = stage(round_of(home), "top-home")
    reached = (
        first.groupBy("query_id")
        .agg(F.min("score").alias("least"), F.count(F.lit(1)).alias("n"))
        .select(F.col("query_id").alias("vec_id"), F.when(F.col("n") >= k, F.col("least").cast("double")).alias("known"))
    )
    others = asking.join(reached, "vec_id", "left").withColumn(
        "shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))
    ).where("shard != home")
    found = first.unionByName(round_of(others))
    by_score = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(by_score))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
