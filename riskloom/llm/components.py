"""Connected components of an edge table by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import stage


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """node, label of every node that an edge names; label is the smallest node of its component.

    Each round hooks every node that is left to the smallest node next to it, follows the hooks two steps and replaces
    the ends of the edges; edges within a node go, so the tables shrink from round to round. The hooks of all rounds,
    one after the other, lead from a node to its label. All steps are joins and aggregates over staged tables.
    """
    pairs = edges.select(F.col(a).alias("a"), F.col(b).alias("b")).where("a != b")
    both = stage(pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    labels = both.select(F.col("a").alias("node"), F.col("a").alias("label")).distinct()
    while not both.isEmpty():
        near = both.groupBy("a").agg(F.min("b").alias("least"))
        hooks = near.select(F.col("a").alias("was"), F.least("a", "least").alias("up"))
        second = hooks.select(F.col("was").alias("mid"), F.col("up").alias("top"))
        hooks = stage(
            hooks.join(second, F.col("up") == F.col("mid")).select("was", F.col("top").alias("now")), "hooks"
        )
        # a node whose edges are gone keeps its label
        labels = labels.join(hooks, F.col("label") == F.col("was"), "left").select(
            "node", F.coalesce("now", "label").alias("label")
        )
        ends = [hooks.select(F.col("was").alias(f"was_{e}"), F.col("now").alias(f"now_{e}")) for e in "ab"]
        both = stage(
            both.join(ends[0], F.col("a") == F.col("was_a"))
            .join(ends[1], F.col("b") == F.col("was_b"))
            .select(F.col("now_a").alias("a"), F.col("now_b").alias("b"))
            .where("a != b")
            .distinct(),
            "edges",
        )
    return labels
