"""Connected components of an undirected graph given by pairs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landledger.llm.common import Scratch, checkpointed


def _followed(hooks: DataFrame, scratch: Scratch) -> DataFrame:
    """``hooks`` (root, next) with the end of every chain as next."""
    while True:
        further = hooks.select(F.col("root").alias("next"), F.col("next").alias("last"))
        hooks = scratch.keep(hooks.join(further, "next", "left").select(
            "root", F.coalesce("last", "next").alias("next"),
            F.col("last").isNotNull().alias("moved")))
        moved = not hooks.where("moved").isEmpty()
        hooks = hooks.drop("moved")
        if not moved:
            return hooks


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (columns a, b); root is the
    smallest node that can be reached.

    Labels are hooked to the smallest label next to them, until no edge joins two
    labels.  A label that hooks points to a smaller one, so hooks are trees; each is
    followed to its end, every step joining the hooks with themselves and so halving
    the way, before labels are replaced.  A round leaves of every group of hooked labels
    one, so rounds and steps both grow with the logarithm of the longest chain.  Every round writes its tables to the
    shared folder, so the joins read plain tables that adaptive execution can split
    where one label is held by very many nodes.  The driver sees one flag per round.
    """
    scratch = Scratch(edges.sparkSession)
    edges = scratch.keep(edges.where("a != b").select(
        F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    both = edges.union(edges.select("b", "a"))
    labels = scratch.keep(both.groupBy(F.col("a").alias("node"))
                          .agg(F.min("b").alias("root"))
                          .select("node", F.least("node", "root").alias("root")))
    while True:
        low = labels.select(F.col("node").alias("a"), F.col("root").alias("la"))
        high = labels.select(F.col("node").alias("b"), F.col("root").alias("lb"))
        hooks = scratch.keep(
            edges.join(low, "a").join(high, "b").where("la != lb")
            .groupBy(F.greatest("la", "lb").alias("root"))
            .agg(F.min(F.least("la", "lb")).alias("next")))
        if hooks.isEmpty():
            labels = checkpointed(labels)
            scratch.close()
            return labels
        hooks = _followed(hooks, scratch)
        labels = scratch.keep(labels.join(hooks, "root", "left").select(
            "node", F.coalesce("next", "root").alias("root")))
