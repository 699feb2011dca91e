"""Connected components by repeated contraction, on tables only."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from postmill.llm.common import kept


def _roots(parents: DataFrame) -> DataFrame:
    """Shorten (node, root) until every root is its own root: the depth halves with each join."""
    while True:
        up = parents.select(F.col("node").alias("root"), F.col("root").alias("above"))
        jumped = kept(parents.join(up, "root").select("node", F.col("above").alias("root"),
                                                      (F.col("above") != F.col("root")).alias("moved")))
        parents = jumped.select("node", "root")
        if jumped.where("moved").isEmpty():
            return parents


def components(edges: DataFrame) -> DataFrame:
    """Rows (node, root) for every node of the edges (a, b); root is the smallest node of its component.

    Each node hooks onto its smallest neighbour, chains are shortened, and the edges between different roots
    form the next, at most half as large graph. Nodes are non-null bigints. Hot nodes only occur on the long
    side of joins against one row per node, which adaptive execution splits.
    """
    edges = kept(edges.select("a", "b").where("a <> b").distinct())
    labels = None
    while not edges.isEmpty():
        both = edges.union(edges.select("b", "a"))
        hooked = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("b"))
        parents = _roots(kept(hooked.select("node", F.least("node", "b").alias("root"))))
        if labels is None:
            labels = parents
        else:
            up = parents.select(F.col("node").alias("root"), F.col("root").alias("above"))
            labels = kept(labels.join(up, "root", "left").select("node", F.coalesce("above", "root").alias("root")))
        left = parents.select(F.col("node").alias("a"), F.col("root").alias("root_a"))
        right = parents.select(F.col("node").alias("b"), F.col("root").alias("root_b"))
        edges = kept(
            edges.join(left, "a").join(right, "b").where("root_a <> root_b")
            .select(F.least("root_a", "root_b").alias("a"), F.greatest("root_a", "root_b").alias("b")).distinct()
        )
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")) if labels is None else labels
