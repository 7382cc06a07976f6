"""Connected components of a graph of links, by alternating stars."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from silverline.llm.common import cut


class Forest:
    """Union-find over 0..n-1, roots being the least members."""

    def __init__(self, n: int):
        self.parent = np.arange(n)

    def roots(self, nodes: np.ndarray) -> np.ndarray:
        at = self.parent[nodes]
        while True:
            up = self.parent[at]
            if (up == at).all():
                self.parent[nodes] = at
                return at
            at = up

    def unite(self, nodes: np.ndarray) -> np.ndarray:
        """Make the nodes one tree; the roots that were hung up below another."""
        roots = np.unique(self.roots(nodes))
        self.parent[roots[1:]] = roots[0]
        return roots[1:]


def _state(edges: DataFrame):
    row = edges.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
    return row["n"], row["h"]


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node with an edge to another; root is the least node of its component.

    ``edges`` has long columns a and b. Large stars and small stars alternate
    until nothing changes, a number of rounds that grows with the logarithm of
    the longest path. Every round is
    written to the shared folder, so a lost executor costs one round at most.
    """
    edges = cut(edges.select("a", "b").filter("a <> b").distinct(), "edges")
    before = _state(edges)
    while before[0]:
        both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b").distinct()
        large = cut(large, "large-star")
        down = large.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        least = down.groupBy("a").agg(F.min("b").alias("m"))
        small = down.join(least, "a").select(F.explode(F.array(
            F.struct(F.col("a").alias("a"), F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e")) \
            .select("e.a", "e.b").filter("a <> b").distinct()
        edges = cut(small, "small-star")
        after = _state(edges)
        if after == before:
            break
        before = after
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
