"""Connected components of a graph whose links are rows."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weirgate.llm.common import Stages


class Forest:
    """Which of ``n`` things are connected, from links given in blocks."""

    def __init__(self, n: int) -> None:
        self.root = np.arange(n)

    def link(self, a: np.ndarray, b: np.ndarray) -> None:
        while len(a):
            a, b = self.root[a], self.root[b]
            apart = a != b
            a, b = a[apart], b[apart]
            np.minimum.at(self.root, np.maximum(a, b), np.minimum(a, b))
            while True:
                above = self.root[self.root]
                if np.array_equal(above, self.root):
                    break
                self.root = above

    def links(self) -> tuple[np.ndarray, np.ndarray]:
        """As few links as connect the same things."""
        children = np.flatnonzero(self.root != np.arange(len(self.root)))
        return children, self.root[children]


def components(edges: DataFrame) -> DataFrame:
    """``(node, component)`` for every node of ``edges(a, b)``: the smallest node it is connected with.

    Each round hooks every node to its smallest neighbour, shortens the chains that gives until all nodes
    know the end of theirs, and replaces the nodes of all links by those ends. What is left are links between
    ends, at most half as many nodes. Minima are partial aggregates; every table that is joined has been
    written, so that a node with very many links is split among tasks. Null nodes are left out.
    """
    stages = Stages(edges.sparkSession, "components")

    def tidy(links: DataFrame) -> DataFrame:
        low, high = F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")
        return links.where("a <> b").select(low, high).distinct()

    every = stages.put(edges.select("a", "b"))
    links = stages.put(tidy(every))
    labels = None
    while not links.isEmpty():
        ends = links.select(F.explode(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))))
        hooks = ends.groupBy(F.col("col.a").alias("node")).agg(F.min("col.b").alias("up"))
        hooks = stages.put(hooks.where("up < node"))
        while True:
            above = hooks.select(F.col("node").alias("up"), F.col("up").alias("top"))
            higher = stages.put(hooks.join(above, "up", "left").select("node", F.coalesce("top", "up").alias("up"), "top"))
            done = higher.where("top IS NOT NULL").isEmpty()
            stages.forget(hooks)
            hooks = higher.select("node", "up")
            if done:
                break
        a = hooks.select(F.col("node").alias("a"), F.col("up").alias("a_up"))
        b = hooks.select(F.col("node").alias("b"), F.col("up").alias("b_up"))
        moved = links.join(a, "a", "left").join(b, "b", "left")
        moved = moved.select(F.coalesce("a_up", "a").alias("a"), F.coalesce("b_up", "b").alias("b"))
        links = stages.put(tidy(moved))
        if labels is None:
            labels = hooks
        else:
            up = hooks.select(F.col("node").alias("up"), F.col("up").alias("top"))
            labels = labels.join(up, "up", "left").select("node", F.coalesce("top", "up").alias("up"))
            labels = stages.put(labels.unionByName(hooks))
    nodes = every.select(F.explode(F.array("a", "b")).alias("node")).where("node IS NOT NULL").distinct()
    if labels is None:
        result = stages.put(nodes.withColumn("component", F.col("node")))
    else:
        result = stages.put(nodes.join(labels, "node", "left").select("node", F.coalesce("up", "node").alias("component")))
    stages.drop(result)
    return result
