"""Connected components of a link table.

Rounds of contraction: every node points to the least node among itself and
its neighbours, pointers are followed until they end at roots, and links are
redrawn between roots; a root joined by no link any more is done. Links
shrink by at least half in usual graphs, each round is aggregates with
partial aggregation and joins that Spark can split when skewed, and each
round's links and pointers are tables in the shared folder: no lineage grows
and nothing is collected but row counts.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import materialise


class Forest:
    """Components of a small set of nodes inside a task; ``links`` are those that joined two of them."""

    def __init__(self, n: int):
        self.parent = np.arange(n)
        self.links: list[tuple[int, int]] = []

    def _root(self, i: int) -> int:
        parent = self.parent
        while parent[i] != i:
            i = parent[i]
        return int(i)

    def roots(self) -> np.ndarray:
        """The root of every node; paths are shortened."""
        while True:
            up = self.parent[self.parent]
            if (up == self.parent).all():
                return self.parent
            self.parent = up

    def link(self, left: np.ndarray, right: np.ndarray) -> None:
        """Add links. Of many, one for each left and each right node is taken
        at a time, and those inside a component are dropped at once."""
        while len(left):
            apart = self.roots()[left] != self.roots()[right]
            left, right = left[apart], right[apart]
            take = np.union1d(np.unique(left, return_index=True)[1], np.unique(right, return_index=True)[1])
            for p, q in zip(left[take].tolist(), right[take].tolist()):
                a, b = self._root(p), self._root(q)
                if a != b:
                    self.parent[max(a, b)] = min(a, b)
                    self.links.append((p, q))


def _follow(pointers: DataFrame) -> DataFrame:
    """(node, root) with every root final, from pointers to smaller nodes."""
    while True:
        nxt = pointers.select(F.col("node").alias("root"), F.col("root").alias("_next"))
        stepped = pointers.join(nxt, "root", "left").select(
            "node", F.coalesce("_next", "root").alias("root"), (F.col("_next").isNotNull() & (F.col("_next") != F.col("root"))).alias("_moved"))
        stepped = materialise(stepped, "pointers")
        pointers = stepped.select("node", "root")
        if stepped.where("_moved").isEmpty():
            return pointers


def components(links: DataFrame) -> DataFrame:
    """node, component (least node reachable) for every node of ``links``.

    ``links`` has two columns of one orderable type; direction, order,
    repeats, loops and rows with a null do not matter. Nodes that only link
    to themselves may be missing from the result; no links give no rows.
    """
    a, b = links.columns
    links = links.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u IS NOT NULL AND v IS NOT NULL AND u != v")
    links = materialise(links.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct(), "links")
    label: DataFrame | None = None
    while not links.isEmpty():
        both = links.select(F.col("u").alias("node"), F.col("v").alias("other")).union(links.select("v", "u"))
        pointers = both.groupBy("node").agg(F.min("other").alias("root")).select("node", F.least("node", "root").alias("root"))
        pointers = _follow(materialise(pointers, "pointers"))
        pu = pointers.select(F.col("node").alias("u"), F.col("root").alias("ru"))
        pv = pointers.select(F.col("node").alias("v"), F.col("root").alias("rv"))
        drawn = links.join(pu, "u").join(pv, "v").where("ru != rv")
        links = materialise(drawn.select(F.least("ru", "rv").alias("u"), F.greatest("ru", "rv").alias("v")).distinct(), "links")
        if label is None:
            label = pointers
        else:
            step = pointers.select(F.col("node").alias("root"), F.col("root").alias("_next"))
            label = materialise(label.join(step, "root", "left").select("node", F.coalesce("_next", "root").alias("root")), "labels")
    if label is None:
        label = links.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return label.withColumnRenamed("root", "component")
