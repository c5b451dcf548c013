"""Connected components of a table of links by alternating stars."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import arrow_map, stored

FOREST_NODES = 500_000


class Forest:
    """Union-find over node numbers as they come; the root of a tree is its smallest node."""

    def __init__(self) -> None:
        self.parent: dict[int, int] = {}

    def root(self, node: int) -> int:
        parent = self.parent
        top = node
        while (up := parent.get(top, top)) != top:
            top = up
        while (up := parent.get(node, node)) != top:
            parent[node], node = top, up
        return top

    def join(self, a: int, b: int) -> None:
        x, y = self.root(a), self.root(b)
        if x != y:
            x, y = min(x, y), max(x, y)
            self.parent[y] = x
            self.parent.setdefault(x, x)

    def edges(self) -> tuple[list[int], list[int]]:
        nodes = [n for n in self.parent if self.root(n) != n]
        return nodes, [self.root(n) for n in nodes]


def _local_stars(edges: DataFrame) -> DataFrame:
    """Every task replaces the links it holds by stars over the same components."""
    def run(batches):
        forest = Forest()
        for batch in batches:
            for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                forest.join(a, b)
            if len(forest.parent) > FOREST_NODES:
                u, v = forest.edges()
                yield {"u": u, "v": v}
                forest = Forest()
        u, v = forest.edges()
        yield {"u": u, "v": v}

    return arrow_map(edges, run, "u long, v long")


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v"))).distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """``node`` and ``root`` (the smallest node of its component) for every node that has a link to another one.

    ``edges`` has two columns of node numbers. Links and labels stay in tables in the shared folder; the driver sees only
    a count and a checksum per round. The number of rounds grows with the logarithm of the longest path.
    """
    a, b = edges.columns
    links = edges.select(F.col(a).cast("long").alias("u"), F.col(b).cast("long").alias("v")).where("u <> v")
    stars, before = stored(_local_stars(links), "stars"), None
    while True:
        mark = stars.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(mark) == before or mark[0] == 0:
            return stars.select(F.col("u").alias("node"), F.col("v").alias("root"))
        before = tuple(mark)
        stars = stored(_small_star(_large_star(stars)), "stars")


def spanning_links(a: np.ndarray, b: np.ndarray) -> tuple[list[int], list[int]]:
    """Enough of the given links to keep their components."""
    forest = Forest()
    for x, y in zip(a.tolist(), b.tolist()):
        forest.join(x, y)
    return forest.edges()
