"""Connected components of a graph given as an edge table, by star contraction.

Alternates the two star steps (Kiveris et al., "Connected Components in
MapReduce and Beyond"): each node's larger neighbours, then its smaller ones,
are linked to its smallest neighbour, until every edge leads to the smallest
node of its component. Rounds grow with the logarithm of the graph's diameter.
Every step is a groupBy-minimum (combined before the shuffle) and a join; each
round's edges are checkpointed, so a lost executor costs one round at most and
neither edges nor labels pass the driver.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checkpointed


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return (both.where("v > u").join(least, "u")
            .select(F.col("v").alias("u"), F.col("m").alias("v")))


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionAll(least.select("u", F.col("m").alias("v"))).distinct()


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node that has an edge; root is the smallest node of its component.

    ``edges`` has columns u and v of one orderable type; direction, repeats and
    loops don't matter. Edges with a null end are no edges.
    """
    plain = edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    current = checkpointed(plain.distinct())
    before = _state(current)
    while before[0]:
        current = checkpointed(_small_star(_large_star(current)))
        after = _state(current)
        if after == before:
            break
        before = after
    return (current.select(F.col("u").alias("node"), F.col("v").alias("root"))
            .unionAll(current.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()))


def forest(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges (node, root) with the same components as the edges (u, v): a task's own share, in memory."""
    nodes, ends = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b = ends[:len(u)], ends[len(u):]
    root = np.arange(len(nodes))
    while True:
        x, y = root[a], root[b]
        open_ = x != y
        if not open_.any():
            break
        a, b = a[open_], b[open_]
        np.minimum.at(root, np.maximum(x, y)[open_], np.minimum(x, y)[open_])
        while True:
            up = root[root]
            if (up == root).all():
                break
            root = up
    moved = root != np.arange(len(nodes))
    return nodes[moved], nodes[root[moved]]
