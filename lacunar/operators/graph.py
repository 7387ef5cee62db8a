"""Connected components of edge tables, by alternating large and small stars."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lacunar.sources.scratch import materialize, release

#: A node is hot from this degree, or from this share of all edges if that is more: so few that they can be broadcast.
HOT_DEGREE, HOT_SHARE = 256, 2000


def local_roots(a: np.ndarray, b: np.ndarray, root: np.ndarray) -> np.ndarray:
    """Roots of local nodes after the links (a, b) join what `root` already joins; the smallest position is the root."""
    while len(a):
        x, y = root[a], root[b]
        low, high = np.minimum(x, y), np.maximum(x, y)
        apart = low != high
        if not apart.any():
            break
        np.minimum.at(root, high[apart], low[apart])
        while ((jump := root[root]) != root).any():
            root = jump
        a, b = a[apart], b[apart]
    return root


def _with_least(edges: DataFrame, least: DataFrame, limit: int) -> DataFrame:
    """edges (u, v) with m, the least neighbour of u. Edges of hot nodes, of which there are 2 * HOT_SHARE at most, meet them
    by a broadcast where they are; only the edges of all others are shuffled."""
    hot = F.broadcast(least.where(F.col("n") > limit).select("u", "m"))
    few = edges.join(F.broadcast(least.where(F.col("n") > limit).select("u")), "u", "left_anti").join(least.where(F.col("n") <= limit).select("u", "m"), "u")
    return few.select("u", "v", "m").union(edges.join(hot, "u").select("u", "v", "m"))


def components(edges: DataFrame, name: str = "edges") -> DataFrame:
    """(node, root) for every node of edges (u, v); root: the smallest node of its component.

    Each round moves every node's neighbours to its smallest one; all state is in tables, and rounds grow with the
    logarithm of the longest path. Roots gather very many neighbours: see `_with_least`.
    """
    now = materialize(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), name)
    mark = lambda df: tuple(df.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
    seen = mark(now)
    while seen[0]:
        limit = max(HOT_DEGREE, 2 * seen[0] // HOT_SHARE)
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = materialize(both.groupBy("u").agg(F.least(F.first("u"), F.min("v")).alias("m"), F.count("*").alias("n")), f"{name}-least")
        large = _with_least(both, least, limit).where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = materialize(large.distinct(), f"{name}-large")
        below = materialize(large.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n")), f"{name}-below")
        moved = _with_least(large, below, limit).where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        after = materialize(moved.union(below.select("u", F.col("m").alias("v"))).where("u <> v").distinct(), name)
        release(now, least, large, below)
        now, last, seen = after, seen, mark(after)
        if seen == last:
            break
    return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
