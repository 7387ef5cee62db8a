"""Exact top-k search by tiled integer matrix products.

Candidates are packed into shards and queries into tiles, as files; a task multiplies a tile by the shards of a group, one
after another, a partial selection keeps k per query, and the lists are merged as a tree. Neither side is broadcast, collected
or sent through a shuffle: only places are joined (`tiling`).

Defined cases: a vector that is null, has a null or non-finite component, or is not of the table's most frequent
length takes no part, nor does a null id. A query's own row is every row with its id. Repeated ids count once, with
their best score. An empty table gives an empty result. Scores are exact; beyond 64 bits they are clamped.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lacunar.llm import tiling
from lacunar.llm.vectors import common_length, matrix, merge_top

SCALE = 1024
SCORES = 1 << 21  # of a step of a task


def quantize(x: np.ndarray, scale: int = SCALE) -> np.ndarray:
    """floor(scale * x) as float64, which holds the whole number exactly."""
    with np.errstate(over="ignore"):
        return np.clip(np.floor(x * float(scale)), -1.7e308, 1.7e308)


def products(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact integer inner products as int64: BLAS where no partial sum can be rounded, else Python integers."""
    q, c = q.astype(np.float64, copy=False), c.astype(np.float64, copy=False)
    size = float(np.sqrt((q * q).sum(1).max(initial=0.0)) * np.sqrt((c * c).sum(1).max(initial=0.0)))
    if size < 2**24:
        return (q.astype(np.float32) @ c.astype(np.float32).T).astype(np.int64)
    if size < 2**53:
        return (q @ c.T).astype(np.int64)
    big = np.array([[int(v) for v in row] for row in q], dtype=object).dot(np.array([[int(v) for v in row] for row in c], dtype=object).T)
    return np.array([[min(max(v, -(2**63)), 2**63 - 1) for v in row] for row in big], dtype=np.int64).reshape(len(q), len(c))


def _columns(key: str, vec: str, dim: int):
    def run(batch: pa.RecordBatch) -> list[np.ndarray]:
        ids, x = matrix(batch, key, vec, dim)
        return [ids, quantize(x)]

    return run


def _search(k: int, dim: int):
    def run(tile: list[np.ndarray], shards: Iterator[list[np.ndarray]], _) -> list[np.ndarray]:
        qi, q = tile[0], tile[1].reshape(-1, dim)
        best = tiling.Best(len(qi), k, once=True)
        for ids, c in shards:
            # an id counts once: repeated ids of a shard can't crowd out others before they are told apart
            step = max(1, SCORES // max(1, len(ids)))
            for a in range(0, len(qi), step):
                score = products(q[a : a + step], c.reshape(-1, dim))
                best.add(a, ids, score, _top(score, ids, k) & (ids[None, :] != qi[a : a + step, None]))
        return [*best.columns(), qi]

    return run


def _top(score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Which scores may be among the k best of other ids: at least the (k + 1)-th best over ids that occur once each."""
    once = np.unique(ids, return_index=True)[1]
    if len(once) <= 4 * k:
        return np.ones(score.shape, bool)
    least = np.partition(score[:, once], len(once) - k - 1, axis=1)[:, len(once) - k - 1]
    return score >= least[:, None]


def exact_top_k(df: DataFrame, k: int = 10, every: int = 100, key: str = "vec_id", vec: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: for each row whose key is divisible by `every`, the k best of all other rows."""
    df = df.select(F.col(key).cast("long").alias(key), vec)
    dim = common_length(df, vec)
    asked = df.where(F.pmod(key, F.lit(every)) == 0)
    plan = tiling.Plan(asked, df, _columns(key, vec, dim), _columns(key, vec, dim), "topk")
    found = plan.merged(plan.over(_search(k, dim)), tiling.merge_best(k, True))

    def lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data in batch.column("data").to_pylist():
                rows, ids, scores, own = tiling.loose(data)
                yield pa.RecordBatch.from_pydict({"query_id": pa.array(own[rows]), "grp": pa.array(np.zeros(len(rows), np.int64)), "vec_id": pa.array(ids), "score": pa.array(scores)})

    # rows that share a query's id may lie in several tiles: their lists are one
    return merge_top(found.mapInArrow(lists, "query_id long, grp long, vec_id long, score long"), k, 1)
