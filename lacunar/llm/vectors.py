"""Vector tables as numpy blocks, and merging of per-query top lists."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

FAN_IN = 16


def common_length(df: DataFrame, vec: str) -> int:
    """The most frequent vector length (ties: the longer); 0 for a table without vectors."""
    sizes = df.where(F.col(vec).isNotNull()).groupBy(F.size(vec).alias("d")).count()
    top = sizes.orderBy(F.desc("count"), F.desc("d")).limit(1).collect()
    return int(top[0]["d"]) if top else 0


def finite(batch: pa.RecordBatch, vec: str, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """(positions, float64 rows) of the vectors of length dim without null or non-finite components."""
    col = batch.column(vec)
    if not isinstance(col, pa.LargeListArray):
        col = col.cast(pa.large_list(col.type.value_type))
    offsets = col.offsets.to_numpy()
    rows = np.flatnonzero(np.asarray(col.is_valid()) & (np.diff(offsets) == dim))
    if not len(rows) or dim == 0:
        return np.zeros(0, np.int64), np.zeros((0, dim))
    values = np.asarray(col.values.to_numpy(zero_copy_only=False), dtype=np.float64)
    x = values[offsets[rows][:, None] + np.arange(dim)]
    good = np.isfinite(x).all(axis=1)
    return rows[good], x[good]


def matrix(batch: pa.RecordBatch, key: str, vec: str, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """(ids, float64 rows) of the vectors that take part: key not null, length dim, all components finite."""
    ids = batch.column(key)
    rows, x = finite(batch, vec, dim)
    known = np.asarray(ids.is_valid())[rows]
    return np.asarray(ids.take(pa.array(rows[known])).to_numpy(zero_copy_only=False), dtype=np.int64), x[known]


def distinct_top(ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k best by (score descending, id ascending), an id counting once with its best score."""
    if len(ids) > 4 * k + 64:
        bound = np.partition(scores, len(scores) - k)[len(scores) - k]
        keep = np.flatnonzero(scores >= bound)
        if len(np.unique(ids[keep])) < k:
            keep = np.arange(len(ids))
    else:
        keep = np.arange(len(ids))
    order = keep[np.lexsort((ids[keep], -scores[keep] if scores.dtype.kind == "f" else ~scores[keep]))]
    _, first = np.unique(ids[order], return_index=True)
    return order[np.sort(first)[:k]]


def merge_top(lists: DataFrame, k: int, groups: int) -> DataFrame:
    """Tree merge of (query_id, grp, vec_id, score) lists, FAN_IN groups at a time, to the k best of each query."""
    best = Window.partitionBy("query_id", "grp").orderBy(F.desc("score"), "vec_id")
    while groups > FAN_IN:
        groups = -(-groups // FAN_IN)
        lists = lists.withColumn("grp", F.pmod("grp", F.lit(groups))).groupBy("query_id", "grp", "vec_id").agg(F.max("score").alias("score"))
        lists = lists.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).drop("rank")
    lists = lists.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    last = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return lists.withColumn("rank", F.row_number().over(last)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
