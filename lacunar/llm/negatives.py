"""Hard negatives by distributed radix selection over integer scores.

Anchors are tiles and all rows are shards (`tiling`); every pass multiplies each tile by the shards of a group. The first pass
keeps the best rows of the anchor's own label, its positives. Each positive opens a window of scores, from 80 % of its own up
to its own, in which the k-th best row of another label is looked for digit by digit: a pass counts the window's rows by
score in 2**DIGIT buckets, the counts of all tasks are added up, and the bucket that holds the k-th row is the next pass's
window, until it is one score wide or holds few rows. Only then rows are gathered: those at or above that bucket, and of them
a task passes on the k best of a window, so that many rows of one score, such as copies, go no further than their task.

Defined cases: a vector that is null, has a null or non-finite component, or is not of the table's most frequent length takes no
part, nor does a row with a null id or label. Rows with an anchor's id are never its positives or negatives. Repeated rows are
rows of their own: each counts in an order, and each is an anchor. A positive with a negative score has an empty window. Scores
are exact; beyond 64 bits they are clamped. An anchor without positives, or a window without rows, gives no row. Empty in,
empty out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lacunar.llm import tiling
from lacunar.llm.scratch import release
from lacunar.llm.topk import SCORES, products, quantize
from lacunar.llm.vectors import common_length, finite

SCALE = 256
POSITIVES = NEGATIVES = 5
DIGIT = 8  # bits of a score that a pass tells apart
FEW = 64  # rows of a bucket that aren't told apart further
OUT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def _columns(key: str, vec: str, dim: int):
    def run(batch: pa.RecordBatch) -> list[np.ndarray]:
        batch = batch.filter(pc.and_(pc.is_valid(batch.column("label")), pc.is_valid(batch.column(key))))
        rows, x = finite(batch, vec, dim)
        number = lambda name: batch.column(name).to_numpy(zero_copy_only=False).astype(np.int64)[rows]
        return [number(key), number("label"), quantize(x, SCALE)]

    return run


def _steps(tile: list[np.ndarray], shards: Iterator[list[np.ndarray]], dim: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(first row of the tile, its scores against a shard, the shard's ids, which rows share the label, which aren't the anchor's own)."""
    qi, ql, q = tile[0], tile[1], tile[2].reshape(-1, dim)
    for ids, label, c in shards:
        step = max(1, SCORES // max(1, len(ids)))
        for a in range(0, len(qi), step):
            own = slice(a, a + step)
            yield a, products(q[own], c.reshape(-1, dim)), ids, label[None, :] == ql[own, None], ids[None, :] != qi[own, None]


def _positives(dim: int):
    def run(tile: list[np.ndarray], shards: Iterator[list[np.ndarray]], _) -> list[np.ndarray]:
        best = tiling.Best(len(tile[0]), POSITIVES)
        for a, score, ids, same, other in _steps(tile, shards, dim):
            best.add(a, ids, score, same & other)
        return [*best.columns(), tile[0]]

    return run


#: A tile's state, an entry a window: its anchor's row of the tile and id; positive id and score; lowest and highest score that
#: are still open; rows still to be found in there; the score from which rows are gathered; whether it is open.
def opened(message: list[np.ndarray]) -> tuple[list[np.ndarray], int]:
    row, pid, score, anchors = message
    low = score - score // 5  # 80 % of the score, rounded up
    open_ = low <= score
    return [row, anchors[row], pid, score, low, score, np.full(len(row), NEGATIVES), low, open_.astype(np.int64)], int(open_.sum())


def shift_of(low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Bits of a score below the digit that a pass counts by."""
    wide = np.maximum(high - low, 0)
    bits = np.array([int(w).bit_length() for w in wide.tolist()], np.int64)
    return np.maximum(0, bits - DIGIT)


def _inside(state: list[np.ndarray], low: np.ndarray, high: np.ndarray, tile: list[np.ndarray], shards: Iterator[list[np.ndarray]], dim: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(window, id, score) of the rows of another label between the bounds of a window, some at a time."""
    order = np.argsort(state[0], kind="stable")
    first = np.searchsorted(state[0][order], np.arange(len(tile[0]) + 1))
    least, most = np.full(len(tile[0]), np.iinfo(np.int64).max), np.full(len(tile[0]), np.iinfo(np.int64).min)
    np.minimum.at(least, state[0], low)
    np.maximum.at(most, state[0], high)
    for a, score, ids, same, other in _steps(tile, shards, dim):
        own = slice(a, a + len(score))
        row, col = np.nonzero((score >= least[own, None]) & (score <= most[own, None]) & ~same & other)
        s, row = score[row, col], row + a
        for j in range(int(np.diff(first).max(initial=0))):
            has = np.flatnonzero(first[row] + j < first[row + 1])
            w = order[first[row[has]] + j]
            hit = (s[has] >= low[w]) & (s[has] <= high[w])
            yield w[hit], ids[col[has[hit]]], s[has[hit]]


def _counts(dim: int):
    def run(tile: list[np.ndarray], shards: Iterator[list[np.ndarray]], state: list[np.ndarray]) -> list[np.ndarray]:
        open_ = np.flatnonzero(state[8])
        part = [c[open_] for c in state]
        shift = shift_of(part[4], part[5])
        total = np.zeros(len(open_) << DIGIT, np.int64)
        for w, _, s in _inside(part, part[4], part[5], tile, shards, dim):
            total += np.bincount((w << DIGIT) + ((part[5][w] - s) >> shift[w]), minlength=len(total))
        hit = np.flatnonzero(total)
        return [(open_[hit >> DIGIT] << DIGIT) + (hit & ((1 << DIGIT) - 1)), total[hit], *state]

    return run


def _added(messages: list[list[np.ndarray]]) -> list[np.ndarray]:
    keys, at = np.unique(np.concatenate([m[0] for m in messages]), return_inverse=True)
    total = np.zeros(len(keys), np.int64)
    np.add.at(total, at, np.concatenate([m[1] for m in messages]))
    return [keys, total, *messages[0][2:]]


def refined(message: list[np.ndarray]) -> tuple[list[np.ndarray], int]:
    """The state after a pass: each open window becomes its bucket of the k-th row."""
    keys, count, *state = message
    state = [c.copy() for c in state]
    _, _, _, _, low, high, need, least, open_ = state
    shift = shift_of(low, high)
    window = keys >> DIGIT
    starts = np.searchsorted(window, np.arange(len(low) + 1))
    for w in np.flatnonzero(open_).tolist():
        bucket, n = keys[starts[w] : starts[w + 1]] & ((1 << DIGIT) - 1), count[starts[w] : starts[w + 1]]
        upto = np.cumsum(n)
        at = int(np.searchsorted(upto, need[w]))
        if at == len(n):  # fewer than k in the whole window: all of them
            open_[w] = 0
            continue
        b, top = int(bucket[at]), int(high[w])
        need[w] -= upto[at] - n[at]
        high[w], low[w] = top - (b << shift[w]), max(int(low[w]), top - ((b + 1) << shift[w]) + 1)
        least[w] = low[w]
        open_[w] = int(shift[w] > 0 and n[at] > FEW)
    return state, int(open_.sum())


def _gathered(dim: int):
    def run(tile: list[np.ndarray], shards: Iterator[list[np.ndarray]], state: list[np.ndarray]) -> list[np.ndarray]:
        held = [np.zeros(0, np.int64)] * 3
        for found in _inside(state, state[7], state[3], tile, shards, dim):
            if len(found[0]):
                held = list(tiling.best_of(*(np.append(h, f) for h, f in zip(held, found, strict=True)), NEGATIVES, False))
        return [*held, *state[1:4]]

    return run


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for data in batch.column("data").to_pylist():
            w, ids, scores, anchor, positive, score = tiling.loose(data)
            order = np.lexsort((ids, ~scores, w))
            w, ids, scores = w[order], ids[order], scores[order]
            rank = np.arange(len(w)) - np.searchsorted(w, w) + 1
            names = [c.split()[0] for c in OUT.split(", ")]
            yield pa.RecordBatch.from_arrays([pa.array(v) for v in (anchor[w], positive[w], rank.astype(np.int32), ids, score[w], scores)], names=names)


def hard_negatives(df: DataFrame, every: int = 100, key: str = "vec_id", vec: str = "embedding", label: str = "label") -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score: for each row whose key is divisible by `every` and
    each of its best rows of the same label, the best rows of other labels that score 80 to 100 % of it."""
    df = df.select(F.col(key).cast("long").alias(key), vec, F.col(label).cast("long").alias("label"))
    dim = common_length(df, vec)
    columns = _columns(key, vec, dim)
    plan = tiling.Plan(df.where(F.pmod(key, F.lit(every)) == 0), df, columns, columns, "negatives")
    state = plan.stated(plan.merged(plan.over(_positives(dim)), tiling.merge_best(POSITIVES, False)), opened, "negatives-windows")
    while state.agg(F.sum("left")).first()[0]:  # a pass a digit: 64 / DIGIT at most
        after = plan.stated(plan.merged(plan.over(_counts(dim), state), _added), refined, "negatives-windows")
        release(state)
        state = after
    return plan.merged(plan.over(_gathered(dim), state), tiling.merge_best(NEGATIVES, False)).mapInArrow(_rows, OUT)


def flipped(df: DataFrame) -> DataFrame:
    """Labels as the query has them: where vec_id is divisible by 7, the next of ten."""
    return df.withColumn("label", F.when(F.pmod("vec_id", F.lit(7)) == 0, (F.col("label").cast("long") + 1) % 10).otherwise(F.col("label").cast("long")))
