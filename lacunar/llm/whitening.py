"""Whitening of embeddings by a covariance of two passes.

Entries become whole numbers x, floor(SCALE * entry) + SHIFT. A first pass adds them up exactly, as two halves of 32 bits that no
sum of rows overflows, so that n and the sums S are whole numbers whatever the order of rows. A second pass centres each
row by them, (n * x - S) / n, which is exact up to one rounding, and only then multiplies: a task adds up the outer products of
its rows as matrix products, and treeAggregate merges one d x d matrix a task, so deep that the driver gets a few. LAPACK's
symmetric solver gives the components there; the projection, d x k numbers, is broadcast. A last pass over the projected rows
adds up their own covariance in the same way and tells how far it is from the identity. What a task and the driver hold is
bounded by the square of the vectors' length, not by the table.

Defined cases: a vector that is null, holds a null or non-finite entry, or is not of the table's most frequent length takes no
part. Rows with a null id and repeated rows are rows like any other. x is held within 64 bits, and so is `deviation`. Vectors
shorter than k have as many components as entries. A component whose variance is none but for rounding (constant or dependent
dimensions, a single row) can't be scaled: `whitened` is null there, and it doesn't count in identity_error, which is null if
no component is left; `explained` is null if no dimension varies. Empty in, empty out.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lacunar.llm.vectors import common_length, finite

SCALE, SHIFT = 64, 1_000_000
COMPONENTS = 32
ROWS = 4096  # of a step of a task
FAN_IN = 8  # matrices that meet in one merge
LEAST, MOST = -(2**63), 2**63 - 1
OUT = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def integers(x: np.ndarray) -> np.ndarray:
    """floor(SCALE * x) + SHIFT as int64, held within 64 bits."""
    with np.errstate(over="ignore"):
        v = np.floor(x * float(SCALE))
    if np.abs(v).max(initial=0.0) < 2.0**62:
        return v.astype(np.int64) + SHIFT
    return np.array([[min(max(int(c) + SHIFT, LEAST), MOST) if math.isfinite(c) else (MOST if c > 0 else LEAST) for c in row] for row in v.tolist()], np.int64).reshape(v.shape)


@dataclass(frozen=True)
class Fit:
    """Rows n and sums S of each dimension, as whole numbers of any size."""

    n: int
    sums: tuple[int, ...]

    def scaled(self, x: np.ndarray) -> np.ndarray:
        """n * x - S, exact: int64 where that holds it, else Python's whole numbers."""
        most = max(int(x.max(initial=0)), -int(x.min(initial=0)))
        if most * self.n + max(map(abs, self.sums), default=0) < 2**63:
            return x * np.int64(self.n) - np.array(self.sums, np.int64)
        return x.astype(object) * self.n - np.array(self.sums, object)

    def centred(self, scaled: np.ndarray) -> np.ndarray:
        """x - S / n in double precision."""
        return scaled.astype(np.float64) / float(self.n) if scaled.dtype != object else np.array([[v / self.n for v in row] for row in scaled.tolist()], np.float64).reshape(scaled.shape)

    @staticmethod
    def deviation(scaled: np.ndarray) -> np.ndarray:
        """Sum of squares of each row, exact, at most the largest 64-bit number."""
        most = float(np.abs(scaled.astype(np.float64)).max(initial=0.0))
        if scaled.dtype != object and most * most * scaled.shape[1] < 2.0**62:
            return (scaled * scaled).sum(axis=1)
        return np.array([min(sum(v * v for v in row), MOST) for row in scaled.tolist()], np.int64)


def _steps(batches: Iterator[pa.RecordBatch], vec: str, dim: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """(batch, rows of it that take part, their whole numbers), some rows at a time."""
    for batch in batches:
        for a in range(0, len(batch), ROWS):
            part = batch.slice(a, ROWS)
            rows, x = finite(part, vec, dim)
            if len(rows):
                yield part, rows, integers(x)


def sums(df: DataFrame, vec: str, dim: int) -> Fit:
    """The first pass; a row for each dimension comes back."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, high, low = 0, np.zeros(dim, np.int64), np.zeros(dim, np.int64)
        for _, rows, x in _steps(batches, vec, dim):
            n += len(rows)
            high += (x >> 32).sum(axis=0)
            low += (x & 0xFFFFFFFF).sum(axis=0)
        if n:
            yield pa.RecordBatch.from_pydict({"d": pa.array(range(dim), pa.int32()), "n": pa.array([n] * dim, pa.int64()), "high": pa.array(high), "low": pa.array(low)})

    whole = lambda c: F.sum(F.col(c).cast("decimal(38,0)")).alias(c)
    got = df.select(vec).mapInArrow(run, "d int, n long, high long, low long").groupBy("d").agg(F.sum("n").alias("n"), whole("high"), whole("low")).collect()
    got.sort(key=lambda r: r["d"])
    return Fit(got[0]["n"] if got else 0, tuple((int(r["high"]) << 32) + int(r["low"]) for r in got))


def _merged(parts: DataFrame, dim: int) -> np.ndarray:
    """Sum of the matrices of all tasks (data binary), merged as a tree."""
    n = parts.rdd.getNumPartitions()
    depth = max(2, math.ceil(math.log(max(2, n), FAN_IN)))
    add = lambda total, row: total + np.frombuffer(row["data"], np.float64).reshape(dim, dim)
    return parts.rdd.treeAggregate(np.zeros((dim, dim)), add, lambda a, b: a + b, depth)


def covariance(df: DataFrame, vec: str, dim: int, fit: Fit) -> np.ndarray:
    """The second pass: centred outer products over n."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((dim, dim))
        for _, _, x in _steps(batches, vec, dim):
            z = fit.centred(fit.scaled(x))
            total += z.T @ z
        yield pa.RecordBatch.from_pydict({"data": pa.array([total.tobytes()], pa.binary())})

    return _merged(df.select(vec).mapInArrow(run, "data binary"), dim) / fit.n


def components(v: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(unit eigenvectors as columns, eigenvalues, which of them aren't rounding), k of them by falling eigenvalue."""
    size = float(np.abs(v).max(initial=0.0)) or 1.0
    e, u = np.linalg.eigh(v / size)
    e, u = e[::-1][:k] * size, u[:, ::-1][:, :k]
    return u, np.maximum(e, 0.0), e > 16 * np.finfo(float).eps * len(v) * max(float(e.max(initial=0.0)), 0.0)


def whiten(df: DataFrame, k: int = COMPONENTS, key: str = "vec_id", vec: str = "embedding") -> DataFrame:
    """vec_id, component (from 1), n, deviation, whitened, explained, identity_error of every row and its first k components."""
    spark = df.sparkSession
    df = df.select(F.col(key).cast("long").alias(key), vec)
    dim = common_length(df, vec)
    fit = sums(df, vec, dim) if dim else Fit(0, ())
    if not fit.n:
        return spark.createDataFrame([], OUT)
    v = covariance(df, vec, dim, fit)
    u, e, real = components(v, k)
    kept = np.flatnonzero(real)
    held = spark.sparkContext.broadcast(u / np.sqrt(np.where(real, e, 1.0)))

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # the projected rows have the mean 0 by their making: those of a dimension, n * x - S, add up to 0 exactly
        total = np.zeros((len(kept), len(kept)))
        for _, _, x in _steps(batches, vec, dim):
            w = fit.centred(fit.scaled(x)) @ held.value[:, kept]
            total += w.T @ w
        yield pa.RecordBatch.from_pydict({"data": pa.array([total.tobytes()], pa.binary())})

    trace = float(np.trace(v))
    error = float(np.abs(_merged(df.select(vec).mapInArrow(spread, "data binary"), len(kept)) / fit.n - np.eye(len(kept))).max()) if len(kept) else None
    explained = [float(x) / trace if trace > 0 else None for x in e]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, rows, x in _steps(batches, vec, dim):
            scaled = fit.scaled(x)
            w = fit.centred(scaled) @ held.value
            many, m = w.shape
            at = np.repeat(rows, m)
            yield pa.RecordBatch.from_pydict({
                "vec_id": part.column(key).take(pa.array(at)), "component": pa.array(np.tile(np.arange(1, m + 1, dtype=np.int32), many)), "n": pa.array(np.full(many * m, fit.n)),
                "deviation": pa.array(np.repeat(fit.deviation(scaled), m)), "whitened": pa.array(w.ravel(), mask=np.tile(~real, many)),
                "explained": pa.array(explained * many, pa.float64()), "identity_error": pa.array([error] * (many * m), pa.float64()),
            })

    return df.mapInArrow(run, OUT)
