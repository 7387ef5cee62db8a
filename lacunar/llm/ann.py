"""Approximate nearest neighbours by adaptive dimension scan over inverted lists.

Vectors get one more component that makes the largest inner product the smallest Euclidean distance, then a random
rotation. Each query probes its nearest lists; within a list the rotated components are read in blocks of columns,
and after each block a hypothesis test abandons the candidates whose partial distance already says that they lie
beyond the k-th best found (d of D components carry about d/D of the squared distance). Survivors are scored exactly,
in double precision, on the original vectors.

How many lists a query probes is a test too. Its nearest lists, of FIRST_ROWS rows in all, give the k-th best so far. The
size and spread of every other list then tell how many of its rows are expected to be nearer (directions within a list
are taken as evenly spread), and the richest lists are probed until the rest is expected to hold MISS of all such rows.
Vectors in clusters need a few lists; where there are none, as in vectors drawn evenly from a sphere, over half of all.

The codebook is of two levels: up to COARSE centroids, and residuals that every one of them is combined with, so that
lists grow with the square root of the rows up to COARSE * FINE. Only it and a sample that gives each query its first
bound are held by every task; both are fitted on about TRAIN_ROWS sampled rows, so their size does not depend on the
table. Every row is indexed. Neighbouring lists make a part, and a part of many rows several shards; shards and blocks of
queries are files of bounded size in the shared folder. A task reads one block and one shard at a time: what is sent says
where they lie and, a bit for each, which query of the block probes which list of the part. No vector is sent with a list.

Defined cases: as in `topk` (null, zero and non-finite vectors and vectors of another length take no part; repeated
ids count once; a query meets all candidates if there are fewer than k; empty in, empty out).
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import FloatType

from lacunar.llm.files import blobs, read_blob
from lacunar.llm.scratch import materialize, new_path, release
from lacunar.llm.textops import trim
from lacunar.llm.vectors import common_length, distinct_top, matrix, merge_top

TRAIN_ROWS, COARSE, FINE = 16_384, 1024, 64
FIRST_ROWS = 3072  # of the lists that are probed first; their k-th best bounds the rest
MISS = 0.1  # of the rows that may be nearer, expected in lists that aren't probed
EPSILON = 2.1  # of the hypothesis test: the larger, the fewer false rejections
COLUMNS = 16  # in a block
SHARD, BLOCK = 8192, 1024  # rows of a shard, queries of a block; fewer of long vectors
VALUES = 1 << 21  # vector components that a step of a task takes at once
PAIRS_PER_TASK = 32
PACKED = "list int, uid long, n int, spread double, ids binary, vecs binary"
PLACED = "part int, sub int, n int, file string, at long, size long"
ASKED = "part int, bits binary, n_queries int, block_file string, block_at long, block_size long"
FOUND = "query_id long, grp long, vec_id long, score double"


def _nonzero(batch: pa.RecordBatch, key: str, vec: str, dim: int) -> tuple[np.ndarray, np.ndarray]:
    ids, x = matrix(batch, key, vec, dim)
    good = (x != 0).any(axis=1)
    return ids[good], x[good]


def _norms(key: str, vec: str, dim: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, most = 0, 0.0
        for batch in batches:
            x = _nonzero(batch, key, vec, dim)[1]
            n, most = n + len(x), max(most, float((x * x).sum(1).max(initial=0.0)))
        yield pa.RecordBatch.from_pydict({"n": pa.array([n], pa.int64()), "most": pa.array([most], pa.float64())})

    return run



def _means(points: np.ndarray, count: int) -> np.ndarray:
    """Centroids of `count` groups of points, by k-means from points spread over their order."""
    order = np.lexsort(points.T[::-1])
    centroids = points[order[np.linspace(0, len(points) - 1, count).astype(int)]]
    for _ in range(8):
        own = np.argmin(0.5 * (centroids * centroids).sum(1) - points @ centroids.T, axis=1)
        size = np.bincount(own, minlength=count)
        total = np.zeros(centroids.shape)
        np.add.at(total, own, points)
        centroids[size > 0] = (total[size > 0] / size[size > 0, None]).astype(np.float32)
    return centroids


def _upper(z: np.ndarray) -> np.ndarray:
    """Probability that a normal variable exceeds z, to 1e-7 (Abramowitz and Stegun 26.2.17)."""
    t = 1 / (1 + 0.2316419 * np.abs(z))
    tail = np.exp(-z * z / 2) / math.sqrt(2 * math.pi) * t * (0.319381530 + t * (-0.356563782 + t * (1.781477937 + t * (-1.821255978 + t * 1.330274429))))
    return np.where(z >= 0, tail, 1 - tail)


class Space:
    """The rotation, the codebook and the sample; a few MB at most, whatever the table."""

    def __init__(self, sample: np.ndarray, sample_ids: np.ndarray, most: float, n: int, k: int, seed: int = 7):
        dim = sample.shape[1]
        rng = np.random.default_rng(seed)
        self.most, self.k = most, k
        self.rotation = np.linalg.qr(rng.standard_normal((dim + 1, dim + 1)))[0].astype(np.float32)
        self.sample, self.sample_ids = sample, sample_ids
        points = self.place(sample)
        lists = max(1, min(COARSE, round(math.sqrt(n)), len(points) // 8))
        fine = max(1, min(FINE, round(math.sqrt(n) / COARSE), len(points) // 8))
        self.coarse, self.fine = np.zeros((1, dim + 1), np.float32), np.zeros((1, dim + 1), np.float32)
        if len(points):
            self.coarse = _means(points, lists)
            if fine > 1:
                self.fine = _means(points - self.coarse[self._closest(points, self.coarse)], fine)
        self.lists = len(self.coarse) * len(self.fine)
        self.size, self.spread = np.zeros(self.lists), np.zeros(self.lists)  # of each list: rows, their mean squared distance from its centroid

    @staticmethod
    def _closest(points: np.ndarray, centroids: np.ndarray) -> np.ndarray:
        return np.argmin(0.5 * (centroids * centroids).sum(1) - points @ centroids.T, axis=1)

    def own(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(list of each point, its squared distance from the list's centroid)."""
        a = self._closest(points, self.coarse)
        rest = points - self.coarse[a]
        b = self._closest(rest, self.fine)
        return a * len(self.fine) + b, ((rest - self.fine[b]) ** 2).sum(1)

    def asked(self, points: np.ndarray, bound: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
        """(query, list) pairs: the nearest lists or, with a bound of the k-th squared distance, those to be probed after them."""
        c = (self.coarse[:, None] + self.fine[None]).reshape(-1, points.shape[1])
        far = np.maximum(0, (points * points).sum(1)[:, None] + (c * c).sum(1) - 2 * (points @ c.T)).astype(float)
        order = np.argsort(far, axis=1, kind="stable")
        held = np.cumsum(self.size[order], axis=1) - self.size[order]
        first = np.zeros(far.shape, bool)
        np.put_along_axis(first, order, held < FIRST_ROWS, 1)
        if bound is None:
            return np.nonzero(first & (self.size > 0))
        reach = 2 * np.sqrt(far * self.spread) + 1e-9
        more = self.size * _upper(np.where(np.isfinite(bound)[:, None], (far + self.spread - bound[:, None]) / reach, -10.0) * math.sqrt(points.shape[1] - 1))
        more[first] = 0
        order = np.argsort(-more, axis=1, kind="stable")
        each = np.take_along_axis(more, order, 1)
        rest = np.cumsum(each[:, ::-1], axis=1)[:, ::-1]  # expected in a list and all behind it
        probe = np.zeros(far.shape, bool)
        np.put_along_axis(probe, order, rest > MISS * (self.k + rest[:, :1]), 1)
        return np.nonzero(probe & (self.size > 0))

    def place(self, x: np.ndarray, query: bool = False) -> np.ndarray:
        """Scaled by the largest norm, completed and rotated. A query is brought to length one, which keeps its order."""
        if query:
            y = x / np.sqrt((x * x).sum(1))[:, None]
            rest = np.zeros(len(x))
        else:
            y = x / math.sqrt(self.most)
            rest = np.sqrt(np.clip(1 - (y * y).sum(1), 0, None))
        return np.concatenate([y, rest[:, None]], axis=1).astype(np.float32) @ self.rotation

    def nearest_in_sample(self, ids: np.ndarray, x: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each query the ids and scores of the k best of the sample, itself left out."""
        out = []
        for own, score in zip(ids, x @ self.sample.T, strict=True):
            other = np.flatnonzero(self.sample_ids != own)
            top = other[distinct_top(self.sample_ids[other], score[other], self.k)]
            out.append((self.sample_ids[top], (x[len(out)] * self.sample[top]).sum(1)))
        return out

    def bounds(self, ids: np.ndarray, x: np.ndarray, least: np.ndarray) -> np.ndarray:
        """An upper bound of each query's k-th smallest squared distance: by the score `least` or within the sample."""
        length = np.sqrt((x * x).sum(1)) * math.sqrt(self.most)
        last = np.array([s[self.k - 1] if len(s) >= self.k else -np.inf for _, s in self.nearest_in_sample(ids, x)])
        return (2 - 2 * np.maximum(last, least) / length).astype(np.float32)


def _slices(ids: np.ndarray, *others: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
    for a in range(0, len(ids), BLOCK):
        yield ids[a : a + BLOCK], *(x[a : a + BLOCK] for x in others)


def _found(query: np.ndarray, grp: int, ids: np.ndarray, score: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({"query_id": pa.array(query, pa.int64()), "grp": pa.array(np.full(len(query), grp), pa.int64()), "vec_id": pa.array(ids, pa.int64()), "score": pa.array(score, pa.float64())})


def _seeds(space: Space, key: str, vec: str, dim: int):
    """The k best of the sample as found rows, so that a query never ends with fewer than k."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, x in _slices(*_nonzero(batch, key, vec, dim)):
                best = space.nearest_in_sample(ids, x)
                yield _found(np.repeat(ids, [len(i) for i, _ in best]), 0, np.concatenate([i for i, _ in best]), np.concatenate([s for _, s in best]))

    return run


def _assign(space: Space, key: str, vec: str, dim: int, kind: str):
    """Rows packed by their nearest list; `kind`: of the column's components, which lose nothing by it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        uid = TaskContext.get().partitionId() << 32
        for batch in batches:
            for ids, x in _slices(*_nonzero(batch, key, vec, dim)):
                lists, spread = space.own(space.place(x))
                order = np.argsort(lists, kind="stable")
                starts = np.flatnonzero(np.diff(lists[order], prepend=-1))
                rows = np.split(order, starts[1:])
                yield pa.RecordBatch.from_pydict({
                    "list": pa.array(lists[order][starts], pa.int32()), "uid": pa.array(np.arange(uid, uid + len(starts)), pa.int64()), "n": pa.array([len(r) for r in rows], pa.int32()),
                    "spread": pa.array([float(spread[r].sum()) for r in rows], pa.float64()), "ids": [ids[r].tobytes() for r in rows], "vecs": [x[r].astype(kind).tobytes() for r in rows],
                })
                uid += len(starts)

    return run


def _parts(size: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """(part of each list, shards of each part): neighbouring lists up to `limit` rows; a longer list is a part of its own."""
    part, subs, held = np.zeros(len(size), np.int32), [], limit + 1
    for i, n in enumerate(size.tolist()):
        if held + n > limit:
            subs.append(max(1, math.ceil(n / limit)))
            held = 0
        part[i], held = len(subs) - 1, held + n
    return part, np.array(subs, np.int32)


def _shard(folder: str):
    """A part's or shard's rows in a file: lists (ascending), ids and vectors."""

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("list")
        lists = np.repeat(table["list"].to_numpy(), table["n"].to_numpy()).astype(np.int32)
        with blobs(folder) as out:
            place = out.add(b"".join([lists.tobytes(), *table["ids"].to_pylist(), *table["vecs"].to_pylist()]))
        return pa.table({c: pa.array([v], t) for c, v, t in zip(("part", "sub", "n", "file", "at", "size"), (table["part"][0].as_py(), table["sub"][0].as_py(), len(lists), *place), (pa.int32(), pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.int64()), strict=True)})

    return run


def _ask(space: Space, key: str, vec: str, dim: int, folder: str, part: np.ndarray, later: bool):
    """Blocks of queries in files, and a row for each part of which a query of the block probes a list in the first or second
    turn. A query column "least" holds the k-th best score so far."""
    edges = np.append(np.flatnonzero(np.diff(part, prepend=-1)), len(part))
    most = max(64, min(BLOCK, VALUES // max(1, dim)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with blobs(folder) as out:
            for batch in batches:
                all_ids, all_x = _nonzero(batch, key, vec, dim)
                known = dict(zip(batch.column(key).to_pylist(), batch.column("least").to_pylist(), strict=True))
                for a in range(0, len(all_ids), most):
                    ids, x = all_ids[a : a + most], all_x[a : a + most]
                    least = np.array([-np.inf if known[i] is None else known[i] for i in ids.tolist()])
                    points, bound = space.place(x, True), space.bounds(ids, x, least)
                    asked = np.zeros((len(ids), space.lists), bool)
                    for i in range(0, len(ids), 64):
                        row, lists = space.asked(points[i : i + 64], bound[i : i + 64] if later else None)
                        asked[row + i, lists] = True
                    hit = np.flatnonzero(np.logical_or.reduceat(asked.any(axis=0), edges[:-1]))
                    if not len(hit):
                        continue
                    file, at, size = out.add(ids.tobytes() + bound.astype(np.float32).tobytes() + x.tobytes())
                    bits = [np.packbits(asked[:, edges[p] : edges[p + 1]]).tobytes() for p in hit.tolist()]
                    same = lambda v, t: pa.array([v] * len(hit), t)  # noqa: E731, B023
                    yield pa.RecordBatch.from_pydict({
                        "part": pa.array(hit, pa.int32()), "bits": pa.array(bits, pa.binary()), "n_queries": same(len(ids), pa.int32()),
                        "block_file": same(file, pa.string()), "block_at": same(at, pa.int64()), "block_size": same(size, pa.int64()),
                    })

    return run


def _cut(data: bytes, *kinds: tuple[type | str, int]) -> list[np.ndarray]:
    """Arrays that lie one after another: (kind, length)."""
    out, at = [], 0
    for kind, n in kinds:
        out.append(np.frombuffer(data, kind, n, at))
        at += out[-1].nbytes
    return out


def scan(q: np.ndarray, c: np.ndarray, bound: np.ndarray, k: int, qi: np.ndarray, ci: np.ndarray, known: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """(query, candidate) positions that the tests leave. q, c: rotated; bound: of each query's k-th squared distance, if
    `known` from nearer lists; qi, ci: ids. While many are left, a block of columns is one matrix product for all."""
    full = c.shape[1]
    gap = np.zeros((len(q), len(c)), np.float32)
    alive = row = col = part = None
    for a in range(0, full, COLUMNS):
        b = min(full, a + COLUMNS)
        share = (b / full) * (1 + EPSILON / math.sqrt(b)) ** 2 if b < full else 1.0
        if row is None:
            step = q[:, a:b] @ (-2 * c[:, a:b].T)
            step += (q[:, a:b] ** 2).sum(1)[:, None]
            step += (c[:, a:b] ** 2).sum(1)
            gap += step
            if a == 0 and not (known and np.isfinite(bound).all()):
                once = np.unique(ci, return_index=True)[1]
                if len(once) > k:  # of other rows, an id once, the k that look best so far give a bound of this list's own
                    look = np.where(ci[once][None, :] == qi[:, None], np.inf, gap[:, once])
                    first = once[np.argpartition(look, k - 1, axis=1)[:, :k]]
                    bound = np.minimum(bound, ((q[:, None, :] - c[first]) ** 2).sum(2).max(1))
            near = gap <= (bound * share + 1e-5).astype(np.float32)[:, None]
            alive = near if alive is None else alive & near
            if b == full or 16 * np.count_nonzero(alive) < alive.size:
                row, col = np.nonzero(alive)
                part = gap[row, col]
        else:
            part = part + ((q[row, a:b] - c[col, a:b]) ** 2).sum(1)
            keep = part <= (bound * share + 1e-5)[row]
            row, col, part = row[keep], col[keep], part[keep]
    return row, col


def _best(found: list[tuple[np.ndarray, np.ndarray, np.ndarray]], k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of (query, id, score) rows the k best of each query, an id once."""
    query, ids, score = (np.concatenate([f[i] for f in found]) for i in range(3))
    order = np.lexsort((-score, ids, query))
    query, ids, score = query[order], ids[order], score[order]
    once = np.append(True, (np.diff(query) != 0) | (np.diff(ids) != 0))[: len(query)]
    query, ids, score = query[once], ids[once], score[once]
    order = np.lexsort((ids, -score, query))
    query, ids, score = query[order], ids[order], score[order]
    top = np.arange(len(query)) - np.searchsorted(query, query) < k
    return query[top], ids[top], score[top]


def _search(space: Space, dim: int, kind: str, edges: np.ndarray, later: bool):
    """The k best of each query of a block in the lists of a shard that it probes."""
    k, step = space.k, max(1, VALUES // (dim + 1))

    def pair(bits: bytes, nq: int, first: int, lists: int, queries: bytes, n: int, shard: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        qi, bound, q = _cut(queries, (np.int64, nq), (np.float32, nq), (np.float64, nq * dim))
        own, ci, c = _cut(shard, (np.int32, n), (np.int64, n), (kind, n * dim))
        q, c = q.reshape(nq, dim), c.reshape(n, dim)
        qr, cr = space.place(q, True), space.place(c.astype(np.float64))
        asked = np.unpackbits(np.frombuffer(bits, np.uint8), count=nq * lists).reshape(nq, lists).astype(bool)
        none = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))
        found, held = [none], 0
        starts = np.flatnonzero(np.diff(own, prepend=-1))
        for lo, hi in zip(starts.tolist(), [*starts[1:].tolist(), n], strict=False):
            who = np.flatnonzero(asked[:, own[lo] - first])
            for at in range(lo, hi, step):
                end = min(hi, at + step)
                take = max(1, min(256, (1 << 18) // (end - at)))
                for i in range(0, len(who), take):
                    some = who[i : i + take]
                    row, col = scan(qr[some], cr[at:end], bound[some], k, qi[some], ci[at:end], later)
                    row, col = some[row], col + at
                    other = qi[row] != ci[col]
                    row, col = row[other], col[other]
                    for j in range(0, len(row), step):
                        r, o = row[j : j + step], col[j : j + step]
                        found.append((r, ci[o], (q[r] * c[o].astype(np.float64)).sum(1)))
                        held += len(r)
                    if held > 1 << 18:
                        found = [_best(found, k)]
                        held = 0
        row, ids, score = _best(found, k)
        return qi[row], ids, score

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for p in batch.to_pylist():
                first, last = edges[p["part"]], edges[p["part"] + 1]
                queries, shard = read_blob(p["block_file"], p["block_at"], p["block_size"]), read_blob(p["file"], p["at"], p["size"])
                query, ids, score = pair(p["bits"], p["n_queries"], first, last - first, queries, p["n"], shard)
                yield _found(query, p["part"] + p["sub"], ids, score)
        trim()

    return run


def adaptive_scan(df: DataFrame, k: int = 20, every: int = 20, key: str = "vec_id", vec: str = "embedding", train_rows: int = TRAIN_ROWS) -> DataFrame:
    """query_id, rank, vec_id, score: for each row whose key is divisible by `every`, about the k best of all other rows."""
    spark = df.sparkSession
    df = df.select(F.col(key).cast("long").alias(key), vec)
    dim = common_length(df, vec)
    total = df.mapInArrow(_norms(key, vec, dim), "n long, most double").agg(F.sum("n").alias("n"), F.max("most").alias("most")).first()
    n, most = int(total["n"] or 0), float(total["most"] or 0.0)
    if not n:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    share = min(1.0, train_rows / n)
    sampled = df.where(F.pmod(F.xxhash64(key, F.lit("sample")), F.lit(1 << 30)) < int(share * (1 << 30)))
    table = sampled.limit(2 * train_rows).toArrow()
    got = [_nonzero(b, key, vec, dim) for b in table.to_batches()] or [(np.zeros(0, np.int64), np.zeros((0, dim)))]
    ids, x = np.concatenate([g[0] for g in got]), np.concatenate([g[1] for g in got])
    order = np.argsort(ids, kind="stable")
    ids, x = ids[order], x[order]
    space = Space(x, ids, most, n, k)
    space.sample, space.sample_ids = space.sample[:2048], space.sample_ids[:2048]

    kind = "f4" if isinstance(df.schema[vec].dataType.elementType, FloatType) else "f8"
    base = materialize(df.mapInArrow(_assign(space, key, vec, dim, kind), PACKED), "ann-base")
    per = base.groupBy("list").agg(F.sum("n").alias("n"), F.sum("spread").alias("spread")).collect()  # a row a list: COARSE * FINE at most
    for r in per:
        space.size[r["list"]], space.spread[r["list"]] = r["n"], r["spread"] / r["n"]
    part, subs = _parts(space.size, max(256, min(SHARD, VALUES // dim)))
    edges = np.append(np.flatnonzero(np.diff(part, prepend=-1)), len(part))
    of = spark.createDataFrame([(i, int(p), int(subs[p])) for i, p in enumerate(part) if space.size[i]], "list int, part int, subs int")
    rows = base.join(F.broadcast(of), "list").withColumn("sub", F.pmod(F.xxhash64("uid"), F.col("subs")).cast("int"))
    rows = rows.select("part", "sub", "list", "n", "ids", "vecs")
    shards = materialize(rows.groupBy("part", "sub").applyInArrow(_shard(new_path(spark, "ann-shards")), PLACED), "ann-places")
    release(base)
    queries = df.where(F.pmod(key, F.lit(every)) == 0)

    def probe(queries: DataFrame, later: bool) -> DataFrame:
        asked = materialize(queries.mapInArrow(_ask(space, key, vec, dim, new_path(spark, "ann-blocks"), part, later), ASKED), "ann-queries")
        pairs = asked.join(shards, "part")
        tasks = max(3 * spark.sparkContext.defaultParallelism, -(-pairs.count() // PAIRS_PER_TASK))
        return pairs.repartition(tasks).mapInArrow(_search(space, dim, kind, edges, later), FOUND)

    groups = len(subs) + int(subs.max())
    found = probe(queries.withColumn("least", F.lit(None).cast("double")), False)
    found = found.unionByName(queries.mapInArrow(_seeds(space, key, vec, dim), FOUND))
    near = materialize(merge_top(found, k, groups), "ann-near")
    kth = near.where(F.col("rank") == k).select(F.col("query_id").alias(key), F.col("score").alias("least"))
    rest = probe(queries.join(kth, key, "left").select(key, vec, "least"), True)
    return merge_top(rest.unionByName(near.select("query_id", F.lit(0).cast("long").alias("grp"), "vec_id", "score")), k, groups)
