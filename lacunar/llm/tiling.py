"""Tiles of queries against groups of shards of all rows, by places.

Rows are written once to files of the shared folder: all of them as shards, the queries again as tiles. What is joined and
shuffled says only where a tile and the shards of a group lie; a task reads a tile once, then the shards of the group one at
a time. What comes back for a tile and a group is one packed message; messages of a tile are merged as a tree, FAN_IN at a
time, so no task gets the messages of all groups.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lacunar.llm.files import blobs, read_blob
from lacunar.llm.scratch import materialize, new_path
from lacunar.llm.textops import trim
from lacunar.llm.vectors import FAN_IN

SHARD, TILE, SHARDS_PER_GROUP = 8192, 1024, 8
PLACE = "n long, file string, at long, size long"
MESSAGE = "tile long, grp long, data binary"
PAIRS_PER_TASK = 8


def compact(x: np.ndarray) -> np.ndarray:
    """Whole numbers, held as float64, in the smallest kind that holds them."""
    most = float(np.abs(x).max(initial=0.0))
    return x.astype(np.int16 if most < 2**15 else np.int32 if most < 2**31 else np.float64)


def pack(columns: list[np.ndarray]) -> bytes:
    """Arrays of one length, the last of them with rows, one after another, with their kinds before them."""
    head = np.array([v for c in columns for v in (ord(c.dtype.kind), c.dtype.itemsize, c.size)], np.int64)
    return b"".join([np.array([len(columns)], np.int64).tobytes(), head.tobytes(), *[np.ascontiguousarray(c).tobytes() for c in columns]])


def unpack(data: bytes) -> list[np.ndarray]:
    n = int(np.frombuffer(data, np.int64, 1)[0])
    head = np.frombuffer(data, np.int64, 3 * n, 8).reshape(n, 3).tolist()
    at, out = 8 + 24 * n, []
    for kind, size, length in head:
        out.append(np.frombuffer(data, f"{chr(kind)}{size}", length, at))
        at += size * length
    return out


Columns = Callable[[pa.RecordBatch], list[np.ndarray]]


def placed(df: DataFrame, columns: Columns, rows: int, name: str) -> DataFrame:
    """PLACE of runs of up to `rows` rows of df, as the arrays that `columns` makes of a batch."""
    folder = new_path(df.sparkSession, f"{name}-files")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def write(parts: list[list[np.ndarray]]) -> pa.RecordBatch:
            whole = [np.concatenate(p) for p in zip(*parts, strict=True)]
            n = len(whole[0])
            whole[-1] = compact(whole[-1]).ravel()
            return pa.RecordBatch.from_pydict({c: pa.array([v], t) for c, v, t in zip(("n", "file", "at", "size"), (n, *out.add(pack(whole))), (pa.int64(), pa.string(), pa.int64(), pa.int64()), strict=True)})

        held, count = [], 0
        with blobs(folder) as out:
            for batch in batches:
                got = columns(batch)
                for a in range(0, len(got[0]), rows):
                    part = [c[a : a + rows] for c in got]
                    if held and count + len(part[0]) > rows:
                        yield write(held)
                        held, count = [], 0
                    held.append(part)
                    count += len(part[0])
            if count:
                yield write(held)
        trim()

    return materialize(df.mapInArrow(run, PLACE), name)


class Plan:
    """The pairs of tiles and groups of shards. `query` and `row` make the arrays of tiles and shards, vectors last."""

    def __init__(self, queries: DataFrame, rows: DataFrame, query: Columns, row: Columns, name: str):
        spark = rows.sparkSession
        n_tiles = max(1, -(-queries.count() // TILE))  # by the queries there are, however the ids are spread
        self.cores = spark.sparkContext.defaultParallelism
        tiles = placed(queries.repartition(n_tiles), query, TILE, f"{name}-tiles")  # in turn: no id can crowd a tile
        shards = placed(rows, row, SHARD, f"{name}-shards")
        total, self.n_tiles = shards.agg(F.count("*").alias("s"), F.sum("n").alias("n")).first(), tiles.count()
        self.n_shards = total["s"]
        self.groups = max(1, -(-(total["n"] or 0) // (SHARD * SHARDS_PER_GROUP)), min(total["s"], -(-2 * self.cores // max(1, self.n_tiles))))
        self.tiles = materialize(tiles.select(F.xxhash64("file", "at").alias("tile"), *(F.col(c).alias(f"tile_{c}") for c in ("file", "at", "size"))), f"{name}-tile-places")
        grouped = shards.withColumn("grp", F.pmod(F.xxhash64("file", "at"), F.lit(self.groups))).groupBy("grp").agg(F.collect_list(F.struct("n", "file", "at", "size")).alias("shards"))
        self.shards = materialize(grouped, f"{name}-groups")  # about SHARDS_PER_GROUP places a group

    def over(self, run: Callable[[list[np.ndarray], Iterator[list[np.ndarray]], list[np.ndarray] | None], list[np.ndarray]], state: DataFrame | None = None) -> DataFrame:
        """MESSAGE of each tile and group: what `run` makes of the tile, the shards of the group one by one, and the tile's
        state (tile, file, at, size of a file) if there is one."""
        tiles = self.tiles if state is None else self.tiles.join(state.select("tile", *(F.col(c).alias(f"state_{c}") for c in ("file", "at", "size"))), "tile")
        pairs = tiles.withColumn("grp", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(self.groups - 1).cast("long")))).join(self.shards, "grp")
        n = max(1, min(self.n_tiles * self.groups, max(3 * self.cores, -(-self.n_tiles * self.groups // PAIRS_PER_TASK))))
        has_state = state is not None

        def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for p in batch.to_pylist():
                    tile = unpack(read_blob(p["tile_file"], p["tile_at"], p["tile_size"]))
                    known = unpack(read_blob(p["state_file"], p["state_at"], p["state_size"])) if has_state else None
                    made = run(tile, (unpack(read_blob(s["file"], s["at"], s["size"])) for s in p["shards"]), known)
                    yield pa.RecordBatch.from_pydict({"tile": pa.array([p["tile"]], pa.int64()), "grp": pa.array([p["grp"]], pa.int64()), "data": pa.array([squeezed(made)], pa.binary())})
                    trim()

        return pairs.repartition(n).mapInArrow(task, MESSAGE)

    def merged(self, messages: DataFrame, merge: Callable[[list[list[np.ndarray]]], list[np.ndarray]]) -> DataFrame:
        """One message a tile (tile, data): `merge` makes one of some, and gives the same in whatever order they come."""

        def run(table: pa.Table) -> pa.Table:
            got = [loose(d) for d in table["data"].to_pylist()]
            made = squeezed(merge(got)) if len(got) > 1 else table["data"][0].as_py()
            trim()
            return pa.table({"tile": table["tile"].slice(0, 1), "grp": table["grp"].slice(0, 1), "data": pa.array([made], pa.binary())})

        left = self.groups
        while left > 1:
            left = -(-left // FAN_IN)
            messages = messages.withColumn("grp", F.pmod("grp", F.lit(left))).groupBy("tile", "grp").applyInArrow(run, MESSAGE)
        return messages.select("tile", "data")

    def stated(self, messages: DataFrame, change: Callable[[list[np.ndarray]], tuple[list[np.ndarray], int]], name: str) -> DataFrame:
        """The state of each tile as a file: what `change` makes of its message; `left`, the number that comes with it."""
        folder = new_path(messages.sparkSession, f"{name}-files")

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            with blobs(folder) as out:
                for batch in batches:
                    for tile, data in zip(batch.column("tile").to_pylist(), batch.column("data").to_pylist(), strict=True):
                        state, left = change(loose(data))
                        row = (tile, *out.add(pack(state)), left)
                        yield pa.RecordBatch.from_pydict({c: pa.array([v], t) for c, v, t in zip(("tile", "file", "at", "size", "left"), row, (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int64()), strict=True)})
            trim()

        return materialize(messages.mapInArrow(run, "tile long, file string, at long, size long, left long"), name)


def squeezed(columns: list[np.ndarray]) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(pack([c.ravel() for c in columns]))


def loose(data: bytes) -> list[np.ndarray]:
    return unpack(zstandard.ZstdDecompressor().decompress(data))


def best_of(rows: np.ndarray, ids: np.ndarray, scores: np.ndarray, k: int, once: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of (row, id, score) the k best of each row: score falling, then id; with `once` an id counts once, with its best score."""
    order = np.lexsort((ids, ~scores, rows))
    rows, ids, scores = rows[order], ids[order], scores[order]
    if once:
        again = np.lexsort((~scores, ids, rows))
        first = np.ones(len(rows), bool)
        first[again[1:]] = (np.diff(rows[again]) != 0) | (np.diff(ids[again]) != 0)
        rows, ids, scores = rows[first], ids[first], scores[first]
    top = np.arange(len(rows)) - np.searchsorted(rows, rows) < k
    return rows[top], ids[top], scores[top]


class Best:
    """The k best of each row of a tile over shards; what can't be among them is left out by a bound before it is sorted."""

    def __init__(self, n: int, k: int, once: bool = False):
        self.n, self.k, self.once = n, k, once
        self.rows, self.ids, self.scores = (np.zeros(0, np.int64) for _ in range(3))
        self.bound = np.full(n, np.iinfo(np.int64).min)

    def add(self, first: int, ids: np.ndarray, scores: np.ndarray, allowed: np.ndarray) -> None:
        """Scores of rows first, first + 1, ... against `ids`; only where `allowed`."""
        own = slice(first, first + len(scores))
        allowed = allowed & (scores >= self.bound[own, None])
        if scores.shape[1] > 8 * self.k and not self.once:
            masked = np.where(allowed, scores, np.iinfo(np.int64).min)
            kth = np.partition(masked, scores.shape[1] - self.k, axis=1)[:, scores.shape[1] - self.k]
            allowed &= scores >= kth[:, None]  # ties with the k-th stay
        at, col = np.nonzero(allowed)
        if not len(at):
            return
        self.rows, self.ids, self.scores = best_of(np.append(self.rows, at + first), np.append(self.ids, ids[col]), np.append(self.scores, scores[at, col]), self.k, self.once)
        ends = np.searchsorted(self.rows, np.arange(first, first + len(scores)), side="right") - 1
        full = np.bincount(self.rows, minlength=self.n)[own] >= self.k
        self.bound[own] = np.where(full, self.scores[np.maximum(ends, 0)], self.bound[own])

    def columns(self) -> list[np.ndarray]:
        return [self.rows, self.ids, self.scores]


def merge_best(k: int, once: bool):
    """Merges messages (row, id, score, ...) of a tile; what follows is the tile's own and the same in all of them."""

    def merge(messages: list[list[np.ndarray]]) -> list[np.ndarray]:
        return [*best_of(*(np.concatenate([m[i] for m in messages]) for i in range(3)), k, once), *messages[0][3:]]

    return merge
