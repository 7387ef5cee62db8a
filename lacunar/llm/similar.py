"""The exact similarity of word shingles within groups of candidates.

Rows with equal sets of shingles are one node. Within a group every pair that may link two parts of it is compared by
its whole sets, so what is linked has the similarity and no pair of a group is left out. A group of more than PART nodes
is cut into a grid of cells; a cell returns a spanning tree.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lacunar.llm.blocks import thaw
from lacunar.llm.files import read_blob
from lacunar.llm.textops import Words, trim

SEED = 42
PART = 2048  # nodes
BUCKET = 4000  # nodes


def shingles(col: pa.Array, shingle: int) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash of each shingle, one row after the other; how many each row has."""
    words = Words(col, lower=True)
    n = np.diff(words.docs)
    if not len(words):
        return np.zeros(0, np.uint64), np.zeros(len(col), np.int64)
    spaced = np.full(len(words.data) + len(words), 32, np.uint8)
    spaced[np.arange(len(words.data)) + np.repeat(np.arange(len(words)), np.diff(words.at))] = words.data
    at = words.at + np.arange(len(words) + 1)
    count = np.where(n >= shingle, n - shingle + 1, np.minimum(n, 1))
    ends = np.cumsum(count)
    first = np.arange(int(ends[-1])) + np.repeat(words.docs[:-1] - (ends - count), count)
    last = np.minimum(first + shingle, np.repeat(words.docs[1:], count))
    text, digest = spaced.tobytes(), xxhash.xxh64_intdigest
    return np.fromiter([digest(text[a:b], SEED) for a, b in zip(at[first].tolist(), (at[last] - 1).tolist(), strict=True)], np.uint64, len(first)), count


def distinct(col: pa.Array, shingle: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of each row, ascending, one row after the other; how many each has."""
    h, count = shingles(col, shingle)
    row = np.repeat(np.arange(len(count)), count)
    order = np.lexsort((h, row))
    h, row = h[order], row[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (row[1:] != row[:-1])
    return h[new], np.bincount(row[new], minlength=len(count))


def names(h: np.ndarray, n: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each row's set."""
    ends = np.cumsum(n)
    return np.array([xxhash.xxh3_64_intdigest(h[b - k : b].tobytes()) for b, k in zip(ends.tolist(), n.tolist(), strict=True)], np.uint64)


def _sets(shingle: int):
    def run(place: dict, asked: pa.Table) -> pa.Table:
        rows = thaw(read_blob(*place.values())).take(asked["row"].combine_chunks())
        h, n = distinct(rows["text"].combine_chunks(), shingle)
        ends = np.cumsum(n)
        sets = [h[b - k : b].tobytes() for b, k in zip(ends.tolist(), n.tolist(), strict=True)]
        return asked.select(["fp", "group", "parts"]).append_column("grams", pa.array(sets, pa.binary()))

    return run


def _tree(sets: list[np.ndarray], similarity: float) -> list[tuple[int, int]]:
    """Pairs of positions that join all sets linked by `similarity`; each set is compared with all that aren't reached yet."""
    size = np.array([len(s) for s in sets])
    at = np.cumsum(np.concatenate([[0], size]))
    codes = np.unique(np.concatenate(sets), return_inverse=True)[1]
    mark = np.zeros(int(codes.max()) + 1, bool)
    rest, todo, out = np.arange(len(sets)), [], []
    while len(rest):
        if not todo:
            todo, rest = [int(rest[0])], rest[1:]
        a = todo.pop()
        near = (size[rest] >= similarity * size[a] - 1e-6) & (size[a] >= similarity * size[rest] - 1e-6)
        mark[codes[at[a] : at[a + 1]]] = True
        for i in np.flatnonzero(near).tolist():
            b = rest[i]
            both = np.count_nonzero(mark[codes[at[b] : at[b + 1]]])
            near[i] = both >= similarity * (size[a] + size[b] - both) - 1e-6
        mark[codes[at[a] : at[a + 1]]] = False
        todo += rest[near].tolist()
        out += [(a, b) for b in rest[near].tolist()]
        rest = rest[~near]
    return out


def _compare(similarity: float):
    def run(table: pa.Table) -> pa.Table:
        cells: dict[tuple[int, int, int], list[int]] = {}
        for i, cell in enumerate(zip(table["group"].to_pylist(), table["row"].to_pylist(), table["line"].to_pylist(), strict=True)):
            cells.setdefault(cell, []).append(i)
        fp, grams = table["fp"].to_numpy(), table["grams"].combine_chunks()
        u, v = [], []
        for mine in cells.values():
            for a, b in _tree([np.frombuffer(grams[i].as_py(), np.uint64) for i in mine], similarity) if len(mine) > 1 else ():
                u.append(fp[mine[a]])
                v.append(fp[mine[b]])
        trim()
        return pa.table({"u": pa.array(u, pa.int64()), "v": pa.array(v, pa.int64())})

    return run


def verified(found, asked: DataFrame) -> DataFrame:
    """Links (u, v) between the nodes of each group of `found` (simhash.Similar); asked has block_id, row, fp and group of one row a node."""
    sizes = asked.groupBy("group").agg(F.ceil(F.count("*") / PART).cast("long").alias("parts"))
    sets = found.beside(asked.join(sizes, "group"), _sets(found.shingle), "fp long, group long, parts long, grams binary")
    spot = sets.withColumn("part", F.pmod(F.xxhash64("fp"), "parts")).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
    cells = spot.select("fp", "group", "grams", F.least("part", "other").alias("row"), F.greatest("part", "other").alias("line"))
    buckets = max(1, -(-asked.count() // BUCKET)) * 2
    cells = cells.withColumn("bucket", F.pmod(F.xxhash64("group", "row", "line"), F.lit(buckets)))
    return cells.groupBy("bucket").applyInArrow(_compare(found.similarity), "u long, v long")
