"""SimHash near-duplicates: fingerprints linked by anchor-point covering.

A fingerprint of 64 bits or more is cut into segments. On each segment a covering code gives the anchors: a fingerprint
belongs to an anchor within the covering radius R and is copied to every anchor within R + 1, so of two fingerprints
that agree but for one bit in some segment the one meets the other at its own anchor. Per anchor all of the owners are
compared with all of the copies, as bit counts of whole arrays. Codes: the Golay code (23 bits, R = 3; 4,096 anchors a
segment and about 5 copies) and, for very many fingerprints, all words (R = 0; 2**21 anchors and 22 copies).

`near_duplicates(distance=4)` links by the distance alone: 64 bits in three segments, and two fingerprints within 4 bits
agree but for one bit in one of them, so every link is found. By `similarity` (the default: 0.8 of five-word shingles),
64 bits tell too little: copies at 0.8 differ in 10 of them. There a fingerprint has 384 bits in 16 segments; 99.9 % of
pairs at 0.8, and more of closer ones, meet at an anchor. Pairs within NEAR bits are candidates only: rows of linked
candidates are compared by their whole sets of shingles (`similar`), so what is linked has the similarity. Sets whose
sizes alone rule it out never meet: an anchor is one of a class of sizes.

Equal fingerprints (or sets) are compared once. A cell of the comparison holds about OWNERS x COPIES fingerprints: an
anchor with more, as a sample of SAMPLE fingerprints tells, is cut into a grid of cells, and all are if there are very
many fingerprints. A task returns not its pairs but a spanning forest, and components are joined over tables.

Defined cases: a text without words (null, empty, white space) has fingerprint 0 and is linked like any other. A text of
fewer words than a shingle is one shingle. Rows that share an id are all returned; a null id counts as no id, so a
component of such rows alone has a null id. Other columns are not read. Empty in, empty out.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lacunar.llm import similar
from lacunar.llm.blocks import freeze, tasks, thaw, whole_blocks
from lacunar.llm.files import blobs, read_blob
from lacunar.llm.graph import components, local_roots
from lacunar.llm.scratch import materialize, new_path
from lacunar.llm.textops import ragged, slices, trim

SHINGLE, DISTANCE = 4, 4
OWNERS, COPIES = 16_384, 65_536
GOLAY_UP_TO = 1 << 24  # fingerprints
BUCKET = 40_000  # fingerprints a bucket
SAMPLE, HOT = 1 << 16, 64  # fingerprints that tell which anchors are crowded; of them at an anchor, to be one
LANES, NEAR = 6, 112  # of 64 bits; of all bits: between copies at 0.8 about 60 differ, between other texts 192
BLOCK_BYTES = 2 << 20
PLACED = ("file", "at", "length")  # where a block lies
_SPREAD = np.packbits(np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").reshape(256, 8, 1) * np.ones((1, 1, 8), np.uint8) * np.array([1, 0, 0, 0, 0, 0, 0, 0], np.uint8), axis=2, bitorder="little").reshape(256, 8).copy().view(np.uint64).ravel()


def majorities(h: np.ndarray, count: np.ndarray, lanes: int = 1) -> np.ndarray:
    """(rows, lanes) of 64 bits each: whether a bit is set in over half of a row's hashes. Later lanes mix the hash anew."""
    out = np.zeros((len(count), lanes), np.uint64)
    if not len(h):
        return out
    ends = np.cumsum(count)
    # runs of at most 255 shingles of a document: eight one-byte counters fit a 64-bit number
    starts = ends - count
    runs = -(-count // 255)
    run_ends = np.cumsum(runs)
    within = np.arange(int(run_ends[-1])) - np.repeat(run_ends - runs, runs)
    run_at = np.repeat(starts, runs) + 255 * within
    full = np.flatnonzero(count)
    for j in range(lanes):
        if j:
            h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
            h ^= h >> np.uint64(32)
        parts = h.view(np.uint8).reshape(-1, 8)
        for i in range(8):
            sums = np.add.reduceat(_SPREAD[parts[:, i]], run_at).view(np.uint8).reshape(-1, 8).astype(np.int64)
            bits = np.add.reduceat(sums, (run_ends - runs)[full], axis=0) * 2 > count[full][:, None]
            out[full, j] |= np.packbits(bits, axis=1, bitorder="little").ravel().astype(np.uint64) << np.uint64(8 * i)
    return out


def fingerprints(col: pa.Array, shingle: int = SHINGLE) -> np.ndarray:
    """A 64-bit fingerprint of each row."""
    return majorities(*similar.shingles(col, shingle))[:, 0]


def _fingerprint(shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", 2 << 20):
                yield pa.RecordBatch.from_pydict({"doc_id": part.column("doc_id"), "fp": pa.array(fingerprints(part.column("text"), shingle).view(np.int64))})
        trim()

    return run


@cache
def golay() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(syndrome of each 11-bit tail and 12-bit head as two tables, error patterns of weight <= 4 by syndrome, padded with
    -1 and by ascending weight). The code is systematic: the 12 high bits of a codeword are its number."""
    generator = 0b101011100011  # x^11 + x^9 + x^7 + x^6 + x^5 + x + 1

    def remainder(v: np.ndarray) -> np.ndarray:
        v = v.copy()
        for bit in range(22, 10, -1):
            v = np.where(v >> bit & 1, v ^ (generator << (bit - 11)), v)
        return v

    bits = [1 << i for i in range(23)]
    patterns = [0]
    level = [(0, -1)]
    for _ in range(4):
        level = [(p | bits[i], i) for p, last in level for i in range(last + 1, 23)]
        patterns += [p for p, _ in level]
    p = np.array(patterns, np.int64)
    s = remainder(p)
    order = np.argsort(s, kind="stable")
    width = np.bincount(s, minlength=2048)
    table = np.full((2048, int(width.max())), -1, np.int64)
    table[s[order], np.arange(len(p)) - np.repeat(np.cumsum(width) - width, width)] = p[order]
    return remainder(np.arange(1 << 11, dtype=np.int64)), remainder(np.arange(1 << 12, dtype=np.int64) << 11), table


def anchors(values: np.ndarray, bits: int, code: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(own anchor of each segment value; position and anchor of each copy)."""
    if code == "all":
        flips = np.array([0, *(1 << i for i in range(bits))], np.int64)
        return values, np.repeat(np.arange(len(values)), len(flips)), (values[:, None] ^ flips[None, :]).ravel()
    low, high, table = golay()
    errors = table[low[values & 0x7FF] ^ high[values >> 11]]
    at, slot = np.nonzero(errors >= 0)
    return (values ^ errors[:, 0]) >> 11, at, (values[at] ^ errors[at, slot]) >> 11


@dataclass(frozen=True)
class Scheme:
    """How fingerprints are cut and when two are linked. `ratio`: of the sizes of two linked ones, at least."""

    segments: tuple[tuple[int, int], ...]
    near: int
    ratio: float | None = None
    code: str = "golay"

    @property
    def lanes(self) -> int:
        return -(-max(start + bits for start, bits in self.segments) // 64)

    def classes(self, size: np.ndarray) -> np.ndarray:
        """Linked fingerprints are of the same class or of classes next to each other."""
        if self.ratio is None:
            return np.zeros(len(size), np.int64)
        return np.floor(np.log(np.maximum(size, 1)) / (math.log(1 / self.ratio) * 1.04)).astype(np.int64) + 1

    def segment(self, bits: np.ndarray, s: int) -> np.ndarray:
        start, width = self.segments[s]
        word, off = divmod(start, 64)
        v = bits[:, word] >> np.uint64(off)
        if off + width > 64:
            v = v | (bits[:, word + 1] << np.uint64(64 - off))
        return (v & np.uint64((1 << width) - 1)).astype(np.int64)

    def entries(self, bits: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(anchor, with its class and segment; 1 for copies; whose) of all owners and copies."""
        kind = self.classes(size)
        keys, roles, whose = [], [], []
        for s, (_, width) in enumerate(self.segments):
            own, at, copy = anchors(self.segment(bits, s), width, self.code)
            for shift in (0,) if self.ratio is None else (-1, 0, 1):
                keys.append(((kind + shift) * len(self.segments) + s) << 24 | own)
                whose.append(np.arange(len(own)))
                roles.append(np.zeros(len(own), np.uint8))
            keys.append((kind[at] * len(self.segments) + s) << 24 | copy)
            whose.append(at)
            roles.append(np.ones(len(at), np.uint8))
        return np.concatenate(keys), np.concatenate(roles), np.concatenate(whose)

    def class_of(self, key: np.ndarray) -> np.ndarray:
        return (key >> 24) // len(self.segments)


def exact(distance: int = DISTANCE, code: str = "golay") -> Scheme:
    """64 bits in three segments: every link within 4 bits (or 5) is found."""
    if distance > 5:
        raise ValueError("two fingerprints of more than 5 different bits need not agree but for one bit in one of three segments")
    return Scheme(((0, 21), (21, 21), (42, 22)), distance, None, code)


def wide(similarity: float) -> Scheme:
    return Scheme(tuple((23 * i, 23) for i in range(64 * LANES // 23)), NEAR, similarity)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = x.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(31))


def _prints(batch: pa.RecordBatch, lanes: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(node, bits, size); without a column `bits` the node is its own fingerprint."""
    fp = batch.column("fp").to_numpy()
    if "bits" not in batch.schema.names:
        return fp, fp.view(np.uint64)[:, None], np.zeros(len(fp), np.int64)
    return fp, np.frombuffer(b"".join(batch.column("bits").to_pylist()), np.uint64).reshape(-1, lanes), batch.column("size").to_numpy()


def _counts(scheme: Scheme):
    """Owners and copies of each anchor among this task's fingerprints."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, bits, size = _prints(batch, scheme.lanes)
            key, role, _ = scheme.entries(bits, size)
            keys, inverse = np.unique(key, return_inverse=True)
            owners, copies = (np.bincount(inverse[role == r], minlength=len(keys)) for r in (0, 1))
            yield pa.RecordBatch.from_pydict({"anchor": pa.array(keys), "owners": pa.array(owners, pa.int64()), "copies": pa.array(copies, pa.int64())})

    return run


def _classes(scheme: Scheme):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, counts = np.unique(scheme.classes(_prints(batch, scheme.lanes)[2]), return_counts=True)
            yield pa.RecordBatch.from_pydict({"class": pa.array(names, pa.int64()), "n": pa.array(counts, pa.int64())})

    return run


def _cut(key: np.ndarray, role: np.ndarray, whose: np.ndarray, node: np.ndarray, grid: tuple[int, int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Entries dealt to a grid of cells: an owner to a row of them, a copy to a column."""
    rows, columns = grid
    spot = _mixed(node[whose] >> 1)
    owner = role == 0
    reps = np.where(owner, columns, rows)
    at = np.repeat(np.arange(len(key)), reps)
    other = np.arange(len(at)) - np.repeat(np.cumsum(reps) - reps, reps)
    line = np.where(owner, spot % np.uint64(rows), spot % np.uint64(columns)).astype(np.int64)[at]
    cell = np.where(owner[at], line * columns + other, other * columns + line)
    return _mixed(key[at] ^ ((cell + 1) << 44)).view(np.int64), role[at], whose[at]


def _deal(scheme: Scheme, parts: dict[int, int], crowded: dict[int, tuple[int, int]], grid: tuple[int, int]):
    """For each bucket one message: its cells, roles and whose they are, and the fingerprints once each."""
    hot = np.array(sorted(crowded), np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, len(batch), 4096):
                node, bits, size = _prints(batch.slice(a, 4096), scheme.lanes)
                key, role, whose = scheme.entries(bits, size)
                kind = scheme.class_of(key)
                found = [(kind, key, role, whose)]
                if len(hot) or grid != (1, 1):
                    is_hot = np.isin(key, hot)
                    rest = ~is_hot
                    found = [(kind[rest], key[rest], role[rest], whose[rest])] if grid == (1, 1) else []
                    groups = [(crowded[int(k)], np.flatnonzero(key == k)) for k in np.unique(key[is_hot]).tolist()]
                    for how, at in [*groups, *([(grid, np.flatnonzero(rest))] if grid != (1, 1) else [])]:
                        cell, r, w = _cut(key[at], role[at], whose[at], node, how)
                        found.append((np.repeat(kind[at], np.where(role[at] == 0, how[1], how[0])), cell, r, w))
                kind, cell, role, whose = (np.concatenate([f[i] for f in found]) for i in range(4))
                names, index = np.unique(kind, return_inverse=True)
                share = np.array([parts.get(int(k), 1) for k in names], np.uint64)
                bucket = (kind << 32) + (_mixed(cell) % share[index]).astype(np.int64)
                order = np.lexsort((whose, bucket))
                bucket, cell, role, whose = bucket[order], cell[order], role[order], whose[order]
                starts = np.flatnonzero(np.diff(bucket, prepend=np.int64(-1 << 62)))
                out: dict[str, list] = {k: [] for k in ("bucket", "cells", "roles", "whose", "nodes", "bits")}
                for i, j in zip(starts.tolist(), [*starts[1:].tolist(), len(bucket)], strict=True):
                    own, who = np.unique(whose[i:j], return_inverse=True)
                    for name, v in zip(out, (bucket[i], cell[i:j].tobytes(), role[i:j].tobytes(), who.astype(np.uint16).tobytes(), node[own].tobytes(), bits[own].tobytes()), strict=True):
                        out[name].append(v)
                yield pa.RecordBatch.from_pydict({k: pa.array(v, pa.int64() if k == "bucket" else pa.binary()) for k, v in out.items()})

    return run


def _within(bits: np.ndarray, x: np.ndarray, y: np.ndarray, near: int) -> np.ndarray:
    """Which of the pairs of nodes differ, in `near` bits at most; a lane that alone says more ends a comparison."""
    at = np.flatnonzero(x != y)
    far = np.zeros(len(at), np.uint16)
    for lane in range(bits.shape[1]):
        far = far + np.bitwise_count(bits[x[at], lane] ^ bits[y[at], lane])
        keep = far <= near * min(1.0, (lane + 1) / bits.shape[1] + 0.15)
        at, far = at[keep], far[keep]
    return at


def _compare(scheme: Scheme):
    def run(table: pa.Table) -> pa.Table:
        raw = {k: table[k].to_pylist() for k in ("cells", "roles", "whose", "nodes", "bits")}
        cat = lambda name, kind: np.concatenate([np.frombuffer(b, kind) for b in raw[name]])
        cell, role, node = cat("cells", np.int64), cat("roles", np.uint8), cat("nodes", np.int64)
        nodes, first, index = np.unique(node, return_index=True, return_inverse=True)
        bits = cat("bits", np.uint64).reshape(-1, scheme.lanes)[first]
        base = np.cumsum([0, *[len(b) // 8 for b in raw["nodes"]]])
        who = index[np.concatenate([np.frombuffer(b, np.uint16).astype(np.int64) + a for b, a in zip(raw["whose"], base, strict=False)])]
        order = np.lexsort((role, cell))
        cell, role, who = cell[order], role[order], who[order]
        starts = np.flatnonzero(np.diff(cell, prepend=cell[0] - 1)) if len(cell) else np.zeros(0, np.int64)
        stops = np.append(starts[1:], len(cell))
        cuts = starts + (np.add.reduceat(role == 0, starts) if len(starts) else 0)
        root = np.arange(len(nodes))
        owners, copies = cuts - starts, stops - cuts
        small = np.flatnonzero((owners > 0) & (copies > 0) & (owners * copies <= 1 << 16))
        # of small cells all pairs at once, some millions at a time
        each_owner, of_cell = ragged(starts[small], owners[small]), np.repeat(small, owners[small])
        upto = np.cumsum(copies[of_cell])
        at = 0
        while at < len(of_cell):
            to = max(at + 1, int(np.searchsorted(upto, (upto[at - 1] if at else 0) + (1 << 21), side="right")))
            c = of_cell[at:to]
            x, y = who[np.repeat(each_owner[at:to], copies[c])], who[ragged(cuts[c], copies[c])]
            hit = _within(bits, x, y, scheme.near)
            root = local_roots(len(nodes), x[hit], y[hit], root)
            at = to
        for i in np.flatnonzero((owners > 0) & (copies > 0) & (owners * copies > 1 << 16)).tolist():
            todo, other = np.unique(who[starts[i] : cuts[i]]), np.unique(who[cuts[i] : stops[i]])
            while len(todo):  # owners that are joined already look only at what isn't joined to them
                part = root[todo] == root[todo[0]]
                mine, far = todo[part][:512], other[root[other] != root[todo[0]]]
                for j in range(0, len(far), 8192):
                    x, y = np.repeat(mine, len(far[j : j + 8192])), np.tile(far[j : j + 8192], len(mine))
                    hit = _within(bits, x, y, scheme.near)
                    root = local_roots(len(nodes), x[hit], y[hit], root)
                todo = np.concatenate([todo[part][512:], todo[~part]])
        linked = np.flatnonzero(root != np.arange(len(nodes)))
        trim()
        return pa.table({"u": pa.array(nodes[linked], pa.int64()), "v": pa.array(nodes[root[linked]], pa.int64())})

    return run


def links(prints: DataFrame, code: str | None = None, scheme: Scheme | None = None) -> DataFrame:
    """Links (u, v) that join all nodes (fp; or fp, bits, size) which the scheme links, and no others."""
    n = prints.count()
    scheme = scheme or exact(code=code or ("golay" if n <= GOLAY_UP_TO else "all"))
    share = min(1.0, SAMPLE / max(1, n))
    sample = prints if share == 1 else prints.where(F.pmod(F.xxhash64("fp", F.lit("anchors")), F.lit(1 << 30)) < int(share * (1 << 30)))
    per = sample.mapInArrow(_counts(scheme), "anchor long, owners long, copies long").groupBy("anchor").agg(F.sum("owners").alias("owners"), F.sum("copies").alias("copies"))
    if share < 1:  # HOT of the sample or more: a bounded number of anchors, each with a share of all
        per = per.where((F.col("owners") >= HOT) | (F.col("copies") >= HOT))
    many = per.where((F.col("owners") > OWNERS * share) | (F.col("copies") > COPIES * share)).where("owners > 0").collect()
    cells = lambda x, most: max(1, math.ceil(x / share / most))
    crowded = {r["anchor"]: (cells(r["owners"], OWNERS), cells(r["copies"], COPIES)) for r in many}
    grid = (cells(HOT, OWNERS), cells(HOT, COPIES)) if share < 1 else (1, 1)  # what an anchor that isn't hot may hold
    times = 1 if scheme.ratio is None else 3
    sizes = prints.mapInArrow(_classes(scheme), "class long, n long").groupBy("class").agg(F.sum("n").alias("n")).collect()  # a row a class
    parts = {r["class"] + d: 0 for r in sizes for d in ((0,) if times == 1 else (-1, 0, 1))}
    for r in sizes:
        for d in (0,) if times == 1 else (-1, 0, 1):
            parts[r["class"] + d] += r["n"]
    parts = {k: max(1, -(-v // BUCKET)) * (2 if times == 1 else 1) for k, v in parts.items()}
    dealt = prints.mapInArrow(_deal(scheme, parts, crowded, grid), "bucket long, cells binary, roles binary, whose binary, nodes binary, bits binary")
    return dealt.groupBy("bucket").applyInArrow(_compare(scheme), "u long, v long")


def _plain(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def with_roots(links: DataFrame, name: str) -> DataFrame:
    roots = components(links, name)
    return materialize(roots.union(roots.select(F.col("root").alias("node"), "root").distinct()), f"{name}-roots")


def component_names(prints: DataFrame, roots: DataFrame) -> DataFrame:
    """fp, component_id of every node (fp, least)."""
    linked = prints.join(roots, F.col("fp") == F.col("node")).select("fp", "least", "root")
    groups = linked.groupBy("root").agg(F.min("least").alias("component"))
    named = linked.select("fp", "root").join(groups, "root").select("fp", "component")
    return materialize(prints.join(named, "fp", "left").select("fp", F.coalesce("component", "least").alias("component_id")), "simhash-components")


def near_duplicates(docs: DataFrame, shingle: int = 5, similarity: float = 0.8, distance: int | None = None) -> DataFrame:
    """doc_id, fingerprint, component_id of every document.

    Links are pairs of `similarity` or more of their sets of shingles or, if `distance` is given, pairs of 64-bit
    fingerprints within so many bits.
    """
    if distance is None:
        rows = Similar(_plain(docs), shingle, similarity).rows()
        return rows.select("doc_id", F.lower(F.hex("bits")).alias("fingerprint"), "component_id")
    marked = materialize(_plain(docs).mapInArrow(_fingerprint(shingle), "doc_id long, fp long"), "simhash-docs")
    prints = materialize(marked.groupBy("fp").agg(F.min("doc_id").alias("least")), "simhash-prints")
    named = component_names(prints, with_roots(links(prints.select("fp"), scheme=exact(distance, "golay" if prints.count() <= GOLAY_UP_TO else "all")), "simhash-edges"))
    return marked.join(named, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def representatives(docs: DataFrame, shingle: int = 5, similarity: float = 0.8) -> DataFrame:
    """docs without near-duplicates: of each component the row with its smallest id stays; of rows that share an id one,
    and all with a null id. All columns as they are; texts are read again from their blocks and never shuffled."""
    found = Similar(docs, shingle, similarity)
    rows = found.rows().where("doc_id IS NOT NULL")
    first = rows.where("doc_id = component_id").groupBy("doc_id").agg(F.min(F.struct("fp", "block_id", "row")).alias("k"))
    stay = first.select("k.block_id", "k.row").union(found.table.where("doc_id IS NULL").select("block_id", "row"))
    columns = docs.columns

    def run(places: dict, rows: pa.Table) -> pa.Table:
        return thaw(read_blob(*places.values())).take(rows["row"].combine_chunks()).select(columns)

    return found.beside(stay, run, docs.schema)


class Similar:
    """The rows of docs in blocks, with the component of each.

    `table`: block_id, row, doc_id, fp (of the set of shingles), bits (fingerprint), size (of the set) of every row.
    """

    def __init__(self, docs: DataFrame, shingle: int, similarity: float):
        folder = new_path(docs.sparkSession, "simhash-files")
        self.shingle, self.similarity, self.scheme = shingle, similarity, wide(similarity)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            from pyspark import TaskContext

            block = TaskContext.get().partitionId() << 32
            with blobs(folder) as out:
                for batch in whole_blocks(batches, "text", BLOCK_BYTES):
                    place = out.add(freeze(batch))
                    h, n = similar.distinct(batch.column("text"), shingle)
                    fp = similar.names(h, n)
                    bits = majorities(h, n, LANES)
                    none = [None] * (len(batch) - 1)  # the first row of a block says where it lies
                    columns = {"block_id": pa.array(np.full(len(batch), block)), "row": pa.array(np.arange(len(batch))), "doc_id": pa.array(batch.column("doc_id").to_pylist(), pa.int64())}
                    columns |= {"fp": pa.array(fp.view(np.int64)), "bits": pa.array([b.tobytes() for b in bits], pa.binary()), "size": pa.array(n, pa.int64())}
                    columns |= {k: pa.array([v, *none], t) for k, v, t in zip(PLACED, place, (pa.string(), pa.int64(), pa.int64()), strict=True)}
                    yield pa.RecordBatch.from_pydict(columns)
                    block += 1
                    trim()

        got = docs.mapInArrow(run, "block_id long, row long, doc_id long, fp long, bits binary, size long, file string, at long, length long")
        got = materialize(got, "simhash-blocks")
        self.blocks = got.where("file IS NOT NULL").select("block_id", *PLACED)
        self.n_blocks = self.blocks.count()
        self.table = got.drop(*PLACED)

    def beside(self, rows: DataFrame, run: Callable[[dict, pa.Table], pa.Table], schema: str | StructType) -> DataFrame:
        """What `run` makes of each block's place and the rows (block_id, row, ...) that name some of its rows."""
        n = tasks(self.blocks, self.n_blocks)
        asked = rows.repartition(n, "block_id").join(self.blocks.repartition(n, "block_id").hint("shuffle_hash"), "block_id")

        def one(table: pa.Table) -> pa.Table:
            out = run({c: table[c][0].as_py() for c in PLACED}, table.sort_by("row"))
            trim()
            return out

        return asked.groupBy("block_id").applyInArrow(one, schema)

    def rows(self) -> DataFrame:
        """block_id, row, doc_id, fp, bits, component_id of every row."""
        nodes = self.table.groupBy("fp").agg(F.min("doc_id").alias("least"), F.min(F.struct("block_id", "row")).alias("k"), F.first("bits").alias("bits"), F.first("size").alias("size"))
        nodes = materialize(nodes, "simhash-nodes")
        groups = with_roots(links(nodes.where("size > 0").select("fp", "bits", "size"), scheme=self.scheme), "simhash-candidates")
        asked = nodes.join(groups, F.col("fp") == F.col("node")).select("k.block_id", "k.row", "fp", F.col("root").alias("group"))
        linked = materialize(similar.verified(self, materialize(asked, "simhash-asked")), "simhash-linked")
        named = component_names(nodes.select("fp", "least"), with_roots(linked, "simhash-edges"))
        return self.table.join(named, "fp").select("block_id", "row", "doc_id", "fp", "bits", "component_id")
