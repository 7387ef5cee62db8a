"""Similarity join of documents by the Jaccard similarity of their word n-grams: rare-first prefix filtering.

A set is that of a text's distinct shingles, each as a 64-bit key: 8 bits tell how frequent the shingle is, by a sketch of
counters over all documents, and 56 its hash. Keys ascend from the rarest shingle on, and sets are sorted by them. Of two
sets a and b that share alpha = t / (1 + t) * (|a| + |b|) shingles or more, the first |s| - t |s| + 1 keys of each (its prefix)
hold one that both have, so only sets that share a prefix key meet. Filters of a pair at such a key, before any text is read:
length (the smaller has at least t times the size of the larger), position (what is left behind the key in the shorter rest,
and the key itself, can still reach alpha) and suffix (cut at fixed hashes into RANGES ranges, the sets' counts differ in all
by at most what alpha leaves unshared). A task joins what passes into groups of candidates and returns a forest of them, not
their pairs. Then the texts of each group are read from where they lie, once a cell, and its sets are compared whole: each pair
once, in the one cell that holds it, and not at all if other links have joined it already.

Equal sets are one node. Texts are written once to files and never go through a shuffle; what is shuffled is a row for each
prefix key, then the rows of keys that several sets have. A key of more than PART rows, and a group of as many candidates, is cut
into a grid of cells of two parts.
The sketch has 2**BITS counters whatever the table: every task holds their codes (4 MB). It only orders the keys, so that
counters which several shingles share cost candidates and lose no link.

Defined cases: a text without words (null, empty, white space) has an empty set and is linked with nothing, not even another
such text. One of fewer words than a shingle is one shingle. Rows that share an id are all returned, each by its own text; a
null id counts as no id, so a component of such rows alone has a null id. Other columns are not read. Empty in, empty out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lacunar.llm.blocks import whole_blocks
from lacunar.llm.files import blobs, read_many
from lacunar.llm.graph import local_roots
from lacunar.llm.scratch import delete, materialize, new_path, release
from lacunar.llm.simhash import component_names, with_roots
from lacunar.llm.textops import Words, ragged, trim

SHINGLE, PERCENT = 5, 80
BITS, SHARDS = 22, 16  # of the sketch
RANGES = 32  # of the suffix filter
PART = 2048  # rows of a key that meet in one cell
ROWS = 100_000  # rows of a bucket
BUCKET = 1000  # candidates of a bucket
PAIRS = 1 << 20  # of a step of a task
KEYS = 1 << 21  # keys of the sets of a part
BLOCK_BYTES = 2 << 20
FAN_IN = 32
ROW = "uid long, block_id long, doc_id long, name binary, size long, file string, at long, length long, shard int, data binary"
NODE = "node long, size long, ranges binary, file string, at long, length long, tokens binary"
CELL = "token long, row long, line long, side int, pos long, node long, size long"
LINK = "u long, v long"


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def shingles(col: pa.Array, shingle: int) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash of each shingle, one row after the other; how many each row has. Each distinct word is hashed once."""
    words = Words(col, lower=True)
    n = np.diff(words.docs)
    count = np.where(n >= shingle, n - shingle + 1, np.minimum(n, 1))
    if not len(words):
        return np.zeros(0, np.uint64), count
    index, names = words.coded()
    word = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in names.to_pylist()), np.uint64, len(names))[index]
    first = ragged(words.docs[:-1], count)
    stop = np.repeat(words.docs[1:], count)
    h = np.zeros(len(first), np.uint64)
    for j in range(shingle):
        at = first + j
        inside = at < stop
        h = np.where(inside, _mixed(h * np.uint64(0x9E3779B97F4A7C15) + word[np.minimum(at, len(word) - 1)]), h)
    return h, count


def _sorted_sets(h: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values of each row, ascending, one row after the other; how many each has."""
    row = np.repeat(np.arange(len(count)), count)
    order = np.lexsort((h, row))
    h, row = h[order], row[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (row[1:] != row[:-1])
    return h[new], np.bincount(row[new], minlength=len(count))


def keyed(h: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """The key of each hash: rarer ones are smaller."""
    return (codes[(h & np.uint64((1 << BITS) - 1)).astype(np.int64)].astype(np.uint64) << np.uint64(56)) | (h >> np.uint64(8))


def code_of(count: np.ndarray) -> np.ndarray:
    """Counts as codes of 8 bits that ascend with them."""
    return np.minimum(255, np.floor(8 * np.log2(np.maximum(count, 1)))).astype(np.uint8)


class Rule:
    """When two sets are linked: 100 * shared >= percent * union, all in whole numbers."""

    def __init__(self, percent: int):
        if not 1 <= percent <= 100:
            raise ValueError("a percent from 1 to 100")
        self.percent = percent

    def prefix(self, size: np.ndarray) -> np.ndarray:
        return size + (-self.percent * size // 100) + 1

    def alpha(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Shingles that linked sets of these sizes share at least."""
        return -(-self.percent * (a + b) // (100 + self.percent))

    def least(self) -> int:
        """The smallest size of a set that another, not equal to it, may be linked to."""
        return -(-self.percent // (100 - self.percent)) if self.percent < 100 else 1 << 62

    def length(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return 100 * np.minimum(a, b) >= self.percent * np.maximum(a, b)

    def position(self, a: np.ndarray, b: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Whether sets whose first shared key lies at i and j may still be linked."""
        return 1 + np.minimum(a - i - 1, b - j - 1) >= self.alpha(a, b)

    def suffix(self, a: np.ndarray, b: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """x, y: counts of the sets' keys by range, 255 at most. What they differ in isn't shared."""
        return np.abs(x.astype(np.int16) - y).sum(axis=1, dtype=np.int64) <= a + b - 2 * self.alpha(a, b)

    def linked(self, a: np.ndarray, b: np.ndarray, shared: np.ndarray) -> np.ndarray:
        return (100 + self.percent) * shared >= self.percent * (a + b)


def _read(shingle: int, folder: str):
    """Pass 1: each row's set by name and size, and where its text lies; the counters of a task at its end."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        uid = TaskContext.get().partitionId() << 36
        counters = np.zeros(1 << BITS, np.int64)
        none = lambda n, t: pa.nulls(n, t)
        squeeze = zstandard.ZstdCompressor(level=1).compress
        with blobs(folder) as out:
            for batch in whole_blocks(batches, "text", BLOCK_BYTES):
                h, size = _sorted_sets(*shingles(batch.column("text"), shingle))
                np.add.at(counters, (h & np.uint64((1 << BITS) - 1)).astype(np.int64), 1)
                ends, m = np.cumsum(size), len(batch)
                names = [xxhash.xxh3_128_digest(h[b - k : b].tobytes()) for b, k in zip(ends.tolist(), size.tolist(), strict=True)]
                places = [out.add(squeeze(t.as_buffer())) if k else (None, None, None) for t, k in zip(batch.column("text").cast(pa.large_binary()), size.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.arange(uid, uid + m)), pa.array(np.full(m, uid)), batch.column("doc_id"), pa.array(names, pa.binary()), pa.array(size, pa.int64()),
                    *(pa.array([p[i] for p in places], t) for i, t in enumerate((pa.string(), pa.int64(), pa.int64()))), none(m, pa.int32()), none(m, pa.binary()),
                ], names=[c.split()[0] for c in ROW.split(", ")])
                uid += m
                trim()
        if counters.any():
            shards = [squeeze(c.astype(np.uint32).tobytes()) for c in np.split(counters, SHARDS)]
            columns = [none(SHARDS, t) for t in (pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.string(), pa.int64(), pa.int64())]
            task = pa.array([TaskContext.get().partitionId()] * SHARDS, pa.int64())
            yield pa.RecordBatch.from_arrays([task, *columns, pa.array(range(SHARDS), pa.int32()), pa.array(shards, pa.binary())], names=[c.split()[0] for c in ROW.split(", ")])

    return run


def _counters(data: bytes) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint32)


def _summed(table: pa.Table) -> pa.Table:
    total = np.zeros((1 << BITS) // SHARDS, np.int64)
    for data in table["data"]:
        total += _counters(data.as_py())
    data = zstandard.ZstdCompressor(level=1).compress(np.minimum(total, 2**32 - 1).astype(np.uint32).tobytes())
    return pa.table({"task": table["task"].slice(0, 1), "shard": table["shard"].slice(0, 1), "data": pa.array([data], pa.binary())})


def sketch(rows: DataFrame) -> np.ndarray:
    """The codes of all counters: a few MB, whatever the table. Counters of tasks are added up as a tree, FAN_IN at a time."""
    parts = rows.where("shard IS NOT NULL").select(F.col("uid").alias("task"), "shard", "data")
    left = parts.where("shard = 0").count()
    while left > 1:
        left = -(-left // FAN_IN)
        parts = parts.withColumn("task", F.pmod("task", F.lit(left))).groupBy("task", "shard").applyInArrow(_summed, "task long, shard int, data binary")
    codes = np.zeros(1 << BITS, np.uint8)
    for r in parts.collect():  # SHARDS rows
        width = len(codes) // SHARDS
        codes[r["shard"] * width : (r["shard"] + 1) * width] = code_of(_counters(r["data"]))
    return codes


def _sets(places: list[tuple[str, int, int]], shingle: int, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted keys of the texts at some places, one after the other; how many each has."""
    loose = zstandard.ZstdDecompressor().decompress
    texts, keys, sizes, held = [], [], [], 0

    def flush() -> None:
        h, count = shingles(pa.array(texts, pa.large_binary()), shingle)
        k, n = _sorted_sets(keyed(h, codes), count)
        keys.append(k)
        sizes.append(n)

    for data in read_many(places):
        texts.append(loose(data))
        held += len(texts[-1])
        if held > BLOCK_BYTES:
            flush()
            texts, held = [], 0
    if texts:
        flush()
    return np.concatenate(keys), np.concatenate(sizes)


def _prefixes(shingle: int, rule: Rule, held):
    """Pass 2, a block at a time: each node's prefix and counts by range."""

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("at")
        keys, size = _sets(list(zip(*(table[c].to_pylist() for c in ("file", "at", "length")), strict=True)), shingle, held.value)
        row = np.repeat(np.arange(len(size)), size)
        ranges = np.minimum(255, np.bincount(row * RANGES + (keys & np.uint64(RANGES - 1)).astype(np.int64), minlength=len(size) * RANGES)).astype(np.uint8).reshape(-1, RANGES)
        starts, long = np.cumsum(size) - size, rule.prefix(size)
        tokens = [keys[a : a + p].tobytes() for a, p in zip(starts.tolist(), long.tolist(), strict=True)]
        trim()
        return pa.table({"node": table["node"], "size": pa.array(size, pa.int64()), "ranges": pa.array([r.tobytes() for r in ranges], pa.binary()), "file": table["file"], "at": table["at"], "length": table["length"], "tokens": pa.array(tokens, pa.binary())})

    return run


def _tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each key of a prefix."""
    for batch in batches:
        for a in range(0, len(batch), 1024):
            part = batch.slice(a, 1024)
            tokens = part.column("tokens").to_pylist()
            n = np.array([len(t) // 8 for t in tokens], np.int64)
            token = np.frombuffer(b"".join(tokens), np.int64)
            at = np.repeat(np.arange(len(part)), n)
            yield pa.RecordBatch.from_pydict({"token": pa.array(token), "pos": pa.array(ragged(np.zeros(len(n), np.int64), n)), "node": part.column("node").take(pa.array(at)), "size": part.column("size").take(pa.array(at))})


class Groups:
    """Rows of a bucket in cells: sorted by cell, then size; `edges` are the cells' first rows and the end."""

    def __init__(self, table: pa.Table):
        cell = [table[c].to_numpy() for c in ("token", "row", "line")]
        size, node = table["size"].to_numpy(), table["node"].to_numpy()
        self.order = np.lexsort((node, size, *cell[::-1]))
        self.token, row, line = (c[self.order] for c in cell)
        self.size, self.node, self.pos, self.side = size[self.order], node[self.order], table["pos"].to_numpy()[self.order], table["side"].to_numpy()[self.order]
        self.whole = row == line  # else only rows of different sides are pairs
        new = np.ones(len(row), bool)
        new[1:] = (self.token[1:] != self.token[:-1]) | (row[1:] != row[:-1]) | (line[1:] != line[:-1])
        self.edges = np.append(np.flatnonzero(new), len(row))

    def pairs(self, rule: Rule) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs of rows that pass the filters of length and position; partners end where sizes grow too large."""
        stop = np.repeat(self.edges[1:], np.diff(self.edges))
        at = np.arange(len(stop))
        # the last partner of a row by length: sizes ascend within a cell
        rank = np.repeat(np.arange(len(self.edges) - 1), np.diff(self.edges)) << 40
        last = np.searchsorted(rank + self.size, rank + self.size * 100 // rule.percent, side="right")
        many = np.maximum(0, np.minimum(stop, last) - at - 1)
        upto = np.cumsum(many)
        i = 0
        while i < len(at):
            to = max(i + 1, int(np.searchsorted(upto, (upto[i - 1] if i else 0) + PAIRS, side="right")))
            x, y = np.repeat(at[i:to], many[i:to]), ragged(at[i:to] + 1, many[i:to])
            ok = self.whole[x] | (self.side[x] != self.side[y])
            ok &= rule.length(self.size[x], self.size[y]) & rule.position(self.size[x], self.size[y], self.pos[x], self.pos[y])
            ok &= self.node[x] != self.node[y]
            if ok.any():
                yield x[ok], y[ok]
            i = to


def _shared(rule: Rule):
    """Rows of a bucket that have a partner."""

    def run(table: pa.Table) -> pa.Table:
        groups = Groups(table)
        some = np.zeros(table.num_rows, bool)
        for x, y in groups.pairs(rule):
            some[x] = some[y] = True
        out = table.select([c.split()[0] for c in CELL.split(", ")]).take(pa.array(groups.order[some]))
        trim()
        return out

    return run


def _candidates(rule: Rule):
    """A forest of the pairs of a bucket that pass the suffix filter, too; no text is read for it."""

    def run(table: pa.Table) -> pa.Table:
        groups = Groups(table)
        ranges = np.frombuffer(b"".join(table["ranges"].to_pylist()), np.uint8).reshape(-1, RANGES)[groups.order]
        nodes, index = np.unique(groups.node, return_inverse=True)
        root = np.arange(len(nodes))
        for x, y in groups.pairs(rule):
            apart = root[index[x]] != root[index[y]]
            x, y = x[apart], y[apart]
            near = rule.suffix(groups.size[x], groups.size[y], ranges[x], ranges[y])
            root = local_roots(len(nodes), index[x[near]], index[y[near]], root)
        return _forest(nodes, root)

    return run


def _forest(nodes: np.ndarray, root: np.ndarray) -> pa.Table:
    joined = np.flatnonzero(root != np.arange(len(nodes)))
    trim()
    return pa.table({"u": pa.array(nodes[joined], pa.int64()), "v": pa.array(nodes[root[joined]], pa.int64())})


def _compared(shingle: int, rule: Rule, held):
    """A forest of the linked sets of each cell of a bucket. Sets are read a cell at a time, and each pair is compared once, but
    for pairs that are joined already."""

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([("group", "ascending"), ("row", "ascending"), ("line", "ascending"), ("file", "ascending"), ("at", "ascending")])
        node, row, line, side = (table[c].to_numpy() for c in ("node", "row", "line", "side"))
        group, places = table["group"].to_numpy(), list(zip(*(table[c].to_pylist() for c in ("file", "at", "length")), strict=True))
        nodes, index = np.unique(node, return_inverse=True)
        root = np.arange(len(nodes))
        new = np.ones(len(node), bool)
        new[1:] = (np.diff(group) != 0) | (np.diff(row) != 0) | (np.diff(line) != 0)
        edges = np.append(np.flatnonzero(new), len(node))
        for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
            mine = index[a:b]
            if len(mine) > 1:
                keys, size = _sets(places[a:b], shingle, held.value)
                root = _joined(rule, mine, side[a:b] if row[a] != line[a] else None, keys, size, root)
        return _forest(nodes, root)

    return run


def _joined(rule: Rule, mine: np.ndarray, side: np.ndarray | None, keys: np.ndarray, size: np.ndarray, root: np.ndarray) -> np.ndarray:
    """Roots after the linked ones of a cell's sets are joined; of two sides, only pairs of one and the other are looked at."""
    starts = np.cumsum(size) - size
    for i in range(len(mine)):
        rest = np.arange(i + 1, len(mine)) if side is None else np.flatnonzero(side == 1) if side[i] == 0 else np.zeros(0, np.int64)
        rest = rest[(root[mine[rest]] != root[mine[i]]) & rule.length(size[i], size[rest])]
        for at in range(0, len(rest), 512):
            those = rest[at : at + 512]
            own, other = keys[starts[i] : starts[i] + size[i]], keys[ragged(starts[those], size[those])]
            hit = own[np.minimum(np.searchsorted(own, other), len(own) - 1)] == other
            shared = np.add.reduceat(hit.astype(np.int64), np.cumsum(size[those]) - size[those])
            good = those[rule.linked(size[i], size[those], shared)]
            root = local_roots(len(root), np.full(len(good), mine[i]), mine[good], root)
    return root


def verified(candidates: DataFrame, prefixes: DataFrame, compare) -> DataFrame:
    """Links (u, v) that join all linked sets of each group of candidates (node, root). A group of more than PART sets or KEYS
    keys is cut into a grid of cells of two parts each; what is sent is where texts lie."""
    asked = prefixes.select("node", "size", "file", "at", "length").join(candidates.select("node", F.col("root").alias("group")), "node")
    parts = candidates.join(prefixes.select("node", "size"), "node").groupBy(F.col("root").alias("group")).agg(F.greatest(F.ceil(F.count("*") / PART), F.ceil(F.sum("size") / KEYS)).cast("long").alias("parts"))
    spot = asked.join(parts, "group").withColumn("part", F.pmod(F.xxhash64("node"), F.col("parts"))).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
    cells = spot.select("group", F.least("part", "other").alias("row"), F.greatest("part", "other").alias("line"), F.when(F.col("part") < F.col("other"), 0).otherwise(1).alias("side"), "node", "file", "at", "length")
    buckets = max(1, -(-candidates.count() // BUCKET)) * 2
    return cells.withColumn("bucket", F.pmod(F.xxhash64("group", "row", "line"), F.lit(buckets))).groupBy("bucket").applyInArrow(compare, LINK)


def _cells(prefixes: DataFrame, codes: np.ndarray) -> DataFrame:
    """Rows of CELL. Only keys whose counter reaches PART can have that many rows: those alone are counted exactly."""
    rows = prefixes.select("node", "size", "tokens").mapInArrow(_tokens, "token long, pos long, node long, size long")
    code = int(code_of(np.array([PART]))[0])
    if int(codes.max(initial=0)) < code:
        return rows.select("token", F.lit(0).cast("long").alias("row"), F.lit(0).cast("long").alias("line"), F.lit(0).alias("side"), "pos", "node", "size")
    frequent = F.shiftrightunsigned(F.col("token"), 56) >= code
    parts = rows.where(frequent).groupBy("token").agg(F.count("*").alias("n")).where(F.col("n") > PART).select("token", F.ceil(F.col("n") / PART).cast("long").alias("parts"))
    part = F.pmod(F.xxhash64("node"), F.col("parts"))
    split = rows.where(frequent).join(parts, "token", "left").withColumn("parts", F.coalesce("parts", F.lit(1).cast("long"))).withColumn("part", part)
    split = split.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
    split = split.select("token", F.least("part", "other").alias("row"), F.greatest("part", "other").alias("line"), F.when(F.col("part") < F.col("other"), 0).otherwise(1).alias("side"), "pos", "node", "size")
    return rows.where(~frequent).select("token", F.lit(0).cast("long").alias("row"), F.lit(0).cast("long").alias("line"), F.lit(0).alias("side"), "pos", "node", "size").unionByName(split)


def _dealt(cells: DataFrame, n: int, rows: int) -> DataFrame:
    return cells.withColumn("bucket", F.pmod(F.xxhash64("token", "row", "line"), F.lit(max(1, -(-n // rows)))))


def jaccard_components(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id of every document; linked are sets of `percent` or more of 100 in similarity."""
    spark, rule = docs.sparkSession, Rule(percent)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    folder = new_path(spark, "jaccard-texts")
    table = materialize(docs.mapInArrow(_read(shingle, folder), ROW), "jaccard-rows")
    codes = sketch(table)
    held = spark.sparkContext.broadcast(codes)
    rows = table.where("shard IS NULL")
    nodes = rows.where("size > 0").groupBy("name").agg(F.min("doc_id").alias("least"), F.min(F.struct("uid", "block_id", "file", "at", "length")).alias("k"), F.first("size").alias("size"))
    nodes = materialize(nodes.select("name", "least", "size", F.col("k.uid").alias("node"), "k.block_id", "k.file", "k.at", "k.length"), "jaccard-nodes")
    asked = nodes.where(F.col("size") >= rule.least()).select("node", "block_id", "file", "at", "length")
    prefixes = materialize(asked.groupBy("block_id").applyInArrow(_prefixes(shingle, rule, held), NODE), "jaccard-prefixes")
    n = prefixes.agg(F.sum(F.length("tokens"))).first()[0] or 0
    shared = materialize(_dealt(_cells(prefixes, codes), n // 8, ROWS).groupBy("bucket").applyInArrow(_shared(rule), CELL), "jaccard-shared")
    near = _dealt(shared.join(prefixes.select("node", "ranges"), "node"), shared.count(), ROWS).groupBy("bucket").applyInArrow(_candidates(rule), LINK)
    candidates = with_roots(near, "jaccard-candidates")
    links = materialize(verified(candidates, prefixes, _compared(shingle, rule, held)), "jaccard-links")
    delete(spark, folder)
    release(shared, prefixes)
    components = component_names(nodes.select(F.col("node").alias("fp"), "least"), with_roots(links, "jaccard-edges"))
    by_name = nodes.join(components, F.col("node") == F.col("fp")).select("name", "component_id")
    linked = rows.where("size > 0").join(by_name, "name").select("doc_id", F.col("size").alias("n_shingles"), "component_id")
    return linked.unionByName(rows.where("size = 0").select("doc_id", F.col("size").alias("n_shingles"), F.col("doc_id").alias("component_id")))
