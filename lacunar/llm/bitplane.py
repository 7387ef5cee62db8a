"""Token ids in plane-shuffled binary files.

Documents lie in ascending doc_id order, nulls last. They are dealt to ranges of ids, quantiles of a bounded sample, and a
range is written as files of about SHARD_DOCS documents each; rows that share an id, or have none, are dealt to as many
ranges as the id is quantiles of, so no id makes a task large. Those follow each other in an order that the input decides.
A file holds

    b"LPL1" | chunks ... | index (JSON) | its length, 8 bytes little-endian | b"LPL1"

A chunk is a block of up to BLOCK whole numbers of one stream ("ids": token ids; "doc": document ids; "len": tokens of
each document; "null": 1 for a null document id). The block is transposed into planes, all first bytes of its numbers,
then all second bytes and so on (or, with planes="bit", single bits), and every plane is compressed by itself with
zstandard. The index lists [stream, offset, count, width in bytes, planes, [compressed length of each plane]] and the
CRC-32 of the chunk, so a reader can seek to any block.

Files are written under a name of the attempt and renamed, so a task that is run again leaves one whole file.

Defined cases: a null text is empty; its document holds the end id alone. Repeated rows are all kept. An empty table
gives no file and an empty result. Other columns, whatever their names, are not read.
"""

from __future__ import annotations

import json
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lacunar.llm.files import open_uri
from lacunar.llm.scratch import materialize, new_path
from lacunar.llm.textops import slices
from lacunar.llm.tokens import Encoder

MAGIC = b"LPL1"
BLOCK = 1 << 16
SHARD_DOCS = 8192
SAMPLE = 1 << 18  # ids, at most about so many, that the ranges are made from; 16 of them a range
MANIFEST = "shard long, file string, n_docs long, n_ids long"


def shuffle_block(values: np.ndarray, planes: str) -> tuple[int, list[bytes]]:
    """(width in bytes, planes) of unsigned 64-bit numbers."""
    width = max(1, (int(values.max()).bit_length() + 7) // 8)
    rows = values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width]
    if planes == "byte":
        return width, [np.ascontiguousarray(rows[:, i]).tobytes() for i in range(width)]
    bits = np.unpackbits(rows, axis=1, bitorder="little")
    return width, [np.packbits(bits[:, i], bitorder="little").tobytes() for i in range(8 * width)]


def unshuffle_block(parts: list[bytes], count: int, width: int, planes: str) -> np.ndarray:
    rows = np.zeros((count, 8), np.uint8)
    if planes == "byte":
        for i, p in enumerate(parts):
            rows[:, i] = np.frombuffer(p, np.uint8)
    else:
        bits = np.stack([np.unpackbits(np.frombuffer(p, np.uint8), count=count, bitorder="little") for p in parts], axis=1)
        rows[:, :width] = np.packbits(bits, axis=1, bitorder="little")
    return rows.view("<u8").ravel()


class Writer:
    def __init__(self, out, planes: str = "byte", level: int = 3):
        self.out, self.planes, self.zstd = out, planes, zstandard.ZstdCompressor(level=level)
        self.index: list[list] = []
        self.held: dict[str, list[np.ndarray]] = {}
        self.count: dict[str, int] = {}
        self.out.write(MAGIC)
        self.at = len(MAGIC)

    def add(self, stream: str, values: np.ndarray) -> None:
        self.held.setdefault(stream, []).append(values.astype(np.uint64))
        self.count[stream] = self.count.get(stream, 0) + len(values)
        if self.count[stream] >= BLOCK:
            self._flush(stream, False)

    def _flush(self, stream: str, all_of_it: bool) -> None:
        values = np.concatenate(self.held[stream])
        whole = len(values) if all_of_it else len(values) // BLOCK * BLOCK
        for a in range(0, whole, BLOCK):
            block = values[a : min(a + BLOCK, whole)]
            width, parts = shuffle_block(block, self.planes)
            packed = [self.zstd.compress(p) for p in parts]
            chunk = b"".join(packed)
            self.out.write(chunk)
            self.index.append([stream, self.at, len(block), width, self.planes, [len(p) for p in packed], zlib.crc32(chunk)])
            self.at += len(chunk)
        self.held[stream], self.count[stream] = [values[whole:]], len(values) - whole

    def close(self) -> None:
        for stream in self.held:
            self._flush(stream, True)
        index = json.dumps(self.index).encode()
        self.out.write(index + len(index).to_bytes(8, "little") + MAGIC)
        self.out.close()


class Reader:
    """Streams of one file, block by block."""

    def __init__(self, source):
        self.source = source
        size = source.size()
        tail = source.read_at(12, size - 12)
        if tail[8:] != MAGIC or source.read_at(4, 0) != MAGIC:
            raise ValueError("not a plane file")
        n = int.from_bytes(tail[:8], "little")
        self.index = json.loads(source.read_at(n, size - 12 - n))
        self.zstd = zstandard.ZstdDecompressor()

    def blocks(self, stream: str) -> Iterator[np.ndarray]:
        for name, at, count, width, planes, lengths, crc in self.index:
            if name == stream:
                chunk = self.source.read_at(sum(lengths), at)
                if zlib.crc32(chunk) != crc:
                    raise ValueError(f"damaged chunk at {at}")
                ends = np.cumsum([0, *lengths])
                yield unshuffle_block([self.zstd.decompress(chunk[a:b]) for a, b in zip(ends, ends[1:], strict=False)], count, width, planes)

    def all(self, stream: str) -> np.ndarray:
        return np.concatenate([np.zeros(0, np.uint64), *self.blocks(stream)])

    def documents(self) -> Iterator[tuple[int | None, int, Iterator[np.ndarray]]]:
        """(document id, number of ids, its ids in parts); the parts are to be read before the next document."""
        blocks = self.blocks("ids")
        block = np.zeros(0, np.uint64)

        def parts(n: int) -> Iterator[np.ndarray]:
            nonlocal block
            while n:
                if not len(block):
                    block = next(blocks)
                part, block = block[:n], block[n:]
                n -= len(part)
                yield part

        for doc, null, n in zip(self.all("doc").view(np.int64).tolist(), self.all("null").tolist(), self.all("len").tolist(), strict=True):
            yield None if null else doc, n, parts(n)


def _encode(tokenizer: str, end: int, bounds: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder.of(tokenizer)
        n = 0
        for batch in batches:
            for part in slices(batch, "text"):
                ids, offsets = encoder.encode(part.column("text"), end)
                kind = np.uint16 if encoder.tokenizer.get_vocab_size() <= 1 << 16 and end < 1 << 16 else np.uint32
                docs = part.column("doc_id")
                keys = docs.fill_null(np.iinfo(np.int64).max).to_numpy(zero_copy_only=False)
                first, last = (np.searchsorted(bounds, keys, side=side) for side in ("left", "right"))
                shard = first + (np.arange(n, n + len(keys)) % (last - first + 1))  # an id that is several bounds has several ranges
                n += len(keys)
                width = np.dtype(kind).itemsize
                data = pa.Array.from_buffers(pa.large_binary(), len(part), [None, pa.py_buffer(np.ascontiguousarray(offsets * width)), pa.py_buffer(ids.astype(kind))])
                yield pa.RecordBatch.from_pydict({"shard": pa.array(shard, pa.int64()), "doc_id": docs, "width": pa.array(np.full(len(part), width, np.int32)), "ids": data.cast(pa.binary())})

    return run


def _write(folder: str, planes: str, shard_docs: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made, open_shard, writer, n_docs, n_ids = [], -1, None, 0, 0

        def finish() -> None:
            if writer:
                writer.close()
                final = f"{folder}/{open_shard:020d}.lpl"
                fs, there = open_uri(final)
                fs.move(f"{there}.{attempt}", there)
                made.append((open_shard, final, n_docs, n_ids))

        for batch in batches:
            for shard, doc, width, ids in zip(*(batch.column(c).to_pylist() for c in ("shard", "doc_id", "width", "ids")), strict=True):
                if shard << 32 != open_shard >> 32 << 32 or n_docs >= shard_docs:
                    finish()
                    open_shard = max(shard << 32, open_shard + 1)
                    attempt, n_docs, n_ids = uuid.uuid4().hex, 0, 0
                    fs, there = open_uri(f"{folder}/{open_shard:020d}.lpl")
                    fs.create_dir(there.rsplit("/", 1)[0], recursive=True)
                    writer = Writer(fs.open_output_stream(f"{there}.{attempt}"), planes)
                values = np.frombuffer(ids, np.uint16 if width == 2 else np.uint32)
                writer.add("ids", values)
                writer.add("doc", np.array([doc or 0], np.int64).view(np.uint64))
                writer.add("null", np.array([doc is None], np.uint64))
                writer.add("len", np.array([len(values)], np.uint64))
                n_docs, n_ids = n_docs + 1, n_ids + len(values)
        finish()
        if made:
            yield pa.RecordBatch.from_pydict({k: pa.array([m[i] for m in made], t) for i, (k, t) in enumerate((("shard", pa.int64()), ("file", pa.string()), ("n_docs", pa.int64()), ("n_ids", pa.int64())))})

    return run


def write_planes(docs: DataFrame, folder: str, tokenizer: str, end: int, planes: str = "byte", shard_docs: int = SHARD_DOCS) -> DataFrame:
    """Encode every text, write the shards' files to a shared folder and return their manifest (shard, file, n_docs, n_ids)."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    n = docs.select("doc_id").count()
    ranges = max(1, min(-(-n // shard_docs), SAMPLE // 16))
    bounds = np.zeros(0, np.int64)
    if ranges > 1:
        # so many rows, chosen by the place they have in the input, that every copy of an id may be among them
        share = min(1.0, SAMPLE / n)
        chosen = docs.select("doc_id").where(F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(1 << 30)) < int(share * (1 << 30)))
        ids = np.sort(np.array([np.iinfo(np.int64).max if r[0] is None else r[0] for r in chosen.limit(2 * SAMPLE).collect()], np.int64))
        bounds = ids[(np.arange(1, ranges) * len(ids)) // ranges] if len(ids) else bounds
    encoded = docs.mapInArrow(_encode(tokenizer, end, bounds), "shard long, doc_id long, width int, ids binary")
    ordered = encoded.repartition(len(bounds) + 1, "shard").sortWithinPartitions("shard", F.col("doc_id").asc_nulls_last(), "ids")
    return materialize(ordered.mapInArrow(_write(folder, planes, 2 * shard_docs), MANIFEST), "planes-manifest")


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for file, base in zip(batch.column("file").to_pylist(), batch.column("base").to_pylist(), strict=True):
            fs, there = open_uri(file)
            docs, starts, lengths, crcs, at = [], [], [], [], base
            with fs.open_input_file(there) as source:
                for doc, n, parts in Reader(source).documents():
                    crc = 0
                    for part in parts:
                        crc = zlib.crc32(part.astype("<u4").tobytes(), crc)
                    docs.append(doc)
                    starts.append(at)
                    lengths.append(n)
                    crcs.append(crc)
                    at += n
            yield pa.RecordBatch.from_pydict({"doc_id": pa.array(docs, pa.int64()), "start": pa.array(starts, pa.int64()), "n_tokens": pa.array(lengths, pa.int64()), "ids_crc32": pa.array(crcs, pa.int64())})


def read_digest(manifest: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, from the files alone. The running sum is over one row a file."""
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    based = manifest.withColumn("base", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))
    tasks = int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return based.repartition(tasks, "shard").select("file", "base").mapInArrow(_digest, "doc_id long, start long, n_tokens long, ids_crc32 long")


def encode_and_read_back(spark: SparkSession, docs: DataFrame, tokenizer: str, end: int = 2, planes: str = "byte", shard_docs: int = SHARD_DOCS) -> DataFrame:
    return read_digest(write_planes(docs, new_path(spark, "planes"), tokenizer, end, planes, shard_docs))
