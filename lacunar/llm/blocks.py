"""Blocks of whole rows, and exchanges in which blocks ask hash buckets and get answers back.

A block is some MB of rows as one compressed Arrow message, written once to a file in the shared folder; the table of
blocks only says where each lies, so passes read blocks from their files and no text goes through a shuffle. A pass over
the blocks sends, for each of a fixed number of hash buckets, one packed array to that bucket; a bucket is one group, of about the
same size as any other since keys are hashed and each block sends a key once, however often it occurs. Answers go back
to their block the same way. No key's occurrences ever meet in one task, and rows of the shuffle are arrays, not keys.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType, _parse_datatype_string

from lacunar.llm.files import blobs, read_blob
from lacunar.llm.scratch import materialize, new_path
from lacunar.llm.textops import slices, trim

BLOCK_BYTES = 4 << 20
BLOCK_ROWS = 1 << 16
BLOCKS_PER_TASK = 4
SMALL = 256  # bytes of an answer that its row holds itself
PLACE = "block_id long, n_rows long, n_bytes long, file string, at long, size long"
SENT = "bucket long, block_id long, data binary"
ANSWER = "block_id long, bucket long, data binary"


def freeze(table: pa.Table | pa.RecordBatch) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", 3))) as writer:
        writer.write(table)
    return sink.getvalue().to_pybytes()


def thaw(payload: bytes) -> pa.Table:
    return pa.ipc.open_stream(payload).read_all()


def shrink(*arrays: np.ndarray) -> bytes:
    """Arrays as one compressed message; `grow` gives them back."""
    return zstandard.ZstdCompressor(level=1).compress(freeze_arrays(arrays))


def freeze_arrays(arrays) -> bytes:
    head = [np.array([len(arrays)], np.int64).tobytes()]
    for a in arrays:
        head.append(np.array([ord(a.dtype.kind), a.dtype.itemsize, len(a)], np.int64).tobytes())
    return b"".join([*head, *[np.ascontiguousarray(a).tobytes() for a in arrays]])


def grow(data: bytes) -> list[np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(data)
    n = int(np.frombuffer(raw, np.int64, 1)[0])
    head = np.frombuffer(raw, np.int64, 3 * n, 8).reshape(n, 3).tolist()
    at, out = 8 + 24 * n, []
    for kind, size, length in head:
        out.append(np.frombuffer(raw, f"{chr(kind)}{size}", length, at))
        at += size * length
    return out


def placed(block: int, n_rows: int, n_bytes: int, place: tuple[str, int, int]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64())
    names = ("block_id", "n_rows", "n_bytes", "file", "at", "size")
    return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip((block, n_rows, n_bytes, *place), kinds, strict=True)], names=names)


def pack_blocks(df: DataFrame, text: str, order: str, name: str, convert: Callable[[pa.RecordBatch], pa.RecordBatch] | None = None, limit: int = BLOCK_BYTES) -> DataFrame:
    """The blocks' table (PLACE); rows of a block by `order`, nulls last, else as they came."""
    folder = new_path(df.sparkSession, f"{name}-files")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        block = TaskContext.get().partitionId() << 32
        with blobs(folder) as out:
            for batch in whole_blocks(batches, text, limit):
                keys = batch.column(order)
                at = np.lexsort((keys.fill_null(0).to_numpy(zero_copy_only=False), ~np.asarray(keys.is_valid())))
                batch = batch.take(pa.array(at))
                n_bytes = int(pa.compute.sum(pa.compute.binary_length(batch.column(text))).as_py() or 0)
                payload = freeze(convert(batch) if convert else batch)
                trim()
                yield placed(block, len(batch), n_bytes, out.add(payload))
                block += 1

    return materialize(df.mapInArrow(run, PLACE), name)


def whole_blocks(batches: Iterator[pa.RecordBatch], text: str, limit: int, most: int = BLOCK_ROWS) -> Iterator[pa.RecordBatch]:
    """Runs of rows of about `limit` bytes of text, and of `most` rows or few more, across the batches of a task."""
    held: list[pa.RecordBatch] = []
    size = rows = 0
    for batch in batches:
        for part in slices(batch, text, max(1, limit // 4)):
            held.append(part)
            size += int(pa.compute.sum(pa.compute.binary_length(part.column(text))).as_py() or 0)
            rows += part.num_rows
            if size >= limit or rows >= most:
                yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
                held, size, rows = [], 0, 0
    if held:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def tasks(df: DataFrame, n_blocks: int) -> int:
    """How many tasks a pass over the blocks takes: a few blocks each, and all cores."""
    return max(1, min(n_blocks, max(-(-n_blocks // BLOCKS_PER_TASK), 3 * df.sparkSession.sparkContext.defaultParallelism)))


def sent(block_id: int, parts: dict[int, bytes]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({"bucket": pa.array(list(parts), pa.int64()), "block_id": pa.array([block_id] * len(parts), pa.int64()), "data": pa.array(list(parts.values()), pa.binary())})


def split(bucket: np.ndarray) -> list[tuple[int, np.ndarray]]:
    """(bucket, positions in it) of the buckets that occur; positions ascend."""
    if not len(bucket):
        return []
    order = np.argsort(bucket, kind="stable")
    keys, at = np.unique(bucket[order], return_index=True)
    return [(int(k), order[a:b]) for k, a, b in zip(keys, at, [*at[1:], len(order)], strict=True)]


def exchange(sends: DataFrame, answer: Callable[[int, list[int], list[bytes]], list[tuple[int, int, bytes]]], folder: str | None = None) -> DataFrame:
    """Answers (block_id, bucket, data): `answer` gets a bucket with its blocks, ascending, and what they sent. With a folder,
    what blocks are answered lies there, once, in a file of each bucket, and the table tells only where (file, at, size)."""

    def run(table: pa.Table) -> pa.Table:
        ids, data = table["block_id"].to_pylist(), table["data"].to_pylist()
        order = sorted(range(len(ids)), key=ids.__getitem__)
        rows = answer(table["bucket"][0].as_py(), [ids[i] for i in order], [data[i] for i in order])
        del table, data
        out = {"block_id": pa.array([r[0] for r in rows], pa.int64()), "bucket": pa.array([r[1] for r in rows], pa.int64())}
        if folder is None:
            out["data"] = pa.array([r[2] for r in rows], pa.binary())
        else:
            with blobs(folder) as files:
                places = [files.add(r[2]) if len(r[2]) > SMALL and r[0] >= 0 else None for r in rows]
            out["data"] = pa.array([None if p else r[2] for r, p in zip(rows, places, strict=True)], pa.binary())
            for i, (name, kind) in enumerate((("file", pa.string()), ("at", pa.int64()), ("size", pa.int64()))):
                out[name] = pa.array([p[i] if p else None for p in places], kind)
        trim()
        return pa.table(out)

    return sends.groupBy("bucket").applyInArrow(run, ANSWER if folder is None else f"{ANSWER}, file string, at long, size long")


Run = Callable[[int, bytes, dict[int, bytes]], Iterator[pa.RecordBatch]]


def over(blocks: DataFrame, n_blocks: int, run: Run, schema: str | StructType, answers: DataFrame | None = None) -> DataFrame:
    """What `run` makes of each block: its number, what its file holds and its answers by bucket. One shuffle brings the
    answers and the blocks' places together, in small rows; a task holds one block at a time."""
    rows = blocks.select("block_id", F.lit(None).cast("long").alias("bucket"), F.lit(None).cast("binary").alias("data"), "file", "at", "size")
    if answers is not None:
        rows = rows.unionByName(answers, allowMissingColumns=True)
    empty = _arrow(schema)

    def one(table: pa.Table) -> pa.Table:
        place, got = None, {}
        for bucket, data, *at in zip(*(table[c].to_pylist() for c in ("bucket", "data", "file", "at", "size")), strict=True):
            if bucket is None:
                place = at
            else:
                got[bucket] = read_blob(*at) if data is None else data
        block = table["block_id"][0].as_py()
        del table
        made = list(run(block, read_blob(*place), got)) if place else []
        trim()
        return pa.Table.from_batches(made) if made else empty.empty_table()

    return rows.repartition(tasks(blocks, n_blocks), "block_id").groupBy("block_id").applyInArrow(one, schema)


def _arrow(schema: str | StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(_parse_datatype_string(schema) if isinstance(schema, str) else schema)
