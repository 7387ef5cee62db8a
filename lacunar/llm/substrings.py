"""Substring dedup with a count-min prefilter.

A window is 20 consecutive words. Pass 1: every block of documents marks its distinct windows in DEPTH rows of a
count-min sketch; the blocks' sketches are merged shard by shard, in counters that stop at two, and each block learns
which of its windows are estimated to occur in another block. Estimates are never too low, so none is lost. Pass 2:
only those windows, with 128-bit hashes of their words, are grouped exactly, and each block learns which of them begin
earlier elsewhere. Repeats within a block are found there. Pass 3 removes the covered words.

The sketch is as wide as the input asks for (WIDTH_PER_WINDOW counters a window) and is held in shards, by as many
tasks; nothing is broadcast. A window that occurs in every document is sent once by each block.

Defined cases: a null text has no words. Equal ids: the order within a block, then of the blocks, decides; null ids
come last. Texts under 20 words are kept. Words are the bytes between white space, unchanged. A removal in the
pipeline joins the kept words by one space; a text that loses nothing stays as it is.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lacunar.llm.blocks import SENT, Run, exchange, grow, over, pack_blocks, sent, shrink, split, thaw
from lacunar.llm.scratch import materialize, release
from lacunar.llm.textops import Words

WINDOW = 20
DEPTH, WIDTH_PER_WINDOW, SHARD_BITS = 2, 8, 24
_BASES = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F], dtype=np.uint64)
_ROW = np.uint64(0xD6E8FEB86659FD93)
OWN = -1  # tag of what a block tells itself


def _power(base: int, n: int) -> np.ndarray:
    p = np.full(n, base, np.uint64)
    if n:
        p[0] = 1
    return np.cumprod(p, dtype=np.uint64)


class Windows:
    """Windows of a column in row order: `at` first words, `key` 64-bit hashes; `second()` gives the other 64 bits."""

    def __init__(self, col: pa.Array, width: int = WINDOW):
        self.words, self.width = Words(col), width
        index, distinct = self.words.coded()
        both = np.frombuffer(b"".join(xxhash.xxh3_128_digest(w) for w in distinct.to_pylist()), np.uint64).reshape(-1, 2)
        self.hash = both[index] if len(index) else np.zeros((0, 2), np.uint64)
        row = np.repeat(np.arange(len(col)), np.diff(self.words.docs))
        n = max(0, len(row) - width + 1)
        self.at = np.flatnonzero(row[:n] == row[width - 1 :]) if n else np.zeros(0, np.int64)
        self.key = self._lane(0)[self.at]

    def _lane(self, lane: int) -> np.ndarray:
        base = int(_BASES[lane])
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(self.hash[:, lane] * _power(base, len(self.hash)), dtype=np.uint64)])
        n = max(0, len(self.hash) - self.width + 1)
        return (total[self.width :] - total[:n]) * _power(pow(base, -1, 1 << 64), n) if n else np.zeros(0, np.uint64)

    def second(self) -> np.ndarray:
        return self._lane(1)[self.at]


def _distinct(values: np.ndarray) -> np.ndarray:
    """np.unique by sorting; by itself it hashes, which takes many times as long for hashes of windows."""
    values = np.sort(values)
    return values[np.concatenate([[True], values[1:] != values[:-1]])] if len(values) else values


def _slot(key: np.ndarray, row: int, bits: int) -> np.ndarray:
    """Counter of each key in a row of the sketch. Row 0 takes the high bits, so its order is that of the keys."""
    return (key if row == 0 else (key ^ (key >> np.uint64(31))) * _ROW) >> np.uint64(64 - bits)


def _part(row: int, bits: int, shard_bits: int, shard: int) -> int:
    return row * (1 << max(0, bits - shard_bits)) + shard


def _sketch(bits: int, shard_bits: int):
    def run(block: int, payload: bytes, _: dict) -> Iterator[pa.RecordBatch]:
        key = _distinct(Windows(thaw(payload)["text"].combine_chunks()).key)
        parts = {}
        for row in range(DEPTH):
            slot = _distinct(_slot(key, row, bits))
            shard = slot >> np.uint64(min(bits, shard_bits))
            cut = [*np.flatnonzero(np.diff(shard, prepend=np.uint64(1 << 63))), len(slot)]
            for a, b in zip(cut, cut[1:], strict=False):
                gap = np.diff(slot[a:b] & np.uint64((1 << shard_bits) - 1), prepend=np.uint64(0))
                kind = np.uint16 if gap.max() < 1 << 16 else np.uint32
                low = gap.astype(kind).view(np.uint8).reshape(-1, kind().itemsize)
                parts[_part(row, bits, shard_bits, int(shard[a]))] = shrink(np.array([b - a], np.int64), low.T.ravel())
        if parts:
            yield sent(block, parts)

    return run


def _merge(shard_bits: int):
    def run(bucket: int, blocks: list[int], data: list[bytes]) -> list[tuple[int, int, bytes]]:
        """Which counters of a shard reach two."""
        once, twice = np.zeros(1 << shard_bits, bool), np.zeros(1 << shard_bits, bool)
        for d in data:
            slot = _unpack(d)
            again = once[slot]
            twice[slot[again]] = True
            once[slot] = True
        return [(block, bucket, shrink(np.packbits(twice[_unpack(d)]))) for block, d in zip(blocks, data, strict=True)]

    return run


def _unpack(data: bytes) -> np.ndarray:
    n, planes = grow(data)
    planes = planes.reshape(-1, int(n[0]))
    gap = sum(planes[i].astype(np.int64) << (8 * i) for i in range(len(planes)))
    return np.cumsum(gap)


def _estimated(heads: np.ndarray, bits: int, shard_bits: int, answers: dict[int, bytes]) -> np.ndarray:
    """Of a block's distinct keys, ascending: those whose counters all reach two."""
    alive = np.arange(len(heads))
    for row in range(DEPTH):
        slot, back = np.unique(_slot(heads[alive], row, bits), return_inverse=True)
        every = slot if row == 0 else _distinct(_slot(heads, row, bits))
        shard = every >> np.uint64(min(bits, shard_bits))
        keys, counts = np.unique(shard, return_counts=True)
        flags = np.concatenate([np.zeros(0, np.uint8), *[np.unpackbits(grow(answers[_part(row, bits, shard_bits, int(k))])[0], count=int(n)) for k, n in zip(keys, counts, strict=True)]]).astype(bool)
        hit = flags if row == 0 else flags[np.searchsorted(every, slot)]
        alive = alive[hit[back]]
    return alive


def _exact(bits: int, shard_bits: int, buckets: int):
    """Send the windows estimated repeated, once a block, with the place where they first begin in it."""

    def run(block: int, payload: bytes, answers: dict[int, bytes]) -> Iterator[pa.RecordBatch]:
        rows = thaw(payload)
        w = Windows(rows["text"].combine_chunks())
        order = np.argsort(w.key, kind="stable")
        key, second = w.key[order], w.second()[order]
        new = np.concatenate([[True], key[1:] != key[:-1]]) if len(key) else np.zeros(0, bool)
        if len(key) and ((second[1:] != second[:-1]) & ~new[1:]).any():  # one key of two windows
            order = order[np.lexsort((order, second, key))]
            key, second = w.key[order], w.second()[order]
            new[1:] = (key[1:] != key[:-1]) | (second[1:] != second[:-1])
        again = np.zeros(len(key), bool)
        again[order[~new]] = True
        heads = np.flatnonzero(new)
        distinct, back = np.unique(key[heads], return_inverse=True)
        flagged = np.zeros(len(distinct), bool)
        flagged[_estimated(distinct, bits, shard_bits, answers)] = True
        heads = heads[flagged[back]]
        place = order[heads]
        row = np.searchsorted(w.words.docs, w.at[place], side="right") - 1
        ids = rows["doc_id"].combine_chunks()
        null = ~np.asarray(ids.is_valid())
        doc = ids.fill_null(0).to_numpy(zero_copy_only=False)
        parts = {}
        for b, at in split((key[heads] % np.uint64(buckets)).astype(np.int64)):
            at = at[np.argsort(place[at])]
            parts[b] = shrink(key[heads[at]], second[heads[at]], null[row[at]].view(np.uint8), doc[row[at]], (w.at[place[at]] - w.words.docs[row[at]]).astype(np.int64), place[at].astype(np.int32))
        yield sent(block, parts)
        yield sent(block, {OWN - block % buckets: shrink(np.packbits(again))})

    return run


def _first(bucket: int, blocks: list[int], data: list[bytes]) -> list[tuple[int, int, bytes]]:
    """For each block the places, among those it sent, of windows that begin earlier elsewhere."""
    if bucket <= OWN:
        return [(block, OWN, d) for block, d in zip(blocks, data, strict=True)]
    got = [grow(d) for d in data]
    key, second, null, doc, start, _ = (np.concatenate([g[i] for g in got]) for i in range(6))
    source = np.repeat(np.arange(len(got)), [len(g[0]) for g in got])
    order = np.lexsort((source, start, doc, null, second, key))
    key, second = key[order], second[order]
    later = np.zeros(len(order), bool)
    later[order[1:]] = (key[1:] == key[:-1]) & (second[1:] == second[:-1])
    ends = np.cumsum([0, *[len(g[0]) for g in got]])
    return [(block, bucket, shrink(g[5][later[a:b]])) for block, g, a, b in zip(blocks, got, ends, ends[1:], strict=False)]


def _removed(rows: pa.Table, answers: dict[int, bytes]) -> tuple[Words, np.ndarray]:
    """(words, which of them go)."""
    words = Words(rows["text"].combine_chunks())
    row = np.repeat(np.arange(rows.num_rows), np.diff(words.docs))
    n = max(0, len(row) - WINDOW + 1)
    at = np.flatnonzero(row[:n] == row[WINDOW - 1 :]) if n else np.zeros(0, np.int64)
    again = np.unpackbits(grow(answers[OWN])[0], count=len(at)).astype(bool) if OWN in answers else np.zeros(len(at), bool)
    for bucket, data in answers.items():
        if bucket != OWN:
            again[grow(data)[0]] = True
    edge = np.zeros(len(words) + 1, np.int64)
    edge[at[again]] += 1
    edge[at[again] + WINDOW] -= 1
    return words, np.cumsum(edge)[:-1] > 0


def _kept(words: Words, gone: np.ndarray, i: int) -> bytes:
    a, b = int(words.docs[i]), int(words.docs[i + 1])
    data, at = words.data, words.at
    return b" ".join(data[at[k] : at[k + 1]].tobytes() for k in (a + np.flatnonzero(~gone[a:b])).tolist())


def _digest(block: int, payload: bytes, answers: dict[int, bytes]) -> Iterator[pa.RecordBatch]:
    rows = thaw(payload)
    words, gone = _removed(rows, answers)
    count = np.concatenate([[0], np.cumsum(gone)])[words.docs]
    text, at = words.data.tobytes(), words.at.tolist()
    keep, docs = (~gone).tolist(), words.docs.tolist()
    sha = [hashlib.sha256(b" ".join([text[at[k] : at[k + 1]] for k in range(a, b) if keep[k]])).hexdigest() for a, b in zip(docs, docs[1:], strict=False)]
    yield pa.RecordBatch.from_pydict({"doc_id": rows["doc_id"].combine_chunks(), "n_words": pa.array(np.diff(words.docs)), "n_removed": pa.array(np.diff(count)), "kept_sha256": pa.array(sha, pa.string())})


def _texts(columns: list[str]):
    def run(block: int, payload: bytes, answers: dict[int, bytes]) -> Iterator[pa.RecordBatch]:
        rows = thaw(payload)
        words, gone = _removed(rows, answers)
        lost = np.diff(np.concatenate([[0], np.cumsum(gone)])[words.docs])
        text = rows["text"].to_pylist()
        for i in np.flatnonzero(lost).tolist():
            text[i] = _kept(words, gone, i).decode("utf-8", "replace")
        new = rows.set_column(rows.schema.get_field_index("text"), "text", pa.array(text, pa.string()))
        yield from new.select(columns).combine_chunks().to_batches()

    return run


def _repeats(docs: DataFrame, name: str, run: Run, schema: str | StructType) -> DataFrame:
    """What `run` makes of the blocks of docs (doc_id, text, ...) and their answers about repeated windows."""
    blocks = pack_blocks(docs, "text", "doc_id", name)
    total = blocks.agg(F.sum("n_bytes").alias("bytes"), F.count("*").alias("n")).first()
    n = total["n"]
    windows = max(1, (total["bytes"] or 0) // 5)
    bits = max(16, (WIDTH_PER_WINDOW * windows - 1).bit_length())
    flags = materialize(exchange(over(blocks, n, _sketch(bits, SHARD_BITS), SENT), _merge(SHARD_BITS)), f"{name}-flags")
    found = materialize(exchange(over(blocks, n, _exact(bits, SHARD_BITS, max(1, -(-n // 2))), SENT, flags), _first), f"{name}-found")
    release(flags)
    return over(blocks, n, run, schema, found)


def _plain(docs: DataFrame) -> DataFrame:
    return docs.withColumns({"doc_id": F.col("doc_id").cast("long"), "text": F.col("text").cast("string")})


def repeated_spans(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 of every document."""
    return _repeats(_plain(docs).select("doc_id", "text"), "substrings", _digest, "doc_id long, n_words long, n_removed long, kept_sha256 string")


def remove_repeats(docs: DataFrame) -> DataFrame:
    """docs, their texts without the words that windows from earlier cover; all other columns as they are."""
    plain = _plain(docs)
    return _repeats(plain, "substrings-texts", _texts(docs.columns), plain.schema)
