"""Words and pieces of whole Arrow text columns, found without a loop over words."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SPACES = (0x20, *range(0x09, 0x0E))
_bytes = np.arange(256)
LOWER = np.where((_bytes >= 65) & (_bytes <= 90), _bytes + 32, _bytes).astype(np.uint8)
IS_WORD = (~np.isin(_bytes, SPACES)).astype(np.uint8)
IS_ALNUM = (((_bytes >= 0x30) & (_bytes <= 0x39)) | ((_bytes >= 0x61) & (_bytes <= 0x7A)) | (_bytes >= 0x80)).astype(np.uint8)


def trim() -> None:
    """Give freed memory back, so that a reused worker doesn't keep the peak of its last task."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # not glibc
        pass


def slices(batch: pa.RecordBatch, text: str, limit: int = 16 << 20) -> Iterator[pa.RecordBatch]:
    """Runs of whole rows of about `limit` bytes of text; a longer text makes a run of its own."""
    if not batch.num_rows:
        return
    sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    ends = np.cumsum(sizes)
    at = 0
    while at < len(sizes):
        base = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, base + limit, side="right")))
        yield batch.slice(at, to - at)
        at = to


def raw(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a text column from 0; null is empty."""
    col = pc.fill_null(col.cast(pa.large_binary()), b"")
    if not len(col):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = col.buffers()
    offsets = np.frombuffer(offsets, np.int64)[col.offset : col.offset + len(col) + 1]
    data = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    return data, offsets - offsets[0]


def binary(data: np.ndarray, offsets: np.ndarray) -> pa.Array:
    offsets = np.ascontiguousarray(offsets, dtype=np.int64)
    return pa.Array.from_buffers(pa.large_binary(), len(offsets) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data))])


class Words:
    """Words of a column: `data` holds their bytes without a gap, `at` their offsets, `docs` each row's first word."""

    def __init__(self, col: pa.Array, word: np.ndarray = IS_WORD, lower: bool = False):
        data, offsets = raw(col)
        if lower:
            data = LOWER[data]
        inside = word[data]
        before = np.empty(len(data) + 1, np.uint8)
        before[0], before[1:] = 0, inside
        edges = offsets[1:-1][offsets[1:-1] < len(data)]
        before[edges] = 0
        starts = np.flatnonzero(inside > before[:-1])
        after = before[1:].copy() if len(data) else np.zeros(0, np.uint8)
        after[:-1] = inside[1:]
        after[-1:] = 0
        after[edges[edges > 0] - 1] = 0
        ends = np.flatnonzero(inside > after)
        self.data = data[inside.view(bool)]
        self.at = np.concatenate([np.zeros(1, np.int64), np.cumsum(ends + 1 - starts)])
        self.docs = np.searchsorted(starts, offsets)

    def __len__(self) -> int:
        return len(self.at) - 1

    def coded(self) -> tuple[np.ndarray, pa.Array]:
        """(index of each word, distinct words)."""
        coded = binary(self.data, self.at).dictionary_encode()
        return coded.indices.to_numpy(), coded.dictionary


def pieces(col: pa.Array) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """(index of each piece, distinct pieces, each row's first piece). Joined, a row's pieces are its text.

    A text is cut before a space or line feed that follows a character which is surely no white space. Tokenizers whose
    pre-tokenizer cuts there, too, have no token that spans such a place, so tokens of pieces are tokens of the text.
    """
    data, offsets = raw(col)
    cut = np.flatnonzero((data == 32) | (data == 10))
    cut = cut[cut > 0]
    last = data[cut - 1]
    safe = (last > 32) & (last != 127)
    wide = np.flatnonzero(last >= 0x80)
    if len(wide):  # may be the last byte of a wide space
        lead2, lead3 = data[cut[wide] - 2], data[np.maximum(cut[wide] - 3, 0)]
        safe[wide] &= (lead2 != 0xC2) & ((lead3 < 0xE1) | (lead3 > 0xE3))
    mark = np.zeros(len(data) + 1, bool)
    mark[cut[safe]] = True
    mark[offsets] = True
    at = np.flatnonzero(mark)
    coded = binary(data, at).dictionary_encode() if len(at) > 1 else binary(data, np.zeros(1, np.int64)).dictionary_encode()
    return coded.indices.to_numpy(), coded.dictionary, np.searchsorted(at, offsets)


def whole(col: pa.Array) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """As `pieces`, each row one piece."""
    coded = binary(*raw(col)).dictionary_encode()
    return coded.indices.to_numpy(), coded.dictionary, np.arange(len(col) + 1)


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Positions starts[i] .. starts[i] + lengths[i] - 1, one run after another."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total, dtype=np.int64) + np.repeat(starts - (ends - lengths), lengths)
