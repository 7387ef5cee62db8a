"""Vector bin packing of token sequences under limits on tokens, segments and loss-bearing tokens.

A sequence begins with a piece of a document that no sequence holds whole, if there is one. Then it takes, of the
waiting documents that fit whole, the one whose demand has the largest dot product
with what is left of the three limits, each as a share of its limit; when none fits, or one segment is left, the document
that gives the longest piece is cut so that the sequence becomes full, and its rest waits on. A task packs what it reads
by itself, so nothing is shuffled or collected; only its last sequences can fall short. At most WAITING documents wait at
a time.

What bears no loss is the start of a document: its prompt column or, for documents without one, `prompt_share` of its
tokens. Tokens behind it bear loss, so pieces of long texts come up against the limit on loss-bearing tokens and are
packed with starts of others, and short texts come up against the limit on segments.

Defined cases: a null text is empty, so its document is the end id alone; every row, repeated or not, is packed. Only
"doc_id", the text and the prompt column are read. An empty table gives no rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lacunar.llm.textops import slices, trim
from lacunar.llm.tokens import Encoder

LENGTH, SEGMENTS, LOSS, PROMPT_SHARE = 2048, 12, 2016, 0.125
WAITING, LEFT = 2048, 1024
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, loss long"


class Packer:
    """Documents in, closed sequences out: (document, start, length, sequence, offset, loss) pieces."""

    def __init__(self, tokens: int, segments: int, loss: int):
        self.limit = np.array([tokens, segments, loss], dtype=np.float64)
        self.doc = np.zeros(0, np.int64)  # waiting: document, first token, tokens left, tokens left without loss
        self.start, self.left, self.free = (np.zeros(0, np.int64) for _ in range(3))
        self.sequence = 0

    def add(self, docs: np.ndarray, tokens: np.ndarray, free: np.ndarray) -> None:
        self.doc, self.start = np.concatenate([self.doc, docs]), np.concatenate([self.start, np.zeros(len(docs), np.int64)])
        self.left, self.free = np.concatenate([self.left, tokens]), np.concatenate([self.free, np.minimum(free, tokens)])

    def _take(self, i: int, n: int, room: np.ndarray) -> tuple[int, int, int, int, int, int]:
        loss = max(0, n - int(self.free[i]))
        piece = (int(self.doc[i]), int(self.start[i]), n, self.sequence, int(self.limit[0] - room[0]), loss)
        self.start[i] += n
        self.left[i] -= n
        self.free[i] = max(0, int(self.free[i]) - n)
        room -= (n, 1, loss)
        return piece

    def fill(self, until: int) -> Iterator[tuple[int, int, int, int, int, int]]:
        while (waiting := int(np.count_nonzero(self.left))) > until:
            room = self.limit.copy()
            long = np.where((self.left > room[0]) | (self.left - self.free > room[2]), self.left, 0)
            if long.any():  # what no sequence holds whole comes first, while others' starts are there to go with it
                i = int(np.argmax(long))
                yield self._take(i, int(min(self.left[i], room[0], self.free[i] + room[2])), room)
            while room[0] >= 1 and room[1] >= 1 and waiting:
                loss = np.maximum(0, self.left - self.free)
                fits = (self.left > 0) & (self.left <= room[0]) & (loss <= room[2])
                if fits.any() and (room[1] > 1 or (fits & (self.left == room[0])).any()):
                    w = room / self.limit / self.limit
                    score = np.where(fits, w[0] * self.left + w[1] + w[2] * loss, -1.0)
                    i = int(np.argmax(score))
                    yield self._take(i, int(self.left[i]), room)
                    waiting -= 1
                else:
                    most = np.minimum(np.minimum(self.left, int(room[0])), self.free + int(room[2]))
                    i = int(np.lexsort((-self.left, -most))[0])
                    if most[i] < 1:
                        break
                    yield self._take(i, int(most[i]), room)
            self.sequence += 1
            if len(self.left) > 2 * waiting + 64:
                keep = self.left > 0
                self.doc, self.start, self.left, self.free = self.doc[keep], self.start[keep], self.left[keep], self.free[keep]


def _pack(tokenizer: str, end: int, tokens: int, segments: int, loss: int, prompt: bool, prompt_share: float, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encoder, packer, base = Encoder.of(tokenizer), Packer(tokens, segments, loss), TaskContext.get().partitionId() << 32
        ids_of: dict[int, tuple[int | None, np.ndarray]] = {}
        n = 0

        def out(until: int) -> Iterator[pa.RecordBatch]:
            rows = list(packer.fill(until))
            if rows:
                doc, start, length, seq, offset, lossy = (list(c) for c in zip(*rows, strict=True))
                cut = [ids_of[d][1][s : s + k] for d, s, k in zip(doc, start, length, strict=True)]
                columns = {
                    "doc_id": pa.array([ids_of[d][0] for d in doc], pa.int64()), "start": pa.array(start, pa.int64()), "length": pa.array(length, pa.int64()),
                    "ids_crc32": pa.array([zlib.crc32(c) for c in cut], pa.int64()), "doc_tokens": pa.array([len(ids_of[d][1]) for d in doc], pa.int64()),
                    "sequence_id": pa.array(np.array(seq, np.int64) + base), "offset": pa.array(offset, pa.int64()), "loss": pa.array(lossy, pa.int64()),
                }
                yield pa.RecordBatch.from_pydict(columns | ({"ids": pa.array(cut, pa.list_(pa.int32()))} if with_ids else {}))
            waiting = set(packer.doc[packer.left > 0].tolist())
            for d in [d for d in ids_of if d not in waiting]:
                del ids_of[d]

        for batch in batches:
            for part in slices(batch, "text", 4 << 20):
                ids, offsets = encoder.encode(part.column("text"), end)
                ids = ids.astype("<u4", copy=False)
                lead = [np.zeros(0, np.uint32)] * len(part)
                if prompt:
                    p_ids, p_off = encoder.encode(part.column("prompt"))
                    lead = [p_ids[a:b] for a, b in zip(p_off, p_off[1:], strict=False)]
                sizes = np.diff(offsets) + [len(x) for x in lead]
                for i, doc in enumerate(part.column("doc_id").to_pylist()):
                    own = ids[offsets[i] : offsets[i + 1]]
                    ids_of[n + i] = doc, np.concatenate([lead[i].astype("<u4"), own]) if len(lead[i]) else own.copy()
                free = np.array([len(x) for x in lead], np.int64) if prompt else np.floor(sizes * prompt_share).astype(np.int64)
                packer.add(np.arange(n, n + len(part)), sizes, free)
                n += len(part)
                if np.count_nonzero(packer.left) > WAITING:
                    yield from out(LEFT)
        yield from out(0)
        trim()

    return run


def pack(docs: DataFrame, tokenizer: str, end: int = 1, tokens: int = LENGTH, segments: int = SEGMENTS, loss: int | None = None, prompt: str | None = None, prompt_share: float = 0.0, with_ids: bool = False) -> DataFrame:
    """One row a piece: where it lies in its document and in its sequence (`loss`: its loss-bearing tokens).

    A document is the ids of its prompt, of its text and the end id. What bears no loss are the ids of the prompt or,
    without that column, the first `prompt_share` of all. No `loss`: no limit but that on tokens.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), *([F.col(prompt).cast("string").alias("prompt")] if prompt else []))
    return docs.mapInArrow(_pack(tokenizer, end, tokens, segments, loss or tokens, bool(prompt), prompt_share, with_ids), PIECES + (", ids array<int>" if with_ids else ""))
