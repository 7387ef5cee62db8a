"""Language-model scoring with a probabilistic suffix tree over words.

The tree's contexts are the empty one and runs of up to `depth` words. A context is a candidate if it occurs at least
`min_count` times in training (without one: makes up at least P_MIN of the training tokens), so their number grows with
the corpus. It is retained if the distribution of the next word diverges from that of its suffix by MIN_DIVERGENCE nats
or more, or if it is the suffix of a retained one. A token is scored in the state of the longest retained suffix of what
precedes it; the text's start counts as the end mark.

Distributions are smoothed towards the suffix's: P(w|s) = (c(s,w) + T(s) P(w|suffix)) / (c(s) + T(s)), T: distinct
followers; at the root P(w) = (c(w) + 1) / (N + V + 1), which leaves one share for unseen words. They sum to one.

All counts are exact and over all training documents. They are gathered level by level: a context occurs as often as its
last word follows the rest of it, so what a block was answered at one level tells it the candidates of the next. A
context's followers meet in one hash bucket, which tests the divergence. A context that occurs as often as its suffix
always stands behind the same word, so it has its suffix's followers and isn't asked for. Only contexts with HOT of the
tokens or more (at most 1 / HOT a level, whatever the corpus) are spread over all buckets; their sums are aggregated by
context and given to every task. A last exchange closes the set under suffixes.

A block is split into words once. What it learns at a level it keeps in files of the shared folder, where its next
passes find it: shuffles carry counts alone, of one level at a time. Buckets number the words, frequent ones first, and
the contexts of the next level; what is sent names both by number, and words' hashes are dropped when they are numbered.
Ranks and words ascend where they can, and what is sent are the steps. Contexts are known by 64-bit hashes of numbers.

Defined cases: a null text is the end mark alone. Null ids count as training. An empty table gives no rows. Words are
known by 64-bit hashes. Only doc_id and text are read.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lacunar.llm import blocks as shared
from lacunar.llm.blocks import SENT, exchange, freeze, over, sent, split, thaw
from lacunar.llm.files import blobs, read_blob
from lacunar.llm.scratch import delete, materialize, new_path, release
from lacunar.llm.textops import Words
from lacunar.llm.toxicity import fold

P_MIN, MIN_DIVERGENCE = 1e-4, 0.02
MIN_COUNT, DEPTH = 20, 4
BLOCK_BYTES, BUCKET_BYTES = 4 << 20, 8 << 20  # of text in a block, and for each bucket
pack_blocks = partial(shared.pack_blocks, limit=BLOCK_BYTES)
HOT = 1e-3
END = np.uint64(0xE3D0_0000_0000_0001)
_A, _B, _C = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))
FOLDS, HELD = 7, 2
TALLY = -2  # block id of what buckets report to all
LOG_STEPS = 1 << 12  # logarithms are summed in whole steps of so many a nat
LEVELS = 16  # a context's number holds its level
OWN = -1  # bucket of what a block tells itself: where its files lie
ALONE = 256  # bytes from which a plane is compressed by itself
_zip, _unzip = zstandard.ZstdCompressor(level=1), zstandard.ZstdDecompressor()  # one each a worker


def shrink(*arrays: np.ndarray) -> bytes:
    """Arrays of one or two dimensions as one message; `grow` gives them back. Each row of planes is compressed by itself,
    for its bytes are spread as no other's, but small ones together with what tells kinds and sizes."""
    head, small, large = [len(arrays)], [], []
    for a in arrays:
        head += [ord(a.dtype.kind), a.dtype.itemsize, a.ndim, a.shape[0], a.shape[-1]]
        for row in a if a.ndim == 2 else [a]:
            data = np.ascontiguousarray(row).tobytes()
            if len(data) >= ALONE:
                large.append(_zip.compress(data))
                head.append(len(large[-1]))
            else:
                small.append(data)
    head = np.array(head, "<u4")
    first = _zip.compress(b"".join([np.array([len(head)], "<u4").tobytes(), _planes(head).tobytes(), *small]))
    return b"".join([np.array([len(first)], "<u4").tobytes(), first, *large])


def grow(data: bytes) -> list[np.ndarray]:
    end = 4 + int(np.frombuffer(data, "<u4", 1)[0])
    first = _unzip.decompress(data[4:end])
    n = int(np.frombuffer(first, "<u4", 1)[0])
    head = iter(_joined(np.frombuffer(first, np.uint8, 4 * n, 4), "<u4").tolist())
    at, out = 4 + 4 * n, []
    for _ in range(next(head)):
        kind, item, dims, rows, length = (next(head) for _ in range(5))
        parts = []
        for _ in range(rows if dims == 2 else 1):
            if (size := item * length) >= ALONE:
                packed = next(head)
                parts.append(_unzip.decompress(data[end : end + packed]))
                end += packed
            else:
                parts.append(first[at : at + size])
                at += size
        whole = np.frombuffer(parts[0] if len(parts) == 1 else b"".join(parts), f"{chr(kind)}{item}")
        out.append(whole.reshape(rows, length) if dims == 2 else whole)
    return out


def _code(folder: str):
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        """Texts as numbers of the block's words, the most frequent first, the end mark last. Each distinct word's hash once,
        in a file of its own that goes as soon as the buckets have numbered the words."""
        words = Words(batch.column("text"), lower=True)
        index, distinct = words.coded()
        often = np.argsort(-np.bincount(index, minlength=len(distinct)), kind="stable")
        place = np.empty(len(often), np.int64)
        place[often] = np.arange(len(often))
        hashes = np.array([xxhash.xxh3_64_intdigest(w) for w in distinct.to_pylist()], dtype=np.uint64)[often]
        n = batch.num_rows
        docs = words.docs + np.arange(n + 1)
        at = np.full(len(words) + n, len(hashes), np.int64)
        at[np.arange(len(words)) + np.repeat(np.arange(n), np.diff(words.docs))] = place[index]
        own = freeze(batch.select(["doc_id", "held_out"]))
        with blobs(folder) as out:
            hashed = json.dumps(out.add(shrink(np.concatenate([hashes, [END]]))))
        return pa.RecordBatch.from_pydict({"rows": [own], "tokens": [shrink(_count(np.diff(docs)), _count(at))], "distinct": [len(hashes) + 1], "hashed": [hashed]})

    return run


class Tokens:
    """A block's words and end marks in order: `index` into its `distinct` ones, `docs` each row's first token."""

    def __init__(self, payload: bytes):
        block = thaw(payload)
        rows = thaw(block["rows"][0].as_py())
        self.ids, self.held = rows["doc_id"].combine_chunks(), rows["held_out"].combine_chunks()
        self.distinct, self.hashed = block["distinct"][0].as_py(), block["hashed"][0].as_py()
        sizes, self.index = map(_counted, grow(block["tokens"][0].as_py()))
        self.docs = np.concatenate([[0], np.cumsum(sizes)])
        self.train = np.repeat(~self.held.to_numpy(zero_copy_only=False).astype(bool), sizes)
        self.k = np.arange(len(self.index)) - np.repeat(self.docs[:-1], sizes)  # tokens of the text before each

    def hashes(self) -> np.ndarray:
        """Of the distinct words; only until they are numbered."""
        return grow(read_blob(*json.loads(self.hashed)))[0]

    def number(self, numbers: np.ndarray) -> None:
        """Words as the buckets number them, 0 if training hasn't them."""
        self.end, self.word = np.uint64(numbers[-1]), numbers[self.index].astype(np.uint64)

    def before(self) -> np.ndarray:
        """`index` of what precedes each token."""
        out = np.roll(self.index, 1)
        out[self.k == 0] = self.distinct - 1
        return out

    def names(self, depth: int) -> Iterator[np.ndarray]:
        """The contexts of 1, 2, ... words before each token, as hashes; meaningless where the text has fewer."""
        name = np.zeros(len(self.word), np.uint64)
        for d in range(1, depth + 1):
            last = np.full(len(self.word), self.end)
            last[d:] = self.word[:-d]
            last[self.k == d - 1] = self.end
            name = _mix((name * _C) ^ (last * _B))
            yield name


def _planes(x: np.ndarray) -> np.ndarray:
    width = x.dtype.itemsize
    return np.ascontiguousarray(x).view(np.uint8).reshape(-1, width).T.ravel()


def _joined(planes: np.ndarray, kind=np.uint64) -> np.ndarray:
    width = np.dtype(kind).itemsize
    return np.ascontiguousarray(planes.reshape(width, -1).T).view(kind).ravel()


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * _A
    return x ^ (x >> np.uint64(29))


def _bucket(key: np.ndarray, buckets: int) -> np.ndarray:
    return (_mix(key) % np.uint64(buckets)).astype(np.int64)


def _count(x: np.ndarray) -> np.ndarray:
    """A column of counts in as few planes as it needs."""
    width = next(w for w in (1, 2, 3, 4, 8) if x.max(initial=0) < 1 << (8 * w))
    return _planes(x.astype("<u8")).reshape(8, -1)[:width]


def _counted(planes: np.ndarray) -> np.ndarray:
    whole = np.zeros((planes.shape[1], 8), np.uint8)
    whole[:, : len(planes)] = planes.T
    return whole.view("<i8").ravel()


def _order(key: np.ndarray) -> np.ndarray:
    """Positions by key, by 16 bits at a time."""
    out = np.arange(len(key))
    for digit in range(0, int(key.max(initial=0)).bit_length(), 16):
        out = out[np.argsort((key[out] >> np.uint64(digit)).astype(np.uint16), kind="stable")]
    return out


def _back(out: np.ndarray, sizes: list[int]):
    ends = np.cumsum([0, *sizes])
    return [out[a:b] for a, b in zip(ends, ends[1:], strict=False)]


def _ranked(total: np.ndarray, least: float) -> np.ndarray:
    """Ranks from 1 of what occurs `least` times in this bucket, the most frequent first; else 0. With the bucket they
    make a number: see `_number`."""
    out = np.zeros(len(total), np.int64)
    at = np.flatnonzero(total >= least)
    out[at[np.argsort(-total[at], kind="stable")]] = np.arange(1, len(at) + 1)
    return out


def _number(rank: np.ndarray, bucket: int, buckets: int) -> np.ndarray:
    return np.where(rank > 0, (rank - 1) * buckets + bucket + 1, 0)


def _told(total: np.ndarray, rank: np.ndarray) -> list[np.ndarray]:
    """Totals and their ranks of one bucket. Totals fall as ranks rise, so those with a rank are sent as the steps down."""
    ranked = rank > 0
    falling = total[ranked][np.argsort(rank[ranked], kind="stable")]
    return [_count(rank), _count(total[~ranked]), _count(np.abs(np.diff(falling, prepend=0)))]


def _heard(arrays: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(totals, ranks) of the three arrays of `_told`."""
    rank, others, steps = map(_counted, arrays)
    total = np.zeros(len(rank), np.int64)
    total[rank == 0] = others
    at = np.flatnonzero(rank)
    steps[1:] *= -1
    total[at[np.argsort(rank[at], kind="stable")]] = np.cumsum(steps)
    return total, rank


def _ascending(word: np.ndarray, starts: np.ndarray) -> list[np.ndarray]:
    """Words that ascend within runs: the first of each run, then the steps between the others."""
    steps = np.diff(word, prepend=0)
    return [_count(word[starts]), _count(np.delete(steps, starts))]


def _ascended(arrays: list[np.ndarray], runs: np.ndarray) -> np.ndarray:
    """The words of the two arrays of `_ascending`, given the lengths of the runs."""
    first, steps = map(_counted, arrays)
    starts = np.cumsum(runs) - runs
    word, rest = np.zeros(int(runs.sum()), np.int64), np.ones(int(runs.sum()), bool)
    rest[starts] = False
    word[rest] = steps
    word = np.cumsum(word)
    return word + np.repeat(first - word[starts], runs)


def _words(buckets: int, folder: str):
    def run(block: int, payload: bytes, _: dict) -> Iterator[pa.RecordBatch]:
        t = Tokens(payload)
        count = np.bincount(t.index, weights=t.train, minlength=t.distinct).astype(np.int64)
        hashes = t.hashes()
        bucket = _bucket(hashes, buckets)
        with blobs(folder) as own:
            asked = json.dumps(own.add(shrink(_count(bucket)))).encode()
        parts = {b: shrink(_planes(hashes[at]), _count(count[at])) for b, at in split(bucket)}
        yield _send(block, buckets, parts | {OWN: asked})

    return run


def _total():
    def run(bucket: int, blocks: list[int], data: list[bytes]) -> list[tuple[int, int, bytes]]:
        """Totals and ranks of each block's words; to all: how many words occur in training, and how often."""
        if bucket <= OWN:
            return [(block, OWN, d) for block, d in zip(blocks, data, strict=True)]
        got = [grow(d) for d in data]
        keys = [_joined(g[0]) for g in got]
        distinct, back = np.unique(np.concatenate(keys), return_inverse=True)
        total = np.bincount(back, weights=np.concatenate([_counted(g[1]) for g in got]), minlength=len(distinct)).astype(np.int64)
        number, sizes = _ranked(total, 1), [len(k) for k in keys]
        out = [(block, bucket, shrink(*_told(x, i))) for block, x, i in zip(blocks, _back(total[back], sizes), _back(number[back], sizes), strict=True)]
        return [*out, (TALLY, bucket, shrink(np.array([0], np.uint64), np.array([np.count_nonzero(total)], float), np.array([total.sum()], float), np.zeros(1)))]

    return run


def _contexts(near: np.ndarray, hot: np.ndarray, bucket: int, buckets: int) -> np.ndarray:
    """The contexts of a message: those of this bucket, as differences of what their numbers hold but for the bucket, then
    the hot ones, which any bucket may have."""
    place = np.cumsum(_counted(near))
    return np.concatenate([(place // LEVELS * buckets + bucket) * LEVELS + place % LEVELS, _counted(hot)])


def _followed(buckets: int, least: float, last: bool):
    def run(bucket: int, blocks: list[int], data: list[bytes]) -> list[tuple[int, int, bytes]]:
        """Totals of each block's (context, word) and their ranks as contexts, and of its contexts T and whether they
        diverge; to all: T, mass and the sum of c log(c) without the logarithms of the suffix's shares, of hot contexts."""
        if bucket <= OWN:
            return [(block, OWN, d) for block, d in zip(blocks, data, strict=True)]
        got = [grow(d) for d in data]
        names = [_contexts(g[4], g[6], bucket, buckets) for g in got]
        lengths = [_counted(g[3]) for g in got]
        name, name_first, name_back = np.unique(np.concatenate(names), return_index=True, return_inverse=True)
        context = np.repeat(name_back, np.concatenate(lengths))
        keys = (context << 40) | np.concatenate([_ascended(g[0:2], r) for g, r in zip(got, lengths, strict=True)])
        distinct, back = np.unique(keys, return_inverse=True)
        context = distinct >> 40
        total = np.bincount(back, weights=np.concatenate([_counted(g[2]) for g in got]), minlength=len(distinct))
        logs = np.bincount(name_back, weights=np.concatenate([_counted(g[5]) for g in got]), minlength=len(name)) / -LOG_STEPS
        hot = np.concatenate([np.arange(len(x)) >= len(x) - g[6].shape[1] for x, g in zip(names, got, strict=True)])[name_first]
        seen = total > 0
        add = lambda x: np.bincount(context[seen], weights=x, minlength=len(name))
        followers, mass, own = add(None), add(total[seen]), add(total[seen] * np.log(total[seen]))
        with np.errstate(divide="ignore", invalid="ignore"):
            gain = (own - logs) / mass - np.log(mass)
        followers, ok = np.where(hot, 0, followers).astype(np.int64), (gain >= MIN_DIVERGENCE) & ~hot
        if hot.any():
            tally = shrink(name[hot].astype(np.uint64), add(None)[hot].astype(float), mass[hot], (own - logs)[hot])
        number = np.zeros(len(total), np.int64) if last else _ranked(total, least)
        sizes, runs = [int(r.sum()) for r in lengths], [len(x) for x in names]
        parts = (_back(total[back].astype(np.int64), sizes), _back(number[back], sizes), _back(followers[name_back], runs), _back(ok[name_back], runs))
        out = [(block, bucket, shrink(*_told(x, i), _count(f), np.packbits(o))) for block, x, i, f, o in zip(blocks, *parts, strict=True)]
        return [*out, (TALLY, bucket, tally)] if hot.any() else out

    return run


def _closed(bucket: int, blocks: list[int], data: list[bytes]) -> list[tuple[int, int, bytes]]:
    """Whether a longer context of each block's contexts diverges anywhere."""
    if bucket <= OWN:
        return [(block, OWN, d) for block, d in zip(blocks, data, strict=True)]
    got = [grow(d) for d in data]
    names = [_joined(g[0]) for g in got]
    distinct, back = np.unique(np.concatenate(names), return_inverse=True)
    mark = np.zeros(len(distinct), np.uint8)
    np.maximum.at(mark, back, np.concatenate([g[1] for g in got]))
    return [(block, bucket, shrink(m)) for block, m in zip(blocks, _back(mark[back], [len(x) for x in names]), strict=True)]


def _distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(distinct keys, ascending; where one of each is; which of them each key is). Faster than np.unique, whose order is stable."""
    order = np.argsort(keys)
    in_order = keys[order]
    new = np.ones(len(keys), bool)
    np.not_equal(in_order[1:], in_order[:-1], out=new[1:])
    back = np.empty(len(keys), np.int64)
    back[order] = np.cumsum(new) - 1
    return in_order[new], order[new], back


def _by_ranks(*columns: np.ndarray) -> np.ndarray:
    """The order by columns of small whole numbers, the last first, as np.lexsort gives it: by one number where they fit into it."""
    total, shift = np.zeros(len(columns[0]), np.int64), 0
    for c in columns:
        total |= c.astype(np.int64) << shift
        shift += int(c.max(initial=0)).bit_length()
        if shift > 62:
            return np.lexsort(columns)
    return np.argsort(total)


class Plan:
    """What all passes share: sizes, thresholds, the folder of the blocks' files and the hot contexts of the known levels."""

    def __init__(self, folder: str, buckets: int, n: int, v: int, least: float):
        self.folder, self.buckets, self.n, self.v, self.least, self.hot_mass = folder, buckets, n, v, max(1, least), max(1, HOT * n)
        self.hot: list[tuple[np.ndarray, np.ndarray]] = []

    def asked(self, d: int) -> str:
        """The folder of what is needed until the answers of level d are taken."""
        return f"{self.folder}-asked-{d}"


class Level:
    """Order of what a block asks at level d: its (context, word) keys by bucket, hot contexts last, and context number. It
    follows from the levels below and the numbers of the contexts, so the pass that gets the answers finds it again."""

    def __init__(self, known: Known, d: int, numbers: np.ndarray | None = None):
        t, plan = known.t, known.plan
        self.mass, self.at, self.same = known.asks(d)
        *_, name = t.names(d)
        name = name[self.at]
        keys, first, back = _distinct(_mix(name ^ (t.word[self.at] * _A)))
        _, context_first, of = _distinct(name[first])
        if numbers is None:  # of the contexts, in the order of their names
            before = known.contexts(d)
            numbers = before[self.at[first[context_first]]]
        self.numbers, number = numbers, numbers[of]
        hot = self.mass[self.at][first] >= plan.hot_mass
        bucket = np.where(hot, _bucket(keys, plan.buckets), number // LEVELS % plan.buckets)
        order = _by_ranks(known.word_rank()[t.index[self.at][first]], np.unique(numbers, return_inverse=True)[1][of] if len(numbers) else number, hot.astype(np.int64), bucket)
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        self.back, self.first = place[back], self.at[first][order]  # key of each asked token; a token of each key
        number, self.bucket, self.hot = number[order], bucket[order], hot[order]
        self.starts = np.flatnonzero((number != np.roll(number, 1)) | (self.bucket != np.roll(self.bucket, 1)) | (np.arange(len(number)) == 0))  # runs of a context in a bucket
        self.runs = np.diff(np.append(self.starts, len(number)))
        self.run_number, self.run_hot = number[self.starts], self.hot[self.starts]


class Known:
    """What a block knows after some levels: for each token `total`, `followers` (T) and `ok` (the context diverges) of level
    d, all 0 where there is no candidate; level 0 is the empty context. `number`: of the context that ends with the token."""

    def __init__(self, t: Tokens, plan: Plan, answers: dict[int, bytes]):
        self.t, self.plan = t, plan
        self.kept: list[list] = []  # where the levels lie
        self.order: np.ndarray | None = None
        self.rank: np.ndarray | None = None
        none = np.zeros(len(t.index), np.int64)
        if plan.hot:
            self.kept, asked = json.loads(answers[OWN])
            self.words, self.word_numbers = map(_counted, grow(read_blob(*self.kept[0])))
        else:  # answers are totals and numbers of words
            asked = None
            self.words, self.word_numbers = np.zeros(t.distinct, np.int64), np.zeros(t.distinct, np.int64)
            for b, at in split(_counted(*grow(read_blob(*json.loads(answers[OWN]))))):
                self.words[at], rank = _heard(grow(answers[b]))
                self.word_numbers[at] = _number(rank, b, plan.buckets)
        t.number(self.word_numbers)
        self.total, self.followers, self.ok = [self.words[t.index]], [none], [none > 0]
        self.number = self.word_numbers[t.index] * LEVELS
        for place in self.kept[1:]:
            *counts, ok = grow(read_blob(*place))
            total, followers = map(_counted, counts)
            ok = np.unpackbits(ok, count=len(followers)).astype(bool)
            if len(self.total) == 1:
                followers, ok = followers[t.before()], ok[t.before()]
                total[self._by_word()] = total.copy()
            self.total.append(total)
            self.followers.append(followers)
            self.ok.append(ok)
        if asked:
            self._take(answers, *map(_counted, grow(read_blob(*asked))))

    def _by_word(self) -> np.ndarray:
        """The order in which files hold level 1: tokens after the same word side by side, which takes fewer bytes."""
        if self.order is None:
            self.order = _order(self.t.before().astype(np.uint64) * np.uint64(self.t.distinct) + self.t.index.astype(np.uint64))
        return self.order

    def word_rank(self) -> np.ndarray:
        """Place of each distinct word in the order of numbers; words of one number (those that training lacks) by their index."""
        if self.rank is None:
            self.rank = np.empty(len(self.word_numbers), np.int64)
            self.rank[np.argsort(self.word_numbers, kind="stable")] = np.arange(len(self.word_numbers))
        return self.rank

    def mass(self, d: int) -> np.ndarray:
        """How often the context of d words before each token occurs in training."""
        out = np.zeros(len(self.t.index), np.int64)
        if d == 0:
            out[:] = self.plan.n
            return out
        out[1:] = self.total[d - 1][:-1]
        out[self.t.k < d - 1] = 0
        if d == 1:
            out[self.t.k == 0] = self.words[-1]  # the last of a block's distinct words is the end mark
        return out

    def asks(self, d: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(mass, tokens whose context is asked for, tokens whose context is as frequent as its suffix)."""
        mass, suffix = self.mass(d), self.mass(d - 1)
        can = mass >= self.plan.least
        return mass, np.flatnonzero(can & (mass < suffix)), np.flatnonzero(can & (mass == suffix))

    def contexts(self, d: int) -> np.ndarray:
        """The number of the context of d words before each token."""
        out = np.zeros(len(self.t.index), np.int64)
        out[1:] = self.number[:-1]
        if d == 1:
            out[self.t.k == 0] = self.word_numbers[-1] * LEVELS
        return out

    def _take(self, answers: dict[int, bytes], carried: np.ndarray, numbers: np.ndarray) -> None:
        d = len(self.total)
        level = Level(self, d, numbers if d > 1 else None)
        own = [b for b in sorted(answers) if b != OWN]
        got = [grow(answers[b]) for b in own]
        cat = lambda parts, kind: np.concatenate([np.zeros(0, kind), *parts])
        told = [_heard(g[0:3]) for g in got]
        total, followers = cat([x for x, _ in told], np.int64), cat([_counted(g[3]) for g in got], np.int64)
        number = cat([_number(rank, b, self.plan.buckets) for b, (_, rank) in zip(own, told, strict=True)], np.int64)
        ok = cat([np.unpackbits(g[4], count=g[3].shape[1]) for g in got], np.uint8) > 0
        names, sums = self.plan.hot[d - 1]
        hot = np.flatnonzero(level.run_hot)
        if len(hot):
            mine = sums[np.searchsorted(names, level.run_number[hot])]
            followers[hot], ok[hot] = np.abs(mine), mine > 0
        n, at, same = len(self.t.index), level.at, level.same
        new = [np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros(n, bool)]
        for v, x in zip(new, (total[level.back], np.repeat(followers, level.runs)[level.back], np.repeat(ok, level.runs)[level.back]), strict=True):
            v[at] = x
        new[0][same], new[1][same] = self.total[-1][same], self.followers[-1][same]
        for known, v in zip((self.total, self.followers, self.ok), new, strict=True):
            known.append(v)
        self.number = np.zeros(n, np.int64)
        self.number[at] = np.where(number > 0, number * LEVELS + d, 0)[level.back]
        self.number[same] = carried  # it occurs where its suffix does: the number of that names it, too

    def keep(self, out) -> None:
        """Write the levels that no file holds yet. At level 1 the context is a word: what belongs to it is kept once."""
        for d in range(len(self.kept), len(self.total)):
            if d:
                total, followers, ok = self.total[d], self.followers[d], self.ok[d]
                if d == 1:
                    total = total[self._by_word()]
                    followers, ok = np.zeros(self.t.distinct, np.int64), np.zeros(self.t.distinct, bool)
                    followers[self.t.before()], ok[self.t.before()] = self.followers[1], self.ok[1]
                self.kept.append(out.add(shrink(_count(total), _count(followers), np.packbits(ok))))
            else:
                self.kept.append(out.add(shrink(_count(self.words), _count(self.word_numbers))))

    def ask(self, out, own) -> dict[int, bytes]:
        """What is sent for the next level, by bucket. `own` takes what is read only with the answers to it."""
        t, d = self.t, len(self.total)
        level = Level(self, d)
        at = level.at
        train = t.train[at]
        count = np.bincount(level.back, weights=train, minlength=len(level.bucket)).astype(np.int64)
        with np.errstate(divide="ignore"):
            logs = np.log(self.total[d - 1][at] / np.maximum(1, self.mass(d - 1)[at]))
        run = np.repeat(np.arange(len(level.starts)), level.runs)
        logs = np.bincount(run[level.back], weights=np.where(train, logs, 0.0), minlength=len(level.starts))
        logs = np.round(-LOG_STEPS * logs).astype(np.int64)
        run_number, run_hot, run_bucket = level.run_number, level.run_hot, level.bucket[level.starts]
        word = self.word_numbers[t.index[level.first]]
        self.keep(out)
        numbers = level.numbers if d > 1 else level.numbers[:0]  # at level 1 they follow from those of the words
        asked = own.add(shrink(_count(self.number[level.same]), _count(numbers)))
        parts = {}
        cut = np.flatnonzero(np.diff(run_bucket, prepend=-1))
        for i, j in zip(cut.tolist(), [*cut[1:].tolist(), len(level.starts)][: len(cut)], strict=True):
            a, b = level.starts[i], level.starts[j] if j < len(level.starts) else len(word)
            k = j - int(np.count_nonzero(run_hot[i:j]))
            place = run_number[i:k] // LEVELS // self.plan.buckets * LEVELS + run_number[i:k] % LEVELS
            near = np.diff(place, prepend=0)
            parts[int(run_bucket[i])] = shrink(*_ascending(word[a:b], level.starts[i:j] - a), _count(count[a:b]), _count(level.runs[i:j]), _count(near), _count(logs[i:j]), _count(run_number[k:j]))
        return parts | {OWN: json.dumps([self.kept, asked]).encode()}

    def open(self) -> tuple[np.ndarray, np.ndarray, list[tuple[np.ndarray, np.ndarray, np.ndarray]]]:
        """(distinct contexts that don't diverge, whether a longer one here does; by level: positions, their number, and
        positions whose context has what its suffix has, for it occurs where that does and neither diverges)."""
        depth = len(self.total) - 1
        names = list(self.t.names(max(1, depth - 1)))
        longer = np.zeros(len(self.t.index), bool)
        shut = [(f > 0) & ~ok for f, ok in zip(self.followers, self.ok, strict=True)]
        found, marks, places = [], [], []
        for d in range(depth - 1, 0, -1):
            longer |= self.ok[d + 1]
            as_suffix = shut[d] & shut[d - 1] & (self.mass(d) == self.mass(d - 1)) if d > 1 else np.zeros(len(longer), bool)
            at = np.flatnonzero(shut[d] & ~as_suffix)
            found.append(names[d - 1][at])
            marks.append(longer[at])
            places.append((at, np.flatnonzero(as_suffix)))
        distinct, back = np.unique(np.concatenate([np.zeros(0, np.uint64), *found]), return_inverse=True)
        mark = np.zeros(len(distinct), np.uint8)
        mark[back[np.concatenate([np.zeros(0, bool), *marks])]] = 1
        numbers = _back(back, [len(x) for x in found])
        return distinct, mark, [(at, number, same) for (at, same), number in zip(places, numbers, strict=True)][::-1]


def _send(block: int, buckets: int, parts: dict[int, bytes]) -> pa.RecordBatch:
    """What a block tells itself goes to a bucket of its own kind, as many of them as others."""
    return sent(block, {OWN - block % buckets if b == OWN else b: d for b, d in parts.items()})


def _ask(plan: Plan):
    def run(block: int, payload: bytes, answers: dict[int, bytes]) -> Iterator[pa.RecordBatch]:
        with blobs(plan.folder) as out, blobs(plan.asked(len(plan.hot) + 1)) as own:
            yield _send(block, plan.buckets, Known(Tokens(payload), plan, answers).ask(out, own))

    return run


def _ask_closed(plan: Plan):
    def run(block: int, payload: bytes, answers: dict[int, bytes]) -> Iterator[pa.RecordBatch]:
        with blobs(plan.folder) as out:
            known = Known(Tokens(payload), plan, answers)
            known.keep(out)
            name, mark, _ = known.open()
            parts = {b: shrink(_planes(name[at]), mark[at]) for b, at in split(_bucket(name, plan.buckets))}
            yield _send(block, plan.buckets, parts | {OWN: json.dumps([known.kept, None]).encode()})

    return run


def _score(plan: Plan):
    def run(block: int, payload: bytes, answers: dict[int, bytes]) -> Iterator[pa.RecordBatch]:
        t = Tokens(payload)
        known = Known(t, plan, answers)
        name, _, places = known.open()
        closed = np.zeros(len(name), bool)
        for b, at in split(_bucket(name, plan.buckets)):
            closed[at] = grow(answers[b])[0] > 0
        base = (known.total[0] + 1) / (plan.n + plan.v + 1)
        p, below = base.copy(), np.zeros(len(base), bool)
        for d in range(1, len(known.total)):
            use = known.ok[d].copy()
            if d <= len(places):
                at, number, same = places[d - 1]
                use[at] = closed[number]
                use[same] = below[same]
            below = use
            at = np.flatnonzero(use)
            followers = known.followers[d][at]
            p[at] = (known.total[d][at] + followers * p[at]) / (known.mass(d)[at] + followers)
        add = lambda x: np.add.reduceat(x, t.docs[:-1])  # noqa: E731  each row has its end mark
        yield pa.RecordBatch.from_pydict({
            "doc_id": t.ids, "held_out": t.held, "n_tokens": pa.array(np.diff(t.docs)), "n_known": pa.array(add((known.total[0] > 0).astype(np.int64))),
            "train_tokens": pa.array(np.full(len(t.ids), plan.n)), "base_score": pa.array(add(np.log10(base))), "score": pa.array(add(np.log10(p))),
        })

    return run


def _report(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for data in batch.column("data").to_pylist():
            name, *sums = grow(data)
            yield pa.RecordBatch.from_pydict({"name": pa.array(name.view(np.int64)), **{c: pa.array(x.astype(float)) for c, x in zip("abc", sums, strict=True)}})


def _reported(answers: DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """What the buckets tell all, summed by name: a row for each hot context."""
    rows = answers.where(F.col("block_id") == TALLY).select("data").mapInArrow(_report, "name long, a double, b double, c double")
    rows = rows.groupBy("name").agg(*[F.sum(c).alias(c) for c in "abc"]).collect()
    name = np.array([r["name"] for r in rows], np.int64).view(np.uint64)
    order = np.argsort(name)
    return name[order], *(np.array([r[c] for r in rows], float)[order] for c in "abc")


def _hot(answers: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Names of the hot contexts, ascending, and their T, negative if the context doesn't diverge."""
    name, followers, mass, rest = _reported(answers)
    gain = rest / np.maximum(1, mass) - np.log(np.maximum(1, mass))
    return name, np.where(gain >= MIN_DIVERGENCE, followers, -followers).astype(np.int64)


def suffix_tree_scores(docs: DataFrame, min_count: int | None = MIN_COUNT, depth: int = DEPTH) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every document."""
    if not 1 <= depth < LEVELS:
        raise ValueError(f"depth must be 1 to {LEVELS - 1}")
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    docs = docs.withColumn("held_out", F.coalesce(fold(F.col("doc_id"), FOLDS) == HELD, F.lit(False)))
    hashed = new_path(spark, "tree-hashes")
    blocks = pack_blocks(docs, "text", "doc_id", "tree-tokens", _code(hashed))
    n_blocks = blocks.count()
    buckets = max(1, -(-n_blocks * BLOCK_BYTES // BUCKET_BYTES))
    folder = new_path(spark, "tree-files")
    told = new_path(spark, "tree-answers")
    answers = materialize(exchange(over(blocks, n_blocks, _words(buckets, f"{folder}-asked-0"), SENT), _total(), told), "tree-words")
    delete(spark, hashed)
    _, v, n, _ = (float(x.sum()) for x in _reported(answers))
    plan = Plan(folder, buckets, int(n), int(v), P_MIN * n if min_count is None else min_count)

    def gather(run, answer, name: str) -> tuple[DataFrame, str]:
        folder = new_path(spark, "tree-answers")
        found = materialize(exchange(over(blocks, n_blocks, run, SENT, answers.where(F.col("block_id") != TALLY)), answer, folder), name)
        release(answers)
        delete(spark, told)
        return found, folder

    for d in range(1, depth + 1):
        answers, told = gather(_ask(plan), _followed(buckets, plan.least, d == depth), f"tree-level-{d}")
        plan.hot.append(_hot(answers))
        delete(spark, plan.asked(d - 1))
    answers, told = gather(_ask_closed(plan), _closed, "tree-closed")
    delete(spark, plan.asked(depth))
    out = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return over(blocks, n_blocks, _score(plan), out, answers)
