"""Toxicity by FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

A text's features are the distinct hashes of its words and their stems (the first STEMS bytes of a longer word, so that
other forms of a word are known, too), of its word pairs and of its pairs with one word between (letters and digits, A-Z
lowered); each counts once, so a long text is not paid for its length, but that one which occurs LEVELS times or more is a
further feature for each level: what clean texts have once, toxic ones repeat. Rates are kept per coordinate and L1 leaves few weights other than zero: a few KB that go to every task, at most MAX_WEIGHTS of them by
the size of the training sample. Labels are learned from about `train_rows` labelled documents, chosen by a hash of
their id; every text is scored, whole.

Defined cases: a null or empty text has no features, so its score is that of the bias. A label that is null is
unknown; of several labels of a document the largest holds. Without a label of either kind every score is the share
of toxic ones. Only doc_id and text are read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lacunar.llm.textops import IS_ALNUM, Words, slices, trim

TRAIN_ROWS = 12_000
ALPHA, BETA, L1, L2, EPOCHS = 2.0, 1.0, 20.0, 0.1, 6
TOXIC_WEIGHT = 6.0  # of an example with label 1, as they are few
THRESHOLD = 0.7
STEMS = (4, 5, 6, 7)  # bytes; a longer word has its first ones as features, too, for its other forms
LEVELS = (2, 3)  # occurrences
LEAST_TEXTS = 2  # of the sample, that a feature occurs in
_LEVEL = np.array([0x5BD1E995, 0x27D4EB2F], np.uint32)  # what tells the features of each level from the plain ones
_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xFF51AFD7ED558CCD], dtype=np.uint64)


def features(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(row, 32-bit feature) of every word, stem, pair and skip pair, repeats included."""
    words = Words(col, IS_ALNUM, lower=True)
    index, distinct = words.coded()
    distinct = distinct.to_pylist()
    hashed = lambda texts, seed: np.array([xxhash.xxh64_intdigest(w, seed) for w in texts], dtype=np.uint64)[index] if len(index) else np.zeros(0, np.uint64)
    h = hashed(distinct, 1)
    row = np.repeat(np.arange(len(col), dtype=np.int64), np.diff(words.docs))
    rows, found = [row], [h]
    for stem in STEMS:
        long = np.diff(words.at) > stem
        rows.append(row[long])
        found.append(hashed([w[:stem] for w in distinct], stem + 1)[long])
    for gap, a, b in ((1, _ODD[0], _ODD[1]), (2, _ODD[2], _ODD[3])):
        same = row[:-gap] == row[gap:]
        rows.append(row[:-gap][same])
        found.append(((h[:-gap] * a) ^ (h[gap:] * b))[same] + np.uint64(gap))
    x = np.concatenate(found)
    x ^= x >> np.uint64(29)
    return np.concatenate(rows), ((x * _ODD[4]) >> np.uint64(32)).astype(np.uint32)


def once(row: np.ndarray, f: np.ndarray, rows: int) -> list[np.ndarray]:
    """Distinct features of each row, ascending, those of the levels among them."""
    pairs, count = np.unique((row.astype(np.uint64) << np.uint64(32)) | f, return_counts=True)
    more = [pairs[count >= level] ^ np.uint64(mark) for level, mark in zip(LEVELS, _LEVEL, strict=True)]
    pairs = np.sort(np.concatenate([pairs, *more]))
    at = np.searchsorted(pairs >> np.uint64(32), np.arange(rows + 1))
    low = (pairs & np.uint64(0xFFFFFFFF)).astype(np.uint32)
    return [np.unique(low[a:b]) for a, b in zip(at, at[1:], strict=False)]


def train(examples: list[np.ndarray], labels: np.ndarray, least_texts: int = 1) -> tuple[np.ndarray, np.ndarray, float]:
    """(features with a weight, ascending; weights; bias).

    Features of fewer than `least_texts` texts are left out: those of one text, most of all, only name it.
    """
    share = (labels.sum() + 0.5) / (len(labels) + 1)
    start = math.log(share / (1 - share))
    none = np.zeros(0, np.uint32), np.zeros(0), start
    if not len(labels) or labels.min() == labels.max():
        return none
    names, counts = np.unique(np.concatenate(examples), return_counts=True)
    names = names[counts >= least_texts]
    if not len(names):
        return none
    ids = []
    for e in examples:
        at = np.minimum(np.searchsorted(names, e), len(names) - 1)
        ids.append(at[names[at] == e])
    z, n = np.zeros(len(names)), np.zeros(len(names))
    z0, n0 = 0.0, 0.0

    def weights(i) -> np.ndarray:
        w = -(z[i] - np.sign(z[i]) * L1) / ((BETA + np.sqrt(n[i])) / ALPHA + L2)
        return np.where(np.abs(z[i]) > L1, w, 0.0)

    bias = start
    for epoch in range(EPOCHS):
        for k in np.random.default_rng(epoch).permutation(len(ids)):
            i = ids[k]
            w = weights(i)
            p = 1 / (1 + math.exp(-max(-30.0, min(30.0, float(w.sum()) + bias))))
            g = (p - float(labels[k])) * (TOXIC_WEIGHT if labels[k] else 1.0)
            root = np.sqrt(n[i])
            z[i] += g - (np.sqrt(n[i] + g * g) - root) / ALPHA * w
            n[i] += g * g
            z0 += g - (math.sqrt(n0 + g * g) - math.sqrt(n0)) / ALPHA * (bias - start)
            n0 += g * g
            bias = start - z0 / ((BETA + math.sqrt(n0)) / ALPHA)
    w = weights(np.arange(len(names)))
    keep = w != 0
    return names[keep], w[keep], bias


def pieces_of(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Runs of whole rows of about a MB of text: their features take some 60 times as much."""
    yield from slices(batch, "text", 1 << 20)


def _examples(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in pieces_of(batch):
            row, f = features(part.column("text"))
            yield pa.RecordBatch.from_pydict({"doc_id": part.column("doc_id"), "toxic": part.column("toxic"), "features": [x.tobytes() for x in once(row, f, len(part))]})
            del row, f
            trim()
    trim()


def _fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    examples, labels = [], []
    for batch in batches:
        examples += [np.frombuffer(b, np.uint32) for b in batch.column("features").to_pylist()]
        labels += batch.column("toxic").to_pylist()
    names, weights, bias = train(examples, np.array(labels, dtype=np.int64), LEAST_TEXTS)
    del examples
    trim()
    yield pa.RecordBatch.from_pydict({"names": [names.tobytes()], "weights": [weights.tobytes()], "bias": pa.array([bias], pa.float64())})


class Model:
    """Sparse weights with a bit table in front, so most features are passed over without a search. `base`: the plain features
    that have a weight themselves or at a level; `each`: their weights, plain and by level."""

    def __init__(self, names: np.ndarray, weights: np.ndarray, bias: float):
        self.names, self.weights, self.bias = names, weights, bias
        self.base = np.unique(np.concatenate([names, *[names ^ m for m in _LEVEL]]))
        self.each = np.zeros((1 + len(LEVELS), len(self.base)))
        for own, mark in zip(self.each, (np.uint32(0), *_LEVEL), strict=True):
            at = np.minimum(np.searchsorted(names, self.base ^ mark), max(0, len(names) - 1))
            hit = names[at] == self.base ^ mark if len(names) else np.zeros(len(self.base), bool)
            own[hit] = weights[at[hit]]
        self.maybe = np.zeros(1 << 16, bool)
        self.maybe[self.base >> np.uint32(16)] = True

    def scores(self, col: pa.Array) -> np.ndarray:
        total = np.full(len(col), self.bias)
        row, f = features(col)
        near = np.flatnonzero(self.maybe[f >> np.uint32(16)]) if len(self.base) else np.zeros(0, np.int64)
        if len(near):
            row, f = row[near], f[near]
            at = np.minimum(np.searchsorted(self.base, f), len(self.base) - 1)
            hit = self.base[at] == f
            pairs, count = np.unique(row[hit] * len(self.base) + at[hit], return_counts=True)
            for own, level in zip(self.each, (1, *LEVELS), strict=True):
                often = pairs[count >= level]
                np.add.at(total, often // len(self.base), own[often % len(self.base)])
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def fold(doc_id: Column, parts: int) -> Column:
    """crc32 of the id's decimal text, modulo parts."""
    return F.pmod(F.crc32(doc_id.cast("string")), F.lit(parts))


def fit(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS) -> Model:
    """Learn from about train_rows labelled documents outside the held-out fold."""
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")).where("doc_id IS NOT NULL AND toxic IS NOT NULL")
    known = known.where(fold(F.col("doc_id"), 3) != 1).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    n = known.count()
    share = min(1.0, train_rows / max(1, n))
    known = known.where(F.pmod(F.xxhash64("doc_id", F.lit("toxicity")), F.lit(1 << 30)) < int(share * (1 << 30)))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    found = texts.join(F.broadcast(known), "doc_id")  # the sample's ids, about train_rows of them
    examples = found.mapInArrow(_examples, "doc_id long, toxic int, features binary")
    one = examples.repartition(1).sortWithinPartitions(F.xxhash64("doc_id"), "features").mapInArrow(_fit, "names binary, weights binary, bias double").first()
    if one is None:
        return Model(*train([], np.zeros(0, np.int64)))
    return Model(np.frombuffer(one["names"], np.uint32), np.frombuffer(one["weights"], np.float64), one["bias"])


def _score(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces_of(batch):
                found = pa.array(model.scores(part.column("text")))
                trim()
                yield pa.RecordBatch.from_pydict({"doc_id": part.column("doc_id"), "held_out": part.column("held_out"), "score": found})

    return run


def score(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score, predicted of every document."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    docs = docs.withColumn("held_out", F.coalesce(fold(F.col("doc_id"), 3) == 1, F.lit(False)))
    scored = docs.mapInArrow(_score(model), "doc_id long, held_out boolean, score double")
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def keep_clean(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of docs that score below the threshold, all columns as they are."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces_of(batch):
                keep = pa.array(model.scores(part.column("text")) < threshold)
                trim()
                yield part.filter(keep)

    return docs.mapInArrow(run, docs.schema)
