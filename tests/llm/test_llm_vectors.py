"""op1 and op10 against brute force, with odd vectors."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from lacunar.llm import ann, tiling, topk

SCHEMA = "vec_id long, embedding array<float>, score string, grp int, uid string"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, "x", 1, None) for i, v in rows], SCHEMA)


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(2)
    x = rng.standard_normal((300, 8)).astype(np.float32)
    x[40:60] = x[40]  # ties
    out = [(int(i), [float(f) for f in v]) for i, v in enumerate(x)]
    odd = [None, [], [1.0] * 7, [1.0, None] + [0.0] * 6, [math.nan] * 8, [math.inf] * 8]
    return [*out, *[(1000 + 100 * i, v) for i, v in enumerate(odd)], (1600, [0.0] * 8), (None, [1.0] * 8), out[5], out[20], out[100]]


def good(rows, zero):
    return {i: np.array(v, float) for i, v in rows if i is not None and v is not None and len(v) == 8 and all(c is not None and math.isfinite(c) for c in v) and (zero or any(v))}


def brute(vectors, every, k, kind):
    out = []
    for q in sorted(i for i in vectors if i % every == 0):
        score = {i: kind(vectors[q], v) for i, v in vectors.items() if i != q}
        best = sorted(score, key=lambda i: (-score[i], i))[:k]
        out += [(q, r + 1, i, score[i]) for r, i in enumerate(best)]
    return out


def test_exact(spark, rows):
    got = sorted(map(tuple, topk.exact_top_k(frame(spark, rows), k=10, every=10).collect()))
    assert got == brute(good(rows, True), 10, 10, lambda a, b: int(np.floor(a * 1024) @ np.floor(b * 1024)))


def test_exact_beyond_floats(spark):
    rows = [(0, [3e20, 1.0]), (1, [2e20, -7.0]), (2, [3e10, 5.0]), (100, [1.0, 0.0])]
    got = {(r["query_id"], r["vec_id"]): r["score"] for r in topk.exact_top_k(frame(spark, rows)).collect()}
    f = lambda x: math.floor(1024 * float(np.float32(x)))
    assert got[100, 2] == f(3e10) * 1024 and got[0, 1] == 2**63 - 1 and got[0, 2] == 2**63 - 1


def test_exact_tiles_and_shards(spark, rows, monkeypatch):
    monkeypatch.setattr(tiling, "SHARD", 16)
    monkeypatch.setattr(tiling, "TILE", 4)
    monkeypatch.setattr(tiling, "SHARDS_PER_GROUP", 1)
    got = sorted(map(tuple, topk.exact_top_k(frame(spark, rows), k=5, every=10).collect()))
    assert got == brute(good(rows, True), 10, 5, lambda a, b: int(np.floor(a * 1024) @ np.floor(b * 1024)))


def test_exact_all_ids_are_queries(spark, monkeypatch):
    """Tiles follow the number of queries, not that of rows over `every`."""
    monkeypatch.setattr(tiling, "TILE", 8)
    rng = np.random.default_rng(8)
    rows = [(100 * i, [float(f) for f in v]) for i, v in enumerate(rng.standard_normal((120, 8)).astype(np.float32))]
    got = sorted(map(tuple, topk.exact_top_k(frame(spark, rows), k=3, every=100).collect()))
    assert got == brute(good(rows, True), 100, 3, lambda a, b: int(np.floor(a * 1024) @ np.floor(b * 1024)))


def test_scan_recall(spark, rows):
    got = sorted(map(tuple, ann.adaptive_scan(frame(spark, rows), k=20, every=20).collect()))
    want = brute(good(rows, False), 20, 20, lambda a, b: float((a * b).sum()))
    assert len(got) == len(want)
    hit = {(q, v) for q, _, v, _ in got} & {(q, v) for q, _, v, _ in want}
    assert len(hit) >= 0.9 * len(want)
    vectors = good(rows, False)
    assert all(s == pytest.approx(float(vectors[q] @ vectors[v]), abs=1e-12) for q, _, v, s in got)


def test_scan_with_repeated_rows(spark):
    """Many copies of a row, the query's own among them, shut out no other candidate."""
    rng = np.random.default_rng(6)
    x = rng.standard_normal((200, 8)).astype(np.float32)
    rows = [(i, [float(f) for f in v]) for i, v in enumerate(x)]
    rows += [r for r in rows if r[0] % 10 == 0] * 30
    got = sorted(map(tuple, ann.adaptive_scan(frame(spark, rows), k=20, every=20).collect()))
    want = brute(good(rows, False), 20, 20, lambda a, b: float((a * b).sum()))
    assert len(got) == len(want) and len({(q, v) for q, _, v, _ in got} & {(q, v) for q, _, v, _ in want}) >= 0.95 * len(want)


def test_scan_probes_what_it_needs(monkeypatch):
    """In clusters a few lists are probed; a codebook of two levels holds every row once."""
    monkeypatch.setattr(ann, "COARSE", 16)
    monkeypatch.setattr(ann, "FIRST_ROWS", 200)
    rng = np.random.default_rng(7)
    x = rng.standard_normal((40, 32))[rng.integers(0, 40, 4000)] + 0.1 * rng.standard_normal((4000, 32))
    space = ann.Space(x[:1500], np.arange(1500), float((x * x).sum(1).max()), len(x), 20)
    assert len(space.fine) > 1 and space.lists == len(space.coarse) * len(space.fine)
    own, far = space.own(space.place(x))
    space.size = np.bincount(own, minlength=space.lists).astype(float)
    space.spread = np.bincount(own, weights=far, minlength=space.lists) / np.maximum(1, space.size)
    q = np.arange(0, 4000, 100)
    points = space.place(x[q], True)
    score = x[q] @ x.T
    score[np.arange(len(q)), q] = -np.inf
    top = np.argsort(-score, axis=1)[:, :20]
    first = np.zeros((len(q), space.lists), bool)
    first[space.asked(points, None)] = True
    inside = np.where(first[:, own], score, -np.inf)
    kth = -np.partition(-inside, 19, axis=1)[:, 19]
    bound = 2 - 2 * kth / (np.sqrt((x[q] ** 2).sum(1)) * math.sqrt(space.most))
    later = np.zeros_like(first)
    later[space.asked(points, bound)] = True
    assert not (first & later).any()
    probed = (first | later)[np.arange(len(q))[:, None], own[top]]
    assert probed.mean() > 0.9 and ((first | later) @ space.size).mean() < 0.5 * len(x)


def test_scan_sends_no_vector_with_a_list(spark, monkeypatch):
    """What queries take grows with their number, not with that of the lists they probe; lists are cut into shards."""
    monkeypatch.setattr(ann, "FIRST_ROWS", 200)
    monkeypatch.setattr(ann, "SHARD", 300)
    rng = np.random.default_rng(9)
    x = rng.standard_normal((3000, 64)).astype(np.float32)
    x[500:1200] = x[500]  # a list longer than a shard
    sent, write = [], ann.materialize

    def materialize(df, name):
        out = write(df, name)
        if name == "ann-queries":
            sent.extend(v or 0 for v in out.select(*[F.sum(F.length(c)) for c, kind in out.dtypes if kind == "binary"]).first())
        return out

    monkeypatch.setattr(ann, "materialize", materialize)
    rows = frame(spark, [(i, [float(f) for f in v]) for i, v in enumerate(x)])
    got = [tuple(r) for r in ann.adaptive_scan(rows, k=5, every=3).select("query_id", "vec_id", "score").collect()]
    assert 0 < sum(sent) < 1000 * 64 * 8
    score = x[::3].astype(float) @ x.T.astype(float)
    score[np.arange(1000), np.arange(0, 3000, 3)] = -np.inf
    least = -np.partition(-score, 4, axis=1)[:, 4]  # ties count
    assert len(got) == 5000 and sum(s >= least[q // 3] - 1e-9 for q, _, s in got) >= 4500


def test_scan_with_unequal_lengths(spark):
    rng = np.random.default_rng(4)
    x = rng.standard_normal((400, 8)) * rng.uniform(0.1, 10, (400, 1))
    rows = [(i, [float(f) for f in v]) for i, v in enumerate(x.astype(np.float32))]
    got = {(r["query_id"], r["vec_id"]) for r in ann.adaptive_scan(frame(spark, rows), k=10, every=20, train_rows=200).collect()}
    want = {(q, v) for q, _, v, _ in brute(good(rows, False), 20, 10, lambda a, b: float((a * b).sum()))}
    assert len(got & want) >= 0.9 * len(want)


@pytest.mark.parametrize("rows", [[], [(0, None)], [(0, [1.0, 2.0])]])
def test_too_few(spark, rows):
    assert ann.adaptive_scan(frame(spark, rows)).count() == 0 and topk.exact_top_k(frame(spark, rows)).count() == 0


def test_fewer_than_k(spark):
    rows = [(0, [1.0, 0.0]), (1, [0.5, 0.5]), (2, [0.0, 1.0])]
    assert [(r["rank"], r["vec_id"]) for r in ann.adaptive_scan(frame(spark, rows)).orderBy("rank").collect()] == [(1, 1), (2, 2)]
