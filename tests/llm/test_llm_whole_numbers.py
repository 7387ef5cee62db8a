"""op11 and op12 against brute force, with odd rows."""

import math

import numpy as np
import pytest

from lacunar.llm import negatives, tiling, whitening

SCHEMA = "vec_id long, embedding array<float>, label int, score string, n int, rank string, tile int"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, y, "x", 1, None, 3) for i, v, y in rows], SCHEMA)


def some(n, dim, seed):
    rng = np.random.default_rng(seed)
    x = rng.standard_normal((n, dim)).astype(np.float32) / math.sqrt(dim)
    return [(i, [float(f) for f in v], int(y)) for i, (v, y) in enumerate(zip(x, rng.integers(0, 10, n), strict=True))]


def odd(dim):
    return [(1000, None, 1), (1100, [], 1), (1200, [1.0] * (dim - 1), 1), (1300, [1.0, None] + [0.0] * (dim - 2), 1), (1400, [math.nan] * dim, 2), (1500, [math.inf] * dim, 3), (None, [0.5] * dim, 1)]


def whole(v):
    return [math.floor(64 * c) + 1_000_000 for c in v]


def check_whitened(rows, got, dim, components):
    x = [(i, whole(v)) for i, v, _ in rows if v is not None and len(v) == dim and all(c is not None and math.isfinite(c) for c in v)]
    n = len(x)
    sums = [sum(v[d] for _, v in x) for d in range(dim)]
    centred = np.array([[(n * v[d] - sums[d]) / n for d in range(dim)] for _, v in x])
    cov = centred.T @ centred / n
    e = np.linalg.eigvalsh(cov)[::-1]
    assert len(got) == n * components and {r["n"] for r in got} == {n}
    table = {}
    for r in got:
        table.setdefault(r["component"], []).append(r)
    deviation = sorted((i if i is not None else -1, sum((n * a - b) ** 2 for a, b in zip(v, sums, strict=True))) for i, v in x)
    for j in range(components):
        mine = sorted(table[j + 1], key=lambda r: (r["vec_id"] if r["vec_id"] is not None else -1, r["deviation"]))
        assert [(r["vec_id"] if r["vec_id"] is not None else -1, r["deviation"]) for r in mine] == deviation
        assert mine[0]["explained"] == pytest.approx(e[j] / e.sum(), rel=1e-4)
        assert 0 <= mine[0]["identity_error"] <= 1e-4
    ids = [i for i, _ in x if i is not None and [k for k, _ in x].count(i) == 1]
    w = np.array([[next(r["whitened"] for r in table[j + 1] if r["vec_id"] == i) for j in range(components)] for i in ids])
    values, vectors = np.linalg.eigh(cov)
    want = centred[[k for k, (i, _) in enumerate(x) if i in set(ids)]] @ vectors[:, ::-1][:, :components] / np.sqrt(values[::-1][:components])
    sign = np.sign((w * want).sum(axis=0))
    assert np.allclose(w, want * sign, atol=1e-6)


def test_whitening(spark):
    rows = [*some(300, 12, 1), *odd(12), *some(300, 12, 1)[5:8]]
    rows += [(2000 + i, [2.0] * 12, 1) for i in range(100)]  # copies: a quarter of the rows
    check_whitened(rows, whitening.whiten(frame(spark, rows).repartition(7), k=32).collect(), 12, 12)


def test_whitening_components(spark):
    rows = some(200, 40, 2)
    got = whitening.whiten(frame(spark, rows), k=32).collect()
    check_whitened(rows, got, 40, 32)


def test_whitening_of_dependent_dimensions(spark):
    rows = [(i, [float(i % 7), float(i % 7), 3.0], 1) for i in range(50)]
    got = whitening.whiten(frame(spark, rows), k=32).collect()
    assert len(got) == 150 and all(r["whitened"] is None for r in got if r["component"] > 1)
    assert all(r["whitened"] is not None and r["identity_error"] < 1e-9 for r in got if r["component"] == 1)
    one = whitening.whiten(frame(spark, rows[:1]), k=32).collect()
    assert len(one) == 3 and all(r["whitened"] is None and r["explained"] is None and r["identity_error"] is None and r["deviation"] == 0 for r in one)


def test_whitening_of_large_entries(spark):
    rows = [(0, [3e38, 1.0], 1), (1, [-3e38, 2.0], 1), (2, [1e15, 5.0], 1)]
    got = {(r["vec_id"], r["component"]): r for r in whitening.whiten(frame(spark, rows)).collect()}
    assert len(got) == 6 and all(r["deviation"] == 2**63 - 1 for (i, _), r in got.items() if i < 2)
    x = [2**63 - 1, -(2**63), math.floor(64 * float(np.float32(1e15))) + 10**6]
    z = np.array([(3 * v - sum(x)) / 3 for v in x])
    first = [got[i, 1]["whitened"] for i in range(3)]
    assert np.allclose(np.abs(first), np.abs(z / np.sqrt((z * z).mean())), rtol=1e-9)


@pytest.mark.parametrize("rows", [[], [(0, None, 1)], [(0, [], 1)]])
def test_nothing(spark, rows):
    assert whitening.whiten(frame(spark, rows)).count() == 0 and negatives.hard_negatives(frame(spark, rows)).count() == 0


def mined(rows, every, dim):
    x = [(i, np.array([math.floor(256 * c) for c in v], object), y) for i, v, y in rows if i is not None and y is not None and v is not None and len(v) == dim and all(c is not None and math.isfinite(c) for c in v)]
    out = []
    for a, q, label in x:
        if a % every:
            continue
        scored = sorted(((-int(v @ q), i, y) for i, v, y in x if i != a), key=lambda r: r[:2])
        for s, p, _ in [r for r in scored if r[2] == label][:5]:
            near = [r for r in scored if r[2] != label and 80 * -s <= 100 * -r[0] <= 100 * -s][:5]
            out += [(a, p, k + 1, i, -s, -t) for k, (t, i, _) in enumerate(near)]
    return sorted(out)


def test_negatives(spark):
    rows = [*some(500, 8, 3), *odd(8), (1700, [0.1] * 8, None), *some(500, 8, 3)[5:8], *some(500, 8, 3)[100:101]]
    got = sorted(map(tuple, negatives.hard_negatives(frame(spark, rows), every=10).collect()))
    assert got == mined(rows, 10, 8) and len(got) > 500


def test_negatives_of_many_copies(spark, monkeypatch):
    """A third of the rows are one vector of another label; tiles, shards, groups and digits are many."""
    for name, value in (("SHARD", 32), ("TILE", 8), ("SHARDS_PER_GROUP", 1)):
        monkeypatch.setattr(tiling, name, value)
    monkeypatch.setattr(negatives, "FEW", 2)
    rows = some(300, 8, 4)
    rows += [(5000 + i, rows[0][1], rows[0][2] + 1) for i in range(150)]
    got = sorted(map(tuple, negatives.hard_negatives(frame(spark, rows).repartition(6), every=10).collect()))
    assert got == mined(rows, 10, 8) and len(got) > 100


def test_windows_by_digits():
    rng = np.random.default_rng(5)
    scores = rng.integers(70_000, 100_001, 4000)
    state, left = negatives.opened([np.array([0]), np.array([7]), np.array([100_000]), np.array([0])])
    passes = 0
    while left:
        low, high = state[4], state[5]
        s = scores[(scores >= low[0]) & (scores <= high[0])]
        keys, counts = np.unique((high[0] - s) >> negatives.shift_of(low, high)[0], return_counts=True)
        state, left = negatives.refined([keys, counts, *state])
        passes += 1
    inside = np.sort(scores[(scores >= 80_000)])[::-1]
    assert 1 <= passes <= 2 and state[7][0] <= inside[4] and (inside >= state[7][0]).sum() <= negatives.FEW + 5


def test_beyond_64_bits(spark):
    rows = [(0, [3e20, 1.0], 1), (1, [2e20, -7.0], 1), (2, [3e20, 5.0], 2), (3, [1e-3, 0.0], 2)]
    got = [tuple(r) for r in negatives.hard_negatives(frame(spark, rows)).collect()]
    assert got == [(0, 1, 1, 2, 2**63 - 1, 2**63 - 1)]
