"""Hand-worked grids and plain nested loops against the dense kernels."""

import math

import numpy as np
import pytest

from lacunar.config import A1, A2, Despeckle, Limits
from lacunar.functions import flags as fl
from lacunar.operators import kernels
from lacunar.operators.spiral import halo, offsets

N = np.nan
OPEN = Limits(None, None)


def a1(stack, target=0, **how):
    v = np.array(stack, float)
    t = np.zeros(v.shape, bool)
    t[target] = True
    return kernels.fill_a1(v, np.zeros(v.shape, np.int64), A1(**how), OPEN, t)


def test_spiral_order():
    dx, dy, d = offsets(11)
    assert list(zip(dx, dy)) == [(-1, 0), (0, -1), (0, 1), (1, 0), (-1, -1), (-1, 1), (1, -1), (1, 1), (-2, 0), (0, -2), (0, 2)]
    assert halo(8) == 1 and halo(24) == 2 and d[4] == math.sqrt(2)


@pytest.mark.parametrize(("least", "most", "trim", "value", "dist", "flag"), [(2, 12, False, 11.0, 1.207107, 16), (2, 12, True, 11.0, 1.276142, 16), (2, 8, False, 11.0, 1.207107, 48), (9, 12, False, N, N, 2)])
def test_a1_equal_differences(least, most, trim, value, dist, flag):
    now, then = np.full((3, 3), 5.0), np.full((3, 3), 4.0)
    now[1, 1], then[1, 1] = N, 10
    v, f, d, n = a1([now, then], search=8, min_used=least, max_used=most, trim=trim)
    assert v[0, 1, 1] == pytest.approx(value, abs=1e-6, nan_ok=True) and d[0, 1, 1] == pytest.approx(dist, abs=1e-6, nan_ok=True)
    assert f[0, 1, 1] == flag and n[0, 1, 1] == 8


@pytest.mark.parametrize(("search", "least", "most", "trim", "value", "dist"), [(8, 2, 12, False, 9.077737, 1.138071), (8, 2, 12, True, 9.855539, 1.082843), (4, 2, 4, False, 5.0, 1.0)])
def test_a1_three_years(search, least, most, trim, value, dist):
    now = np.array([[1, 2, 3], [4, N, 6], [7, 8, 9]])
    two = np.full((3, 3), 2.0)
    two[1, 1] = 20
    v, f, d, _ = a1([now, np.ones((3, 3)), two], search=search, min_used=least, max_used=most, trim=trim)
    assert v[0, 1, 1] == pytest.approx(value, abs=1e-6) and d[0, 1, 1] == pytest.approx(dist, abs=1e-6) and f[0, 1, 1] == 48


def plain_a1(v, search, least, most, trim, ratio, top, zero):
    """Nested loops over cells, years and neighbours."""
    out = {}
    dx, dy, far = offsets(search)
    years, h, w = v.shape
    for t in range(years):
        for y in range(h):
            for x in range(w):
                if not math.isnan(v[t, y, x]) or np.isnan(v[:, y, x]).all():
                    continue
                rows = []
                for s in range(1, years):
                    for dz in (s, -s):
                        if not 0 <= t + dz < years or math.isnan(v[t + dz, y, x]):
                            continue
                        for a, b, d in zip(dx, dy, far):
                            if len(rows) == most or not (0 <= y + b < h and 0 <= x + a < w):
                                continue
                            p, q = v[t, y + b, x + a] - zero, v[t + dz, y + b, x + a] - zero
                            if math.isnan(p) or math.isnan(q):
                                continue
                            alt = v[t + dz, y, x] - zero
                            if ratio:
                                r = top if q == 0 else min(top, max(1 / top, p / q))
                                rows.append((r, alt * r + zero, 1 / abs(dz) / d, d))
                            else:
                                rows.append((p - q, alt + p - q, 1 / abs(dz) / d, d))
                if len(rows) >= least:
                    used = [*rows]
                    total = [sum(r[1] * r[2] for r in used), sum(r[2] for r in used), sum(r[3] for r in used), len(used)]
                    if trim and len(rows) > 2:
                        for r in (min(rows, key=lambda r: r[0]), max(rows, key=lambda r: r[0])):
                            total = [total[0] - r[1] * r[2], total[1] - r[2], total[2] - r[3], total[3] - 1]
                    out[t, y, x] = (total[0] / total[1], total[2] / total[3])
    return out


@pytest.mark.parametrize("ratio", [False, True])
@pytest.mark.parametrize("trim", [False, True])
def test_a1_random(ratio, trim):
    rng = np.random.default_rng(3)
    v = rng.integers(1, 30, (4, 7, 6)).astype(float)
    v[rng.random(v.shape) < 0.35] = N
    want = plain_a1(v, 24, 3, 9, trim, ratio, 2.0, -5.0 if ratio else 0.0)
    got, flags, dist, n = kernels.fill_a1(v, np.zeros(v.shape, np.int64), A1(24, 3, 9, ratio, 2.0, trim), Limits(None, None, absolute_zero=-5.0), np.ones(v.shape, bool))
    assert {tuple(map(int, k)) for k in np.argwhere((flags & 16) != 0)} == set(want)
    for k, (value, d) in want.items():
        assert got[k] == pytest.approx(value) and dist[k] == pytest.approx(d)
    assert ((flags & 32) == 0)[(flags & 16) == 0].all()


def plain_pass(diff, gap, order):
    d = diff.copy()
    out = np.full(diff.shape, N)
    for y, x in order:
        if gap[y, x]:
            near = [d[b, a] for b in (y - 1, y, y + 1) for a in (x - 1, x, x + 1) if (b, a) != (y, x) and 0 <= b < d.shape[0] and 0 <= a < d.shape[1] and not math.isnan(d[b, a])]
            if near:
                d[y, x] = out[y, x] = sum(near) / len(near)
    return out


def test_a2_passes_are_the_plain_scans():
    rng = np.random.default_rng(5)
    value, mean = rng.random((9, 11)) * 20, rng.random((9, 11)) * 20
    gap = rng.random(value.shape) < 0.5
    value[gap] = N
    flags = np.where(gap, fl.FAILURE, 0)
    flags[0, :3] = fl.OCEAN
    got, _, need = kernels.fill_a2(value, mean, flags, np.full(value.shape, N), A2(), OPEN)
    diff = np.where(flags == fl.OCEAN, N, value - mean)
    for i, (axis, outer, inner) in enumerate(kernels.PASSES):
        outs = range(11 if axis == "x" else 9)[::outer]
        ins = range(9 if axis == "x" else 11)[::inner]
        order = [(b, a) if axis == "x" else (a, b) for a in outs for b in ins]
        np.testing.assert_allclose(got[i], plain_pass(diff, need, order) + mean, rtol=1e-12)


def test_a2_row_and_reach():
    got, _, _ = kernels.fill_a2(np.array([[14, N, N]]), np.full((1, 3), 10.0), np.array([[0, 2, 2]]), np.full((1, 3), N), A2(), OPEN)
    assert np.isnan(got[:, 0, 2]).sum() == 4 and np.nanmax(got[:, 0, 1:]) == np.nanmin(got[:, 0, 1:]) == 14
    value, flags = np.full((8, 7), N), np.full((8, 7), fl.OCEAN)
    value[0, 1], flags[0, 1] = 3.0, 0
    for y, x in [*((y, 1) for y in range(1, 7)), *((6, x) for x in range(1, 6)), *((y, 5) for y in range(1, 7))]:
        flags[y, x] = fl.FAILURE
    got, _, gap = kernels.fill_a2(value, np.zeros((8, 7)), flags, np.full((8, 7), N), A2(), OPEN)
    left = np.argwhere(gap & np.isnan(got).all(axis=0))
    assert left.tolist() == [[1, 5], [2, 5], [3, 5], [4, 5]]


@pytest.mark.parametrize(("near", "kept"), [([12.0] * 8, True), ([10.0] * 8, False), ([12.0] * 3, False)])
def test_despeckle(near, kept):
    v = np.full((1, 3, 3), N)
    spots = [(0, 0), (0, 1), (0, 2), (1, 0), (1, 2), (2, 0), (2, 1), (2, 2)]
    for (y, x), n in zip(spots, near):
        v[0, y, x] = n
    v[0, 1, 1] = 12
    flags = np.zeros(v.shape, np.int64)
    flags[0, 1, 1] = fl.SPECKLE
    out, f = kernels.despeckle(v, flags, v - 10, Despeckle(8, 4, 8, tolerance=0.2))
    assert (out[0, 1, 1] == 12) == kept and f[0, 1, 1] == (0 if kept else fl.SPECKLE)
