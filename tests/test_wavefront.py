"""Components of gaps that are filled tile by tile have the values of a plain scan of the whole image."""

import numpy as np
import pytest

from lacunar.config import A2, Limits
from lacunar.functions import flags as fl
from lacunar.operators import fill_a2, kernels, wavefront

N = np.nan
OPEN = Limits(None, None, absolute_zero=-50.0)


def plain_pass(value, mean, gap, ratio, way):
    """One pass as nested loops over the image: the scan as it is defined."""
    h, w = value.shape
    zero = OPEN.absolute_zero
    d = (value - zero) / (mean - zero) if ratio else value - mean
    if ratio:
        d = np.clip(d, 1 / 3.0, 3.0)
    out = np.full(value.shape, N)
    axis, outer, inner = way
    xs, ys = range(w), range(h)
    turn = lambda r, by: r if by > 0 else reversed(r)
    cells = [(y, x) for x in turn(xs, outer) for y in turn(ys, inner)] if axis == "x" else [(y, x) for y in turn(ys, outer) for x in turn(xs, inner)]
    around = sorted(((dx, dy) for dx in (-1, 0, 1) for dy in (-1, 0, 1) if dx or dy), key=lambda o: (o[0] ** 2 + o[1] ** 2, *o))
    for y, x in cells:
        if not gap[y, x]:
            continue
        near = [d[y + dy, x + dx] for dx, dy in around if 0 <= y + dy < h and 0 <= x + dx < w and not np.isnan(d[y + dy, x + dx])]
        if near and (not ratio or sum(near) > 0):
            d[y, x] = sum(near) / len(near)
            out[y, x] = d[y, x] * (mean[y, x] - zero) + zero if ratio else d[y, x] + mean[y, x]
    return out


def image(seed, h=26, w=30):
    rng = np.random.default_rng(seed)
    value = np.round(rng.normal(10, 3, (h, w)), 3)
    flags = np.where(rng.random((h, w)) < 0.45, fl.FAILURE, 0)
    flags[3:, 4 : w - 4] = np.where(rng.random((h - 3, w - 8)) < 0.93, fl.FAILURE, 0)
    flags[rng.random((h, w)) < 0.04] = fl.OCEAN
    value[flags != 0] = N
    mean = np.round(rng.normal(9, 1, (h, w)), 3)
    mean[rng.random((h, w)) < 0.03] = N
    return value, mean, flags, np.where(rng.random((h, w)) < 0.3, np.round(rng.random((h, w)) * 5, 2), N)


def frame(spark, images):
    null = lambda v: None if np.isnan(v) else float(v)
    rows = [(t, y, x, null(v[y, x]), null(m[y, x]), int(f[y, x]), null(d[y, x])) for t, (v, m, f, d) in images.items() for y in range(v.shape[0]) for x in range(v.shape[1])]
    return spark.createDataFrame(rows, "year int, y int, x int, value double, mean double, flags short, dist double")


@pytest.mark.parametrize(("config", "large", "tile"), [(A2(), 0, 8), (A2(), 60, 11), (A2(ratio=True, max_ratio=3.0), 0, 16)])
def test_same_as_a_plain_scan(spark, monkeypatch, config, large, tile):
    monkeypatch.setattr(fill_a2, "LARGE", large)
    images = {2000: image(1), 2003: image(2, 14, 17)}
    got = {}
    for r in fill_a2.pass_values(frame(spark, images), config, OPEN, tile=16, wave_tile=tile).collect():
        got[r["year"], r["pass"], r["y"], r["x"]] = (r["pass_value"], r["pass_dist"])
    for t, (v, m, f, d) in images.items():
        values, far, gap = kernels.fill_a2(v, m, f, d, config, OPEN)
        want = {(t, p, y, x): (values[p, y, x], far[p, y, x]) for p in range(8) for y, x in zip(*np.nonzero(gap & ~np.isnan(values[p])), strict=True)}
        assert {k: g for k, g in got.items() if k[0] == t} == want  # to the last bit
        ok = (f & fl.OCEAN) == 0
        for p, way in enumerate(kernels.PASSES):
            plain = plain_pass(np.where(ok, v, N), np.where(ok, m, N), gap, config.ratio, way)
            assert (np.isnan(plain) == np.isnan(np.where(gap, values[p], N))).all() and np.allclose(plain[gap], values[p][gap], equal_nan=True)


def test_no_tile_waits_for_a_later_one():
    """Every neighbour that comes before a cell in a scan lies in its tile or in one of an earlier diagonal."""
    tile = 4
    for axis, outer, inner in kernels.PASSES:
        k = wavefront.tiling((axis, outer, inner))
        sign = wavefront.TILINGS[k][1]

        def turn(o, i, sign=sign, inner=inner):
            return inner * ((i + sign * o) // tile + sign * (o // tile))

        for o in range(12):
            for i in range(12):
                for do, di in ((-1, -1), (-1, 0), (-1, 1), (0, -1)):
                    assert 0 <= turn(o, i) - turn(o + outer * do, i + inner * di) <= 2


def test_a_gap_without_a_value_around(spark, monkeypatch):
    monkeypatch.setattr(fill_a2, "LARGE", 0)
    v, m, f = np.full((6, 6), N), np.full((6, 6), 1.0), np.full((6, 6), fl.FAILURE)
    assert fill_a2.pass_values(frame(spark, {1: (v, m, f, v)}), A2(), OPEN, tile=4, wave_tile=4).count() == 0


def test_winding_gap_over_many_tiles(spark, monkeypatch):
    """A gap one cell wide that turns often: rounds follow it through tiles and back."""
    monkeypatch.setattr(fill_a2, "LARGE", 10)
    f = np.zeros((17, 17), int)
    f[1::4, 1:16] = fl.FAILURE
    for k, y in enumerate(range(1, 13, 4)):
        f[y : y + 5, 15 if k % 2 == 0 else 1] = fl.FAILURE
    v = np.where(f == 0, np.arange(17 * 17).reshape(17, 17) % 13 * 1.0, N)
    m, d = np.zeros((17, 17)), np.full((17, 17), N)
    values, _, gap = kernels.fill_a2(v, m, f, d, A2(), OPEN)
    got = {(r["pass"], r["y"], r["x"]): r["pass_value"] for r in fill_a2.pass_values(frame(spark, {1: (v, m, f, d)}), A2(), OPEN, tile=8, wave_tile=4).collect()}
    assert got == {(p, y, x): values[p, y, x] for p in range(8) for y, x in zip(*np.nonzero(gap & ~np.isnan(values[p])), strict=True)}
