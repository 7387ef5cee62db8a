"""Dense numpy kernels: one tile of the despeckle and A1 search, one component of the A2 smear."""

from __future__ import annotations

import numpy as np

from lacunar.config import A1, A2, Despeckle, Limits
from lacunar.functions import flags as fl
from lacunar.operators.spiral import offsets


def shifted(a: np.ndarray, dy: int, dx: int) -> np.ndarray:
    """a[..., y + dy, x + dx], NaN outside."""
    out = np.full_like(a, np.nan)
    h, w = a.shape[-2:]
    y0, y1, x0, x1 = max(0, -dy), min(h, h - dy), max(0, -dx), min(w, w - dx)
    if y0 < y1 and x0 < x1:
        out[..., y0:y1, x0:x1] = a[..., y0 + dy : y1 + dy, x0 + dx : x1 + dx]
    return out


CHUNK, BATCH = 1024, 64  # cells and offsets that are looked at together; offsets of later batches are more


def batches(n: int) -> list[slice]:
    """Runs of a search's offsets, each twice as long as the one before up to 4 * BATCH: most cells end in the first ones."""
    out, at, wide = [], 0, BATCH
    while at < n:
        out.append(slice(at, min(n, at + wide)))
        at, wide = out[-1].stop, min(2 * wide, 4 * BATCH)
    return out


class Around:
    """Images with a rim of NaN as wide as a search, so that what lies around a cell is flat places without a test of the edges."""

    def __init__(self, shape: tuple[int, int], search: int):
        self.dx, self.dy, self.far = offsets(search)
        self.rim = int(max(np.abs(self.dx).max(initial=0), np.abs(self.dy).max(initial=0)))
        self.h, self.w = shape
        self.wide = self.w + 2 * self.rim
        self.step = self.dy * self.wide + self.dx
        self.batches = batches(search)

    def place(self, y: np.ndarray, x: np.ndarray) -> np.ndarray:
        return (y + self.rim) * self.wide + x + self.rim

    def padded(self, image: np.ndarray) -> np.ndarray:
        out = np.full((self.h + 2 * self.rim, self.wide), np.nan)
        out[self.rim : self.rim + self.h, self.rim : self.rim + self.w] = image
        return out.ravel()

    def any_near(self, image: np.ndarray, y: np.ndarray, x: np.ndarray) -> np.ndarray:
        """Which cells have a value within the square that the search lies in: four places of a summed-area table."""
        total = np.zeros((self.h + 1, self.w + 1), np.int64)
        np.cumsum(np.cumsum(~np.isnan(image), axis=0, dtype=np.int64), axis=1, out=total[1:, 1:])
        y0, y1, x0, x1 = np.maximum(y - self.rim, 0), np.minimum(y + self.rim + 1, self.h), np.maximum(x - self.rim, 0), np.minimum(x + self.rim + 1, self.w)
        return total[y1, x1] - total[y0, x1] - total[y1, x0] + total[y0, x0] > 0


def _first(got: np.ndarray, n: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """(which of `got` are values, how many in a row); what is beyond the first `most` of a row, n of which it has already,
    becomes NaN."""
    ok = got == got
    many = ok.sum(axis=1)
    over = np.flatnonzero(n + many > most)
    if len(over):
        ok[over] &= np.cumsum(ok[over], axis=1) <= (most - n[over])[:, None]
        many[over] = most - n[over]
        part = got[over]
        part[~ok[over]] = np.nan
        got[over] = part
    return ok, many


def _zeroed(got: np.ndarray) -> np.ndarray:
    """NaN as 0: several times as fast as a choice by a mask that follows no pattern."""
    return np.fmax(got, 0.0) + np.fmin(got, 0.0)


def despeckle(value: np.ndarray, flags: np.ndarray, z: np.ndarray, config: Despeckle) -> tuple[np.ndarray, np.ndarray]:
    """(value, flags) of a classified stack (years, y, x) after the speckle test."""
    value, flags = value.copy(), flags.copy()
    near = Around(z.shape[1:], config.search)
    for t in range(len(z)):
        y, x = np.nonzero(flags[t] & fl.SPECKLE)
        if not len(y):
            continue
        image, spot = near.padded(z[t]), near.place(y, x)
        n, total = np.zeros(len(y), np.int64), np.zeros(len(y))
        for a in range(0, len(y), CHUNK):
            rows = np.arange(a, min(len(y), a + CHUNK))
            for part in near.batches:
                got = image.take(spot[rows][:, None] + near.step[None, part])
                n[rows] += _first(got, n[rows], config.max_used)[1]
                total[rows] += _zeroed(got).sum(axis=1)
                rows = rows[n[rows] < config.max_used]
                if not len(rows):
                    break
        with np.errstate(invalid="ignore", divide="ignore"):
            clear = (n >= config.min_used) & (np.abs(total / n - z[t, y, x]) < config.tolerance)
        flags[t, y[clear], x[clear]] &= ~fl.SPECKLE & 0xFF
        value[t, y[~clear], x[~clear]] = np.nan
    return value, flags


class Pairs:
    """What the pairs of one year's gaps add up to: their number, the sums of weighted fills, weights and distances, and the pairs
    with the smallest and the largest difference, the first of equals."""

    def __init__(self, n: int, most: int):
        self.most, self.n = most, np.zeros(n, np.int64)
        self.sums = np.zeros((n, 3))  # weight * fill, weight, distance
        self.low, self.high = np.full(n, np.inf), np.full(n, -np.inf)
        self.cut = {"low": np.zeros((n, 3)), "high": np.zeros((n, 3))}

    def add(self, rows: np.ndarray, diff: np.ndarray, alt: np.ndarray, weight: np.ndarray, far: np.ndarray, config: A1, zero: float) -> None:
        """diff: of each row's neighbours in order, NaN where there is no pair; alt: the other year's value at the gap."""
        ok, many = _first(diff, self.n[rows], self.most)
        self.n[rows] += many
        used = ok.astype(np.float64)
        w, d, moved = used @ weight, used @ far, _zeroed(diff) @ weight
        self.sums[rows] += np.stack([alt * moved + zero * w if config.ratio else alt * w + moved, w, d], axis=1)
        if config.trim:
            for side, reduce in (("low", np.fmin), ("high", np.fmax)):
                value, best = reduce.reduce(diff, axis=1), getattr(self, side)
                new = np.flatnonzero(value < best[rows] if side == "low" else value > best[rows])
                i, value = rows[new], value[new]
                k = np.argmax(diff[new] == value[:, None], axis=1)
                best[i] = value
                fill = alt[new] * value + zero if config.ratio else alt[new] + value
                self.cut[side][i] = np.stack([fill * weight[k], weight[k], far[k]], axis=1)


def fill_a1(value: np.ndarray, flags: np.ndarray, config: A1, limits: Limits, target: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(value, flags, dist, pairs) of a stack (years, y, x); target: rows (year, y, x) to be filled.

    The years' difference is one image for each pair of years; gaps take it around themselves in batches of offsets, as one
    gather, until they have enough. Donor years without any pair in reach are passed over.
    """
    known = ~np.isnan(value).all(axis=0)
    empty = np.isnan(value) & ((flags & (fl.OCEAN | fl.FAILURE)) == 0) & target
    zero = limits.absolute_zero if config.ratio else 0.0
    v = value - zero
    out, flags = value.copy(), np.where(empty & ~known, fl.FAILURE, flags)
    dist, count = np.full(value.shape, np.nan), np.full(value.shape, -1, np.int64)
    years = len(value)
    near = Around(value.shape[1:], config.search)
    for t in range(years):
        y, x = np.nonzero(empty[t] & known)
        if not len(y):
            continue
        pairs, spot = Pairs(len(y), config.max_used), near.place(y, x)
        for dz in (sign * step for step in range(1, years) for sign in (1, -1)):
            if not 0 <= t + dz < years:
                continue
            then = v[t + dz]
            alt = then[y, x]
            live = np.flatnonzero(~np.isnan(alt) & (pairs.n < config.max_used))
            if not len(live):
                continue
            if config.ratio:
                with np.errstate(divide="ignore", invalid="ignore"):
                    both = np.where(then == 0, np.where(np.isnan(v[t]), np.nan, config.max_ratio), np.clip(v[t] / then, 1 / config.max_ratio, config.max_ratio))
            else:
                both = v[t] - then
            live = live[near.any_near(both, y[live], x[live])]
            image = near.padded(both)
            for a in range(0, len(live), CHUNK):
                rows = live[a : a + CHUNK]
                for part in near.batches:
                    diff = image.take(spot[rows][:, None] + near.step[None, part])
                    pairs.add(rows, diff, alt[rows], 1.0 / abs(dz) / near.far[part], near.far[part], config, zero)
                    rows = rows[pairs.n[rows] < config.max_used]
                    if not len(rows):
                        break
        n = pairs.n
        enough = n >= config.min_used
        trim = enough & (n > 2) & config.trim
        both = np.where(trim[:, None], pairs.cut["low"] + pairs.cut["high"], 0.0)
        with np.errstate(divide="ignore", invalid="ignore"):
            sums = pairs.sums - both
            filled, mean_d = sums[:, 0] / sums[:, 1], sums[:, 2] / (n - 2 * trim)
        out[t, y[enough], x[enough]] = filled[enough]
        dist[t, y[enough], x[enough]] = mean_d[enough]
        new = np.where(enough, fl.A1_FILLED | np.where(n == config.max_used, fl.A1_FULL, 0), fl.FAILURE)
        flags[t, y, x] |= new.astype(flags.dtype)
        count[t, y, x] = n
    return out, flags, dist, count


# Scan directions of the eight passes: (outer axis, outer step, inner step).
PASSES = (("x", 1, 1), ("x", -1, 1), ("x", 1, -1), ("x", -1, -1), ("y", 1, 1), ("y", 1, -1), ("y", -1, 1), ("y", -1, -1))


def anomaly(value: np.ndarray, mean: np.ndarray, ocean: np.ndarray, config: A2, limits: Limits) -> np.ndarray:
    if not config.ratio:
        return np.where(ocean, np.nan, value - mean)
    with np.errstate(divide="ignore", invalid="ignore"):
        r = (value - limits.absolute_zero) / (mean - limits.absolute_zero)
    return np.where(ocean, np.nan, np.clip(r, 1 / config.max_ratio, config.max_ratio))


class Cells:
    """Cells of components, known by place: memory follows the cells, not the boxes around them. Components don't touch."""

    def __init__(self, component: np.ndarray, y: np.ndarray, x: np.ndarray):
        names, comp = np.unique(component, return_inverse=True)
        low, high = np.full((2, len(names)), np.iinfo(np.int64).max), np.full((2, len(names)), -1)
        for i, v in enumerate((y, x)):
            np.minimum.at(low[i], comp, v)
            np.maximum.at(high[i], comp, v)
        self.y, self.x = y - low[0][comp], x - low[1][comp]
        self.bottom, self.right = (high - low)[:, comp]
        wide = high[1] - low[1] + 3  # a blank column and row on either side
        first = np.cumsum([0, *((high[0] - low[0] + 3) * wide)[:-1]]) if len(names) else np.zeros(0, np.int64)
        self.wide = wide[comp]
        self.number = first[comp] + (self.y + 1) * self.wide + self.x + 1
        self.order = np.argsort(self.number)

    def around(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(positions of the eight cells around each of `at`, or the number of cells if there is none; how far they lie)."""
        dx, dy, hop = offsets(8)
        near = self.number[at][:, None] + dy[None, :] * self.wide[at][:, None] + dx[None, :]
        sorted_ = self.number[self.order]
        spot = np.minimum(np.searchsorted(sorted_, near), max(0, len(sorted_) - 1))
        return np.where(sorted_[spot] == near, self.order[spot], len(sorted_)), hop

    def step(self, at: np.ndarray, way: tuple[str, int, int]) -> np.ndarray:
        """2 * outer + inner place of a scan. All cells of one step are independent of each other and depend on smaller
        steps only, so a step, of all components at once, is one array operation."""
        axis, outer, inner = way
        places = {"x": (self.x, self.right), "y": (self.y, self.bottom)}
        turned = lambda name, by: (places[name][0] if by > 0 else places[name][1] - places[name][0])[at]
        return 2 * turned(axis, outer) + turned("y" if axis == "x" else "x", inner)


def smear(cells: Cells, diff: np.ndarray, gaps: np.ndarray, dist: np.ndarray, config: A2, way: tuple[str, int, int], near: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(anomaly, distance) that one pass gives the cells at `gaps`; near: what is around those."""
    around, hop = near
    d, far = np.append(diff, np.nan), np.append(np.nan_to_num(dist, nan=0.0), 0.0)
    out_d, out_far = np.full(len(diff), np.nan), np.full(len(diff), np.nan)
    step = cells.step(gaps, way)
    order = np.argsort(step, kind="stable")
    cuts = np.flatnonzero(np.diff(step[order], prepend=-1))
    for part in np.split(order, cuts[1:]) if len(cuts) else ():
        at = around[part]
        found = d[at]
        ok = ~np.isnan(found)
        n = ok.sum(1)
        total = np.where(ok, found, 0.0).sum(1)
        reach = np.where(ok, far[at] + hop[None, :], 0.0).sum(1)
        got = (n > 0) & (total > 0 if config.ratio else True)
        mine = gaps[part][got]
        d[mine] = out_d[mine] = total[got] / n[got]
        out_far[mine] = reach[got] / n[got]
    return out_d, out_far


def fill_a2_cells(cells: Cells, value: np.ndarray, mean: np.ndarray, flags: np.ndarray, dist: np.ndarray, config: A2, limits: Limits) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(pass values, pass distances), both (8, cells) and NaN where a pass gives nothing, and the cells that need a value."""
    gap = ((flags & fl.FAILURE) != 0) & ~np.isnan(mean) & ((flags & fl.OCEAN) == 0)
    diff = anomaly(value, mean, (flags & fl.OCEAN) != 0, config, limits)
    gaps = np.flatnonzero(gap)
    near = cells.around(gaps)
    got = [smear(cells, diff, gaps, dist, config, way, near) for way in PASSES]
    values, fars = np.stack([g[0] for g in got]), np.stack([g[1] for g in got])
    if config.ratio:
        values = values * (mean - limits.absolute_zero) + limits.absolute_zero
    else:
        values = values + mean
    return values, fars, gap


def fill_a2(value: np.ndarray, mean: np.ndarray, flags: np.ndarray, dist: np.ndarray, config: A2, limits: Limits) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """As fill_a2_cells, of a whole image (y, x)."""
    y, x = np.indices(value.shape)
    cells = Cells(np.zeros(value.size, np.int64), y.ravel(), x.ravel())
    values, fars, gap = fill_a2_cells(cells, *(a.ravel() for a in (value, mean, flags, dist)), config, limits)
    return values.reshape(8, *value.shape), fars.reshape(8, *value.shape), gap.reshape(value.shape)
