"""Joining of linked nodes within a task; components over tables are those of the rest of the library."""

from __future__ import annotations

import numpy as np

from lacunar.operators.graph import components

__all__ = ["components", "local_roots"]


def local_roots(n: int, a: np.ndarray, b: np.ndarray, root: np.ndarray) -> np.ndarray:
    """Roots of n local nodes after the links (a, b) join what `root` already joins; the smallest position is the root."""
    while len(a):
        x, y = root[a], root[b]
        low, high = np.minimum(x, y), np.maximum(x, y)
        open_ = low != high
        if not open_.any():
            break
        np.minimum.at(root, high[open_], low[open_])
        while (jump := root[root]).tobytes() != root.tobytes():
            root = jump
        a, b = a[open_], b[open_]
    return root
