"""Neighbour offsets in the order of a spiral search."""

from __future__ import annotations

from functools import cache

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


@cache
def offsets(search: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(dx, dy, distance) of the nearest `search` neighbours, by distance, then dx, then dy; the cell itself left out."""
    reach = int(np.sqrt(search / 3.14)) + 2
    side = np.arange(-reach, reach + 1)
    dx, dy = (a.ravel() for a in np.meshgrid(side, side, indexing="ij"))
    order = np.lexsort((dy, dx, dx * dx + dy * dy))[1 : search + 1]
    dx, dy = dx[order], dy[order]
    return dx, dy, np.sqrt(dx * dx + dy * dy)


def halo(search: int) -> int:
    """Cells that a search can reach beyond its own, along either axis."""
    dx, dy, _ = offsets(search)
    return int(max(np.abs(dx).max(), np.abs(dy).max())) if search else 0


def spiral_table(spark: SparkSession, search: int) -> DataFrame:
    """k (from 1), dx, dy, dist."""
    dx, dy, dist = offsets(search)
    return spark.createDataFrame([(k + 1, int(a), int(b), float(d)) for k, (a, b, d) in enumerate(zip(dx, dy, dist, strict=True))], "k int, dx int, dy int, dist double")


def spiral_column(search: int) -> Column:
    """The table as an array literal, to be exploded where it is needed: no join, no shuffle."""
    dx, dy, _ = offsets(search)
    rows = ",".join(f"named_struct('k',{k + 1},'dx',{a},'dy',{b})" for k, (a, b) in enumerate(zip(dx.tolist(), dy.tolist(), strict=True)))
    return F.expr(f"array({rows})")
