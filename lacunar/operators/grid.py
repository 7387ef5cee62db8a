"""Dense grids, areas, dates and tiles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

RESOLUTION = 0.008333333333333


CELLS = 1 << 22  # of a task that makes a grid


def meet(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "inner") -> DataFrame:
    """The join of two tables that both grow with the cells: by a shuffle, whatever Spark takes their sizes for. It goes by the
    bytes of files, and cells are written so small that it would broadcast millions of them, through the driver's memory."""
    return left.join(right.hint("merge"), on, how)


def complete(obs: DataFrame, height: int, width: int, by: Sequence[str] = ("year",), box: tuple[int, int, int, int] | None = None, dates: DataFrame | None = None) -> DataFrame:
    """obs (by..., y, x, value) with a row for every cell of every date that occurs; NULL values are gaps.

    What is shuffled are the values and one row for each date and row of the grid; cells are made behind that shuffle, by
    as many tasks as the grid asks for, and meet their values there. With `box` (y0, y1, x0, x1) that is the area: its cells alone
    are read and made. `dates` (by...) are the dates, if they are known without reading obs.
    """
    y0, y1, x0, x1 = box or (0, height, 0, width)
    y0, y1, x0, x1 = max(0, y0), min(height, y1), max(0, x0), min(width, x1)
    inside = within(obs, y0, y1, x0, x1)
    kinds = {f.name: f.dataType for f in obs.schema}
    upto = lambda low, high, c: (F.sequence(F.lit(low), F.lit(high - 1)) if low < high else F.array()).cast(f"array<{kinds[c].simpleString()}>")
    rows = (obs.select(*by).distinct() if dates is None else dates.select(*by)).withColumn("y", F.explode(upto(y0, y1, "y")))
    rows = rows.withColumns({"x": F.lit(None).cast(kinds["x"]), "value": F.lit(None).cast(kinds["value"])})
    high, wide = max(1, y1 - y0), max(1, x1 - x0)
    n = max(3 * obs.sparkSession.sparkContext.defaultParallelism, min(high, 64 * -(-high * wide // CELLS)))
    both = rows.unionByName(inside.select(*by, "y", "x", "value")).repartition(n, *by, "y")
    both = both.withColumn("x", F.explode(F.when(F.col("x").isNull(), upto(x0, x1, "x")).otherwise(F.array("x"))))
    return both.groupBy(*by, "y", "x").agg(F.max("value").alias("value"))


def pixel_limits(north: float, south: float, west: float, east: float, res: float = RESOLUTION, top: float = 90, left: float = -180) -> tuple[int, int, int, int]:
    """(y0, y1, x0, x1) of a bounding box in degrees, in cells of a grid whose corner lies at (top, left); the ends are exclusive."""
    return int((top - north) / res), int((top - south) / res + 0.5), int((west - left) / res), int((east - left) / res + 0.5)


def within(df: DataFrame, y0: int, y1: int, x0: int, x1: int) -> DataFrame:
    """Cells of an area; on tiled files the scan skips others by their statistics."""
    return df.where((F.col("y") >= y0) & (F.col("y") < y1) & (F.col("x") >= x0) & (F.col("x") < x1))


def clipped_transform(transform: Sequence[float], y0: int, x0: int) -> list[float]:
    """The affine transform of an area: the origin moves by its offset."""
    gx, sx, rx, gy, ry, sy = transform
    return [gx + x0 * sx + y0 * rx, sx, rx, gy + x0 * ry + y0 * sy, ry, sy]


def on_days(df: DataFrame, days: Sequence[int]) -> DataFrame:
    """Rows of some days of year; none, or a 0 among them, means all. Prunes partitions of a table written by day."""
    return df if not days or 0 in days else df.where(F.col("doy").isin(*days))


def is_target(start_year: int | None, start_doy: int | None = None) -> Column:
    """Rows to fill. Rows before the start stay in the table, as they still give values."""
    if start_year is None:
        return F.lit(True)
    if start_doy is None:
        return F.col("year") >= start_year
    return F.col("year") * 1000 + F.col("doy") >= start_year * 1000 + start_doy


def with_position(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """df with `pos`, the position of a row's year among the years of its day; missing years leave no hole. Ranked on the
    distinct dates alone and joined back."""
    dates = df.select(*by, "year").distinct()
    dates = dates.withColumn("pos", F.dense_rank().over(Window.partitionBy(*by).orderBy("year")))
    return df.join(F.broadcast(dates), [*by, "year"])  # a row for each image of the archive


def shape(mask: DataFrame) -> tuple[int, int]:
    """(height, width) of a table that holds every cell, such as the land mask."""
    top = mask.agg(F.max("y").alias("y"), F.max("x").alias("x")).first()
    return (top["y"] + 1, top["x"] + 1) if top["y"] is not None else (0, 0)


def tile_size(memory: int, years: int, margin: int, cell_bytes: int = 64) -> int:
    """The largest tile, in steps of 32 cells and 32 at least, whose stack with its halo fits into some bytes of a task."""
    side = int((memory / (cell_bytes * max(1, years))) ** 0.5) - 2 * margin
    return max(32, side // 32 * 32)


def tiled(df: DataFrame, tile: int, halo: int) -> DataFrame:
    """Each row once for every tile (ty, tx) whose core or halo holds it; `core` tells the tile it belongs to."""
    first = lambda c: F.floor((F.col(c) - halo) / tile).cast("int")
    last = lambda c: F.floor((F.col(c) + halo) / tile).cast("int")
    df = df.withColumn("ty", F.explode(F.sequence(first("y"), last("y")))).withColumn("tx", F.explode(F.sequence(first("x"), last("x"))))
    core = (F.floor(F.col("y") / tile) == F.col("ty")) & (F.floor(F.col("x") / tile) == F.col("tx"))
    return df.withColumn("core", core)
