"""A2: fill what A1 left by smearing anomalies over the image in eight scan directions.

During a pass information moves through gap cells only, so every 8-connected component of gaps, with the cells around
it, is filled by itself. Components are labelled tile by tile and joined over tile borders; then a task takes many small
ones at once. A component of more than LARGE cells is filled tile by tile (`wavefront`), with the same values: no task holds
more than CELLS + LARGE cells with what is around them.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lacunar.config import A2, Limits
from lacunar.functions import flags as fl
from lacunar.operators import kernels, wavefront
from lacunar.operators.graph import components, local_roots
from lacunar.operators.grid import meet
from lacunar.sources.scratch import materialize

TILE = 512
CELLS = 1 << 16  # gap cells in a task's group, but for a larger component
LARGE = 1 << 18  # gap cells of a component that a task takes whole
FEW = 1 << 16  # large components that are broadcast
WIDTH = 1 << 24  # cells of a row, at most: a cell's number is y * WIDTH + x


def _label(y: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Component of each cell as the smallest cell number in it, by union of the cells' links to the east and south."""
    number = y.astype(np.int64) * WIDTH + x
    order = np.argsort(number)
    sorted_ = number[order]
    a, b = [], []
    for step in (1, WIDTH - 1, WIDTH, WIDTH + 1):
        at = np.minimum(np.searchsorted(sorted_, sorted_ + step), len(sorted_) - 1)
        linked = np.flatnonzero(sorted_[at] == sorted_ + step)
        a.append(linked)
        b.append(at[linked])
    root = local_roots(np.concatenate(a), np.concatenate(b), np.arange(len(number)))
    out = np.empty(len(number), np.int64)
    out[order] = sorted_[root]
    return out


def gap_components(df: DataFrame, by: Sequence[str], tile: int = TILE) -> DataFrame:
    """by..., y, x, component of every gap cell; components of an image are named by their smallest cell."""
    gaps = df.where(fl.has(F.col("flags"), fl.FAILURE) & F.col("mean").isNotNull() & ~fl.has(F.col("flags"), fl.OCEAN)).select(*by, "y", "x")
    tiled = gaps.withColumn("ty", F.floor(F.col("y") / tile)).withColumn("tx", F.floor(F.col("x") / tile))

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        return pdf[[*by, "y", "x"]].assign(label=_label(pdf["y"].to_numpy(), pdf["x"].to_numpy()))

    kinds = {f.name: f.dataType.simpleString() for f in gaps.schema}
    labels = materialize(tiled.groupBy(*by, "ty", "tx").applyInPandas(run, ", ".join(f"{c} {kinds[c]}" for c in [*by, "y", "x"]) + ", label long"), "gaps")
    image = F.xxhash64(*by) if by else F.lit(0).cast("long")
    node = lambda label: F.xxhash64(image, label)
    edge = (F.col("y") % tile).isin(0, tile - 1) | (F.col("x") % tile).isin(0, tile - 1)
    rim = labels.where(edge)
    steps = F.expr("array(struct(0 as dy, 1 as dx), struct(1 as dy, -1 as dx), struct(1 as dy, 0 as dx), struct(1 as dy, 1 as dx))")
    moved = rim.select(*by, (F.col("y") + 0).alias("y0"), (F.col("x") + 0).alias("x0"), F.col("label").alias("from"), F.explode(steps).alias("s")).select(*by, (F.col("y0") + F.col("s.dy")).alias("y"), (F.col("x0") + F.col("s.dx")).alias("x"), "from")
    links = meet(moved, rim, [*by, "y", "x"]).where("from <> label").select(node(F.col("from")).alias("u"), node(F.col("label")).alias("v"))
    roots = components(links, "gap-edges")
    named = meet(labels.withColumn("node", node(F.col("label"))), roots, ["node"], "left")
    return named.select(*by, "y", "x", F.coalesce("root", "node").alias("component"))


def pass_values(df: DataFrame, config: A2, limits: Limits, by: Sequence[str] = ("year",), tile: int = TILE, wave_tile: int = wavefront.TILE) -> DataFrame:
    """by..., y, x, pass (0 to 7), pass_value, pass_dist for each gap cell and pass that gives it a value."""
    need = ["value", "mean", "flags", "dist"]
    df = df.select(*by, "y", "x", *need)
    comps = materialize(gap_components(df, by, tile), "gap-components")
    large = materialize(comps.groupBy("component").agg(F.count("*").alias("cells")).where(F.col("cells") > LARGE).select("component"), "gap-large")
    n_large = large.count()
    if not n_large:
        return _by_component(df, comps, config, limits, by)
    few = F.broadcast(large) if n_large <= FEW else large
    gaps = comps.join(few, "component", "left_semi")
    return _by_component(df, comps.join(few, "component", "left_anti"), config, limits, by).unionByName(wavefront.wave_passes(df, gaps, config, limits, by, wave_tile))


def _by_component(df: DataFrame, comps: DataFrame, config: A2, limits: Limits, by: Sequence[str]) -> DataFrame:
    """Passes over components that a task takes whole, some of them at once."""
    steps = F.expr("sequence(-1, 1)")
    around = comps.select(*by, "y", "x", "component", F.explode(steps).alias("dy")).select("*", F.explode(steps).alias("dx"))
    cells = around.select(*by, (F.col("y") + F.col("dy")).alias("y"), (F.col("x") + F.col("dx")).alias("x"), "component").distinct()
    cells = meet(cells, df, [*by, "y", "x"])
    own = comps.withColumn("own", F.lit(True))
    # rim cells that are gaps of another component are none: two such cells would be linked
    cells = meet(cells, own, [*by, "y", "x", "component"], "left").withColumn("own", F.coalesce("own", F.lit(False)))

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        number = lambda name, empty: pdf[name].to_numpy(dtype=np.float64, na_value=empty)
        cells = kernels.Cells(pdf["component"].to_numpy(), pdf["y"].to_numpy(dtype=np.int64), pdf["x"].to_numpy(dtype=np.int64))
        flags = number("flags", fl.OCEAN).astype(np.int64)
        values, far, _ = kernels.fill_a2_cells(cells, number("value", np.nan), number("mean", np.nan), flags, number("dist", np.nan), config, limits)
        mine = pdf["own"].to_numpy(dtype=bool)
        spots = [(i, np.flatnonzero(mine & ~np.isnan(values[i]))) for i in range(8)]
        parts = [pdf.iloc[at][[*by, "y", "x"]].assign(**{"pass": i, "pass_value": values[i, at], "pass_dist": far[i, at]}) for i, at in spots]
        return pd.concat(parts)

    kinds = {f.name: f.dataType.simpleString() for f in df.schema}
    schema = ", ".join(f"{c} {kinds[c]}" for c in [*by, "y", "x"]) + ", `pass` int, pass_value double, pass_dist double"
    buckets = max(1, -(-comps.count() // CELLS))
    return cells.withColumn("bucket", F.pmod(F.xxhash64("component"), F.lit(buckets))).groupBy("bucket").applyInPandas(run, schema)


def combine(passes: DataFrame, by: Sequence[str] = ("year",), average: str = "mean") -> DataFrame:
    """by..., y, x, n_passes, a2_value, a2_dist."""
    middle = F.avg("pass_value") if average.lower() == "mean" else F.median("pass_value")
    return passes.groupBy(*by, "y", "x").agg(F.count("pass_value").alias("n_passes"), middle.alias("a2_value"), F.avg("pass_dist").alias("a2_dist"))


def fill(df: DataFrame, config: A2, limits: Limits, by: Sequence[str] = ("year",), tile: int = TILE) -> DataFrame:
    """df with the remaining gaps filled where a pass reaches them: flag 2 goes, 64 comes."""
    got = combine(pass_values(df, config, limits, by, tile), by, config.average)
    df = meet(df, got, [*by, "y", "x"], "left")
    hit = F.col("a2_value").isNotNull()
    df = df.withColumn("value", F.coalesce("a2_value", "value")).withColumn("dist", F.when(hit, F.col("a2_dist")).otherwise(F.col("dist")))
    return df.withColumn("flags", F.when(hit, fl.put(fl.drop(F.col("flags"), fl.FAILURE), fl.A2_FILLED)).otherwise(F.col("flags"))).drop("a2_value", "a2_dist", "n_passes")
