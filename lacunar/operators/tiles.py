"""Despeckle and A1 with long searches: a tile with its halo is one group and one set of dense arrays."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lacunar.config import A1, Despeckle, Limits
from lacunar.operators import kernels
from lacunar.operators.grid import is_target, tiled
from lacunar.operators.spiral import halo


def fill_tiles(classified: DataFrame, despeckle: Despeckle, a1: A1 | None, limits: Limits, by: Sequence[str] = (), start_year: int | None = None, tile: int = 256) -> DataFrame:
    """classified rows (by..., year, y, x, value, mean, sd, z, flags) despeckled and filled (without a1: despeckled alone):
    value, flags, dist, n_pairs.

    The halo holds both searches, so tiles agree with the whole image. Every year of a tile is in its group: a task
    holds (tile + 2 halo)^2 cells a year, whatever the image.
    """
    margin = halo(despeckle.search) + (halo(a1.search) if a1 else 0)
    rows = tiled(classified.withColumn("target", is_target(start_year)), tile, margin)
    keep = [*by, "year", "y", "x"]

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        if not pdf["core"].any():
            return pdf.iloc[:0][[*keep, "mean", "sd", "value", "flags"]].assign(dist=np.zeros(0), n_pairs=pd.array([], dtype="Int64"))
        years = np.sort(pdf["year"].unique())
        t, y, x = np.searchsorted(years, pdf["year"]), pdf["y"].to_numpy(), pdf["x"].to_numpy()
        y0, x0 = y.min(), x.min()
        shape = (len(years), int(y.max() - y0 + 1), int(x.max() - x0 + 1))
        at = (t, y - y0, x - x0)

        def dense(name: str, empty: float, kind: type = np.float64) -> np.ndarray:
            a = np.full(shape, empty, dtype=kind)
            a[at] = pdf[name].to_numpy(dtype=np.float64, na_value=np.nan) if kind is np.float64 else pdf[name].to_numpy()
            return a

        flags = dense("flags", 1, np.int64)
        value, flags = kernels.despeckle(dense("value", np.nan), flags, dense("z", np.nan), despeckle)
        if a1:
            value, flags, dist, n = kernels.fill_a1(value, flags, a1, limits, dense("target", False, bool))
        else:
            dist, n = np.full(shape, np.nan), np.full(shape, -1, np.int64)
        out = pdf[[*keep, "mean", "sd"]].assign(value=value[at], flags=flags[at].astype(np.int16), dist=dist[at], n_pairs=pd.array(n[at], dtype="Int64"))
        out.loc[(n[at] < 0), "n_pairs"] = pd.NA
        return out[pdf["core"].to_numpy()]

    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    schema = ", ".join(f"{c} {kinds[c]}" for c in [*keep, "mean", "sd"]) + ", value double, flags short, dist double, n_pairs long"
    filled = rows.select(*keep, "mean", "sd", "z", "value", "flags", "target", "core", "ty", "tx").groupBy(*by, "ty", "tx").applyInPandas(run, schema)
    nan = lambda c: F.when(~F.isnan(c), F.col(c))
    return filled.withColumns({c: nan(c) for c in ("value", "dist", "mean", "sd")})
