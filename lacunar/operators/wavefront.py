"""A2 over components of gaps that are larger than a task: a wavefront of tiles.

A pass visits cells in the order of a scan, and a cell takes from those before it. In the coordinates (o, i) of a scan's outer and
inner axis a cell depends on (o - 1, i - 1), (o - 1, i), (o - 1, i + 1) and (o, i - 1), so squares of cells would wait for each
other. With i + o in place of i no dependency points forward in either coordinate: tiles of (o, i + o), slanted in the image, form
a graph without cycles, in which a tile waits for three others, all on earlier diagonals. A round fills the tiles of one diagonal,
of all eight passes and all images at once; what later tiles need, the filled cells on a tile's far edges, is handed on as rows of
a table. Two passes in opposite directions cut the image into the same tiles, so there are four tilings.

A task holds one tile with a margin of two cells: about 450 bytes a cell, 120 MB for a tile of 512, however large the component or
the image. Rounds are as many as an image has diagonals of tiles, about three times its side in tiles. Each cell is computed from
the same neighbours in the same order as in a plain scan of the whole image, so the values are the same to the last bit.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lacunar.config import A2, Limits
from lacunar.functions import flags as fl
from lacunar.operators import kernels
from lacunar.operators.grid import meet
from lacunar.sources.scratch import delete, materialize, new_path, release

TILE = 512
WIDTH = 1 << 24  # cells of a row, at most: a cell's number is y * WIDTH + x
TILINGS = (("x", 1), ("x", -1), ("y", 1), ("y", -1))  # outer axis, and by which sign it is added to the inner one
CELL = np.dtype([("y", np.int32), ("x", np.int32), ("diff", np.float64), ("mean", np.float64), ("dist", np.float64), ("own", np.bool_)])
EDGE = np.dtype([("number", np.int64), ("diff", np.float64)])
FOUND = np.dtype([("y", np.int32), ("x", np.int32), ("value", np.float64), ("dist", np.float64)])


def tiling(way: tuple[str, int, int]) -> int:
    axis, outer, inner = way
    return TILINGS.index((axis, outer * inner))


def _packed(by: Sequence[str], config: A2, limits: Limits, tile: int):
    """The cells of a tile and its margin as one message."""

    def run(table: pa.Table) -> pa.Table:
        number = lambda c, empty: pc.fill_null(table[c].cast(pa.float64()), empty).to_numpy()
        cells = np.zeros(table.num_rows, CELL)
        mean, flags = number("mean", np.nan), table["flags"].to_numpy().astype(np.int64)
        cells["y"], cells["x"], cells["mean"], cells["dist"], cells["own"] = table["y"].to_numpy(), table["x"].to_numpy(), mean, number("dist", np.nan), table["own"].to_numpy(zero_copy_only=False)
        cells["diff"] = kernels.anomaly(number("value", np.nan), mean, (flags & fl.OCEAN) != 0, config, limits)
        head = table.select([*by, "tiling", "u", "w"]).slice(0, 1)
        return head.append_column("data", pa.array([cells.tobytes()], pa.binary()))

    return run


def _filled(by: Sequence[str], config: A2, limits: Limits, tile: int):
    """One pass over one tile: its filled cells, and those of them that later tiles see."""

    def run(table: pa.Table) -> pa.Table:
        data = [d for d in table["data"].to_pylist() if d is not None]
        head = table.select([*by, "pass", "u", "w"]).slice(0, 1)
        if not data:  # edges of a tile behind which there are no gaps
            return head.slice(0, 0).append_column("found", pa.array([], pa.binary())).append_column("edge", pa.array([], pa.binary()))
        way = kernels.PASSES[table["pass"][0].as_py()]
        c = np.frombuffer(data[0], CELL)
        diff, number = c["diff"].copy(), c["y"].astype(np.int64) * WIDTH + c["x"]
        order = np.argsort(number)
        for edge in table["edge"].to_pylist():
            if edge is not None:
                e = np.frombuffer(edge, EDGE)
                at = np.minimum(np.searchsorted(number[order], e["number"]), len(number) - 1)
                hit = number[order[at]] == e["number"]
                diff[order[at[hit]]] = e["diff"][hit]
        cells = kernels.Cells(np.zeros(len(c), np.int64), c["y"].astype(np.int64), c["x"].astype(np.int64))
        gaps = np.flatnonzero(c["own"])
        d, far = kernels.smear(cells, diff, gaps, c["dist"], config, way, cells.around(gaps))
        got = gaps[~np.isnan(d[gaps])]
        found = np.zeros(len(got), FOUND)
        value = d[got] * (c["mean"][got] - limits.absolute_zero) + limits.absolute_zero if config.ratio else d[got] + c["mean"][got]
        found["y"], found["x"], found["value"], found["dist"] = c["y"][got], c["x"][got], value, far[got]
        axis, outer, inner = way
        o, i = (found["x"], found["y"]) if axis == "x" else (found["y"], found["x"])
        o, slant = o.astype(np.int64) % tile, (i.astype(np.int64) + outer * inner * o) % tile
        last = (o == (tile - 1 if outer > 0 else 0)) | (slant >= tile - 2 if inner > 0 else slant <= 1)
        edge = np.zeros(int(last.sum()), EDGE)
        edge["number"], edge["diff"] = number[got[last]], d[got[last]]
        return head.append_column("found", pa.array([found.tobytes()], pa.binary())).append_column("edge", pa.array([edge.tobytes()], pa.binary()))

    return run


def _tiles(df: DataFrame, by: Sequence[str], tile: int) -> DataFrame:
    """df (by..., y, x, ..., own) once for every tile of every tiling that holds a cell, or has it in its margin; own: in it."""
    index = lambda c: F.floor(c / tile).cast("long")
    parts = []
    for k, (axis, sign) in enumerate(TILINGS):
        o, i = (F.col("x"), F.col("y")) if axis == "x" else (F.col("y"), F.col("x"))
        slant = i + sign * o
        part = df.withColumn("tiling", F.lit(k)).withColumn("u", F.explode(F.sequence(index(o - 1), index(o + 1)))).withColumn("w", F.explode(F.sequence(index(slant - 2), index(slant + 2))))
        parts.append(part.withColumn("own", F.col("own") & (F.col("u") == index(o)) & (F.col("w") == index(slant))))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def wave_passes(df: DataFrame, gaps: DataFrame, config: A2, limits: Limits, by: Sequence[str] = ("year",), tile: int = TILE) -> DataFrame:
    """by..., y, x, pass, pass_value, pass_dist of the gap cells `gaps` (by..., y, x), whole components of them, in images
    df (by..., y, x, value, mean, flags, dist)."""
    spark, by = df.sparkSession, list(by)
    kinds = {f.name: f.dataType.simpleString() for f in df.schema}
    keys = ", ".join(f"{c} {kinds[c]}" for c in by) + ("," if by else "")
    marked = meet(df.select(*by, "y", "x", "value", "mean", "flags", "dist"), gaps.select(*by, "y", "x", F.lit(True).alias("own")), [*by, "y", "x"], "left").withColumn("own", F.coalesce("own", F.lit(False)))
    active = _tiles(gaps.select(*by, "y", "x", F.lit(True).alias("own")), by, tile).where("own").select(*by, "tiling", "u", "w").distinct()
    rows = _tiles(marked, by, tile).join(active, [*by, "tiling", "u", "w"], "left_semi")
    packed = rows.groupBy(*by, "tiling", "u", "w").applyInArrow(_packed(by, config, limits, tile), f"{keys} tiling int, u long, w long, data binary")
    sign = F.when(F.col("tiling") % 2 == 0, 1).otherwise(-1)
    path = new_path(spark, "wave-tiles")
    packed.withColumn("diagonal", F.col("w") + sign * F.col("u")).write.option("compression", "zstd").partitionBy("tiling", "diagonal").parquet(path)
    tiles = spark.read.parquet(path)
    spans = {r["tiling"]: (r["low"], r["high"]) for r in tiles.groupBy("tiling").agg(F.min("diagonal").alias("low"), F.max("diagonal").alias("high")).collect()}
    rounds = max((high - low + 1 for low, high in spans.values()), default=0)
    schema = f"{keys} `pass` int, u long, w long, found binary, edge binary"
    done: list[DataFrame] = []
    for r in range(rounds):
        turn = None
        for p, way in enumerate(kernels.PASSES):
            k = tiling(way)
            low, high = spans[k]
            diagonal = low + r if way[2] > 0 else high - r
            part = tiles.where((F.col("tiling") == k) & (F.col("diagonal") == diagonal)).select(*by, F.lit(p).alias("pass"), "u", "w", "data")
            turn = part if turn is None else turn.unionByName(part)
        for back in (1, 2):
            if r >= back:
                turn = turn.unionByName(_handed(done[r - back], by, back), allowMissingColumns=True)
        if r == 0:
            turn = turn.withColumn("edge", F.lit(None).cast("binary"))
        done.append(materialize(turn.groupBy(*by, "pass", "u", "w").applyInArrow(_filled(by, config, limits, tile), schema), "wave-round"))
    delete(spark, path)
    if not done:
        return spark.createDataFrame([], f"{keys} y {kinds['y']}, x {kinds['x']}, `pass` int, pass_value double, pass_dist double")
    every = done[0]
    for d in done[1:]:
        every = every.union(d)

    def cells(batches):
        for batch in batches:
            for j in range(len(batch)):
                found = np.frombuffer(batch.column("found")[j].as_py(), FOUND)
                at = pa.array(np.full(len(found), j))
                head = [batch.column(c).take(at) for c in by]
                yield pa.RecordBatch.from_arrays([*head, pa.array(found["y"]), pa.array(found["x"]), batch.column("pass").take(at), pa.array(found["value"]), pa.array(found["dist"])], names=[*by, "y", "x", "pass", "pass_value", "pass_dist"])

    out = materialize(every.select(*by, "pass", "found").mapInArrow(cells, f"{keys} y int, x int, `pass` int, pass_value double, pass_dist double"), "wave-passes")
    release(*done)
    return out.withColumns({c: F.col(c).cast(kinds[c]) for c in ("y", "x")})


def _handed(done: DataFrame, by: Sequence[str], back: int) -> DataFrame:
    """Edges of a round for the tiles of `back` rounds later: the next along either axis or, two rounds on, along both."""
    ways = F.array(*[F.struct(F.lit(o).alias("o"), F.lit(i).alias("i")) for _, o, i in kernels.PASSES])
    way = F.element_at(ways, F.col("pass") + 1)
    steps = [(way["o"], F.lit(0)), (F.lit(0), way["i"])] if back == 1 else [(way["o"], way["i"])]
    to = F.explode(F.array(*[F.struct((F.col("u") + du).alias("u"), (F.col("w") + dw).alias("w")) for du, dw in steps]))
    return done.where(F.length("edge") > 0).select(*by, "pass", to.alias("to"), "edge").select(*by, "pass", "to.u", "to.w", "edge")
