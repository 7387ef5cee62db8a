"""Reference statistics of cells, and their seasonal correction."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

NORTH_MONTHS, NORTH_SHOULDERS = (1, 2, 3, 10, 11, 12), (4, 9)
SOUTH_MONTHS, SOUTH_SHOULDERS = (4, 5, 6, 7, 8, 9), (10, 3)
ALL_TIME = 13


def synoptic(obs: DataFrame, by: Sequence[str] = ("y", "x")) -> DataFrame:
    """mean, sd and n of each cell over all dates."""
    return obs.groupBy(*by).agg(F.avg("value").alias("mean"), F.stddev_samp("value").alias("sd"), F.count("value").alias("n"))


def stats13(obs: DataFrame, month: Column) -> DataFrame:
    """band (month, or 13 for all time), y, x, mean, sd, n."""
    both = obs.withColumn("band", F.explode(F.array(month.cast("int"), F.lit(ALL_TIME))))
    return both.groupBy("band", "y", "x").agg(F.avg("value").alias("mean"), F.stddev_samp("value").alias("sd"), F.count("value").alias("n"))


def month_or_all(monthly: DataFrame, synoptic_stats: DataFrame) -> DataFrame:
    """month, y, x, mean, sd: of the month where there is one, else of all time."""
    s = synoptic_stats.select("y", "x", F.col("mean").alias("mean_all"), F.col("sd").alias("sd_all"))
    return monthly.join(s, ["y", "x"], "left").select("month", "y", "x", F.coalesce("mean", "mean_all").alias("mean"), F.coalesce("sd", "sd_all").alias("sd"))


def merged(groups: Column) -> Column:
    """mean, sd, n of all members of an array of groups' (mean, sd, n): merged one after another as (n, mean, sum of squares about
    it), which cancels nothing. No members: NULL, NULL, 0."""
    real = F.filter(groups, lambda g: F.coalesce(g["n"], F.lit(0)) > 0)
    whole = lambda n, mean, m2: F.struct(n.cast("double").alias("n"), mean.cast("double").alias("mean"), m2.cast("double").alias("m2"))

    def add(a: Column, g: Column) -> Column:
        n, d = a["n"] + g["n"], g["mean"] - a["mean"]
        inner = F.when(g["n"] > 1, g["sd"] * g["sd"] * (g["n"] - 1)).otherwise(0.0)
        return whole(n, a["mean"] + d * g["n"] / n, a["m2"] + inner + d * d * a["n"] * g["n"] / n)

    def finish(a: Column) -> Column:
        n = a["n"]
        return F.struct(F.when(n > 0, a["mean"]).alias("mean"), F.when(n > 1, F.sqrt(F.greatest(F.lit(0.0), a["m2"]) / (n - 1))).alias("sd"), n.cast("long").alias("n"))

    return F.aggregate(real, whole(F.lit(0.0), F.lit(0.0), F.lit(0.0)), add, finish)


def grand_stats(groups: DataFrame, by: Sequence[str] = ("y", "x")) -> DataFrame:
    """mean, sd, n of all members, from groups' mean, sd, n. A cell's groups, such as its months, are one array: one shuffle."""
    rows = groups.groupBy(*by).agg(F.array_sort(F.collect_list(F.struct("mean", "sd", F.col("n").cast("double").alias("n")))).alias("_groups"))
    return rows.select(*by, merged(F.col("_groups")).alias("_all")).select(*by, "_all.mean", "_all.sd", "_all.n")


def occlusion(hillshade: DataFrame, north_below: int, south_from: int, threshold: int = 120) -> DataFrame:
    """y, x, occluded: the north layer's shade in the north, the south layer's in the south, none between."""
    shade = F.when(F.col("y") < north_below, F.col("north") < threshold).when(F.col("y") >= south_from, F.col("south") < threshold).otherwise(F.lit(False))
    return hillshade.select("y", "x", shade.cast("int").alias("occluded"))


def _spread(bits: Column, times: int) -> Column:
    """What a row of 64 cells, as bits, gives along the row within `times` cells: (step to the chunk, its bits), zeros left out."""
    inside, after, before = bits, F.lit(0).cast("long"), F.lit(0).cast("long")
    for k in range(1, times + 1):
        inside = inside.bitwiseOR(F.shiftleft(bits, k)).bitwiseOR(F.shiftrightunsigned(bits, k))
        after, before = after.bitwiseOR(F.shiftrightunsigned(bits, 64 - k)), before.bitwiseOR(F.shiftleft(bits, 64 - k))
    parts = F.array(*[F.struct(F.lit(step).cast("long").alias("step"), b.alias("bits")) for step, b in ((0, inside), (1, after), (-1, before))])
    return F.filter(parts, lambda p: p["bits"] != 0)


def dilate8(mask: DataFrame, value: str = "occluded", times: int = 1) -> DataFrame:
    """mask (y, x from 0) with its ones grown to their eight neighbours, `times` times.

    The square is separable. 64 cells of a row are the bits of one number; along the row it grows by shifts, what leaves it goes to
    the chunks beside it, and each of these goes to 2 * times + 1 rows: one or two numbers a row in place of (2 * times + 1)^2
    cells for each one. Cells meet their chunk's number at the end.
    """
    if times > 63:
        return dilate8(dilate8(mask, value, 63), value, times - 63)
    chunk = F.shiftright(F.col("x").cast("long"), 6).alias("chunk")
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("x").cast("int").bitwiseAND(63))
    rows = mask.where(F.col(value) != 0).groupBy(F.col("y").cast("long").alias("y"), chunk).agg(F.bit_or(bit).alias("bits"))
    grown = rows.select("y", "chunk", F.explode(_spread(F.col("bits"), times)).alias("p")).select(F.explode(F.sequence(F.col("y") - times, F.col("y") + times)).alias("y"), (F.col("chunk") + F.col("p.step")).alias("chunk"), "p.bits")
    grown = grown.groupBy(F.col("y").alias("_y"), F.col("chunk").alias("_chunk")).agg(F.bit_or("bits").alias("_bits"))
    met = mask.join(grown, (F.col("y") == F.col("_y")) & (F.shiftright(F.col("x").cast("long"), 6) == F.col("_chunk")), "left")
    hit = F.call_function("shiftrightunsigned", F.coalesce("_bits", F.lit(0).cast("long")), F.col("x").cast("int").bitwiseAND(63)).bitwiseAND(F.lit(1).cast("long"))
    return met.withColumn(value, hit.cast("int")).drop("_y", "_chunk", "_bits")


def _of(bands: Column, month: int) -> Column:
    """The struct of a month; NULL where the cell has no such band."""
    return F.try_element_at(F.filter(bands, lambda b: b["band"] == month), F.lit(1))


def _threshold(bands: Column, months: Sequence[int]) -> Column:
    """mean, sd, n and source month that a cell's months are held to: of the earlier-listed of two shoulder months with the
    smaller mean; NULL means count as larger."""
    a, b = (_of(bands, m) for m in months)
    none = F.struct(F.lit(0.0).alias("mean"), F.lit(0.0).alias("sd"), F.lit(0).cast("long").alias("n"), F.lit(-13).alias("source"))
    take = lambda s, source: F.struct(s["mean"].alias("mean"), s["sd"].alias("sd"), s["n"].cast("long").alias("n"), F.lit(source).alias("source"))
    am, bm = a["mean"], b["mean"]
    return F.when(am.isNull() & bm.isNull(), none).when(bm.isNull() | (am < bm), take(a, months[0])).when(am.isNull() | (bm < am), take(b, months[1])).otherwise(take(a, 13))


def winter_min_cut(bands: DataFrame, occluded: DataFrame, north_to: int, south_from: int) -> DataFrame:
    """bands (band, y, x, mean, sd, n) with winter months of occluded cells held to the lower shoulder month; `source`
    is the month a replaced row came from (13: both alike, -13: neither known), else 0. Rows y <= north_to use April and
    September, rows y >= south_from October and March. Band 13 of a changed cell is recomputed from its months.

    A cell with its bands and its shade is one row, made by one shuffle; all else happens within it."""
    band = F.struct("band", "mean", "sd", F.col("n").cast("long").alias("n"))
    both = bands.select("y", "x", band.alias("b"), F.lit(None).cast("boolean").alias("d")).unionByName(occluded.select("y", "x", F.lit(None).cast(bands.select(band.alias("b")).schema["b"].dataType).alias("b"), (F.col("occluded") != 0).alias("d")))
    cells = both.groupBy("y", "x").agg(F.array_sort(F.collect_list("b")).alias("bands"), F.coalesce(F.max("d"), F.lit(False)).alias("dark")).where(F.size("bands") > 0)
    north, south = F.col("dark") & (F.col("y") <= north_to), F.col("dark") & (F.col("y") > north_to) & (F.col("y") >= south_from)
    cells = cells.withColumn("_to", F.when(north, _threshold(F.col("bands"), NORTH_SHOULDERS)).when(south, _threshold(F.col("bands"), SOUTH_SHOULDERS)))
    cells = cells.withColumn("_months", F.when(north, F.array(*map(F.lit, NORTH_MONTHS))).when(south, F.array(*map(F.lit, SOUTH_MONTHS))))

    def cut(b: Column) -> Column:
        over = F.coalesce(F.array_contains("_months", b["band"]) & (b["mean"] > F.col("_to.mean")), F.lit(False))
        new = [F.when(over, F.col(f"_to.{c}")).otherwise(b[c]).alias(c) for c in ("mean", "sd", "n")]
        return F.struct(b["band"].alias("band"), *new, F.when(over, F.col("_to.source")).otherwise(0).alias("source"))

    cells = cells.select("y", "x", F.transform("bands", cut).alias("bands"))
    months = F.filter("bands", lambda b: b["band"] != ALL_TIME)
    again = F.when(F.exists(months, lambda b: b["source"] != 0), merged(months))
    rows = cells.withColumn("_all", again).select("y", "x", "_all", F.explode("bands").alias("b"))
    use = (F.col("b.band") == ALL_TIME) & F.col("_all").isNotNull()
    return rows.select("b.band", "y", "x", *[F.when(use, F.col(f"_all.{c}")).otherwise(F.col(f"b.{c}")).alias(c) for c in ("mean", "sd", "n")], "b.source")
