"""Masks, limits and the speckle test."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lacunar.config import Despeckle, Limits
from lacunar.functions import flags as fl
from lacunar.operators.aggregate import with_month
from lacunar.operators.grid import meet
from lacunar.operators.spiral import spiral_column
from lacunar.sources.scratch import materialize


def _outside(low: Column, high: Column, limits: Limits) -> Column:
    v = F.col("value")
    tests = [F.coalesce(v < low, F.lit(False)), F.coalesce(v > high, F.lit(False))]
    tests += [v < limits.floor] if limits.floor is not None else []
    tests += [v > limits.ceiling] if limits.ceiling is not None else []
    out = tests[0]
    for t in tests[1:]:
        out = out | t
    return out


def classify(grid: DataFrame, stats: DataFrame, mask: DataFrame, limits: Limits, config: Despeckle) -> DataFrame:
    """grid (..., year, y, x, value) with mean, sd, z and flags; values that the masks or limits reject become NULL.

    Ocean comes first, then cells without a mean, then values beyond the hard limits or extreme_z. Values beyond
    speckle_z keep their value and get the speckle flag as suspects. A zero or missing sd skips the tests that need it.
    stats are by cell or, with a column month (and grid with doy), by month and cell.
    """
    if "month" in stats.columns:  # statistics by month: each date takes those of its own
        grid, on = with_month(grid), ["month", "y", "x"]
    else:
        on = ["y", "x"]
    df = meet(meet(grid, stats, on, "left"), mask, ["y", "x"], "left").drop("month")
    df = df.withColumn("value", F.col("value") + limits.offset).withColumn("mean", F.col("mean") + limits.offset)
    sd = F.when(F.col("sd") > 0, F.col("sd"))
    beyond = lambda z: (F.col("mean") - z * sd, F.col("mean") + z * sd)
    ocean, never = F.col("land") == 0, F.col("mean").isNull()
    low, high = beyond(config.speckle_z)
    suspect = F.coalesce((F.col("value") < low) | (F.col("value") > high), F.lit(False))
    df = df.withColumn("_extreme", F.coalesce(_outside(*beyond(config.extreme_z), limits), F.lit(False)))
    flag = F.when(ocean, fl.OCEAN).when(never, fl.FAILURE).when(F.col("value").isNull(), 0).when(F.col("_extreme"), fl.EXTREME).when(suspect, fl.SPECKLE).otherwise(0)
    kept = F.when(~F.coalesce(ocean, F.lit(False)) & ~never & ~F.col("_extreme"), F.col("value"))
    df = df.withColumn("flags", flag.cast("short")).withColumn("value", kept)
    return df.withColumn("z", (F.col("value") - F.col("mean")) / sd).drop("_extreme", "land")


def despeckle(classified: DataFrame, config: Despeckle, by: Sequence[str] = ("year",)) -> DataFrame:
    """Clear suspects that resemble their neighbours; remove the others. Only suspects are searched.

    Neighbours are those of the same date with a z, suspects among them, nearest first up to max_used of `search`.
    """
    keys = [*by, "y", "x"]
    classified = materialize(classified, "classified")  # read for the suspects, for their neighbours and for the result
    suspects = classified.where(fl.has(F.col("flags"), fl.SPECKLE)).select(*keys, F.explode(spiral_column(config.search)).alias("o"))
    asked = suspects.select(*by, F.col("y").alias("sy"), F.col("x").alias("sx"), F.col("o.k").alias("k"), (F.col("y") + F.col("o.dy")).alias("y"), (F.col("x") + F.col("o.dx")).alias("x"))
    near = classified.where("z IS NOT NULL").select(*keys, "z")
    first = Window.partitionBy(*by, "sy", "sx").orderBy("k")
    found = meet(asked, near, keys).withColumn("rn", F.row_number().over(first)).where(F.col("rn") <= config.max_used)
    like = found.groupBy(*by, F.col("sy").alias("y"), F.col("sx").alias("x")).agg(F.count("*").alias("n"), F.avg("z").alias("near_z"))
    df = meet(classified, like.where(F.col("n") >= config.min_used).select(*keys, "near_z"), keys, "left")
    df = df.withColumn("clear", F.abs(F.col("near_z") - F.col("z")) < config.tolerance).drop("near_z")
    suspect = fl.has(F.col("flags"), fl.SPECKLE)
    return df.withColumn("value", F.when(~suspect | F.col("clear"), F.col("value"))).withColumn("flags", F.when(suspect & F.col("clear"), fl.drop(F.col("flags"), fl.SPECKLE)).otherwise(F.col("flags"))).drop("clear")
