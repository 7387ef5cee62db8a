"""A1: fill a gap from the same cell in other years, adjusted by what neighbours did between the two years.

`pairs` and `fill` are relational. One aggregate makes a row of each cell: its values by position of their year, as a map, and its
gaps. A cell with gaps asks the cells at the spiral's offsets, by keys alone, and gets their rows back, which hold the values of all
years; gaps and years are paired there, behind the last shuffle. Maps hold as many values as a day has years. This suits short
searches; what is shuffled grows with cells x search, rows within tasks with gaps x years x search. For the long default search `tiles.fill_tiles` gives the same results with dense arrays, a tile a
task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lacunar.config import A1, Limits
from lacunar.functions import flags as fl
from lacunar.operators.grid import meet, with_position
from lacunar.operators.spiral import spiral_column
from lacunar.sources.scratch import materialize


def with_any_data(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """df with `any_data`: the cell has a value in some year."""
    cell = Window.partitionBy(*by, "y", "x")
    return df.withColumn("any_data", F.max(F.col("value").isNotNull()).over(cell))


def is_gap() -> Column:
    """A cell that A1 tries to fill, of rows with any_data."""
    f = F.col("flags")
    return F.col("value").isNull() & ~fl.any_of(f, fl.OCEAN | fl.FAILURE) & F.col("any_data")


def pairs(stack: DataFrame, config: A1, limits: Limits, by: Sequence[str] = (), targets: Column | None = None) -> DataFrame:
    """Pairs used for each gap, ranked (rn): by..., year, y, x, dz, k, dist, diff, fill, weight."""
    cell = [*by, "y", "x"]
    df = with_position(stack, by)
    zero = limits.absolute_zero if config.ratio else 0.0
    has = F.col("value").isNotNull()
    open_ = ~has & ~fl.any_of(F.col("flags"), fl.OCEAN | fl.FAILURE) & (F.lit(True) if targets is None else targets)
    values = F.map_from_entries(F.collect_list(F.when(has, F.struct("pos", (F.col("value") - zero).alias("v")))))
    series = df.groupBy(*cell).agg(values.alias("values"), F.collect_list(F.when(open_, F.struct("pos", "year"))).alias("gaps"))
    series = materialize(series.where(F.size("values") > 0), "a1-series")  # read for who asks, for who answers and for the pairs
    own = series.where(F.size("gaps") > 0).select(*by, F.col("y").alias("gy"), F.col("x").alias("gx"), F.col("values").alias("alts"), "gaps")
    asked = own.select(*by, "gy", "gx", F.explode(spiral_column(config.search)).alias("o"))
    asked = asked.select("*", (F.col("gy") + F.col("o.dy")).alias("y"), (F.col("gx") + F.col("o.dx")).alias("x"))
    # so many partitions, as pairs are made and ranked behind this shuffle: Spark would merge what is small before it
    spark = stack.sparkSession
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 3 * spark.sparkContext.defaultParallelism)
    near = meet(asked, series.select(*cell, F.col("values").alias("near")), cell).select(*by, "gy", "gx", "o", "near").repartition(n, *by, "gy", "gx")
    pair = meet(near, own, [*by, "gy", "gx"]).select("*", F.explode("gaps").alias("gap")).withColumn("nbr", F.try_element_at("near", F.col("gap.pos"))).where("nbr IS NOT NULL")
    both = pair.select(*by, "gy", "gx", F.col("gap.pos").alias("pos"), F.col("gap.year").alias("year"), "o", "nbr", "near", F.explode("alts").alias("alt_pos", "alt"))
    both = both.withColumn("nbr_alt", F.try_element_at("near", F.col("alt_pos"))).where("nbr_alt IS NOT NULL")
    dist = F.sqrt((F.col("o.dx") * F.col("o.dx") + F.col("o.dy") * F.col("o.dy")).cast("double"))
    if config.ratio:
        r = F.try_divide("nbr", "nbr_alt")
        diff = F.when(F.col("nbr_alt") == 0, F.lit(config.max_ratio)).otherwise(F.greatest(F.lit(1 / config.max_ratio), F.least(F.lit(config.max_ratio), r)))
        fill = F.col("alt") * F.col("diff") + zero
    else:
        diff, fill = F.col("nbr") - F.col("nbr_alt"), F.col("alt") + F.col("diff")
    out = both.select(*by, "year", F.col("gy").alias("y"), F.col("gx").alias("x"), (F.col("alt_pos") - F.col("pos")).alias("dz"), F.col("o.k").alias("k"), dist.alias("dist"), diff.alias("diff"), "alt")
    out = out.withColumn("fill", fill).withColumn("weight", (1.0 / F.abs("dz")) * (1.0 / F.col("dist"))).drop("alt")
    order = Window.partitionBy(*by, "year", "y", "x").orderBy(F.abs("dz"), F.desc("dz"), "k")
    return out.withColumn("rn", F.row_number().over(order)).where(F.col("rn") <= config.max_used)


def combine(used: DataFrame, config: A1, by: Sequence[str] = ()) -> DataFrame:
    """Weighted mean and mean distance of each gap's pairs: by..., year, y, x, n, fill_value, fill_dist.

    Trimming takes out the pairs with the smallest and the largest difference, the first of equals each; if that is one
    and the same pair it is taken out twice. Two pairs or fewer are not trimmed.
    """
    term = F.struct(F.col("diff"), F.col("rn"), (F.col("weight") * F.col("fill")).alias("wf"), F.col("weight").alias("w"), F.col("dist").alias("d"))
    least, most = F.min(term), F.max(F.struct(F.col("diff"), (-F.col("rn")).alias("nr"), (F.col("weight") * F.col("fill")).alias("wf"), F.col("weight").alias("w"), F.col("dist").alias("d")))
    g = used.groupBy(*by, "year", "y", "x").agg(F.count("*").alias("n"), F.sum(F.col("weight") * F.col("fill")).alias("swf"), F.sum("weight").alias("sw"), F.sum("dist").alias("sd_"), least.alias("lo"), most.alias("hi"))
    trim = (F.col("n") > 2) & F.lit(config.trim)
    cut = lambda total, part: F.col(total) - F.when(trim, F.col(f"lo.{part}") + F.col(f"hi.{part}")).otherwise(0.0)
    return g.select(*by, "year", "y", "x", "n", (cut("swf", "wf") / cut("sw", "w")).alias("fill_value"), (cut("sd_", "d") / (F.col("n") - F.when(trim, 2).otherwise(0))).alias("fill_dist"))


def fill(stack: DataFrame, config: A1, limits: Limits, by: Sequence[str] = (), targets: Column | None = None) -> DataFrame:
    """stack (..., year, y, x, value, flags) with filled values, dist, flags and n_pairs.

    A cell without data in any year gets flag 2 alone. Rows that are no targets keep what they have.
    """
    keys = [*by, "year", "y", "x"]
    stack = materialize(stack, "a1-stack")  # read for the dates, for the cells' rows and for the result
    got = combine(pairs(stack, config, limits, by, targets), config, by)
    goal = F.lit(True) if targets is None else targets
    df = meet(with_any_data(stack, by), got, keys, "left").withColumn("_gap", is_gap() & goal)
    enough = F.col("_gap") & (F.coalesce("n", F.lit(0)) >= config.min_used)
    f = F.col("flags")
    dead = F.col("value").isNull() & ~fl.any_of(f, fl.OCEAN | fl.FAILURE) & ~F.col("any_data") & goal
    flags = (
        F.when(enough, fl.put(f, fl.A1_FILLED).bitwiseOR(F.when(F.col("n") == config.max_used, fl.A1_FULL).otherwise(0)).cast("short"))
        .when(F.col("_gap"), fl.put(f, fl.FAILURE)).when(dead, F.lit(fl.FAILURE).cast("short")).otherwise(f)
    )
    df = df.withColumn("flags", flags).withColumn("value", F.when(enough, F.col("fill_value")).otherwise(F.col("value"))).withColumn("dist", F.when(enough, F.col("fill_dist")))
    return df.withColumn("n_pairs", F.when(F.col("_gap"), F.coalesce("n", F.lit(0)))).drop("_gap", "any_data", "n", "fill_value", "fill_dist")
