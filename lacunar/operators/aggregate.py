"""Monthly and annual images, differences and run counters."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from lacunar.functions import flags as fl
from lacunar.functions.calendar import doy_months
from lacunar.operators.grid import meet


def filled_percent() -> Column:
    """Share of cells with any fill flag, in percent; every cell counts, ocean too."""
    return (100 * F.avg(F.when(fl.any_of(F.col("flags"), fl.ANY_FILL), 1.0).otherwise(0.0))).alias("filled_percent")


def with_month(df: DataFrame) -> DataFrame:
    return df.join(F.broadcast(doy_months(df.sparkSession)), "doy")


def monthly_mean(df: DataFrame) -> DataFrame:
    """year, month, y, x, value: mean of the composites that have one."""
    return with_month(df).groupBy("year", "month", "y", "x").agg(F.avg("value").alias("value"))


def annual_mean(df: DataFrame) -> DataFrame:
    """year, y, x, value: mean over composites, not over months."""
    return df.groupBy("year", "y", "x").agg(F.avg("value").alias("value"))


def fill_proportion(df: DataFrame, by: Sequence[str] = ("year", "month")) -> DataFrame:
    """Mean and filled percent of each cell, by month or (without `month`) year."""
    return (with_month(df) if "month" in by else df).groupBy(*by, "y", "x").agg(F.avg("value").alias("value"), filled_percent())


def month_and_year(df: DataFrame) -> DataFrame:
    """Months and years (month 0) from one pass over the composites."""
    df = with_month(df)
    sets = [[df["year"], df["month"], df["y"], df["x"]], [df["year"], df["y"], df["x"]]]
    both = df.groupingSets(sets, "year", "month", "y", "x").agg(F.avg("value").alias("value"), filled_percent())
    return both.withColumn("month", F.coalesce("month", F.lit(0)))


def difference(day: DataFrame, night: DataFrame, by: Sequence[str] = ("year", "doy")) -> DataFrame:
    """day minus night of the dates that both have; NULL where either is."""
    n = night.select(*by, "y", "x", F.col("value").alias("_night"))
    return meet(day.select(*by, "y", "x", F.col("value").alias("_day")), n, [*by, "y", "x"]).select(*by, "y", "x", (F.col("_day") - F.col("_night")).alias("value"))


def _bits() -> dict[str, Column]:
    f = F.col("flags")
    return {"cells": F.count("*"), "ocean": F.count_if(fl.has(f, fl.OCEAN)), "extreme": F.count_if(fl.has(f, fl.EXTREME)), "speckle": F.count_if(fl.has(f, fl.SPECKLE))}


def _pairs() -> dict[str, Column]:
    f, n = F.col("flags"), F.col("n_pairs")
    return {
        "gaps": F.count(n), "full": F.count_if(fl.has(f, fl.A1_FULL)), "partial": F.count_if(fl.has(f, fl.A1_FILLED) & ~fl.has(f, fl.A1_FULL)),
        "insufficient": F.count_if((n > 0) & ~fl.has(f, fl.A1_FILLED)), "none": F.count_if(n == 0), "pairs": F.sum(n),
    }


def _smeared() -> dict[str, Column]:
    f = F.col("flags")
    return {"filled": F.count_if(fl.has(f, fl.A2_FILLED)), "left": F.count_if(fl.has(f, fl.FAILURE)), "clipped": F.count_if(fl.has(f, fl.CLIPPED))}


def _named(columns: dict[str, Column]) -> list[Column]:
    return [c.alias(n) for n, c in columns.items()]


def despeckle_counts(df: DataFrame, by: Sequence[str] = ("year",)) -> DataFrame:
    """Counters of a despeckled stack."""
    f = F.col("flags")
    more = {"never": F.count_if(fl.has(f, fl.FAILURE)), "good": F.count_if(F.col("value").isNotNull()), "gaps": F.count_if(F.col("value").isNull() & ~fl.any_of(f, fl.OCEAN | fl.FAILURE))}
    return df.groupBy(*by).agg(*_named(_bits() | more))


def a1_counts(filled: DataFrame, by: Sequence[str] = ("year",)) -> DataFrame:
    """Counters of an A1 result with n_pairs. gaps = full + partial + insufficient + none."""
    return filled.groupBy(*by).agg(F.count("*").alias("cells"), *_named(_pairs()))


def a2_counts(df: DataFrame, by: Sequence[str] = ("year",)) -> DataFrame:
    return df.groupBy(*by).agg(*_named(_smeared()))


class Counters:
    """Counters of a run, taken while its tables are written: no scan and no job of their own. `get` has them once that is done."""

    def __init__(self) -> None:
        self.seen: dict[str, Observation] = {}

    def _watch(self, df: DataFrame, name: str, columns: dict[str, Column]) -> DataFrame:
        self.seen[name] = Observation()
        return df.observe(self.seen[name], *_named(columns))

    def a1(self, filled: DataFrame) -> DataFrame:
        """filled, as A1 leaves it (with n_pairs); flags of the masks and of the despeckle are on it, too."""
        return self._watch(filled, "a1", _bits() | _pairs())

    def a2(self, done: DataFrame) -> DataFrame:
        return self._watch(done, "a2", _smeared())

    def get(self) -> dict[str, dict[str, int]]:
        return {name: {k: int(v or 0) for k, v in o.get.items()} for name, o in self.seen.items()}


def cleared_counts(classified: DataFrame, despeckled: DataFrame, by: Sequence[str] = ("year",)) -> DataFrame:
    """Suspects of the speckle test, and how many of them their neighbours cleared."""
    speckle = F.count_if(fl.has(F.col("flags"), fl.SPECKLE))
    left = despeckled.groupBy(*by).agg(speckle.alias("_left"))
    return classified.groupBy(*by).agg(speckle.alias("suspects")).join(left, [*by]).select(*by, "suspects", (F.col("suspects") - F.col("_left")).alias("cleared"))


def years_scanned(stack: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """How many years of a day A1 looks at, and the cells that none of them has a value for (permanent gaps)."""
    cells = stack.groupBy(*by, "y", "x").agg(F.count("value").alias("n"), F.max(fl.any_of(F.col("flags"), fl.OCEAN | fl.FAILURE)).alias("out"))
    gaps = cells.groupBy(*by).agg(F.count_if((F.col("n") == 0) & ~F.col("out")).alias("permanent_gaps"))
    years = stack.select(*by, "year").distinct().groupBy(*by).agg(F.count("*").alias("years"))
    return gaps.join(years, [*by]) if by else gaps.crossJoin(years)  # two tables of one row


def a2_pass_counts(gaps: DataFrame, passes: DataFrame, by: Sequence[str] = ("year",)) -> DataFrame:
    """by..., pass, gaps, filled: the gaps that A2 finds and how many of them each pass gives a value."""
    n = gaps.where(fl.has(F.col("flags"), fl.FAILURE) & F.col("mean").isNotNull() & ~fl.has(F.col("flags"), fl.OCEAN)).groupBy(*by).agg(F.count("*").alias("gaps"))
    every = n.withColumn("pass", F.explode(F.sequence(F.lit(0), F.lit(7))))
    filled = passes.groupBy(*by, "pass").agg(F.count("pass_value").alias("filled"))
    return every.join(filled, [*by, "pass"], "left").select(*by, "pass", "gaps", F.coalesce("filled", F.lit(0)).cast("long").alias("filled"))
