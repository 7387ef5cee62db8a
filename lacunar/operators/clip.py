"""Clamp filled values."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lacunar.config import Limits
from lacunar.functions import flags as fl


def clip(df: DataFrame, limits: Limits, checked: int) -> DataFrame:
    """df (value, flags, mean, sd, ...): rows with the flag `checked` are held within mean +- z sd and the hard limits,
    and marked when that changes them. A missing mean, sd or limit leaves its side open."""
    low = F.greatest(F.col("mean") - limits.z * F.col("sd"), F.lit(limits.floor).cast("double"))
    high = F.least(F.col("mean") + limits.z * F.col("sd"), F.lit(limits.ceiling).cast("double"))
    here = fl.has(F.col("flags"), checked) & F.col("value").isNotNull()
    v = F.col("value")
    new = F.when(here & (v < low), low).when(here & (v > high), high).otherwise(v)
    return df.withColumn("_new", new).withColumn("flags", F.when(F.col("_new") != v, fl.put(F.col("flags"), fl.CLIPPED)).otherwise(F.col("flags"))).withColumn("value", F.col("_new")).drop("_new")
