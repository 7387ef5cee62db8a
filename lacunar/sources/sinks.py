"""Writing images as partitioned tables, and their names."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

FILE = 2048  # cells of a file's side
KINDS = {"FilledData": ("value", "float"), "FilledDists": ("dist", "float"), "FillFlags": ("flags", "short")}


def output_name(tag: str, kind: str, year: Column, doy: Column, rest: str = "Data.1km.Data") -> Column:
    """File-style name of an output image."""
    return F.format_string(f"{tag}-{kind}.%d.%03d.{rest}", year, doy)


def write_images(df: DataFrame, path: str, tile: int = 256, mode: str = "overwrite") -> None:
    """value, dist and flags by (variable, doy, year). An image is written by a task for each FILE x FILE cells of it, in
    tile order, so that windows skip files and row groups."""
    out = df.select("variable", "doy", "year", "y", "x", F.col("value").cast("float").alias("value"), F.col("dist").cast("float").alias("dist"), F.col("flags").cast("short").alias("flags"))
    ty, tx = F.floor(F.col("y") / tile), F.floor(F.col("x") / tile)
    fy, fx = F.floor(F.col("y") / FILE), F.floor(F.col("x") / FILE)
    out = out.repartition("variable", "doy", "year", fy, fx).sortWithinPartitions("variable", "doy", "year", fy, fx, ty, tx, "y", "x")
    out.write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy("variable", "doy", "year").parquet(path)


def write_differences(df: DataFrame, path: str, ndv: float = -9999.0) -> None:
    """Day minus night (year, doy, y, x, value) by date, named as the images are; NULL, where either is, as the no-data value."""
    out = df.select("year", "doy", "y", "x", F.coalesce("value", F.lit(ndv)).cast("float").alias("value"), output_name("LST", "DayMinusNight", F.col("year"), F.col("doy")).alias("name"))
    out.repartition("year", "doy", F.floor(F.col("y") / FILE), F.floor(F.col("x") / FILE)).write.mode("overwrite").partitionBy("year", "doy").parquet(path)


def write_aggregate(df: DataFrame, path: str) -> None:
    """Monthly or annual images; the filled percent as a whole number of one byte."""
    out = df.withColumn("value", F.col("value").cast("float")).withColumn("filled_percent", F.col("filled_percent").cast("tinyint"))
    out.write.mode("overwrite").partitionBy("year").parquet(path)


def write_bands(df: DataFrame, path: str) -> None:
    """13-band statistics, a folder a band; with the source of each cell, if df tells it."""
    more = [F.col("source").cast("short").alias("source")] if "source" in df.columns else []
    out = df.select("band", "y", "x", F.col("mean").cast("float").alias("mean"), F.col("sd").cast("float").alias("sd"), F.col("n").cast("int").alias("n"), *more)
    out.write.mode("overwrite").partitionBy("band").parquet(path)


def read_bands(spark: SparkSession, path: str, bands: Sequence[int] = ()) -> DataFrame:
    """What write_bands wrote; other bands than those asked for are not read."""
    df = spark.read.parquet(path)
    return df.where(F.col("band").isin(*bands)) if bands else df
