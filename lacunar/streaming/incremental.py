"""Refill the days whose images arrive."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from lacunar.config import Config
from lacunar.plans.pipeline import run
from lacunar.sources.grids import OBS


def refill(spark: SparkSession, config: Config, arrived: DataFrame, height: int | None = None, width: int | None = None) -> None:
    """Fill the images of the days in `arrived` from their earliest new year on, with all years as donors. Images are
    overwritten whole, so a batch that is run again leaves the same files."""
    first = arrived.groupBy("doy").agg(F.min("year").alias("year")).collect()  # a row a day of year, 46 at most
    for year in sorted({r["year"] for r in first}):
        days = tuple(sorted(r["doy"] for r in first if r["year"] == year))
        run(spark, replace(config, job=replace(config.job, days=days, start_year=year)), height, width)


def watch(spark: SparkSession, config: Config, checkpoint: str, height: int | None = None, width: int | None = None) -> StreamingQuery:
    """A query that refills whatever files have come to the archive since its last run, then ends."""
    stream = spark.readStream.schema(OBS).parquet(config.paths.data)
    if config.paths.variable:
        stream = stream.where(F.col("variable") == config.paths.variable)
    dates = stream.select("doy", "year")
    return dates.writeStream.foreachBatch(lambda batch, _: refill(spark, config, batch, height, width)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
