"""Products from files to files: python -m lacunar.plans.products means|difference|winter ...

means: monthly and annual images with the share of filled cells, from the images of a run.
difference: day minus night of the dates that two archives share.
winter: statistics of 13 bands (mean, SD and n, as rasters of bands) with the winter months of shaded cells held to the shoulder
months, from two rasters of shade; written as rasters of bands, with the month that each cell came from.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lacunar.operators import aggregate, stats
from lacunar.operators.grid import meet
from lacunar.plans.pipeline import is_raster
from lacunar.sources import geotiff, raster
from lacunar.sources.grids import read_obs
from lacunar.sources.scratch import materialize, scope
from lacunar.sources.sinks import write_aggregate, write_differences

BANDS = 13


def _archive(spark: SparkSession, path: str) -> DataFrame:
    return raster.read_archive(spark, path) if is_raster(path) else read_obs(spark, path)


def means(spark: SparkSession, images: str, output: str) -> None:
    """Months and years (month 0) of a run's images (value, flags by variable, doy and year), in a folder a year."""
    write_aggregate(aggregate.month_and_year(spark.read.parquet(images).select("year", "doy", "y", "x", "value", "flags")), output)


def difference(spark: SparkSession, day: str, night: str, output: str, ndv: float = -9999.0) -> None:
    """Cells where both archives have a value; where only one has, the no-data value."""
    images = [_archive(spark, p).select("year", "doy", "y", "x", "value") for p in (day, night)]
    dates = images[0].select("year", "doy").distinct().join(images[1].select("year", "doy").distinct(), ["year", "doy"])
    cells = images[0].unionByName(images[1]).select("year", "doy", "y", "x").distinct().join(F.broadcast(dates), ["year", "doy"])  # a row an image
    whole = [meet(cells, i, ["year", "doy", "y", "x"], "left") for i in images]
    write_differences(aggregate.difference(*whole), output, ndv)


def winter(spark: SparkSession, mean: str, sd: str, n: str, north: str, south: str, output: str, north_to: int, south_from: int, threshold: int = 120) -> None:
    """The rows y <= north_to are the north, y >= south_from the south."""
    with scope(spark):
        meta = geotiff.read_meta(spark, mean).first()
        layer = lambda path, name: raster.read(spark, path).select("band", "y", "x", F.col("value").alias(name))
        bands = layer(mean, "mean").join(layer(sd, "sd"), ["band", "y", "x"], "full").join(layer(n, "n"), ["band", "y", "x"], "full").withColumn("n", F.coalesce("n", F.lit(0)).cast("long"))
        shade = raster.read_band(spark, north, "north").join(raster.read_band(spark, south, "south"), ["y", "x"], "full")
        cut = materialize(stats.winter_min_cut(bands, stats.occlusion(shade, north_to + 1, south_from, threshold), north_to, south_from), "winter")
        transform = [meta[c] for c in ("gx", "sx", "rx", "gy", "ry", "sy")]
        for name in ("mean", "sd", "n", "source"):
            materialize(geotiff.write_bands_geotiff(cut, output, name, name, BANDS, meta["height"], meta["width"], transform), f"winter-{name}")


def main(args: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(description=__doc__.split("\n")[0])
    kinds = parser.add_subparsers(dest="kind", required=True)
    for kind, needed in (("means", ("images", "output")), ("difference", ("day", "night", "output")), ("winter", ("mean", "sd", "n", "north", "south", "output"))):
        one = kinds.add_parser(kind)
        for name in needed:
            one.add_argument(f"--{name}", required=True)
        for name in ("north-to", "south-from") if kind == "winter" else ():
            one.add_argument(f"--{name}", type=int, required=True)
    got = vars(parser.parse_args(args))
    spark = SparkSession.builder.appName("lacunar").getOrCreate()
    {"means": means, "difference": difference, "winter": winter}[got.pop("kind")](spark, **got)
    return 0


if __name__ == "__main__":
    sys.exit(main())
