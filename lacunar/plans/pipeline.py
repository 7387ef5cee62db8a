"""The whole fill: masks and limits, despeckle, A1, clip, A2, clip."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lacunar.config import Config
from lacunar.functions import flags as fl
from lacunar.operators import despeckle, fill_a1, fill_a2, tiles
from lacunar.operators.aggregate import Counters
from lacunar.operators.clip import clip
from lacunar.operators.grid import RESOLUTION, clipped_transform, complete, is_target, on_days, pixel_limits, shape, tile_size, within
from lacunar.operators.spiral import halo
from lacunar.operators.stats import month_or_all
from lacunar.sources import geotiff, raster
from lacunar.sources.grids import file_date, no_data, read_obs, wrong_no_data
from lacunar.sources.scratch import materialize, scope
from lacunar.sources.sinks import write_images

SHORT_SEARCH = 64  # neighbours; longer searches go by tiles of dense arrays


def fill(grid: DataFrame, stats: DataFrame, mask: DataFrame, config: Config, by: Sequence[str] = (), counters: Counters | None = None) -> DataFrame:
    """by..., year, y, x, value, dist, flags of a complete grid (by..., year, y, x, value), from the start year on. `counters`
    takes the run's counters while its tables are written."""
    keys = [*by, "year"]
    start = config.job.start_year
    marked = despeckle.classify(grid, stats, mask, config.limits, config.despeckle)
    if max(config.despeckle.search, config.a1.search) <= SHORT_SEARCH:
        clean = despeckle.despeckle(marked, config.despeckle, keys)
        filled = fill_a1.fill(clean, config.a1, config.limits, by, is_target(start))
    else:
        filled = tiles.fill_tiles(marked, config.despeckle, config.a1, config.limits, by, start, config.job.tile)
    filled = filled.where(is_target(start))
    if config.job.clip:
        filled = clip(filled, config.limits, fl.A1_FILLED)
    filled = counters.a1(filled) if counters else filled
    filled = materialize(filled.select(*keys, "y", "x", "value", "flags", "dist", "mean", "sd"), "a1")
    if config.job.run_a2:
        chosen = F.col("year").isin(*config.job.a2_years) if config.job.a2_years else F.lit(True)
        others = filled.where(~chosen)
        filled = fill_a2.fill(filled.where(chosen), config.a2, config.limits, keys)
        if config.job.clip:
            filled = clip(filled, config.limits, fl.A2_FILLED)
        filled = filled.unionByName(others)
    filled = filled.select(*keys, "y", "x", "value", "dist", "flags")
    return counters.a2(filled) if counters else filled


def is_raster(path: str) -> bool:
    return path.lower().endswith((".tif", ".tiff"))


def reference(spark: SparkSession, config: Config) -> tuple[DataFrame, DataFrame, tuple[int, int]]:
    """(stats, mask, height and width of the mask) of a job. Mean and SD are a parquet table or two rasters; rasters of 12 or 13
    bands hold them by month, and what a month lacks is taken from the 13th band, that of all time. The mask is a parquet table
    or a raster of land (1) and ocean (0)."""
    p = config.paths
    if p.mean or p.sd:
        bands = geotiff.read_meta(spark, p.mean).agg(F.max("bands")).first()[0]
        by = ["y", "x"] if bands == 1 else ["band", "y", "x"]
        layer = lambda path, name: raster.read(spark, path).select(*by, F.col("value").alias(name))
        stats = no_data(layer(p.mean, "mean").join(layer(p.sd, "sd"), by, "full"), config.limits, ("mean", "sd"))
        if bands > 1:
            every = stats.where("band = 13").select("y", "x", F.explode(F.sequence(F.lit(1), F.lit(12))).alias("month"))
            monthly = stats.where("band <= 12").withColumnRenamed("band", "month")
            stats = month_or_all(every.join(monthly, ["month", "y", "x"], "full"), stats.where("band = 13"))
    else:
        stats = no_data(spark.read.parquet(p.stats), config.limits, ("mean", "sd"))
    if is_raster(p.mask):
        size = geotiff.read_meta(spark, p.mask).agg(F.max("height"), F.max("width")).first()
        return stats, raster.read_band(spark, p.mask, "land").withColumn("land", F.col("land").cast("int")), (size[0], size[1])
    mask = spark.read.parquet(p.mask)
    return stats, mask, shape(mask)


def observed(spark: SparkSession, config: Config) -> tuple[DataFrame, DataFrame, list[float]]:
    """(cells of the days to fill, their dates, transform) of a job's archive. Of rasters the names tell the dates and only the files
    of those days are opened; a file whose no-data value isn't the configured one, or that has none, is refused."""
    p, days = config.paths, config.job.days
    transform = [-180.0, RESOLUTION, 0.0, 90.0, 0.0, -RESOLUTION]
    if not is_raster(p.data):
        obs = on_days(read_obs(spark, p.data, p.variable or None), days)
        return obs, obs.select("doy", "year").distinct(), transform
    meta = materialize(geotiff.read_meta(spark, p.data, days), "meta")
    if wrong := wrong_no_data(meta, config.limits).limit(5).collect():
        raise ValueError(f"no-data values differ from {config.limits.ndv}: {[r['path'] for r in wrong]}")
    first = meta.select("gx", "sx", "rx", "gy", "ry", "sy").first()
    dates = meta.select(*[c.alias(n) for n, c in file_date(F.col("path")).items()]).distinct()
    return on_days(raster.read_archive(spark, p.data, p.variable or "data"), days), dates, list(first) if first else transform


def run(spark: SparkSession, config: Config, height: int | None = None, width: int | None = None) -> dict[str, dict[str, int]]:
    """Read, fill and write the images of a job; days are independent of each other and share one plan. The size of the
    grid is that of the mask unless it is given. `data` is a parquet archive or a pattern of GeoTIFF files, which must
    agree on their no-data value; their transform, moved to the area, goes with what is written.

    The counters of the run come back and are written beside the output, as rows of `<output>.counters`. Scratch tables are
    deleted at the end, also of a run that fails."""
    with scope(spark):
        found = _run(spark, config, height, width)
    rows = [(config.paths.variable or "data", step, name, value) for step, each in found.items() for name, value in each.items()]
    spark.createDataFrame(rows, "variable string, step string, counter string, n long").coalesce(1).write.mode("overwrite").parquet(f"{config.paths.output.rstrip('/')}.counters")
    return found


def _run(spark: SparkSession, config: Config, height: int | None, width: int | None) -> dict[str, dict[str, int]]:
    p, job = config.paths, config.job
    obs, dates, transform = observed(spark, config)
    stats, mask, size = reference(spark, config)
    height, width = size[0] if height is None else height, size[1] if width is None else width
    box, y0, x0 = None, 0, 0
    if None not in (job.north, job.south, job.west, job.east):
        box = pixel_limits(job.north, job.south, job.west, job.east, transform[1], transform[3], transform[0])
        stats, mask = (within(d, *box) for d in (stats, mask))
        y0, x0 = max(0, box[0]), max(0, box[2])
    grid = complete(no_data(obs, config.limits).drop("variable"), height, width, ("doy", "year"), box, dates)
    if box:
        height, width = min(height, box[1]) - y0, min(width, box[3]) - x0
    if job.memory:
        years = dates.select("year").distinct().count()
        margin = halo(config.despeckle.search) + halo(config.a1.search)
        config = replace(config, job=replace(job, tile=tile_size(job.memory, years, margin)))
    counters = Counters()
    done = fill(grid, stats, mask, config, ("doy",), counters).withColumn("variable", F.lit(p.variable or "data"))
    if job.geotiff:
        done = done.withColumns({"y": F.col("y") - y0, "x": F.col("x") - x0})
        materialize(geotiff.write_geotiff(done, p.output, height, width, clipped_transform(transform, y0, x0), config.limits.ndv), "written")
    else:
        write_images(done, p.output, config.job.tile)
    return counters.get()
