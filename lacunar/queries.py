"""Queries of the gap-filling engine over grids that are derived from the driver's tables, and their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lacunar.config import A1, A2, DEFAULT_LIMITS, Config, Despeckle, Job, Limits
from lacunar.functions import flags as fl
from lacunar.functions.calendar import composite_doy, doy_months
from lacunar.operators import aggregate, clip, despeckle, fill_a1, fill_a2, grid, periods, spiral, stats, tiles
from lacunar.plans import pipeline
from lacunar.sources import geotiff, grids, raster
from lacunar.sources.scratch import materialize, new_path

H, W = 30, 24
LIMITS = Limits(ceiling=48.0, floor=2.0, z=0.9, absolute_zero=-10.0)
SPECKLE = Despeckle(search=24, min_used=4, max_used=12, extreme_z=1.8, speckle_z=1.0, tolerance=0.4)
SHORT = A1(search=8, min_used=2, max_used=8, trim=False)
TRIM = A1(search=24, min_used=4, max_used=12, trim=True)
RATIO = A1(search=8, min_used=2, max_used=8, ratio=True, max_ratio=2.0, trim=False)
START = 1998


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _base(v: Column) -> Column:
    """Three digits, by a rule that no average of whole numbers lies on the edge of: alike in every engine."""
    return F.floor(v * 1000 + 0.3) / 1000


def _shape(spark: SparkSession, sf_dir: str) -> tuple[int, int]:
    """Rows and columns of the grid: H x W for up to 240,000 rows of lineitem, and as many times more each way as the root
    of every 60,000 rows."""
    times = max(1, int((_table(spark, sf_dir, "lineitem").count() / 60_000) ** 0.5))
    return H * times, W * times


def _obs(spark: SparkSession, sf_dir: str, h: int | None = None, w: int | None = None) -> DataFrame:
    """All rows of lineitem as one value a cell; planted gaps: two blocks and, by a rule on the cell, a sixth of all cells."""
    if h is None or w is None:
        h, w = _shape(spark, sf_dir)
    li = _table(spark, sf_dir, "lineitem")
    li = li.select(F.year("l_shipdate").alias("year"), (F.col("l_partkey") % h).cast("int").alias("y"), (F.col("l_suppkey") % w).cast("int").alias("x"), F.col("l_quantity").alias("q"))
    cells = li.groupBy("year", "y", "x").agg(_base(F.avg("q")).alias("value"))
    return cells.where("NOT (year <= 1997 AND x BETWEEN 8 AND 14 AND y BETWEEN 10 AND 18) AND NOT (x % 11 = 5 AND y % 7 = 3) AND (y * 7 + x * 5 + year * 3 + y * x) % 6 <> 0")


def _parts(spark: SparkSession, sf_dir: str, h: int | None = None, w: int | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(grid, stats, mask)."""
    if h is None or w is None:
        h, w = _shape(spark, sf_dir)
    obs = materialize(_obs(spark, sf_dir, h, w), "obs")  # read for the dates, for the grid and for the statistics
    s = stats.synoptic(obs).select("y", "x", F.when((F.col("x") * 5 + F.col("y")) % 41 != 0, _base(F.col("mean"))).alias("mean"), _base(F.col("sd")).alias("sd"))
    cells = spark.range(h * w).select((F.col("id") / w).cast("int").alias("y"), (F.col("id") % w).cast("int").alias("x"))
    mask = cells.withColumn("land", F.when((F.col("x") * 7 + F.col("y") * 3) % 17 == 0, 0).otherwise(1))
    return grid.complete(obs, h, w), s, mask


def _marked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return despeckle.classify(*_parts(spark, sf_dir), LIMITS, SPECKLE)


def _stack(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The plain stack that the A1 queries fill: no masks, flags 0."""
    h, w = _shape(spark, sf_dir)
    return grid.complete(_obs(spark, sf_dir, h, w), h, w).withColumn("flags", F.lit(0).cast("short"))


def _rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, 8) for c in columns})


def _times(spark: SparkSession, sf_dir: str) -> int:
    return _shape(spark, sf_dir)[0] // H


def _composites(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = _times(spark, sf_dir)
    li = _table(spark, sf_dir, "lineitem").select(F.year("l_shipdate").alias("year"), composite_doy(F.col("l_shipdate")).alias("doy"), (F.col("l_partkey") % (6 * t)).cast("int").alias("y"), (F.col("l_suppkey") % (5 * t)).cast("int").alias("x"), "l_quantity", "l_returnflag", "l_linestatus")
    flag = F.max(F.when(F.col("l_returnflag") == "R", 16).when(F.col("l_returnflag") == "A", 1).otherwise(0)).cast("short")
    return li.groupBy("year", "doy", "y", "x").agg(_base(F.avg("l_quantity")).alias("value"), flag.alias("flags"))


def _bands(spark: SparkSession, sf_dir: str, h: int = 0, w: int = 0) -> DataFrame:
    t = _times(spark, sf_dir)
    h, w = h or 12 * t, w or 10 * t
    li = _table(spark, sf_dir, "lineitem").select(F.col("l_shipdate"), (F.col("l_partkey") % h).cast("int").alias("y"), (F.col("l_suppkey") % w).cast("int").alias("x"), F.col("l_quantity").alias("value"))
    return stats.stats13(li, F.month("l_shipdate")).select("band", "y", "x", _base(F.col("mean")).alias("mean"), _base(F.col("sd")).alias("sd"), "n")


def _hillshade(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two layers of shade by a rule on the items of each cell."""
    t = _times(spark, sf_dir)
    li = _table(spark, sf_dir, "lineitem").select((F.col("l_partkey") % (12 * t)).cast("int").alias("y"), (F.col("l_suppkey") % (10 * t)).cast("int").alias("x"), F.col("l_quantity").cast("long").alias("q"), F.col("l_linenumber").cast("long").alias("n"))
    return li.groupBy("y", "x").agg((F.sum("q") % 256).alias("north"), (F.sum(F.col("q") + 37 * F.col("n")) % 256).alias("south"))


# Queries. Each takes (spark, sf_dir).


def grid_complete(spark, sf_dir):
    return _parts(spark, sf_dir)[0]


def aoi_filter(spark, sf_dir):
    y0, y1, x0, x1 = grid.pixel_limits(80, 55, -175, -150, 1.25)
    return grid.within(_parts(spark, sf_dir)[0], y0, y1, x0, x1)


def start_filter(spark, sf_dir):
    comps = _composites(spark, sf_dir)
    return grid.on_days(comps, (1, 9, 121)).where(grid.is_target(START, 9)).select("year", "doy", "y", "x", "value")


def stack_positions(spark, sf_dir):
    return grid.with_position(_obs(spark, sf_dir).where("year <> 1998")).groupBy("year", "pos").agg(F.count("*").alias("cells"))


def synoptic_stats(spark, sf_dir):
    return _rounded(stats.synoptic(_obs(spark, sf_dir)), "mean", "sd")


def monthly_stats(spark, sf_dir):
    bands = _bands(spark, sf_dir)
    months = bands.where("band <= 12 AND n > 2").withColumnRenamed("band", "month")
    every = bands.where("band = 13").select("y", "x", F.explode(F.sequence(F.lit(1), F.lit(12))).alias("month"))
    joined = every.join(months, ["month", "y", "x"], "left").select("month", "y", "x", "mean", "sd")
    return stats.month_or_all(joined, bands.where("band = 13"))


def limits_lookup(spark, sf_dir):
    names = _table(spark, sf_dir, "region").select(F.concat(F.lit("MOD_"), F.element_at(F.array(*map(F.lit, ("LST", "evi", "tcb", "TCW", "lst_evi"))), F.col("r_regionkey") + 1), F.lit("_Day.tif")).alias("name"))
    rows = spark.createDataFrame([(k, v.ceiling, v.floor) for k, v in DEFAULT_LIMITS.items()], "variable string, ceiling double, floor double")
    hits = names.join(F.broadcast(rows), F.upper("name").contains(F.col("variable")))
    only = hits.groupBy("name").agg(F.count("*").alias("n"), F.first("variable").alias("variable"), F.first("ceiling").alias("ceiling"), F.first("floor").alias("floor"))
    return only.where("n = 1").drop("n")


def filename_parse(spark, sf_dir):
    o = _table(spark, sf_dir, "orders")
    day = F.lpad(F.dayofyear("o_orderdate").cast("string"), 3, "0")
    old = F.concat(F.lit("/in/A"), F.year("o_orderdate").cast("string"), day, F.lit("_Filled_Data.tif"))
    new = F.concat(F.lit("/in/LST."), F.year("o_orderdate").cast("string"), F.lit("."), day, F.lit(".mean.1km.mean.tif"))
    paths = o.select("o_orderkey", F.when(F.col("o_orderkey") % 2 == 0, old).otherwise(new).alias("path"))
    return paths.select("o_orderkey", grids.night_name(grids.base_name(F.col("path"))).alias("name"), *[c.alias(n) for n, c in grids.file_date(F.col("path")).items()])


def doy_month_dim(spark, sf_dir):
    """Orders by the composite that their date falls into, with its month."""
    o = _table(spark, sf_dir, "orders").groupBy(composite_doy(F.col("o_orderdate")).alias("doy")).agg(F.count("*").alias("orders"))
    return o.join(F.broadcast(doy_months(spark)), "doy").select("doy", "month", "orders")


def ndv_to_null(spark, sf_dir):
    li = _table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.when(F.col("l_quantity") > 40, -9999.0).otherwise(F.col("l_quantity")).alias("value"))
    return grids.no_data(li, LIMITS).groupBy("l_linenumber").agg(F.count("*").alias("cells"), F.count("value").alias("present"))


def ocean_neverdata_flags(spark, sf_dir):
    return _marked(spark, sf_dir).select("year", "y", "x", fl.has(F.col("flags"), fl.OCEAN).alias("ocean"), fl.has(F.col("flags"), fl.FAILURE).alias("never"), F.col("value").isNotNull().alias("present"))


def extreme_flags(spark, sf_dir):
    return _marked(spark, sf_dir).where(fl.any_of(F.col("flags"), fl.EXTREME | fl.SPECKLE)).select("year", "y", "x", F.col("flags").cast("int").alias("flags"), "value")


def extreme_offset(spark, sf_dir):
    """Values and means moved by a correction offset before they are tested."""
    marked = despeckle.classify(*_parts(spark, sf_dir), replace(LIMITS, offset=1.5), SPECKLE)
    return _rounded(marked.select("year", "y", "x", F.col("flags").cast("int").alias("flags"), "value", "mean", "z"), "value", "mean", "z")


def zscore(spark, sf_dir):
    return _rounded(_marked(spark, sf_dir).where("z IS NOT NULL").select("year", "y", "x", "z"), "z")


def spiral_offsets(spark, sf_dir):
    """Items by the neighbour that their part names, in the order of the search."""
    items = _table(spark, sf_dir, "lineitem").groupBy((F.col("l_partkey") % 60 + 1).cast("int").alias("k")).agg(F.count("*").alias("items"))
    return _rounded(items.join(F.broadcast(spiral.spiral_table(spark, 60)), "k").select("k", "dx", "dy", "dist", "items"), "dist")


def despeckle_stack(spark, sf_dir):
    return despeckle.despeckle(_marked(spark, sf_dir), SPECKLE).select("year", "y", "x", "value", F.col("flags").cast("int").alias("flags"))


def despeckle_counts(spark, sf_dir):
    return aggregate.despeckle_counts(despeckle.despeckle(_marked(spark, sf_dir), SPECKLE))


def known_unfillable(spark, sf_dir):
    return fill_a1.with_any_data(_stack(spark, sf_dir)).where("NOT any_data").select("y", "x").distinct()


def a1_pairs(spark, sf_dir):
    p = fill_a1.pairs(_stack(spark, sf_dir), SHORT, LIMITS)
    return _rounded(p.select("year", "y", "x", F.col("rn").cast("int").alias("rn"), F.col("dz").cast("int").alias("dz"), "k", "dist", "diff", "fill", "weight"), "dist", "diff", "fill", "weight")


def _filled(df: DataFrame) -> DataFrame:
    return _rounded(df.select("year", "y", "x", "value", "dist", F.col("flags").cast("int").alias("flags")), "value", "dist")


def a1_fill_diff(spark, sf_dir):
    return _filled(fill_a1.fill(_stack(spark, sf_dir), SHORT, LIMITS))


def a1_fill_trim(spark, sf_dir):
    return _filled(fill_a1.fill(_stack(spark, sf_dir), TRIM, LIMITS))


def a1_fill_ratio(spark, sf_dir):
    return _filled(fill_a1.fill(_stack(spark, sf_dir), RATIO, LIMITS))


def a1_start_year(spark, sf_dir):
    return _filled(fill_a1.fill(_stack(spark, sf_dir), SHORT, LIMITS, targets=grid.is_target(START)).where(grid.is_target(START)))


def a1_fill_tiles(spark, sf_dir):
    plain = _stack(spark, sf_dir).withColumns({c: F.lit(None).cast("double") for c in ("mean", "sd", "z")})
    return _filled(tiles.fill_tiles(plain, SPECKLE, TRIM, LIMITS, tile=12))


def a1_fill_default(spark, sf_dir):
    """The default search of 3,142 neighbours."""
    plain = _stack(spark, sf_dir).withColumns({c: F.lit(None).cast("double") for c in ("mean", "sd", "z")})
    return _filled(tiles.fill_tiles(plain, SPECKLE, A1(), LIMITS, tile=64))


def despeckle_default(spark, sf_dir):
    """The default search and thresholds."""
    marked = despeckle.classify(*_parts(spark, sf_dir), LIMITS, Despeckle())
    return tiles.fill_tiles(marked, Despeckle(), None, LIMITS, tile=64).select("year", "y", "x", "value", F.col("flags").cast("int").alias("flags"))


def a1_counts(spark, sf_dir):
    return aggregate.a1_counts(fill_a1.fill(_stack(spark, sf_dir), TRIM, LIMITS))


def _clipped(spark, sf_dir):
    filled = fill_a1.fill(_stack(spark, sf_dir), SHORT, LIMITS)
    return grid.meet(filled, _parts(spark, sf_dir)[1], ["y", "x"], "left")


def clip_a1(spark, sf_dir):
    return _filled(clip.clip(_clipped(spark, sf_dir), LIMITS, fl.A1_FILLED))


def clip_a2(spark, sf_dir):
    df = _clipped(spark, sf_dir).withColumn("flags", F.when(fl.has(F.col("flags"), fl.A1_FILLED) & (F.col("x") % 2 == 0), fl.put(fl.drop(F.col("flags"), fl.A1_FILLED), fl.A2_FILLED)).otherwise(F.col("flags")))
    return _filled(clip.clip(df, LIMITS, fl.A2_FILLED))


def a2_anomaly(spark, sf_dir):
    m = _marked(spark, sf_dir)
    return _rounded(m.where(~fl.has(F.col("flags"), fl.OCEAN)).select("year", "y", "x", (F.col("value") - F.col("mean")).alias("anomaly")).where("anomaly IS NOT NULL"), "anomaly")


def _left(spark, sf_dir):
    """What A1 leaves of the masked stack."""
    df = fill_a1.fill(despeckle.despeckle(_marked(spark, sf_dir), SPECKLE), SHORT, LIMITS)
    return materialize(df.select("year", "y", "x", "value", "mean", "sd", "flags", "dist"), "left")


def a2_pass(spark, sf_dir):
    return _rounded(fill_a2.pass_values(_left(spark, sf_dir), A2(), LIMITS, tile=16), "pass_value", "pass_dist")


def a2_fill(spark, sf_dir):
    return _filled(fill_a2.fill(_left(spark, sf_dir), A2(), LIMITS, tile=16))


def _passes(spark, sf_dir):
    h, w = _shape(spark, sf_dir)
    li = _table(spark, sf_dir, "lineitem")
    return li.select(F.year("l_shipdate").alias("year"), (F.col("l_partkey") % h).cast("int").alias("y"), (F.col("l_suppkey") % w).cast("int").alias("x"), F.when(F.col("l_tax") > 0.01, F.col("l_quantity")).alias("pass_value"), F.col("l_discount").alias("pass_dist"))


def a2_combine(spark, sf_dir):
    return _rounded(fill_a2.combine(_passes(spark, sf_dir)), "a2_value", "a2_dist")


def a2_combine_median(spark, sf_dir):
    return _rounded(fill_a2.combine(_passes(spark, sf_dir), average="median"), "a2_value", "a2_dist")


def _config() -> Config:
    return Config(limits=LIMITS, job=Job(start_year=1996), despeckle=SPECKLE, a1=TRIM, a2=A2())


def fill_pipeline(spark, sf_dir):
    return _filled(pipeline.fill(*_parts(spark, sf_dir), _config()))


def fill_counts(spark, sf_dir):
    return aggregate.a2_counts(pipeline.fill(*_parts(spark, sf_dir), _config()))


def monthly_mean(spark, sf_dir):
    return _rounded(aggregate.monthly_mean(_composites(spark, sf_dir)), "value")


def annual_mean(spark, sf_dir):
    return _rounded(aggregate.annual_mean(_composites(spark, sf_dir)), "value")


def fill_proportion(spark, sf_dir):
    return _rounded(aggregate.fill_proportion(_composites(spark, sf_dir)), "value", "filled_percent")


def month_and_year(spark, sf_dir):
    return _rounded(aggregate.month_and_year(_composites(spark, sf_dir)), "value", "filled_percent")


def period_state(spark, sf_dir):
    """Months and years from a state of three batches, the last one first and one of them twice."""
    comps, state = materialize(_composites(spark, sf_dir), "period-composites"), new_path(spark, "period-state")
    for batch in (2, 0, 1, 0):
        periods.put(comps.where((F.col("doy") / 8).cast("int") % 3 == batch), state, batch)
    return _rounded(periods.images(spark, state), "value", "filled_percent")


def diurnal_difference(spark, sf_dir):
    li = _table(spark, sf_dir, "lineitem").select(F.year("l_shipdate").alias("year"), F.month("l_shipdate").alias("doy"), (F.col("l_partkey") % 6).cast("int").alias("y"), (F.col("l_suppkey") % 5).cast("int").alias("x"), "l_quantity", "l_linestatus")
    image = lambda s: li.where(F.col("l_linestatus") == s).groupBy("year", "doy", "y", "x").agg(_base(F.avg("l_quantity")).alias("value"))
    return _rounded(aggregate.difference(image("O"), image("F")), "value")


def occlusion_mask(spark, sf_dir):
    t = _times(spark, sf_dir)
    return stats.occlusion(_hillshade(spark, sf_dir), 4 * t, 8 * t)


def dilate8(spark, sf_dir):
    t = _times(spark, sf_dir)
    sparse = stats.occlusion(_hillshade(spark, sf_dir), 4 * t, 8 * t, 40)
    return stats.dilate8(sparse, times=2)


def dilate_far(spark, sf_dir):
    """Ten times, over chunks of 64 cells and their neighbours, on a wide grid."""
    t = _times(spark, sf_dir)
    li = _table(spark, sf_dir, "lineitem").select((F.col("l_partkey") % (40 * t)).cast("int").alias("y"), (F.col("l_orderkey") % (200 * t)).cast("int").alias("x"), F.col("l_quantity").alias("q"))
    mask = li.groupBy("y", "x").agg(F.max(F.when(F.col("q") == 50, 1).otherwise(0)).alias("occluded")).withColumn("occluded", F.when((F.col("y") * 7 + F.col("x")) % 13 == 0, F.col("occluded")).otherwise(0))
    return stats.dilate8(mask, times=10)


def winter_min_cut(spark, sf_dir):
    t = _times(spark, sf_dir)
    return _rounded(stats.winter_min_cut(_bands(spark, sf_dir), stats.occlusion(_hillshade(spark, sf_dir), 4 * t, 8 * t, 200), 4 * t, 8 * t), "mean", "sd")


def grand_stats(spark, sf_dir):
    return _rounded(stats.grand_stats(_bands(spark, sf_dir).where("band <= 12")), "mean", "sd")


DEGREES = [-180.0, 0.25, 0.0, 90.0, 0.0, -0.25]


def raster_window(spark, sf_dir):
    """All of lineitem as an archive of daily GeoTIFF images, in tiles; two days and a window of them are read."""
    h, w = _shape(spark, sf_dir)
    li = _table(spark, sf_dir, "lineitem").select(F.year("l_shipdate").alias("year"), (F.col("l_linenumber") * 8 + 1).cast("int").alias("doy"), (F.col("l_partkey") % h).cast("int").alias("y"), (F.col("l_suppkey") % w).cast("int").alias("x"), "l_quantity")
    images = li.groupBy("year", "doy", "y", "x").agg(_base(F.avg("l_quantity")).alias("value")).withColumn("variable", F.lit("QTY"))
    folder = new_path(spark, "raster-window")
    materialize(geotiff.write_geotiff(images, folder, h, w, DEGREES, kinds={"Data": ("value", "float")}, tile=16), "written")
    read = raster.read(spark, f"{folder}/QTY/Data/*.tif", "QTY").where("doy IN (9, 25) AND y >= 5 AND y < 21 AND x BETWEEN 3 AND 11")
    return read.select("year", "doy", "y", "x", F.round("value", 3).alias("value"))


def raster_bands(spark, sf_dir):
    """Statistics of 13 bands as one file of bands in tiles; two bands and a strip of columns are read."""
    h, w = _shape(spark, sf_dir)
    folder = new_path(spark, "raster-bands")
    bands = _bands(spark, sf_dir, h, w)
    materialize(geotiff.write_bands_geotiff(bands, folder, "mean", "mean", 13, h, w, DEGREES, tile=16), "written")
    read = raster.read(spark, f"{folder}/mean.*.tif").where("band IN (7, 13) AND x >= 4 AND x < 9")
    return read.select("band", "y", "x", F.round("value", 3).alias("mean"))


def flag_decode(spark, sf_dir):
    df = clip.clip(_clipped(spark, sf_dir), LIMITS, fl.A1_FILLED)
    return df.groupBy("year").agg(*[F.count_if(c).alias(n) for n, c in fl.decode(F.col("flags")).items()])


ALL = (
    grid_complete, aoi_filter, start_filter, stack_positions, synoptic_stats, monthly_stats, limits_lookup, filename_parse, doy_month_dim, ndv_to_null, ocean_neverdata_flags, extreme_flags, extreme_offset, zscore, spiral_offsets,
    despeckle_stack, despeckle_counts, known_unfillable, a1_pairs, a1_fill_diff, a1_fill_trim, a1_fill_ratio, a1_start_year, a1_fill_tiles, a1_fill_default, despeckle_default, a1_counts, clip_a1, clip_a2, a2_anomaly, a2_pass, a2_fill, a2_combine,
    a2_combine_median, fill_pipeline, fill_counts, monthly_mean, annual_mean, fill_proportion, month_and_year, diurnal_difference, occlusion_mask, dilate8, dilate_far, period_state, winter_min_cut, grand_stats, flag_decode, raster_window, raster_bands,
)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in ALL}


def oracle_sql() -> dict[str, str]:
    from lacunar.oracles import SQL

    return SQL


def entry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fill a small stack: masks, limits, then gaps from other years."""
    g, s, m = _parts(spark, sf_dir, 20, 10)
    marked = despeckle.classify(g, s, m, LIMITS, SPECKLE)
    return _filled(fill_a1.fill(marked, SHORT, LIMITS))
