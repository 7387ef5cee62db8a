"""Counters, monthly statistics, the writers of products, and a run from GeoTIFF files to GeoTIFF files."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from lacunar import config
from lacunar.config import A1, A2, Config, Despeckle, Job, Limits
from lacunar.functions import flags as fl
from lacunar.operators import aggregate, despeckle, fill_a1, fill_a2, grid, stats
from lacunar.plans import pipeline
from lacunar.sources import geotiff, grids, raster, sinks

SPECKLE = Despeckle(8, 2, 8, 9.0, 1.0, 0.5)


@pytest.fixture(scope="module")
def stack(spark):
    rng = np.random.default_rng(5)
    v = rng.integers(1, 40, (4, 9, 8)).astype(float)
    v[rng.random(v.shape) < 0.3] = np.nan
    v[:, 0, 0] = np.nan
    v[:2, 3:6, 2:6] = np.nan
    rows = [(2000 + t, 9, y, x, None if np.isnan(v[t, y, x]) else float(v[t, y, x])) for t in range(4) for y in range(9) for x in range(8)]
    return v, spark.createDataFrame(rows, "year int, doy int, y int, x int, value double")


def parts(spark, df):
    s = stats.synoptic(df).select("y", "x", "mean", "sd")
    return s, df.select("y", "x").distinct().withColumn("land", F.when(F.col("x") == 7, 0).otherwise(1))


def test_complete_makes_every_cell(spark, stack):
    v, df = stack
    got = grid.complete(df.where("value IS NOT NULL"), 9, 8, ("doy", "year"))
    assert sorted(map(tuple, got.select("year", "doy", "y", "x", "value").collect()), key=lambda r: r[:4]) == sorted(map(tuple, df.collect()), key=lambda r: r[:4])
    assert [f.dataType.simpleString() for f in got.schema] == ["int", "int", "int", "int", "double"]
    assert grid.complete(df.where("false"), 9, 8, ("doy", "year")).count() == 0


def test_counters(spark, stack):
    v, df = stack
    marked = despeckle.classify(df, *parts(spark, df), Limits(None, None), SPECKLE).cache()
    clean = despeckle.despeckle(marked, SPECKLE, ("doy", "year")).cache()
    speckle = lambda d: {r["year"]: r["n"] for r in d.groupBy("year").agg(F.count_if(fl.has(F.col("flags"), fl.SPECKLE)).alias("n")).collect()}
    before, after = speckle(marked), speckle(clean)
    assert {r["year"]: (r["suspects"], r["cleared"]) for r in aggregate.cleared_counts(marked, clean).collect()} == {y: (before[y], before[y] - after[y]) for y in before}
    (r,) = aggregate.years_scanned(clean, ("doy",)).collect()
    empty = {(x.y, x.x) for x in clean.groupBy("y", "x").agg(F.count("value").alias("n"), F.max(F.col("flags").bitwiseAND(3)).alias("f")).where("n = 0 AND f = 0").collect()}
    assert (r["years"], r["permanent_gaps"]) == (4, len(empty))
    left = fill_a1.fill(clean, A1(8, 4, 8), Limits(None, None), ("doy",)).select("year", "y", "x", "value", "mean", "flags", "dist").cache()
    passes = fill_a2.pass_values(left, A2(), Limits(None, None)).cache()
    counts = aggregate.a2_pass_counts(left, passes).collect()
    want = {(p["year"], p["pass"]): p["n"] for p in passes.groupBy("year", "pass").agg(F.count("*").alias("n")).collect()}
    assert counts and all(r["filled"] == want.get((r["year"], r["pass"]), 0) <= r["gaps"] for r in counts) and len({r["pass"] for r in counts}) == 8


def test_monthly_statistics(spark, stack):
    _, df = stack
    two = df.union(df.withColumn("doy", F.lit(129)).withColumn("value", F.col("value") + 100))
    one, mask = parts(spark, df)
    monthly = one.withColumn("month", F.lit(1)).union(one.withColumns({"mean": F.col("mean") + 100, "month": F.lit(5)}).select("y", "x", "mean", "sd", "month"))
    got = despeckle.classify(two, monthly, mask, Limits(None, None), SPECKLE)
    assert set(got.columns) == set(despeckle.classify(two, one, mask, Limits(None, None), SPECKLE).columns)
    flags = {d: sorted(tuple(r) for r in got.where(F.col("doy") == d).select("year", "y", "x", "flags").collect()) for d in (9, 129)}
    assert flags[9] == flags[129] and any(r[3] & fl.SPECKLE for r in flags[9])


def test_writers(spark, stack, tmp_path):
    _, df = stack
    flagged = df.withColumn("flags", F.when(F.col("x") % 2 == 0, 16).otherwise(0).cast("short"))
    sinks.write_aggregate(aggregate.month_and_year(flagged), str(tmp_path / "means"))
    means = spark.read.parquet(str(tmp_path / "means"))
    assert dict(means.dtypes)["value"] == "float" and dict(means.dtypes)["filled_percent"] == "tinyint"
    assert {(r["month"], r["filled_percent"]) for r in means.select("month", "filled_percent").distinct().collect()} == {(m, p) for m in (0, 1) for p in (0, 100)}
    sinks.write_differences(aggregate.difference(df, df.withColumn("value", F.col("value") - 2)), str(tmp_path / "difference"))
    d = spark.read.parquet(str(tmp_path / "difference"))
    assert {r["value"] for r in d.select("value").distinct().collect()} == {2.0, -9999.0} and d.count() == df.count()
    assert {r["name"] for r in d.select("name").distinct().collect()} == {f"LST-DayMinusNight.{y}.009.Data.1km.Data" for y in range(2000, 2004)}
    bands = stats.stats13(df.where("value IS NOT NULL").select("y", "x", "value"), F.lit(3)).withColumn("source", F.lit(0))
    sinks.write_bands(bands, str(tmp_path / "bands"))
    assert sinks.read_bands(spark, str(tmp_path / "bands")).count() == bands.count()
    own = sinks.read_bands(spark, str(tmp_path / "bands"), [13])
    assert {r["band"] for r in own.select("band").distinct().collect()} == {13} and set(own.columns) == {"band", "y", "x", "mean", "sd", "n", "source"}


def test_file_index(spark, tmp_path):
    for name in ("LST.2001.009.mean.1km.mean.tif", "A2002017_x.tif", "notes.txt"):
        (tmp_path / name).write_bytes(b"x")
    got = {(r["year"], r["doy"]) for r in grids.file_index(spark, f"{tmp_path}/*.tif").collect()}
    assert got == {(2001, 9), (2002, 17)}


def test_run_from_geotiff_to_geotiff(spark, stack, tmp_path):
    v, df = stack
    transform = [-180.0, 0.008333333333333, 0.0, 90.0, 0.0, -0.008333333333333]
    (tmp_path / "in").mkdir()
    for t in range(4):
        (tmp_path / "in" / f"EVI.{2000 + t}.009.mean.1km.mean.tif").write_bytes(geotiff.encode(np.where(np.isnan(v[t]), -9999, v[t]).astype("f4"), transform, -9999.0))
    s, mask = parts(spark, df)
    s.write.parquet(str(tmp_path / "stats"))
    mask.write.parquet(str(tmp_path / "mask"))
    paths = config.Paths(f"{tmp_path}/in/*.tif", str(tmp_path / "stats"), str(tmp_path / "mask"), str(tmp_path / "out"), "EVI")
    c = Config(paths=paths, limits=Limits(50, 0), despeckle=Despeckle(8, 2, 8), a1=A1(8, 2, 8), job=Job(geotiff=True, memory=1 << 24))
    pipeline.run(spark, c)
    got = {(r["path"].split(".")[-8], r["y"], r["x"]): r["value"] for r in raster.read_cells(spark, f"{tmp_path}/out/EVI/FilledData/*.tif").collect()}
    want = pipeline.fill(grid.complete(df.where("value IS NOT NULL"), 9, 8, ("doy", "year")), s, mask, c, ("doy",)).where("value IS NOT NULL").collect()
    assert len(got) == len(want) > np.count_nonzero(~np.isnan(v[:, :, :7]))
    assert all(got[str(r["year"]), r["y"], r["x"]] == pytest.approx(r["value"], rel=1e-6) for r in want)
    assert {r["gx"] for r in geotiff.read_meta(spark, f"{tmp_path}/out/EVI/*/*.tif").collect()} == {-180.0}
    with pytest.raises(ValueError, match="no-data"):
        pipeline.run(spark, Config(paths=paths, limits=Limits(50, 0, ndv=-1.0), job=Job(geotiff=True)))
