"""Runs from files to files: counters, scratch tables, products, states of periods; dilation on packed rows."""

import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from lacunar import config
from lacunar.config import A1, Config, Despeckle, Job, Limits
from lacunar.functions import flags as fl
from lacunar.operators import aggregate, periods, stats
from lacunar.plans import pipeline, products
from lacunar.sources import geotiff, raster, scratch
from tests.test_geotiff import TRANSFORM


@pytest.mark.parametrize("times", [1, 3, 70])
def test_dilation_over_chunks(spark, times):
    rng = np.random.default_rng(times)
    m = (rng.random((20, 200)) < (0.01 if times < 9 else 0.0005)).astype(int)
    m[3, 64] = m[9, 128] = m[5, 127] = 1
    m[(np.arange(20)[:, None] * np.arange(200)) % 7 == 0] = 0
    want = np.zeros_like(m)
    for y, x in zip(*np.nonzero(m), strict=True):
        want[max(0, y - times) : y + times + 1, max(0, x - times) : x + times + 1] = 1
    rows = [(y, x, int(m[y, x]), "kept") for y in range(20) for x in range(200) if (y * x) % 7]
    got = stats.dilate8(spark.createDataFrame(rows, "y int, x int, occluded int, more string"), times=times).collect()
    assert {(r["y"], r["x"]): r["occluded"] for r in got} == {(y, x): want[y, x] for y, x, *_ in rows} and got[0]["more"] == "kept"


def comps(spark):
    rng = np.random.default_rng(2)
    rows = [(2000 + t, d, y, x, None if rng.random() < 0.2 else float(rng.integers(0, 50)), int(rng.choice([0, 16, 64, 1]))) for t in range(2) for d in (1, 9, 33, 41, 361) for y in range(3) for x in range(4)]
    return spark.createDataFrame(rows, "year int, doy int, y int, x int, value double, flags short")


def rounded(df):
    return sorted((r["year"], r["month"], r["y"], r["x"], None if r["value"] is None else round(r["value"], 9), round(r["filled_percent"], 9)) for r in df.collect())


@pytest.mark.parametrize("order", [(0, 1, 2), (2, 0, 1, 0, 2)])
def test_period_state(spark, tmp_path, order):
    """Batches in any order, some of them twice, give the months and years of all composites."""
    df = comps(spark)
    for b in order:
        periods.put(df.where(F.col("doy") % 3 == b), str(tmp_path), b)
    assert rounded(periods.images(spark, str(tmp_path))) == rounded(aggregate.month_and_year(df))


def test_period_stream(spark, tmp_path):
    df = comps(spark)
    source, state = str(tmp_path / "in"), str(tmp_path / "state")
    for d in (361, 1, 9):
        df.where(F.col("doy") == d).coalesce(1).write.mode("append").parquet(source)
        periods.watch(spark.readStream.schema(df.schema).parquet(source), state, str(tmp_path / "checkpoint")).awaitTermination()
    assert rounded(periods.images(spark, state)) == rounded(aggregate.month_and_year(df.where("doy IN (1, 9, 361)")))


def job(spark, tmp_path):
    rng = np.random.default_rng(5)
    os.makedirs(tmp_path / "in")
    for t in range(4):
        v = np.round(10 + rng.random((14, 11)), 2).astype("f4")
        v[rng.random(v.shape) < 0.2] = -9999
        v[3:8, 3:8] = -9999 if t == 0 else v[3:8, 3:8]
        v[2, 2] = 49 if t == 1 else 10
        (tmp_path / "in" / f"EVI.{2000 + t}.009.mean.1km.mean.tif").write_bytes(geotiff.encode(v, TRANSFORM, -9999.0))
    land = np.ones((14, 11), "f4")
    land[0] = 0
    for name, v in (("mean", np.full((14, 11), 10.5)), ("sd", np.full((14, 11), 2.0)), ("land", land)):
        (tmp_path / f"{name}.tif").write_bytes(geotiff.encode(v.astype("f4"), TRANSFORM, -9999.0))
    paths = config.Paths(data=f"{tmp_path}/in/*.tif", mean=f"{tmp_path}/mean.tif", sd=f"{tmp_path}/sd.tif", mask=f"{tmp_path}/land.tif", output=str(tmp_path / "out"), variable="EVI")
    return Config(paths=paths, limits=Limits(50, 0), despeckle=Despeckle(8, 2, 8), a1=A1(8, 3, 8), job=Job(clip=False))


def held(spark):
    folder = f"{scratch.shared_dir(spark)}/lacunar"
    return sorted(os.listdir(folder)) if os.path.isdir(folder) else []


def test_run_tells_its_counters_and_leaves_nothing(spark, tmp_path):
    c, before = job(spark, tmp_path), held(spark)
    got = pipeline.run(spark, c)
    assert held(spark) == before
    out = spark.read.parquet(str(tmp_path / "out"))
    bits = {name: out.where(f"flags & {bit} <> 0").count() for name, bit in (("ocean", fl.OCEAN), ("extreme", fl.EXTREME), ("full", fl.A1_FULL), ("filled", fl.A2_FILLED), ("left", fl.FAILURE))}
    assert got["a1"]["cells"] == out.count() == 4 * 14 * 11
    assert {**{k: got["a1"][k] for k in ("ocean", "extreme", "full")}, **{k: got["a2"][k] for k in ("filled", "left")}} == bits and bits["extreme"] == 1 and bits["ocean"] == 44
    a1 = got["a1"]
    assert a1["gaps"] == a1["full"] + a1["partial"] + a1["insufficient"] + a1["none"] and a1["full"] + a1["partial"] == out.where(f"flags & {fl.A1_FILLED} <> 0").count() > 0
    table = {(r["step"], r["counter"]): r["n"] for r in spark.read.parquet(f"{tmp_path}/out.counters").collect()}
    assert table == {(s, k): v for s, each in got.items() for k, v in each.items()}


def test_run_that_fails_leaves_nothing(spark, tmp_path):
    c, before = job(spark, tmp_path), held(spark)
    (tmp_path / "in" / "EVI.2001.009.mean.1km.mean.tif").write_bytes(b"broken")
    with pytest.raises(Exception, match="TIFF"):
        pipeline.run(spark, c)
    assert held(spark) == before


def test_means_and_difference(spark, tmp_path):
    c = job(spark, tmp_path)
    pipeline.run(spark, c)
    products.means(spark, f"{tmp_path}/out", f"{tmp_path}/means")
    want = aggregate.month_and_year(spark.read.parquet(f"{tmp_path}/out").select("year", "doy", "y", "x", "value", "flags"))
    got = spark.read.parquet(f"{tmp_path}/means")
    assert got.count() == want.count() and {r[0] for r in got.select("month").distinct().collect()} == {0, 1}
    v = spark.read.parquet(f"{tmp_path}/out").withColumn("value", F.col("value").cast("double"))
    v.where("year < 2003").write.partitionBy("variable", "doy", "year").parquet(f"{tmp_path}/day")
    v.where("year > 2000").withColumn("value", F.when((F.col("y") + F.col("x")) % 3 != 0, F.col("value") - 2)).write.partitionBy("variable", "doy", "year").parquet(f"{tmp_path}/night")
    assert products.main(["difference", "--day", f"{tmp_path}/day", "--night", f"{tmp_path}/night", "--output", f"{tmp_path}/diff"]) == 0
    rows = spark.read.parquet(f"{tmp_path}/diff").collect()
    assert {r["year"] for r in rows} == {2001, 2002} and len(rows) == 2 * 14 * 11
    known = {(r["year"], r["y"], r["x"]) for r in v.where("value IS NOT NULL").collect()}
    assert all(r["value"] == pytest.approx(2.0 if (r["y"] + r["x"]) % 3 and (r["year"], r["y"], r["x"]) in known else -9999.0) for r in rows)


def test_winter_from_rasters(spark, tmp_path):
    rng = np.random.default_rng(8)
    h, w = 9, 7
    mean, sd, n = np.round(rng.normal(10, 4, (13, h, w)), 2), np.round(rng.random((13, h, w)), 2), rng.integers(2, 9, (13, h, w)).astype(float)
    shade = rng.integers(0, 256, (2, h, w)).astype(float)
    for name, v in (("mean", mean), ("sd", sd), ("n", n), ("north", shade[0]), ("south", shade[1])):
        (tmp_path / f"{name}.tif").write_bytes(geotiff.encode(v.astype("f4"), TRANSFORM, -9999.0))
    args = [x for k in ("mean", "sd", "n", "north", "south") for x in (f"--{k}", f"{tmp_path}/{k}.tif")]
    assert products.main(["winter", *args, "--output", f"{tmp_path}/cut", "--north-to", "3", "--south-from", "6"]) == 0
    bands = spark.createDataFrame([(b + 1, y, x, float(np.float32(mean[b, y, x])), float(np.float32(sd[b, y, x])), int(n[b, y, x])) for b in range(13) for y in range(h) for x in range(w)], "band int, y int, x int, mean double, sd double, n long")
    dark = spark.createDataFrame([(y, x, int((shade[0] if y <= 3 else shade[1])[y, x] < 120 and not 3 < y < 6)) for y in range(h) for x in range(w)], "y int, x int, occluded int")
    want = {(r["band"], r["y"], r["x"]): r for r in stats.winter_min_cut(bands, dark, 3, 6).collect()}
    for name in ("mean", "n", "source"):
        got = {(r["band"], r["y"], r["x"]): r["value"] for r in raster.read(spark, f"{tmp_path}/cut/{name}.*.tif").collect()}
        assert len(got) == len(want) and all(v == pytest.approx(want[k][name], rel=1e-6) for k, v in got.items())
    assert any(r["source"] for r in want.values())
