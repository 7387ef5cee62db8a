"""The raster source opens the files, and reads the blocks and bands, that a query asks for."""

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql.datasource import EqualTo, GreaterThan, GreaterThanOrEqual, In, IsNotNull, LessThan, StringContains

from lacunar import config
from lacunar.config import A1, Config, Despeckle, Job, Limits
from lacunar.plans import pipeline
from lacunar.sources import geotiff, raster
from tests.test_geotiff import TRANSFORM, tiff


def archive(folder, days=(1, 9, 17), h=70, w=50, **how):
    out = {}
    for d in days:
        v = (np.arange(h * w).reshape(h, w) % 97 + d).astype("f4")
        v[::7, ::5] = -9999
        (folder / f"EVI.2001.{d:03d}.mean.1km.mean.tif").write_bytes(geotiff.encode(v, TRANSFORM, -9999.0, **how))
        out |= {(d, y, x): float(v[y, x]) for y in range(h) for x in range(w) if v[y, x] != -9999}
    return out


def cells(batches):
    return {(r["doy"], r["y"], r["x"]): r["value"] for b in batches for r in b.to_pylist()}


@pytest.fixture
def counted(monkeypatch):
    """(files opened, bytes of blocks read)."""
    seen = {"files": [], "bytes": 0}
    plain = raster.ranges

    def ranges(uri):
        seen["files"].append(uri.rsplit("/", 1)[-1])
        read, close = plain(uri)

        def counting(at, size):
            seen["bytes"] += size
            return read(at, size)

        return counting, close

    monkeypatch.setattr(raster, "ranges", ranges)
    return seen


def pushed(pattern, *filters, **options):
    reader = raster.RasterReader({"path": str(pattern), **options})
    left = list(reader.pushFilters(list(filters)))
    return reader, left, [b for p in reader.partitions() for b in reader.read(p)]


@pytest.mark.parametrize("how", [{"rows": 8}, {"tile": 16}])
def test_filters_reach_files_and_blocks(tmp_path, counted, how):
    want = archive(tmp_path, **how)
    _, left, got = pushed(tmp_path / "*.tif")
    assert cells(got) == want and len(counted["files"]) == 3
    every, counted["bytes"] = counted["bytes"], 0
    counted["files"].clear()
    text = StringContains(("variable",), "d")
    _, left, got = pushed(tmp_path / "*.tif", EqualTo(("doy",), 9), In(("year",), (2000, 2001)), IsNotNull(("y",)), GreaterThanOrEqual(("y",), 20), LessThan(("y",), 30), GreaterThan(("x",), 40), text)
    assert left == [text] and counted["files"] == ["EVI.2001.009.mean.1km.mean.tif"]
    assert cells(got) == {k: v for k, v in want.items() if k[0] == 9 and 20 <= k[1] < 30 and k[2] > 40}
    assert counted["bytes"] < every / 4


def test_one_file_is_read_by_several_tasks(tmp_path):
    want = archive(tmp_path, days=(5,), rows=4)
    size = (tmp_path / "EVI.2001.005.mean.1km.mean.tif").stat().st_size
    reader, _, got = pushed(tmp_path / "*.tif", split_bytes=size // 5)
    shares = reader.partitions()
    assert len(shares) >= 5 and cells(got) == want
    parts = [cells(reader.read(s)) for s in shares]
    assert sum(map(len, parts)) == len(want) and max(map(len, parts)) < len(want) / 3


def test_small_files_share_a_task(tmp_path):
    archive(tmp_path, days=(1, 2, 3, 4))
    reader, _, _ = pushed(tmp_path / "*.tif")
    assert len(reader.partitions()) == 1


def test_strip_without_compression_is_cut():
    values = np.arange(60 * 30, dtype="f4").reshape(60, 30)
    data, taken = tiff(values), []
    image = geotiff.Image(lambda at, size: taken.append(size) or data[at : at + size])
    blocks = list(image.layout(cells=300))
    assert len(blocks) == 6 and all((image.values(b)[..., 0] == values[b.y : b.y + b.rows]).all() for b in blocks)
    assert max(taken) <= 300 * 4


def test_a_file_beyond_two_gigabytes(tmp_path):
    """A sparse file of 3.7 GB: an uncompressed global image in one strip."""
    h, w = 21_600, 43_200
    small = tiff(np.zeros((1, 1), "f4"))
    file = tmp_path / "EVI.2001.009.mean.1km.mean.tif"
    head = bytearray(small)
    first = int.from_bytes(head[4:8], "little")
    strip = 8
    body = strip + h * w * 4
    directory = bytearray(head[first:])
    for i in range(int.from_bytes(directory[:2], "little")):
        at = 2 + 12 * i
        tag = int.from_bytes(directory[at : at + 2], "little")
        new = {256: w, 257: h, 278: h, 279: h * w * 4}.get(tag)
        if new is not None:
            directory[at + 8 : at + 12] = new.to_bytes(4, "little")
        if tag in (33550, 33922):
            old = int.from_bytes(directory[at + 8 : at + 12], "little")
            directory[at + 8 : at + 12] = (old - first + body).to_bytes(4, "little")
    with open(file, "wb") as f:
        f.write(bytes(head[:4]) + body.to_bytes(4, "little"))
        f.seek(strip + (20_000 * w + 40_000) * 4)
        f.write(np.array([1.5, 2.5], "f4").tobytes())
        f.seek(body)
        f.write(directory)
    reader, _, got = pushed(tmp_path / "*.tif", EqualTo(("y",), 20_000), In(("x",), (40_000, 40_001, 7)))
    assert len(reader.partitions()) > 200 and cells(got) == {(9, 20_000, 7): 0.0, (9, 20_000, 40_000): 1.5, (9, 20_000, 40_001): 2.5}


def test_bands(tmp_path, counted):
    v = np.arange(3 * 40 * 20, dtype="f4").reshape(3, 40, 20)
    (tmp_path / "planar.tif").write_bytes(geotiff.encode(v, TRANSFORM, -9999.0, tile=16))
    _, _, got = pushed(tmp_path / "planar.tif")
    assert {(r["band"], r["y"], r["x"]): r["value"] for b in got for r in b.to_pylist()} == {(b + 1, y, x): v[b, y, x] for b in range(3) for y in range(40) for x in range(20)}
    every, counted["bytes"] = counted["bytes"], 0
    _, _, got = pushed(tmp_path / "planar.tif", EqualTo(("band",), 2), LessThan(("x",), 3))
    assert sorted(r["value"] for b in got for r in b.to_pylist()) == sorted(v[1, :, :3].ravel().tolist()) and counted["bytes"] < every / 2


@pytest.mark.parametrize("predictor", [1, 2])
def test_bands_cell_by_cell(tmp_path, predictor):
    """Interleaved bands, as a file of one band three times as wide whose header then says so."""
    v = (np.arange(8 * 6 * 3).reshape(8, 6, 3) % 50).astype("u1")
    wide = v.copy()
    if predictor == 2:
        wide[:, 1:] = v[:, 1:] - v[:, :-1]
    data = bytearray(tiff(wide.reshape(8, 18), predictor=1))
    first = int.from_bytes(data[4:8], "little")
    for i in range(int.from_bytes(data[first : first + 2], "little")):
        at = first + 2 + 12 * i
        tag = int.from_bytes(data[at : at + 2], "little")
        if tag in (256, 277, 317):
            data[at + 8 : at + 12] = {256: 6, 277: 3, 317: predictor}[tag].to_bytes(4, "little")
    (tmp_path / "chunky.tif").write_bytes(bytes(data))
    _, _, got = pushed(tmp_path / "chunky.tif", In(("band",), (1, 3)))
    assert {(r["band"], r["y"], r["x"]): r["value"] for b in got for r in b.to_pylist()} == {(b + 1, y, x): float(v[y, x, b]) for b in (0, 2) for y in range(8) for x in range(6)}


def test_plan_and_rows(spark, tmp_path):
    want = archive(tmp_path, rows=8)
    df = raster.read(spark, f"{tmp_path}/*.tif", "EVI").where("doy = 9 AND y >= 20 AND y < 30 AND x IN (3, 4)").select("doy", "y", "x", "value")
    plan = df._jdf.queryExecution().optimizedPlan().toString() + df._jdf.queryExecution().executedPlan().toString()
    assert "Filter (" not in plan and "- Filter" not in plan, plan
    assert {(r[0], r[1], r[2]): r[3] for r in df.collect()} == {k: v for k, v in want.items() if k[0] == 9 and 20 <= k[1] < 30 and k[2] in (3, 4)}
    both = raster.read(spark, f"{tmp_path}/*.tif").where("doy = 9 OR y = 3").count()
    assert both == sum(k[0] == 9 or k[1] == 3 for k in want)


def test_a_file_that_is_no_image(spark, tmp_path):
    (tmp_path / "EVI.2001.009.mean.1km.mean.tif").write_bytes(b"no image at all")
    with pytest.raises(Exception, match="not a TIFF file"):
        raster.read(spark, f"{tmp_path}/*.tif").count()
    assert raster.read(spark, f"{tmp_path}/none*.tif").count() == 0


def test_bands_are_written_and_read(spark, tmp_path):
    rows = [(b, y, x, None if (y + x) % 4 == 0 else float(b * 100 + y * 10 + x)) for b in range(1, 14) for y in range(9) for x in range(7)]
    df = spark.createDataFrame(rows, "band int, y int, x int, mean double")
    files = geotiff.write_bands_geotiff(df, str(tmp_path), "mean", "mean", 13, 9, 7, TRANSFORM, side=8, tile=16).collect()
    assert len(files) == 2
    assert [r["bands"] for r in geotiff.read_meta(spark, f"{tmp_path}/mean.*.tif").collect()] == [13, 13]
    got = raster.read(spark, f"{tmp_path}/mean.0.0.tif").where("band >= 12 AND x = 3")
    assert {(r["band"], r["y"], r["x"]): r["value"] for r in got.collect()} == {(b, y, x): v for b, y, x, v in rows if v is not None and b >= 12 and x == 3 and y < 8}


def test_job_over_rasters_alone(spark, tmp_path):
    """Data, mean, SD and coastline are rasters; only the day that is asked for is opened, and a file without its no-data value is refused."""
    rng = np.random.default_rng(3)
    (tmp_path / "in").mkdir()
    values = {}
    for d in (1, 9):
        for t in range(3):
            v = np.round(10 + rng.random((12, 10)), 2).astype("f4")
            v[4, 4 + t] = -9999
            values[d, 2000 + t] = v
            (tmp_path / "in" / f"EVI.{2000 + t}.{d:03d}.mean.1km.mean.tif").write_bytes(geotiff.encode(v, TRANSFORM, -9999.0))
    (tmp_path / "in" / "EVI.2001.017.mean.1km.mean.tif").write_bytes(b"broken, and not asked for")
    for name, v in (("mean", np.full((12, 10), 10.5)), ("sd", np.full((12, 10), 2.0)), ("land", np.ones((12, 10)))):
        (tmp_path / f"{name}.tif").write_bytes(geotiff.encode(v.astype("f4"), TRANSFORM, -9999.0))
    paths = config.Paths(data=f"{tmp_path}/in/*.tif", mean=f"{tmp_path}/mean.tif", sd=f"{tmp_path}/sd.tif", mask=f"{tmp_path}/land.tif", output=str(tmp_path / "out"), variable="EVI")
    c = Config(paths=paths, limits=Limits(50, 0), despeckle=Despeckle(8, 2, 8), a1=A1(8, 2, 8), job=Job(days=(9,), north=88.0, south=85.0, west=-179.0, east=-176.0))
    pipeline.run(spark, c)
    got = spark.read.parquet(str(tmp_path / "out"))
    assert {r[0] for r in got.select("doy").distinct().collect()} == {9} and got.count() == 3 * 6 * 6
    assert got.agg(F.min("y"), F.max("y"), F.min("x"), F.max("x")).first() == (4, 9, 2, 7)
    assert {(r["year"], r["y"], r["x"]) for r in got.where("flags & 16 <> 0").collect()} == {(2000 + t, 4, 4 + t) for t in range(3)}
    bare = bytearray(geotiff.encode(values[9, 2000], TRANSFORM, -9999.0)).replace((42113).to_bytes(2, "little"), (42114).to_bytes(2, "little"))
    (tmp_path / "in" / "EVI.2003.009.mean.1km.mean.tif").write_bytes(bytes(bare))
    with pytest.raises(ValueError, match="no-data"):
        pipeline.run(spark, c)
