"""Relational operators on small tables, and paths against each other."""

import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from lacunar import config, queries
from lacunar.config import A1, A2, Config, Despeckle, Job, Limits
from lacunar.functions.calendar import month_of
from lacunar.operators import aggregate, clip, despeckle, fill_a1, fill_a2, grid, kernels, stats, tiles
from lacunar.plans import cli, pipeline
from lacunar.sources import grids, sinks
from lacunar.streaming import incremental

OPEN = Limits(None, None)


def table(spark, a, names="year int, y int, x int, value double"):
    rows = [(int(t), int(y), int(x), None if np.isnan(a[t, y, x]) else float(a[t, y, x])) for t in range(a.shape[0]) for y in range(a.shape[1]) for x in range(a.shape[2])]
    return spark.createDataFrame(rows, names)


@pytest.fixture(scope="module")
def stack():
    rng = np.random.default_rng(11)
    v = rng.integers(1, 40, (4, 13, 14)).astype(float)
    v[rng.random(v.shape) < 0.4] = np.nan
    v[:2, 3:9, 4:10] = np.nan
    v[:, 0, 0] = np.nan
    return v


def dense(rows, shape, name):
    out = np.full(shape, np.nan)
    for r in rows:
        out[r["year"], r["y"], r["x"]] = np.nan if r[name] is None else r[name]
    return out


@pytest.mark.parametrize("trim", [False, True])
def test_relational_and_tiles_agree(spark, stack, trim):
    a1 = A1(8, 2, 9, trim=trim)
    df = table(spark, stack).withColumn("flags", F.lit(0).cast("short"))
    one = fill_a1.fill(df, a1, OPEN).collect()
    two = tiles.fill_tiles(df.withColumns({c: F.lit(None).cast("double") for c in ("mean", "sd", "z")}), Despeckle(8, 1, 8), a1, OPEN, tile=5).collect()
    v, f, d, n = kernels.fill_a1(stack, np.zeros(stack.shape, np.int64), a1, OPEN, np.ones(stack.shape, bool))
    for rows in (one, two):
        assert len(rows) == stack.size
        np.testing.assert_allclose(dense(rows, stack.shape, "value"), v)
        np.testing.assert_allclose(dense(rows, stack.shape, "dist"), d)
        np.testing.assert_array_equal(dense(rows, stack.shape, "flags"), f)


def test_despeckle_paths_agree(spark, stack):
    s = table(spark, stack)
    mean = stats.synoptic(s).select("y", "x", "mean", "sd")
    mask = s.select("y", "x").distinct().withColumn("land", F.when((F.col("x") + F.col("y")) % 9 == 0, 0).otherwise(1))
    c = Despeckle(8, 2, 5, 1.3, 0.7, 0.3)
    marked = despeckle.classify(s, mean, mask, OPEN, c)
    rows = marked.collect()
    want, flags = kernels.despeckle(dense(rows, stack.shape, "value"), dense(rows, stack.shape, "flags").astype(int), dense(rows, stack.shape, "z"), c)
    got = despeckle.despeckle(marked, c).collect()
    np.testing.assert_allclose(dense(got, stack.shape, "value"), want)
    np.testing.assert_array_equal(dense(got, stack.shape, "flags"), flags)
    assert (flags == 8).any() and (flags == 4).any() and (flags == 1).any()


def test_components_agree_with_the_whole_image(spark, stack):
    a = stack[0]
    flags = np.where(np.isnan(a), 2, 0)
    rows = [(7, int(y), int(x), None if np.isnan(a[y, x]) else float(a[y, x]), 10.0, int(flags[y, x]), None) for y in range(a.shape[0]) for x in range(a.shape[1])]
    df = spark.createDataFrame(rows, "year int, y int, x int, value double, mean double, flags short, dist double")
    values, far, gap = kernels.fill_a2(a, np.full(a.shape, 10.0), flags, np.full(a.shape, np.nan), A2(), OPEN)
    got = {(r["pass"], r["y"], r["x"]): (r["pass_value"], r["pass_dist"]) for r in fill_a2.pass_values(df, A2(), OPEN, tile=4).collect()}
    want = {(p, y, x): (values[p, y, x], far[p, y, x]) for p, y, x in np.argwhere(~np.isnan(values)).tolist()}
    assert got.keys() == want.keys()
    for k in want:
        assert got[k] == pytest.approx(want[k])
    assert gap.sum() > 30


def test_pipeline_paths_and_flags(spark, stack, monkeypatch):
    s = table(spark, stack)
    mean = stats.synoptic(s).select("y", "x", "mean", "sd")
    mask = s.select("y", "x").distinct().withColumn("land", F.lit(1))
    c = Config(limits=Limits(45, 0, z=1.0), job=Job(start_year=1, tile=6), despeckle=Despeckle(8, 2, 5, 1.4, 0.9, 0.3), a1=A1(8, 3, 9))
    one = {(r["year"], r["y"], r["x"]): r for r in pipeline.fill(s, mean, mask, c).collect()}
    monkeypatch.setattr(pipeline, "SHORT_SEARCH", 0)
    two = {(r["year"], r["y"], r["x"]): r for r in pipeline.fill(s, mean, mask, c).collect()}
    assert one.keys() == two.keys() and min(k[0] for k in one) == 1
    for k, r in one.items():
        assert r["flags"] == two[k]["flags"] and (r["value"] == pytest.approx(two[k]["value"]) if r["value"] is not None else two[k]["value"] is None)
        f = r["flags"]
        assert not (f & 2 and f & 64) and not (f & 32 and not f & 16) and not (f & 128 and not f & 80)
        if not f and not np.isnan(stack[k]):
            assert r["value"] == stack[k]


def test_clip(spark):
    df = spark.createDataFrame([(20.0, 16), (4.0, 16), (12.0, 16), (20.0, 0)], "value double, flags short").withColumns({"mean": F.lit(10.0), "sd": F.lit(2.0)})
    once = clip.clip(df, Limits(14, -100), 16)
    got = [(round(r["value"], 6), r["flags"]) for r in once.collect()]
    assert got == [(14.0, 144), (4.84, 144), (12.0, 16), (20.0, 0)]
    assert [r["value"] for r in clip.clip(once, Limits(14, -100), 16).collect()] == [r["value"] for r in once.collect()]
    free = clip.clip(df.withColumns({"mean": F.lit(None).cast("double")}), Limits(None, None), 16).collect()
    assert [r["value"] for r in free] == [20.0, 4.0, 12.0, 20.0]


def test_grand_stats(spark):
    g = spark.createDataFrame([(0, 0, 10.0, 2.0, 4), (0, 0, 20.0, 3.0, 6), (1, 1, None, None, 0)], "y int, x int, mean double, sd double, n long")
    rows = {(r["y"]): r for r in stats.grand_stats(g).collect()}
    assert rows[0]["mean"] == 16 and rows[0]["sd"] == pytest.approx(33**0.5) and rows[0]["n"] == 10
    assert rows[1]["mean"] is None and rows[1]["n"] == 0


def test_area_and_names(spark):
    assert grid.pixel_limits(15, -10, -2, 40) == (9000, 12000, 21360, 26400)
    assert grid.clipped_transform([-180, 0.5, 0, 90, 0, -0.5], 10, 4) == [-178, 0.5, 0, 85, 0, -0.5]
    names = spark.createDataFrame([("a/A2015009_x.tif",), ("b\\LST.2016.017.mean.1km.mean.tif",), ("junk",)], "p string")
    got = [tuple(r) for r in names.select(*[c.alias(n) for n, c in grids.file_date(F.col("p")).items()]).collect()]
    assert got[:2] == [(2015, 9), (2016, 17)] and got[2][1] is None
    assert month_of(121) == 5 and month_of(361) == 12
    out = names.select(sinks.output_name("EVI", "FilledData", F.lit(2015), F.lit(9))).first()[0]
    assert out == "EVI-FilledData.2015.009.Data.1km.Data"


def test_tile_size():
    assert grid.tile_size(1 << 30, 15, 33) == 960 and grid.tile_size(1, 15, 33) == 32


def test_cli_samples(tmp_path, monkeypatch):
    monkeypatch.chdir(tmp_path)
    assert cli.main(["-c", "SAMPLE", "-p", "SAMPLE"]) == 1
    sections = config.load_sections("sample_run.yml", "sample_params.yml")
    assert set(sections) == set(config.PARTS)


def test_config(tmp_path):
    assert config.limits_for("MOD_LST_Day").floor == -100
    for name in ("nothing", "LST_EVI"):
        with pytest.raises(KeyError):
            config.limits_for(name)
    assert Limits(-9999, 0).ceiling is None
    with pytest.raises(ValueError):
        Config(a1=A1(ratio=True))
    f = tmp_path / "run.yml"
    f.write_text(config.sample(("paths", "job")).replace("variable: ''", "variable: EVI"))
    got = config.load(str(f))
    assert got.limits.ceiling == 1.0 and got.job.all_days and got.a1 == A1()
    with pytest.raises(ValueError):
        config.from_dict({"paths": {"data": "LST"}})


def test_run_writes_images(spark, stack, tmp_path):
    obs = table(spark, stack).where("value IS NOT NULL").withColumns({"variable": F.lit("EVI"), "doy": F.lit(9)})
    obs.write.partitionBy("variable", "doy", "year").parquet(str(tmp_path / "in"))
    stats.synoptic(table(spark, stack)).select("y", "x", "mean", "sd").write.parquet(str(tmp_path / "stats"))
    table(spark, stack).select("y", "x").distinct().withColumn("land", F.lit(1)).write.parquet(str(tmp_path / "mask"))
    paths = {"data": str(tmp_path / "in"), "stats": str(tmp_path / "stats"), "mask": str(tmp_path / "mask"), "output": str(tmp_path / "out"), "variable": "EVI"}
    c = config.from_dict({"paths": paths, "job": {"days": [0], "tile": 8, "a2_years": [2, 3]}, "limits": {"ceiling": 50, "floor": 0}, "despeckle": {"search": 8, "min_used": 2, "max_used": 8}, "a1": {"search": 8, "min_used": 2, "max_used": 8}})
    pipeline.run(spark, c)
    out = spark.read.parquet(str(tmp_path / "out"))
    assert out.count() == stack.size and out.where("value IS NOT NULL").count() > np.count_nonzero(~np.isnan(stack))
    assert out.where("year < 2 AND flags & 64 <> 0").count() == 0 < out.where("year >= 2 AND flags & 64 <> 0").count()
    assert {f.name for f in out.schema} == {"variable", "doy", "year", "y", "x", "value", "dist", "flags"}


def test_watch_refills_what_arrives(spark, stack, tmp_path):
    obs = table(spark, stack).where("value IS NOT NULL").withColumns({"variable": F.lit("EVI"), "doy": F.lit(9)})
    save = lambda df: df.write.mode("append").partitionBy("variable", "doy", "year").parquet(str(tmp_path / "in"))
    save(obs.where("year < 3"))
    stats.synoptic(table(spark, stack)).select("y", "x", "mean", "sd").write.parquet(str(tmp_path / "stats"))
    table(spark, stack).select("y", "x").distinct().withColumn("land", F.lit(1)).write.parquet(str(tmp_path / "mask"))
    paths = config.Paths(str(tmp_path / "in"), str(tmp_path / "stats"), str(tmp_path / "mask"), str(tmp_path / "out"), "EVI")
    c = Config(paths=paths, limits=Limits(50, 0), despeckle=Despeckle(8, 2, 8), a1=A1(8, 2, 8), job=Job(run_a2=False))
    incremental.watch(spark, c, str(tmp_path / "cp")).awaitTermination()
    assert {r["year"] for r in spark.read.parquet(str(tmp_path / "out")).select("year").distinct().collect()} == {0, 1, 2}
    save(obs.where("year = 3"))
    incremental.watch(spark, c, str(tmp_path / "cp")).awaitTermination()
    out = spark.read.parquet(str(tmp_path / "out"))
    assert out.where("year = 3").count() == stack[0].size and out.count() == stack.size


def test_pairs_are_ranked_where_they_are_made(spark, stack):
    """What A1 shuffles are the cells' rows and keys that ask for them: no exchange of gaps or pairs, which have a year. The
    rows that ask carry no values."""
    before = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    try:
        for k, v in zip(before, ("false", "-1"), strict=True):
            spark.conf.set(k, v)
        cells = table(spark, stack).withColumn("flags", F.lit(0).cast("short"))
        plan = fill_a1.pairs(cells, A1(search=8, min_used=2, max_used=8, trim=False), OPEN)._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    keys = [line.split("hashpartitioning(")[1].split(")")[0] for line in plan.splitlines() if "hashpartitioning(" in line]
    assert keys and not [k for k in keys if "year#" in k]


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="no test tables")
def test_values_are_gathered_once(spark):
    """Dates, grid and statistics of the queries read one table of values, none of them lineitem."""
    for df in queries._parts(spark, "/root/testdata/sf0.001")[:2]:
        assert df.inputFiles() and not [f for f in df.inputFiles() if "lineitem" in f]


def test_cells_are_not_broadcast(spark, stack, monkeypatch):
    """Tables of cells meet by shuffles, as small as Spark takes them for: a broadcast goes through the driver."""
    plans, modules = [], (despeckle, fill_a1, fill_a2, pipeline)

    def written(df, name):
        df.collect()
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return write(df, name)

    write = fill_a1.materialize
    for m in modules:
        monkeypatch.setattr(m, "materialize", written)
    cells = table(spark, stack)
    mean = stats.synoptic(cells).select("y", "x", "mean", "sd")
    mask = cells.select("y", "x").distinct().withColumn("land", F.when((F.col("x") + F.col("y")) % 9 == 0, 0).otherwise(1))
    done = pipeline.fill(cells, mean, mask, Config(limits=OPEN, job=Job(start_year=0), despeckle=Despeckle(8, 2, 5, 1.3, 0.7, 0.3), a1=A1(8, 2, 9, trim=True), a2=A2()))
    assert len(done.collect()) == stack.size
    joins = [line for plan in [*plans, done._jdf.queryExecution().executedPlan().toString()] for line in plan.splitlines() if "Join [" in line]
    assert [j for j in joins if "SortMergeJoin" in j]
    assert not [j for j in joins if "Broadcast" in j and ("y#" in j or "node#" in j or "component#" in j)]


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="no test tables")
def test_queries_broadcast_no_cells(spark, stack):
    """Counters of the fill, clipped cells with their statistics, differences of images: what they read at the end isn't broadcast, either."""
    image = table(spark, stack).withColumn("doy", F.lit(1))
    for df in (queries.fill_counts(spark, "/root/testdata/sf0.001"), queries.clip_a1(spark, "/root/testdata/sf0.001"), aggregate.difference(image, image)):
        joins = [line for line in df._jdf.queryExecution().executedPlan().toString().splitlines() if "Join [" in line and "y#" in line]
        assert joins and not [j for j in joins if "Broadcast" in j]
