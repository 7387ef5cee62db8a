"""Archives of rasters as a data source that reads only the files, blocks and bands that a query asks for.

`spark.read.format("raster")` lists the files of a pattern by name and size; nothing is opened on the driver. A partition is a
share of one file's blocks, or some small files: a large file is read by as many tasks as its size asks for, whatever it holds. A
task reads a file's header by ranges, then, of the strips or tiles that the pushed filters leave, its own share, each by one range.

Pushed filters: =, <=>, <, <=, >, >=, IN and IS NOT NULL on year and doy (which files are opened; dates come from their names), band
(which planes are read, where bands lie one after another) and y and x (which blocks are read). They are exact: Spark needn't test
them again. Rows are cells with data: no-data cells and NaN are left out.

Options: path (a pattern, or several with commas), variable, with_path (true: a column of the file's path), split_bytes.
A file that is no TIFF, or of an unsupported kind, is an error that names it.
"""

from __future__ import annotations

import fnmatch
import operator
import re
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import (
    DataSource,
    DataSourceReader,
    EqualNullSafe,
    EqualTo,
    Filter,
    GreaterThan,
    GreaterThanOrEqual,
    In,
    InputPartition,
    IsNotNull,
    LessThan,
    LessThanOrEqual,
)

from lacunar.sources.geotiff import Block, Image, open_uri, ranges
from lacunar.sources.grids import OBS

SPLIT_BYTES = 16 << 20
ROWS = 1 << 17  # of a batch
PUSHDOWN = "spark.sql.python.filterPushdown.enabled"
COLUMNS = {"year": pa.int32(), "doy": pa.int32(), "band": pa.int32(), "y": pa.int32(), "x": pa.int32()}
TESTS = {EqualTo: operator.eq, EqualNullSafe: operator.eq, LessThan: operator.lt, LessThanOrEqual: operator.le, GreaterThan: operator.gt, GreaterThanOrEqual: operator.ge}


def name_date(path: str) -> tuple[int | None, int | None]:
    """(year, doy) of a daily file's name, as `grids.file_date` has them."""
    name = re.split(r"[/\\]", path)[-1]
    parts = name.split(".")
    year, doy = (parts[1], parts[2]) if len(parts) >= 6 else (name[1:5], name[5:8])
    number = lambda t: int(t) if re.fullmatch(r"\s*[+-]?\d+\s*", t) else None
    return number(year), number(doy)


def matching(pattern: str) -> Iterator[tuple[str, int]]:
    """(path, bytes) of the files of a pattern; a folder stands for all files in it. Only folders that can match are listed."""
    fs, path = open_uri(pattern)
    prefix = pattern[: len(pattern) - len(path)] if pattern.endswith(path) else ""
    parts = path.split("/")
    fixed = next((i for i, p in enumerate(parts) if re.search(r"[*?\[]", p)), len(parts))
    level = [pyarrow.fs.FileInfo("/".join(parts[:fixed]) or "/", pyarrow.fs.FileType.Directory)] if fixed < len(parts) else fs.get_file_info([path])
    for part in parts[fixed:]:
        found = [f for d in level if d.type == pyarrow.fs.FileType.Directory for f in fs.get_file_info(pyarrow.fs.FileSelector(d.path, allow_not_found=True))]
        level = [f for f in found if fnmatch.fnmatchcase(f.base_name, part)]
    for f in sorted(level, key=lambda f: f.path):
        if f.type == pyarrow.fs.FileType.Directory:
            inside = fs.get_file_info(pyarrow.fs.FileSelector(f.path))
            yield from ((prefix + i.path, i.size) for i in sorted(inside, key=lambda i: i.path) if i.is_file)
        elif f.is_file:
            yield prefix + f.path, f.size


@dataclass
class Share(InputPartition):
    """Files with which share of their blocks: (path, number of the share, of how many)."""

    files: list[tuple[str, int, int]]


class RasterReader(DataSourceReader):
    def __init__(self, options: dict):
        self.patterns = [p.strip() for p in options.get("path", "").split(",") if p.strip()]
        self.variable = options.get("variable", "data")
        self.with_path = str(options.get("with_path", "false")).lower() == "true"
        self.split = int(options.get("split_bytes", SPLIT_BYTES))
        self.tests: list[tuple[str, str, object]] = []

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        for f in filters:
            name = f.attribute[0] if len(getattr(f, "attribute", ())) == 1 else None
            if name in COLUMNS and type(f) in TESTS and isinstance(f.value, int) and not isinstance(f.value, bool):
                self.tests.append((name, type(f).__name__, f.value))
            elif name in COLUMNS and isinstance(f, In) and all(isinstance(v, int) for v in f.value):
                self.tests.append((name, "In", tuple(f.value)))
            elif name in COLUMNS and isinstance(f, IsNotNull):
                self.tests.append((name, "IsNotNull", None))
            else:
                yield f

    def keeps(self, name: str, values: np.ndarray) -> np.ndarray:
        """Which values of a column pass all that was pushed."""
        ok = np.ones(len(values), bool)
        for column, kind, value in self.tests:
            if column == name and kind != "IsNotNull":
                ok &= np.isin(values, value) if kind == "In" else {k.__name__: t for k, t in TESTS.items()}[kind](values, value)
        return ok

    def _dated(self, path: str) -> bool:
        for name, value in zip(("year", "doy"), name_date(path), strict=True):
            tested = any(column == name for column, *_ in self.tests)
            if tested and (value is None or not self.keeps(name, np.array([value]))[0]):
                return False
        return True

    def partitions(self) -> Sequence[InputPartition]:
        out, held, size = [], [], 0
        for pattern in self.patterns:
            for path, n in matching(pattern):
                if not self._dated(path):
                    continue
                shares = max(1, -(-n // self.split))
                if shares > 1:
                    out += [Share([(path, i, shares)]) for i in range(shares)]
                    continue
                if held and size + n > self.split:
                    out.append(Share(held))
                    held, size = [], 0
                held.append((path, 0, 1))
                size += n
        return [*out, *([Share(held)] if held else [])]

    def wanted(self, image: Image) -> tuple[list[Block], np.ndarray, np.ndarray, np.ndarray]:
        """(blocks that hold a cell that is asked for; which rows, columns and bands are)."""
        rows, columns = self.keeps("y", np.arange(image.height)), self.keeps("x", np.arange(image.width))
        bands = self.keeps("band", np.arange(1, image.bands + 1))
        some = lambda b: bands[b.band - 1] if b.band else bands.any()
        return [b for b in image.layout() if some(b) and rows[b.y : b.y + b.rows].any() and columns[b.x : b.x + b.columns].any()], rows, columns, bands

    def read(self, partition: Share) -> Iterator[pa.RecordBatch]:
        for path, share, shares in partition.files if partition else ():  # without any file Spark asks for None
            source, close = ranges(path)
            try:
                image = Image(source)
                blocks, rows, columns, bands = self.wanted(image)
                for block in blocks[len(blocks) * share // shares : len(blocks) * (share + 1) // shares]:
                    value = image.values(block)
                    ok = rows[block.y : block.y + value.shape[0], None, None] & columns[None, block.x : block.x + value.shape[1], None]
                    ok = ok & (bands if not block.band else np.ones(1, bool))[None, None, :] & (value != image.ndv)
                    ok &= ~np.isnan(value) if value.dtype.kind == "f" else True
                    y, x, b = np.nonzero(ok)
                    for a in range(0, len(y), ROWS):
                        own = slice(a, a + ROWS)
                        yield self._batch(path, b[own] + 1 if not block.band else np.full(len(y[own]), block.band), y[own] + block.y, x[own] + block.x, value[y[own], x[own], b[own]].astype(np.float64))
            except (ValueError, KeyError, OSError) as e:
                raise ValueError(f"{path}: {e}") from e
            finally:
                close()

    def _batch(self, path: str, band: np.ndarray, y: np.ndarray, x: np.ndarray, value: np.ndarray) -> pa.RecordBatch:
        n, (year, doy) = len(y), name_date(path)
        same = lambda v, t: pa.nulls(n, t) if v is None else pa.repeat(pa.scalar(v, t), n)
        columns = {"variable": same(self.variable, pa.string()), "year": same(year, pa.int32()), "doy": same(doy, pa.int32()), "band": pa.array(band.astype(np.int32)), "y": pa.array(y.astype(np.int32)), "x": pa.array(x.astype(np.int32)), "value": pa.array(value)}
        return pa.RecordBatch.from_pydict(columns | ({"path": same(path, pa.string())} if self.with_path else {}))


class RasterSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "raster"

    def schema(self) -> str:
        path = ", path string" if str(self.options.get("with_path", "false")).lower() == "true" else ""
        return f"variable string, year int, doy int, band int, y int, x int, value double{path}"

    def reader(self, schema) -> DataSourceReader:
        return RasterReader(dict(self.options))


def read(spark: SparkSession, pattern: str, variable: str = "data", **options: str | int | bool) -> DataFrame:
    """Cells with data of an archive; filters on year, doy, band, y and x reach the files."""
    spark.conf.set(PUSHDOWN, "true")
    spark.dataSource.register(RasterSource)
    reader = spark.read.format("raster").option("variable", variable)
    for name, value in options.items():
        reader = reader.option(name, str(value).lower() if isinstance(value, bool) else value)
    return reader.load(pattern)


def read_archive(spark: SparkSession, pattern: str, variable: str = "data") -> DataFrame:
    """An archive of daily files as rows of grids.OBS; year and day come from the names."""
    return read(spark, pattern, variable).select(*[c.split()[0] for c in OBS.split(", ")])


def read_cells(spark: SparkSession, pattern: str) -> DataFrame:
    """path, y, x, value of every cell with data of the first band."""
    return read(spark, pattern, with_path=True).where("band = 1").select("path", "y", "x", "value")


def read_band(spark: SparkSession, pattern: str, name: str, band: int = 1) -> DataFrame:
    """y, x and one band under a name, such as a mean image."""
    from pyspark.sql import functions as F

    return read(spark, pattern).where(F.col("band") == band).select("y", "x", F.col("value").alias(name))
