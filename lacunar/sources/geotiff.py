"""GeoTIFF in and out, by the public TIFF 6.0, BigTIFF and GeoTIFF layouts, without a raster library.

Read: one band or several, of one kind, cell by cell or band by band; striped or tiled, whole numbers or floats of 8 to 64 bits,
without compression or with deflate, LZW or PackBits, with the horizontal or the floating-point predictor. Written: float32 or
int16 in deflated strips or tiles, in degrees on WGS 84. `raster` reads archives block by block; images are written as mosaics:
a file for each FILE x FILE cells, with its own place on the ground, each by a task.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lacunar.operators.grid import clipped_transform
from lacunar.sources.grids import file_date
from lacunar.sources.sinks import FILE, KINDS

# Bytes and struct codes of the field types; the tags that are read or written.
SIZES = {1: (1, "B"), 2: (1, "c"), 3: (2, "H"), 4: (4, "I"), 5: (8, "II"), 6: (1, "b"), 8: (2, "h"), 9: (4, "i"), 11: (4, "f"), 12: (8, "d"), 13: (4, "I"), 16: (8, "Q"), 17: (8, "q"), 18: (8, "Q")}
WIDTH, HEIGHT, BITS, COMPRESSION, PHOTOMETRIC, STRIPS, SAMPLES, ROWS, STRIP_BYTES, PREDICTOR = 256, 257, 258, 259, 262, 273, 277, 278, 279, 317
TILE_WIDTH, TILE_HEIGHT, TILES, TILE_BYTES, FORMAT, SCALE, TIE, KEYS, NO_DATA = 322, 323, 324, 325, 339, 33550, 33922, 34735, 42113
PLANAR, EXTRA = 284, 338
META = "path string, height int, width int, gx double, sx double, rx double, gy double, ry double, sy double, ndv double, bands int"
PAGE = 1 << 14


def _unlzw(data: bytes) -> bytes:
    out, table = [], []
    bits, width, held, last = 0, 9, 0, None
    for byte in data:
        held, bits = (held << 8) | byte, bits + 8
        while bits >= width:
            bits -= width
            code = held >> bits
            held &= (1 << bits) - 1
            if code == 257:
                return b"".join(out)
            if code == 256:
                table, width, last = [bytes([i]) for i in range(256)] + [b"", b""], 9, None
                continue
            word = table[code] if code < len(table) else last + last[:1]
            out.append(word)
            if last is not None:
                table.append(last + word[:1])
                width = min(12, max(9, (len(table) + 1).bit_length()))
            last = word
    return b"".join(out)


def _unpackbits(data: bytes) -> bytes:
    out, at = [], 0
    while at < len(data):
        n = data[at]
        at += 1
        if n < 128:
            out.append(data[at : at + n + 1])
            at += n + 1
        elif n > 128:
            out.append(data[at : at + 1] * (257 - n))
            at += 1
    return b"".join(out)


DECODERS = {1: bytes, 5: _unlzw, 8: zlib.decompress, 32946: zlib.decompress, 32773: _unpackbits}


@dataclass(frozen=True)
class Block:
    """A strip or tile, or some rows of a strip that isn't compressed: where its bytes lie, its first cell, its size in cells, and
    its band (0: all bands, one after another in each cell)."""

    at: int
    size: int
    y: int
    x: int
    rows: int
    columns: int
    band: int


class Image:
    """Header of one file's first image, and its blocks. `source`: the file's bytes, or a function that reads (at, size) of it;
    then the header and each block are read by ranges."""

    def __init__(self, source: bytes | memoryview | Callable[[int, int], bytes]):
        self.read = source if callable(source) else lambda at, size: bytes(source[at : at + size])
        order = bytes(self.read(0, 2))
        self.end = {b"II": "<", b"MM": ">"}.get(order)
        big = self.end and self._at("H", 2)[0] == 43
        if self.end is None or self._at("H", 2)[0] not in (42, 43):
            raise ValueError("not a TIFF file")
        start = self._at("Q", 8)[0] if big else self._at("I", 4)[0]
        n, first, step, small = (self._at("Q", start)[0], start + 8, 20, 8) if big else (self._at("H", start)[0], start + 2, 12, 4)
        self.tags: dict[int, tuple] = {}
        for i in range(n):
            at = first + step * i
            tag, kind = self._at("HH", at)
            count = self._at("Q" if big else "I", at + 4)[0]
            size, code = SIZES.get(kind, (1, "B"))
            value = at + 4 + small
            if size * count > small:
                value = self._at("Q" if big else "I", value)[0]
            self.tags[tag] = (bytes(self.read(value, count)),) if kind == 2 else self._at(code * count, value)
        one = lambda tag, default=None: self.tags.get(tag, (default,))[0]
        self.height, self.width, self.compression, self.predictor = one(HEIGHT), one(WIDTH), one(COMPRESSION, 1), one(PREDICTOR, 1)
        self.bands, self.planar = one(SAMPLES, 1), one(PLANAR, 1) == 2
        if len({*self.tags.get(BITS, (1,)), *self.tags.get(FORMAT, (1,))}) > 2 or self.compression not in DECODERS:
            raise ValueError("bands of different kinds, or a compression that isn't read")
        self.kind = np.dtype(f"{self.end}{ {1: 'u', 2: 'i', 3: 'f'}[one(FORMAT, 1)] }{one(BITS, 1) // 8}")
        self.ndv = float(one(NO_DATA, b"nan").rstrip(b"\0 ") or "nan")
        (sx, sy, *_), tie = self.tags.get(SCALE, (1.0, 1.0, 0.0)), self.tags.get(TIE, (0.0,) * 6)
        self.transform = [tie[3] - tie[0] * sx, sx, 0.0, tie[4] + tie[1] * sy, 0.0, -sy]
        self.tiled = TILES in self.tags
        self.rows, self.columns = (one(TILE_HEIGHT), one(TILE_WIDTH)) if self.tiled else (min(one(ROWS, self.height), self.height), self.width)
        self.inside = 1 if self.planar else self.bands  # bands of a block

    def _at(self, code: str, at: int) -> tuple:
        return struct.unpack(self.end + code, self.read(at, struct.calcsize(self.end + code)))

    def layout(self, cells: int = 1 << 20) -> Iterator[Block]:
        """All blocks; a strip of more cells is cut into runs of rows, unless it must be decompressed whole."""
        starts, sizes = (self.tags[TILES], self.tags[TILE_BYTES]) if self.tiled else (self.tags[STRIPS], self.tags[STRIP_BYTES])
        across, down = -(-self.width // self.columns), -(-self.height // self.rows)
        for i, (at, size) in enumerate(zip(starts, sizes, strict=True)):
            band, spot = divmod(i, across * down) if self.planar else (-1, i)
            y, x = spot // across * self.rows, spot % across * self.columns
            rows = self.rows if self.tiled else min(self.rows, self.height - y)
            if self.compression == 1 and not self.tiled and rows * self.columns > cells:
                step, wide = max(1, cells // self.columns), self.columns * self.inside * self.kind.itemsize
                for a in range(0, rows, step):
                    n = min(step, rows - a)
                    yield Block(at + a * wide, n * wide, y + a, x, n, self.columns, band + 1)
            else:
                yield Block(at, size, y, x, rows, self.columns, band + 1)

    def values(self, block: Block) -> np.ndarray:
        """(rows, columns, bands) of a block, cut to the image."""
        raw = DECODERS[self.compression](bytes(self.read(block.at, block.size)))
        return self._plain(raw, block.rows)[: self.height - block.y, : self.width - block.x]

    def blocks(self) -> Iterator[tuple[int, int, np.ndarray]]:
        """(first row, first column, values of the first band) of every block."""
        for block in self.layout():
            if block.band <= 1:
                yield block.y, block.x, self.values(block)[..., 0]

    def _plain(self, raw: bytes, rows: int) -> np.ndarray:
        wide = self.columns * self.inside
        if self.predictor == 3:  # bytes of a row, the highest first, each as the difference from the one a cell before
            n = self.kind.itemsize
            planes = np.frombuffer(raw, np.uint8, rows * wide * n).reshape(rows, n * self.columns, self.inside)
            planes = np.cumsum(planes, axis=1, dtype=np.uint8).reshape(rows, n, wide)
            return np.ascontiguousarray(planes.transpose(0, 2, 1)).view(f">f{n}").reshape(rows, self.columns, self.inside)
        values = np.frombuffer(raw, self.kind, rows * wide).reshape(rows, self.columns, self.inside)
        return np.cumsum(values, axis=1, dtype=values.dtype.newbyteorder("=")) if self.predictor == 2 else values


def ranges(uri: str) -> tuple[Callable[[int, int], bytes], Callable[[], None]]:
    """(reader of ranges of a file, what closes it). Small ranges, as those of a header, are cut out of pages of PAGE bytes."""
    fs, path = open_uri(uri)
    source, pages = fs.open_input_file(path), {}

    def read(at: int, size: int) -> bytes:
        if size > PAGE:
            return source.read_at(size, at)
        out = b""
        for page in range(at // PAGE, (at + max(size, 1) - 1) // PAGE + 1):
            if page not in pages:
                while len(pages) >= 8:
                    pages.pop(next(iter(pages)))
                pages[page] = source.read_at(PAGE, page * PAGE)
            out += pages[page]
        skip = at - at // PAGE * PAGE
        return out[skip : skip + size]

    return read, source.close


def _meta(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [c.split()[0] for c in META.split(", ")]
    for batch in batches:
        for path in batch.column("path").to_pylist():
            read, close = ranges(path)
            i = Image(read)
            close()
            row = [path, i.height, i.width, *i.transform, None if np.isnan(i.ndv) else i.ndv, i.bands]
            kinds = [pa.string(), pa.int32(), pa.int32(), *[pa.float64()] * 7, pa.int32()]
            yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, kinds, strict=True)], names=names)


def read_meta(spark: SparkSession, pattern: str, days: Sequence[int] = ()) -> DataFrame:
    """Size, affine transform, no-data value (`ndv`) and number of bands of the files that match a pattern, or of those of some
    days of year. Names are listed; of each file its header is read, by ranges."""
    files = spark.read.format("binaryFile").load(pattern).select("path")
    if days and 0 not in days:
        files = files.where(file_date(F.col("path"))["doy"].isin(*days))
    return files.repartition(3 * spark.sparkContext.defaultParallelism).mapInArrow(_meta, META)


def encode(values: np.ndarray, transform: list[float], ndv: float, rows: int = 64, tile: int | None = None) -> bytes:
    """One image (float32 or int16) as a GeoTIFF file: (rows, columns) or (bands, rows, columns), band after band; in deflated
    strips or, with `tile` (a multiple of 16), in deflated tiles."""
    kind = np.dtype("<f4") if values.dtype.kind == "f" else np.dtype("<i2")
    planes = values[None] if values.ndim == 2 else values
    bands, height, width = planes.shape
    blocks = []
    for plane in planes:
        for y in range(0, height, tile or rows):
            for x in range(0, width, tile or width):
                part = plane[y : y + (tile or rows), x : x + (tile or width)]
                if tile and part.shape != (tile, tile):
                    part = np.pad(part, ((0, tile - part.shape[0]), (0, tile - part.shape[1])), constant_values=0)
                blocks.append(zlib.compress(np.ascontiguousarray(part, kind).tobytes(), 6))
    gx, sx, _, gy, _, sy = transform
    starts = 8 + np.cumsum([0, *map(len, blocks)])
    text = f"{ndv:g}".encode() + b"\0"
    keys = (1, 1, 0, 3, 1024, 0, 1, 2, 1025, 0, 1, 1, 2048, 0, 1, 4326)  # geographic, cells as areas, WGS 84
    places, sizes = starts[:-1].tolist(), [len(b) for b in blocks]
    tags = [(WIDTH, "I", [width]), (HEIGHT, "I", [height]), (BITS, "H", [8 * kind.itemsize] * bands), (COMPRESSION, "H", [8]), (PHOTOMETRIC, "H", [1]), (SAMPLES, "H", [bands]), (PLANAR, "H", [2 if bands > 1 else 1])]
    tags += [(TILE_WIDTH, "I", [tile]), (TILE_HEIGHT, "I", [tile]), (TILES, "I", places), (TILE_BYTES, "I", sizes)] if tile else [(STRIPS, "I", places), (ROWS, "I", [rows]), (STRIP_BYTES, "I", sizes)]
    tags += [(EXTRA, "H", [0] * (bands - 1))] if bands > 1 else []
    tags += [(FORMAT, "H", [3 if kind.kind == "f" else 2] * bands), (SCALE, "d", [sx, -sy, 0.0]), (TIE, "d", [0.0, 0.0, 0.0, gx, gy, 0.0]), (KEYS, "H", list(keys)), (NO_DATA, "s", [text])]
    tags.sort(key=lambda t: t[0])
    head = int(starts[-1]) + int(starts[-1]) % 2
    extra_at, entries, extra = head + 2 + 12 * len(tags) + 4, b"", b""
    for tag, code, items in tags:
        field, count = {"I": 4, "H": 3, "d": 12, "s": 2}[code], len(items[0]) if code == "s" else len(items)
        raw = items[0] if code == "s" else struct.pack(f"<{count}{code}", *items)
        if len(raw) > 4:
            entries += struct.pack("<HHII", tag, field, count, extra_at + len(extra))
            extra += raw + b"\0" * (len(raw) % 2)
        else:
            entries += struct.pack("<HHI", tag, field, count) + raw.ljust(4, b"\0")
    body = b"".join(blocks).ljust(head - 8, b"\0")
    return b"II*\0" + struct.pack("<I", head) + body + struct.pack("<H", len(tags)) + entries + b"\0" * 4 + extra


def open_uri(uri: str) -> tuple[pyarrow.fs.FileSystem, str]:
    """(file system, path in it) of a path or URI."""
    if uri.startswith("file:"):
        return pyarrow.fs.LocalFileSystem(), "/" + uri.removeprefix("file:").lstrip("/")
    if uri.startswith(("s3a://", "s3n://")):
        uri = "s3://" + uri.split("://", 1)[1]
    return pyarrow.fs.FileSystem.from_uri(uri) if "://" in uri else (pyarrow.fs.LocalFileSystem(), uri)


def put(file: str, data: bytes) -> None:
    """Write a file under a name of the attempt, then give it its own."""
    fs, path = open_uri(file)
    fs.create_dir(path.rsplit("/", 1)[0], recursive=True)
    attempt = f"{path}.{uuid.uuid4().hex}"
    with fs.open_output_stream(attempt) as sink:
        sink.write(data)
    fs.move(attempt, path)


WRITTEN = "variable string, kind string, year int, doy int, fy long, fx long, file string"


def write_geotiff(df: DataFrame, folder: str, height: int, width: int, transform: list[float], ndv: float = -9999.0, kinds: dict[str, tuple[str, str]] = KINDS, side: int = FILE, tile: int | None = None) -> DataFrame:
    """Write (variable, year, doy, y, x, value, dist, flags) as mosaics; the table of files written.

    A file holds side x side cells of one image, by a name of the image and of its place in it; NULL becomes `ndv`. Its
    transform is that of the whole image moved to its first cell. Files are written under a name of the attempt and renamed.
    """

    def run(table: pa.Table) -> pa.Table:
        variable, year, doy, fy, fx = (table[c][0].as_py() for c in ("variable", "year", "doy", "fy", "fx"))
        y0, x0 = fy * side, fx * side
        y, x = table["y"].to_numpy() - y0, table["x"].to_numpy() - x0
        shape = (min(side, height - y0), min(side, width - x0))
        out = []
        for name, (column, kind) in kinds.items():
            values = np.full(shape, 0 if kind == "short" else ndv, np.int16 if kind == "short" else np.float32)
            there = table[column].is_valid().to_numpy() if hasattr(table[column], "is_valid") else ~np.isnan(table[column].to_numpy())
            values[y[there], x[there]] = table[column].to_numpy()[there]
            file = f"{folder}/{variable}/{name}/{variable}-{name}.{year}.{doy:03d}.Data.1km.Data.{fy}.{fx}.tif"
            put(file, encode(values, clipped_transform(transform, y0, x0), ndv, tile=tile))
            out.append((variable, name, year, doy, fy, fx, file))
        kinds_ = [pa.string(), pa.string(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.string()]
        names = [c.split()[0] for c in WRITTEN.split(", ")]
        return pa.table({n: pa.array([r[i] for r in out], t) for i, (n, t) in enumerate(zip(names, kinds_, strict=True))})

    rows = df.select("variable", "year", "doy", "y", "x", *dict.fromkeys(c for c, _ in kinds.values()))
    rows = rows.withColumn("fy", F.floor(F.col("y") / side)).withColumn("fx", F.floor(F.col("x") / side))
    return rows.groupBy("variable", "year", "doy", "fy", "fx").applyInArrow(run, WRITTEN)


def write_bands_geotiff(df: DataFrame, folder: str, name: str, column: str, bands: int, height: int, width: int, transform: list[float], ndv: float = -9999.0, side: int = FILE, tile: int = 256) -> DataFrame:
    """Write a column of (band, y, x, ...) as files of `bands` bands in deflated tiles, a file for each side x side cells; the table
    (fy, fx, file) of what was written. NULL becomes `ndv`."""

    def run(table: pa.Table) -> pa.Table:
        fy, fx = table["fy"][0].as_py(), table["fx"][0].as_py()
        y0, x0 = fy * side, fx * side
        values = np.full((bands, min(side, height - y0), min(side, width - x0)), ndv, np.float32)
        got = table.filter(pa.compute.is_valid(table[column]))
        values[got["band"].to_numpy() - 1, got["y"].to_numpy() - y0, got["x"].to_numpy() - x0] = got[column].to_numpy()
        file = f"{folder}/{name}.{fy}.{fx}.tif"
        put(file, encode(values, clipped_transform(transform, y0, x0), ndv, tile=tile))
        return pa.table({"fy": pa.array([fy], pa.int64()), "fx": pa.array([fx], pa.int64()), "file": pa.array([file])})

    rows = df.select("band", "y", "x", F.col(column).cast("float").alias(column)).withColumn("fy", F.floor(F.col("y") / side)).withColumn("fx", F.floor(F.col("x") / side))
    return rows.groupBy("fy", "fx").applyInArrow(run, "fy long, fx long, file string")
