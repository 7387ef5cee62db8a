"""GeoTIFF files: what is written is read again; layouts that others write are read."""

import struct
import zlib

import numpy as np
import pytest

from lacunar.operators.grid import clipped_transform
from lacunar.sources import geotiff, raster

TRANSFORM = [-180.0, 0.5, 0.0, 90.0, 0.0, -0.5]


def lzw(data):
    """Codes of 9 to 12 bits, the width one code early, as TIFF has them."""
    table, codes, width, word = {bytes([i]): i for i in range(256)}, [(256, 9)], 9, b""
    size = 258
    for b in data:
        if word + bytes([b]) in table:
            word += bytes([b])
            continue
        codes.append((table[word], width))
        table[word + bytes([b])] = size
        size += 1
        width = max(9, size.bit_length())
        if size == 4095:
            codes.append((256, 12))
            table, size, width = {bytes([i]): i for i in range(256)}, 258, 9
        word = bytes([b])
    if word:
        codes.append((table[word], width))
    codes.append((257, max(9, (size + 1).bit_length()) if size < 4095 else 12))
    bits = "".join(f"{c:0{w}b}" for c, w in codes)
    return bytes(int(bits[i : i + 8].ljust(8, "0"), 2) for i in range(0, len(bits), 8))


def packbits(data):
    return b"".join(bytes([len(p) - 1]) + p for p in (data[i : i + 100] for i in range(0, len(data), 100)))


def tiff(values, tile=None, compression=1, predictor=1, end="<"):
    """A file with one strip or with tiles, whole or floating numbers, either byte order."""
    kind = values.dtype.newbyteorder(end)
    h, w = values.shape
    th, tw = tile or (h, w)
    blocks = []
    for y in range(0, h, th):
        for x in range(0, w, tw):
            part = np.zeros((th, tw), values.dtype)
            cut = values[y : y + th, x : x + tw]
            part[: cut.shape[0], : cut.shape[1]] = cut
            if predictor == 2:
                part = np.diff(part, axis=1, prepend=np.zeros((th, 1), part.dtype))
            raw = part.astype(kind).tobytes()
            if predictor == 3:
                planes = part.astype(values.dtype.newbyteorder(">")).view(np.uint8).reshape(th, tw, -1).transpose(0, 2, 1).reshape(th, -1)
                raw = np.diff(planes, axis=1, prepend=np.zeros((th, 1), np.uint8)).astype(np.uint8).tobytes()
            blocks.append({1: bytes, 5: lzw, 8: zlib.compress, 32773: packbits}[compression](raw))
    at = 8 + np.cumsum([0, *map(len, blocks)])
    form = {"u": 1, "i": 2, "f": 3}[values.dtype.kind]
    tags = [(256, "I", [w]), (257, "I", [h]), (258, "H", [8 * values.dtype.itemsize]), (259, "H", [compression]), (277, "H", [1]), (317, "H", [predictor])]
    tags += [(322, "I", [tw]), (323, "I", [th]), (324, "I", at[:-1].tolist()), (325, "I", [len(b) for b in blocks])] if tile else [(273, "I", at[:-1].tolist()), (278, "I", [h]), (279, "I", [len(b) for b in blocks])]
    tags += [(339, "H", [form]), (33550, "d", [0.5, 0.5, 0.0]), (33922, "d", [2.0, 4.0, 0.0, -179.0, 88.0, 0.0])]
    extra_at, entries, extra = int(at[-1]) + 6 + 12 * len(tags), b"", b""
    for tag, code, items in tags:
        raw = struct.pack(f"{end}{len(items)}{code}", *items)
        entries += struct.pack(f"{end}HHI", tag, {"I": 4, "H": 3, "d": 12}[code], len(items))
        entries += struct.pack(f"{end}I", extra_at + len(extra)) if len(raw) > 4 else raw.ljust(4, b"\0")
        extra += raw if len(raw) > 4 else b""
    return (b"II*\0" if end == "<" else b"MM\0*") + struct.pack(f"{end}I", int(at[-1])) + b"".join(blocks) + struct.pack(f"{end}H", len(tags)) + entries + b"\0" * 4 + extra


@pytest.mark.parametrize(("kind", "tile", "compression", "predictor", "end"), [("f4", None, 1, 1, "<"), ("f4", (16, 32), 8, 1, ">"), ("i2", None, 5, 2, "<"), ("u1", (16, 16), 5, 1, "<"), ("f8", None, 32773, 1, ">"), ("f4", (32, 16), 8, 3, "<"), ("u2", (16, 16), 8, 2, "<")])
def test_layouts(kind, tile, compression, predictor, end):
    values = (np.arange(45 * 50).reshape(45, 50) * 7 % 251).astype(kind)
    image = geotiff.Image(tiff(values, tile, compression, predictor, end))
    got = np.full(values.shape, 255, np.float64)
    for y, x, part in image.blocks():
        got[y : y + part.shape[0], x : x + part.shape[1]] = part
    assert (got == values).all() and image.transform == TRANSFORM


def test_lzw_of_long_tables():
    data = np.random.default_rng(1).integers(0, 9, 30000, dtype=np.uint8).tobytes()
    assert geotiff._unlzw(lzw(data)) == data


@pytest.mark.parametrize("kind", ["f4", "i2"])
def test_encode(kind):
    values = (np.arange(130 * 7).reshape(130, 7) - 300).astype(kind)
    image = geotiff.Image(geotiff.encode(values, TRANSFORM, -9999.0))
    assert (np.concatenate([b for _, _, b in image.blocks()]) == values).all() and image.ndv == -9999.0 and image.transform == TRANSFORM


def test_written_mosaic_is_read(spark, tmp_path):
    data = [("LST_Day", 2001, d, y, x, None if (x + y) % 5 == 0 else float(x * 10 + y + d), None if x % 2 else 1.5, (x * y) % 256) for d in (1, 9) for y in range(7) for x in range(5)]
    df = spark.createDataFrame(data, "variable string, year int, doy int, y int, x int, value double, dist double, flags short")
    files = geotiff.write_geotiff(df, str(tmp_path / "out"), 7, 5, TRANSFORM, side=4).collect()
    assert len(files) == 2 * 4 * 3
    own = f"{tmp_path}/out/LST_Day/FilledData/*.tif"
    meta = {(r["path"].split(".")[2], *r["path"].split(".")[-3:-1]): r for r in geotiff.read_meta(spark, own).collect()}
    assert len(meta) == 8
    for (_, fy, fx), r in meta.items():
        t = clipped_transform(TRANSFORM, 4 * int(fy), 4 * int(fx))
        assert [r[c] for c in ("gx", "sx", "rx", "gy", "ry", "sy")] == t and r["ndv"] == -9999.0
    got = {}
    for r in raster.read_cells(spark, own).collect():
        *_, doy, _, _, _, fy, fx, _ = r["path"].split(".")
        got[int(doy), 4 * int(fy) + r["y"], 4 * int(fx) + r["x"]] = r["value"]
    assert got == {(d, y, x): v for _, _, d, y, x, v, *_ in data if v is not None}
    days = {(r["year"], r["doy"], r["variable"]) for r in raster.read_archive(spark, own, "LST_Day").collect()}
    assert days == {(2001, 1, "LST_Day"), (2001, 9, "LST_Day")}
