"""GeoTIFF rasters, band 1: a reader of the plain forms of the format, and sums over zones.

Read are strips and tiles of one or more bands, uncompressed or by Deflate, of integers and floats of 8 to 64 bits, with or without
horizontal differences of integers, north up. A cell is masked where it is the no-data value or not finite. Other forms raise ValueError.
"""

from __future__ import annotations

import struct
import zlib
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from terravane.operators.spatial import points_in

# The tags and field types of the format.
WIDTH, HEIGHT, BITS, COMPRESSION, STRIPS, BANDS, STRIP_ROWS, STRIP_BYTES, PLANAR, PREDICTOR = 256, 257, 258, 259, 273, 277, 278, 279, 284, 317
TILE_WIDTH, TILE_HEIGHT, TILES, TILE_BYTES, FORMAT = 322, 323, 324, 325, 339
SCALE, TIE, NO_DATA = 33550, 33922, 42113
FIELDS = {1: "B", 2: "s", 3: "H", 4: "I", 5: "II", 6: "b", 8: "h", 9: "i", 11: "f", 12: "d", 16: "Q"}


@dataclass
class Raster:
    """Values of band 1, masked; x and y: the west and north edge; dx and dy: the size of a cell."""

    values: np.ma.MaskedArray
    x: float
    y: float
    dx: float
    dy: float


def _tags(data: bytes) -> tuple[str, dict[int, tuple]]:
    order = {b"II": "<", b"MM": ">"}.get(data[:2])
    if order is None or struct.unpack_from(order + "H", data, 2)[0] != 42:
        raise ValueError("not a TIFF file")
    at = struct.unpack_from(order + "I", data, 4)[0]
    found = {}
    for i in range(struct.unpack_from(order + "H", data, at)[0]):
        tag, kind, n = struct.unpack_from(order + "HHI", data, at + 2 + 12 * i)
        if kind not in FIELDS:
            continue
        code = f"{n}s" if kind == 2 else FIELDS[kind] * n
        size = struct.calcsize(order + code)
        start = at + 10 + 12 * i if size <= 4 else struct.unpack_from(order + "I", data, at + 10 + 12 * i)[0]
        found[tag] = struct.unpack_from(order + code, data, start)
    return order, found


def decode(data: bytes) -> Raster:
    order, tags = _tags(data)
    one = lambda tag, other=None: tags.get(tag, (other,))[0]
    width, height, bands = one(WIDTH), one(HEIGHT), one(BANDS, 1)
    if one(COMPRESSION, 1) not in (1, 8, 32946) or one(PREDICTOR, 1) not in (1, 2) or len(set(tags[BITS])) != 1:
        raise ValueError("a form of TIFF that isn't read")
    if SCALE not in tags or TIE not in tags:
        raise ValueError("no place on the map")
    kind = {1: "u", 2: "i", 3: "f"}[one(FORMAT, 1)]
    cell = np.dtype(f"{order}{kind}{tags[BITS][0] // 8}")
    planes = one(PLANAR, 1) == 2
    tiled = TILES in tags
    across, down = (one(TILE_WIDTH), one(TILE_HEIGHT)) if tiled else (width, min(one(STRIP_ROWS, height), height))
    out = np.zeros((height, width), cell)
    depth = 1 if planes else bands
    columns = -(-width // across)
    places, sizes = tags[TILES if tiled else STRIPS], tags[TILE_BYTES if tiled else STRIP_BYTES]
    for k in range(columns * -(-height // down)):
        block = data[places[k] : places[k] + sizes[k]]
        block = zlib.decompress(block) if one(COMPRESSION, 1) != 1 else block
        top, left = k // columns * down, k % columns * across
        rows = down if tiled else min(down, height - top)
        values = np.frombuffer(block, cell, rows * across * depth).reshape(rows, across, depth)
        if one(PREDICTOR, 1) == 2:
            values = np.cumsum(values, axis=1, dtype=cell)
        out[top : top + rows, left : left + across] = values[: height - top, : width - left, 0]
    blank = tags[NO_DATA][0].split(b"\0")[0].strip() if NO_DATA in tags else b""
    mask = ~np.isfinite(out) if kind == "f" else np.zeros(out.shape, bool)
    if blank and blank.lower() != b"nan":
        mask |= out == float(blank)
    i, j, _, x, y, _ = tags[TIE][:6]
    dx, dy = tags[SCALE][:2]
    return Raster(np.ma.array(out, mask=mask), x - i * dx, y + j * dy, dx, dy)


def read_raster(spark: SparkSession, path: str) -> DataFrame:
    """(x, y, value) of the unmasked cells of rasters, at their centres; one task a file."""

    def run(batches):
        import pandas as pd

        for rows in batches:
            for content in rows.content:
                r = decode(bytes(content))
                down, across = np.nonzero(~np.ma.getmaskarray(r.values))
                for a in range(0, len(down), 1 << 18):
                    i, j = down[a : a + (1 << 18)], across[a : a + (1 << 18)]
                    yield pd.DataFrame({"x": r.x + (j + 0.5) * r.dx, "y": r.y - (i + 0.5) * r.dy, "value": r.values.data[i, j].astype(float)})

    return spark.read.format("binaryFile").load(path).select("content").mapInPandas(run, "x double, y double, value double")


def zonal_sums(cells: DataFrame, zones: DataFrame, size: float, k: int) -> DataFrame:
    """(id, total, n, top): for each zone (id, ring) the sum of the values of cells whose centre it covers, how many, and the k largest values as (value, x,
    y), the westernmost and southernmost of equals first. Values below 0 count as 0."""
    keyed = cells.select(F.concat_ws(":", "x", "y").alias("point_id"), "x", "y", F.greatest("value", F.lit(0.0)).alias("value"))
    rows = points_in(keyed, zones.select("id", "ring"), size)
    rank = F.row_number().over(Window.partitionBy("id").orderBy(F.desc("value"), "x", "y"))
    best = rows.withColumn("_r", rank).where(F.col("_r") <= k).groupBy("id").agg(F.transform(F.array_sort(F.collect_list(F.struct("_r", "value", "x", "y"))), lambda s: F.struct(s.value.alias("value"), s.x.alias("x"), s.y.alias("y"))).alias("top"))
    return rows.groupBy("id").agg(F.sum("value").alias("total"), F.count("*").alias("n")).join(best, "id")
