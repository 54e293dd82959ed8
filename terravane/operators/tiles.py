"""Vector tiles (MVT 2.1) of polygons, and PMTiles v3 archives of tiles.

Polygons are dealt to the tiles that their bounds cover, those below two pixels are dropped, so a tile holds no more features than
its pixels allow; tiles are encoded in parallel and archived in order of their Hilbert ids.
"""

from __future__ import annotations

import gzip
import hashlib
import json
import os
import struct

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terravane.functions import geo, kernel
from terravane.operators import measure, spatial

EXTENT, BUFFER = 4096, 64


def varint(n: int) -> bytes:
    out = bytearray()
    while n > 0x7F:
        out.append(n & 0x7F | 0x80)
        n >>= 7
    out.append(n)
    return bytes(out)


def read_varint(data: bytes, at: int) -> tuple[int, int]:
    n = shift = 0
    while True:
        b = data[at]
        at += 1
        n |= (b & 0x7F) << shift
        shift += 7
        if b < 0x80:
            return n, at


def zigzag(n: int) -> int:
    return n << 1 if n >= 0 else (-n << 1) - 1


def unzigzag(n: int) -> int:
    return n >> 1 if n & 1 == 0 else -((n + 1) >> 1)


def _field(number: int, data: bytes) -> bytes:
    return varint(number << 3 | 2) + varint(len(data)) + data


def ring_commands(rings: list[list[tuple[int, int]]]) -> list[int]:
    """MoveTo, LineTo and ClosePath of exterior rings (clockwise on the screen, where y grows downwards)."""
    out, x, y = [], 0, 0
    for ring in rings:
        ring = [p for i, p in enumerate(ring) if p != ring[i - 1]]
        if len(ring) < 3 or not kernel.area(ring):
            continue
        if kernel.area(ring) < 0:
            ring.reverse()
        for i, (u, v) in enumerate(ring):
            if i < 2:
                out.append(1 | 1 << 3 if i == 0 else 2 | (len(ring) - 1) << 3)
            out += [zigzag(u - x), zigzag(v - y)]
            x, y = u, v
        out.append(7 | 1 << 3)
    return out


def encode_value(value) -> bytes:
    if isinstance(value, bool):
        return varint(7 << 3) + varint(int(value))
    if isinstance(value, int):
        return varint(6 << 3) + varint(zigzag(value)) if value < 0 else varint(5 << 3) + varint(value)
    if isinstance(value, float):
        return varint(3 << 3 | 1) + struct.pack("<d", value)
    return _field(1, str(value).encode())


def encode_layer(name: str, features: list[tuple[int, list[int], dict]]) -> bytes:
    """features: (id, commands, properties); null properties are left out."""
    keys: dict[str, int] = {}
    values: dict[bytes, int] = {}
    body = _field(1, name.encode())
    for fid, commands, props in features:
        tags = []
        for k in sorted(props):
            if props[k] is not None:
                tags += [keys.setdefault(k, len(keys)), values.setdefault(encode_value(props[k]), len(values))]
        feature = varint(1 << 3) + varint(fid) + _field(2, b"".join(map(varint, tags))) + varint(3 << 3) + varint(3) + _field(4, b"".join(map(varint, commands)))
        body += _field(2, feature)
    body += b"".join(_field(3, k.encode()) for k in keys) + b"".join(_field(4, v) for v in values)
    return _field(3, body + varint(5 << 3) + varint(EXTENT) + varint(15 << 3) + varint(2))


def feature_id(name: str) -> int:
    """The first 13 hex digits of the SHA-256."""
    return int(hashlib.sha256(name.encode()).hexdigest()[:13], 16)


def encode_tiles(polygons: DataFrame, zooms: tuple[int, int], layer: str, props: list[str]) -> DataFrame:
    """(tile_id, z, x, y, data) of polygons (id, ring and the columns props); data is gzip without a time stamp.
    Beyond a pole there is no map, so polygons end there."""
    bounds = spatial.boxes(polygons)
    z = F.col("z")
    covered = spatial.tile_cover(bounds, zooms).join(bounds, "id")
    wide = (F.col("x2") - F.col("x1")) / 360 * F.pow(F.lit(2.0), z) * 256
    high = lambda lat: geo.mercator(geo.on_globe(lat))
    tall = (high(F.col("y2")) - high(F.col("y1"))) / (2 * geo.PI) * F.pow(F.lit(2.0), z) * 256
    shown = covered.where(((wide >= 2) | (tall >= 2)) & (tall > 0))
    n = F.pow(F.lit(2.0), z)
    px = F.transform("ring", lambda p: F.struct(F.bround(((p.x + 180) / 360 * n - F.col("x")) * EXTENT).cast("long").alias("x"), F.bround(((1 - high(p.y) / geo.PI) / 2 * n - F.col("y")) * EXTENT).cast("long").alias("y")))
    rows = shown.select("z", "x", "y", "id", px.alias("px"), *props)
    window = kernel.pieces_of([(-BUFFER, -BUFFER), (EXTENT + BUFFER, -BUFFER), (EXTENT + BUFFER, EXTENT + BUFFER), (-BUFFER, EXTENT + BUFFER)])
    low, high = -BUFFER, EXTENT + BUFFER

    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        features = []
        for row in rows.sort_values("id").to_dict("records"):
            ring = [(int(p["x"]), int(p["y"])) for p in row["px"]][:-1]
            if all(low <= u <= high and low <= v <= high for u, v in ring):
                rings = [ring]
            else:
                rings = [[(round(u), round(v)) for u, v in p] for p in kernel.intersection(kernel.pieces_of(ring), window)]
            commands = ring_commands(rings)
            if commands:
                features.append((feature_id(row["id"]), commands, {p: None if pd.isna(row[p]) else row[p] for p in props} | {"id": row["id"]}))
        data = [gzip.compress(encode_layer(layer, features), mtime=0)] if features else []
        return pd.DataFrame([(int(key[0]), int(key[1]), int(key[2]), d) for d in data], columns=["z", "x", "y", "data"])

    tiles = rows.groupBy("z", "x", "y").applyInPandas(run, "z int, x long, y long, data binary")
    return tiles.select(geo.hilbert_tile_id(F.col("z"), F.col("x"), F.col("y")).alias("tile_id"), "z", "x", "y", "data")


def directory(entries: list[tuple[int, int, int, int]]) -> bytes:
    """A PMTiles directory of (tile_id, offset, length, run)."""
    out, last = varint(len(entries)), 0
    for tile_id, *_ in entries:
        out += varint(tile_id - last)
        last = tile_id
    out += b"".join(varint(e[3]) for e in entries) + b"".join(varint(e[2]) for e in entries)
    for i, (_, offset, _, _) in enumerate(entries):
        out += varint(0 if i and offset == entries[i - 1][1] + entries[i - 1][2] else offset + 1)
    return gzip.compress(out, mtime=0)


def read_directory(data: bytes) -> list[tuple[int, int, int, int]]:
    data, at, columns = gzip.decompress(data), 0, []
    n, at = read_varint(data, at)
    for _ in range(4):
        column = []
        for _ in range(n):
            v, at = read_varint(data, at)
            column.append(v)
        columns.append(column)
    out, tile_id = [], 0
    for i in range(n):
        tile_id += columns[0][i]
        offset = columns[3][i] - 1 if columns[3][i] else out[-1][1] + out[-1][2]
        out.append((tile_id, offset, columns[2][i], columns[1][i]))
    return out


def entries_of(tiles: DataFrame) -> DataFrame:
    """(tile_id, sha, length, run): equal neighbours by id as one run, within blocks of 65,536 ids that are scanned apart."""
    keyed = tiles.select(F.expr("tile_id div 65536").alias("g"), "tile_id", F.struct(F.sha2("data", 256).alias("sha"), F.length("data").alias("length")).alias("v"))
    return measure.run_lengths(keyed, "g", "tile_id", "v").select(F.col("first").alias("tile_id"), "value.sha", "value.length", F.col("length").alias("run"))


HEADER = struct.Struct("<7sB8Q3Q6B4iB2i")
ROOT_LIMIT = 16384 - HEADER.size


def write_archive(tiles: DataFrame, path: str, zooms: tuple[int, int], bounds: tuple[float, float, float, float], metadata: dict) -> int:
    """One PMTiles file on the driver's disk; tiles come over in order, partition by partition. Returns the count of tiles.

    Tiles of equal bytes are stored once; consecutive ones share an entry. Entries that overflow the root go to leaves.
    """
    places: dict[bytes, tuple[int, int]] = {}
    entries: list[list[int]] = []
    n = at = 0
    with open(path + ".data", "wb") as body:
        for row in tiles.orderBy("tile_id").toLocalIterator(prefetchPartitions=True):
            data, n = bytes(row.data), n + 1
            sha = hashlib.sha256(data).digest()
            if sha not in places:
                places[sha] = (at, len(data))
                body.write(data)
                at += len(data)
            offset, length = places[sha]
            last = entries[-1] if entries else None
            if last and last[1] == offset and row.tile_id == last[0] + last[3]:
                last[3] += 1
            else:
                entries.append([row.tile_id, offset, length, 1])
    root, leaves = directory([tuple(e) for e in entries]), b""
    size = 4096
    while len(root) > ROOT_LIMIT:
        leaves, tops = b"", []
        for i in range(0, len(entries), size):
            leaf = directory([tuple(e) for e in entries[i : i + size]])
            tops.append((entries[i][0], len(leaves), len(leaf), 0))
            leaves += leaf
        root, size = directory(tops), size * 2
    about = gzip.compress(json.dumps(metadata, sort_keys=True, separators=(",", ":")).encode(), mtime=0)
    start = HEADER.size
    e7 = [round(v * 10**7) for v in bounds]
    spans = [(start, len(root)), (start + len(root), len(about)), (start + len(root) + len(about), len(leaves)), (start + len(root) + len(about) + len(leaves), at)]
    head = HEADER.pack(b"PMTiles", 3, *[v for s in spans for v in s], n, len(entries), len(places), 1, 2, 2, 1, zooms[0], zooms[1], *e7, zooms[0], (e7[0] + e7[2]) // 2, (e7[1] + e7[3]) // 2)
    with open(path, "wb") as out, open(path + ".data", "rb") as body:
        out.write(head + root + about + leaves)
        while chunk := body.read(1 << 20):
            out.write(chunk)
    os.remove(path + ".data")
    return n


class Archive:
    """A PMTiles file to read tiles from."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            self.data = f.read()
        fields = HEADER.unpack_from(self.data)
        if fields[:2] != (b"PMTiles", 3):
            raise ValueError("not a PMTiles v3 archive")
        self.root, self.about, self.leaves, self.body = (tuple(fields[i : i + 2]) for i in (2, 4, 6, 8))
        self.tiles, self.entries, self.contents = fields[10:13]

    @property
    def metadata(self) -> dict:
        return json.loads(gzip.decompress(self.data[self.about[0] : sum(self.about)]))

    def directory(self) -> list[tuple[int, int, int, int]]:
        """All entries, leaves expanded."""
        out = []
        for e in read_directory(self.data[self.root[0] : sum(self.root)]):
            if e[3]:
                out.append(e)
            else:
                at = self.leaves[0] + e[1]
                out += read_directory(self.data[at : at + e[2]])
        return out

    def tile(self, tile_id: int) -> bytes | None:
        for first, offset, length, run in self.directory():
            if first <= tile_id < first + run:
                at = self.body[0] + offset
                return gzip.decompress(self.data[at : at + length])
        return None
