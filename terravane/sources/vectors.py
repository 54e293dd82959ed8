"""GeoJSON and zipped shapefiles as DataFrames.

GeoJSON: one row a feature, its properties as a map of texts. Shapefiles: a data source that Spark reads with
spark.read.format("zipped_shapefile"), one task a file; polygons come with their holes on the exterior that holds them.
"""

from __future__ import annotations

import io
import json
import struct
import zipfile
from collections.abc import Iterator

import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

RING = "array<struct<x:double,y:double>>"
GEOJSON = "type string, features array<struct<type string, geometry struct<type string, coordinates string>, properties map<string,string>>>, crs struct<type string, properties struct<name string>>"
FEATURES = f"kind string, parts array<array<{RING}>>, properties map<string,string>"
WGS84 = ("", "EPSG:4326", "urn:ogc:def:crs:OGC:1.3:CRS84", "urn:ogc:def:crs:EPSG::4326")
#: Property names under which the weight of a point may stand, first one first.
WEIGHT_NAMES = ["weight", "population", "pop", "value", "pop_max", "pop_est"]


def read_geojson(spark: SparkSession, path: str) -> DataFrame:
    """(kind, parts, properties) of a FeatureCollection: parts of rings for polygons, one part of one line for lines, one point
    for points. Features without a geometry are left out; a document that is no FeatureCollection, or not in WGS84, raises."""
    docs = spark.read.schema(GEOJSON).option("multiLine", True).option("mode", "FAILFAST").json(path)
    name = F.coalesce("crs.properties.name", F.lit(""))
    checked = docs.withColumn("features", F.when((F.coalesce("type", F.lit("")) == "FeatureCollection") & name.isin(*WGS84), F.col("features")).otherwise(F.raise_error(F.concat(F.lit("not a WGS84 FeatureCollection: "), F.input_file_name()))))
    rows = checked.select(F.explode("features").alias("f")).where("f.geometry.type is not null")
    kind, text = F.col("f.geometry.type"), F.col("f.geometry.coordinates")
    level = lambda n: F.from_json(text, "array<" * n + "double" + ">" * n)
    point = lambda c: F.struct(c[0].alias("x"), c[1].alias("y"))
    line = lambda cs: F.transform(cs, point)
    rings = lambda rs: F.transform(rs, line)
    parts = (
        F.when(kind == "MultiPolygon", F.transform(level(4), rings)).when(kind == "Polygon", F.array(rings(level(3)))).when(kind == "MultiLineString", F.array(rings(level(3))))
        .when(kind == "LineString", F.array(F.array(line(level(2))))).when(kind == "MultiPoint", F.array(F.array(line(level(2))))).when(kind == "Point", F.array(F.array(F.array(point(level(1))))))
    )
    return rows.select(kind.alias("kind"), parts.alias("parts"), F.col("f.properties").alias("properties"))


def weighted_points(features: DataFrame) -> DataFrame:
    """(x, y, weight, properties) of points with a finite weight of 0 or more under one of WEIGHT_NAMES."""
    weight = F.coalesce(*[F.expr(f"try_cast(properties['{n}'] as double)") for n in WEIGHT_NAMES])
    rows = features.where("kind = 'Point'").select(F.col("parts")[0][0][0]["x"].alias("x"), F.col("parts")[0][0][0]["y"].alias("y"), weight.alias("weight"), "properties")
    return rows.where("weight >= 0 and weight < double('infinity')")


def to_geojson(rows: DataFrame, path: str, key: str) -> int:
    """Write one FeatureCollection in order of key to the driver's disk: ring and all other columns. Rows come one partition at a time."""
    props = [c for c in rows.columns if c != "ring"]
    features = rows.orderBy(key).select(F.col("ring"), F.to_json(F.struct(*props), {"ignoreNullFields": "false"}).alias("p"))
    n = 0
    with open(path, "w", encoding="utf-8", newline="\n") as out:
        out.write('{"type":"FeatureCollection","features":[')
        for row in features.toLocalIterator(prefetchPartitions=True):
            geometry = json.dumps({"type": "Polygon", "coordinates": [[[p.x, p.y] for p in row.ring]]}, separators=(",", ":"))
            out.write(("," if n else "") + f'\n{{"type":"Feature","geometry":{geometry},"properties":{row.p}}}')
            n += 1
        out.write("\n]}\n")
    return n


def _value(raw: bytes, kind: str):
    for encoding in ("utf-8", "latin-1"):
        try:
            text = raw.decode(encoding).strip(" \0")
            break
        except UnicodeDecodeError:
            continue
    if kind == "L":
        return {"T": "true", "Y": "true", "F": "false", "N": "false"}.get(text.upper())
    if kind in "NF":
        try:
            number = float(text)
            return str(int(number)) if number == int(number) and "." not in text else repr(number)
        except ValueError:
            return None
    return text or None


def dbf_rows(data: bytes) -> Iterator[dict[str, str | None]]:
    """Records of a dBASE table; values as texts."""
    n, head, size = struct.unpack_from("<IHH", data, 4)
    fields, at, offset = [], 32, 1
    while data[at] != 0x0D:
        name, kind, length = data[at : at + 11].split(b"\0")[0].decode("latin-1"), chr(data[at + 11]), data[at + 16]
        fields.append((name, kind, offset, length))
        offset, at = offset + length, at + 32
    for i in range(n):
        record = data[head + i * size : head + (i + 1) * size]
        yield {name: _value(record[o : o + length], kind) for name, kind, o, length in fields}


def _inside(point, ring) -> bool:
    x, y = point
    return sum((b > y) != (d > y) and x < (c - a) * (y - b) / (d - b) + a for (a, b), (c, d) in zip(ring, ring[1:])) % 2 == 1


def _signed(ring) -> float:
    return sum(a[0] * b[1] - b[0] * a[1] for a, b in zip(ring, ring[1:])) / 2


def shapes(data: bytes) -> Iterator[tuple[str, list[list[list[tuple[float, float]]]]] | None]:
    """Polygons (types 5, 15, 25) and lines (3, 13, 23) of a .shp file, None for null shapes; other types raise."""
    at = 100
    while at + 8 <= len(data):
        length = struct.unpack_from(">I", data, at + 4)[0] * 2
        body, at = data[at + 8 : at + 8 + length], at + 8 + length
        kind = struct.unpack_from("<i", body)[0]
        if kind == 0:
            yield None
            continue
        if kind not in (3, 13, 23, 5, 15, 25):
            raise ValueError(f"unsupported shape type {kind}")
        n_parts, n_points = struct.unpack_from("<2i", body, 36)
        starts = [*struct.unpack_from(f"<{n_parts}i", body, 44), n_points]
        flat = struct.unpack_from(f"<{2 * n_points}d", body, 44 + 4 * n_parts)
        points = list(zip(flat[::2], flat[1::2]))
        rings = [points[a:b] for a, b in zip(starts, starts[1:])]
        if kind in (3, 13, 23):
            yield "LineString" if n_parts == 1 else "MultiLineString", [rings]
            continue
        outer = [r for r in rings if _signed(r) <= 0]  # clockwise
        parts = [[r] for r in (outer or rings)]
        for hole in (r for r in rings if outer and _signed(r) > 0):
            home = [p for p in parts if _inside(hole[0], p[0])]
            min(home, key=lambda p: abs(_signed(p[0])), default=parts[0]).append(hole)
        yield "Polygon" if len(parts) == 1 else "MultiPolygon", parts


def read_zip(data: bytes) -> Iterator[tuple]:
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        names = {n.lower().rsplit(".", 1)[-1]: n for n in sorted(z.namelist())}
        records = dbf_rows(z.read(names["dbf"])) if "dbf" in names else iter(())
        for shape in shapes(z.read(names["shp"])):
            properties = next(records, {})
            if shape:
                yield shape[0], [[[{"x": x, "y": y} for x, y in ring] for ring in part] for part in shape[1]], properties


class _Reader(DataSourceReader):
    def __init__(self, path: str):
        self.path = path

    def partitions(self):
        fs, root = pafs.FileSystem.from_uri(self.path) if "://" in self.path else (pafs.LocalFileSystem(), self.path)
        if fs.get_file_info(root).is_file:
            return [InputPartition(self.path)]
        base = self.path.rstrip("/")
        return [InputPartition(f"{base}/{f.base_name}") for f in sorted(fs.get_file_info(pafs.FileSelector(root)), key=lambda f: f.path) if f.base_name.endswith(".zip")]

    def read(self, partition):
        path = partition.value
        fs, root = pafs.FileSystem.from_uri(path) if "://" in path else (pafs.LocalFileSystem(), path)
        with fs.open_input_file(root) as f:
            yield from read_zip(f.readall())


class ZippedShapefile(DataSource):
    """spark.read.format("zipped_shapefile").load(path of one .zip, or of a folder of them)."""

    @classmethod
    def name(cls) -> str:
        return "zipped_shapefile"

    def schema(self) -> str:
        return FEATURES

    def reader(self, schema) -> _Reader:
        return _Reader(self.options["path"])


def read_features(spark: SparkSession, path: str) -> DataFrame:
    """GeoJSON or a zipped shapefile, by the suffix."""
    if not path.lower().endswith(".zip"):
        return read_geojson(spark, path)
    spark.dataSource.register(ZippedShapefile)
    return spark.read.format("zipped_shapefile").load(path)
