"""The overlay kernel, partitions and tiles by their invariants."""

import gzip
import math
import random

import pytest
from pyspark.sql import functions as F

from terravane.functions import geo, kernel
from terravane.operators import partition, spatial, tiles


def box(x1, y1, x2, y2):
    return [(x1, y1), (x2, y1), (x2, y2), (x1, y2), (x1, y1)]


def polygons(spark, rows, more=""):
    data = [(i, [{"x": float(x), "y": float(y)} for x, y in ring], *rest) for i, ring, *rest in rows]
    return spark.createDataFrame(data, f"id string, ring array<struct<x:double,y:double>>{more}")


L = [(0, 0), (4, 0), (4, 1), (1, 1), (1, 4), (0, 4)]


def test_kernel():
    pieces = kernel.pieces_of(L)
    assert kernel.total(pieces) == pytest.approx(7) and kernel.total(kernel.pieces_of(L[::-1])) == pytest.approx(7)
    other = kernel.pieces_of(box(0.5, 0.5, 3, 3))
    both, left = kernel.intersection(pieces, other), kernel.difference(pieces, other)
    assert kernel.total(both) == pytest.approx(0.5 * 2.5 + 0.5 * 2) and kernel.total(both) + kernel.total(left) == pytest.approx(7)
    assert kernel.total(kernel.union([pieces, other])) == pytest.approx(7 + 6.25 - kernel.total(both))
    assert kernel.border(kernel.pieces_of(box(0, 0, 1, 1)), kernel.pieces_of(box(1, 0.25, 2, 3))) == pytest.approx(0.75)
    cells = kernel.voronoi(pieces, [(0.5, 0.5), (3, 0.5), (0.5, 3)])
    assert sum(map(kernel.total, cells)) == pytest.approx(7)


def test_kernel_on_random_stars():
    rng = random.Random(1)
    for _ in range(40):
        def star():
            x, y = rng.random() * 2, rng.random() * 2
            return [(x + math.cos(a) * r, y + math.sin(a) * r) for a, r in ((2 * math.pi * i / 9, 0.5 + rng.random()) for i in range(9))]
        a, b = kernel.pieces_of(star()), kernel.pieces_of(star())
        both = kernel.total(kernel.intersection(a, b))
        assert kernel.total(kernel.difference(a, b)) + both == pytest.approx(kernel.total(a), abs=1e-8)
        assert kernel.total(kernel.union([a, b])) == pytest.approx(kernel.total(a) + kernel.total(b) - both, abs=1e-8)


def test_borders_of_uneven_boxes(spark):
    rows = polygons(spark, [("a", box(0, 0, 1, 1)), ("b", box(1, 0, 2, 2)), ("c", box(0, 1, 1, 2)), ("d", box(2, 2, 3, 3)), ("e", [(0, 0), (1, 0), (0, -1), (0, 0)])])
    found = {(r.a, r.b): r.km for r in spatial.shared_borders(rows, 0.001).collect()}
    assert set(found) == {("a", "b"), ("b", "c"), ("a", "c"), ("a", "e")}  # d meets b in a corner alone
    assert found["a", "b"] == pytest.approx(geo.DEGREE_KM, rel=1e-6)


def test_adjacency_kinds(spark):
    land = polygons(spark, [("a", box(0, 0, 1, 1)), ("b", box(1, 0, 2, 1)), ("c", box(2.3, 0, 3, 1))])
    seas = polygons(spark, [("s", box(2, 0, 2.3, 1), "b", "coastal"), ("t", box(2, 1, 2.3, 2), "c", "coastal")], ", parent string, sea_class string")
    rows = [tuple(r)[:4] for r in spatial.adjacency(land, seas, 0.001, 50).collect()]
    assert rows == [("a", "b", "land", "shared_border"), ("b", "s", "port_to_sea", "port"), ("c", "t", "port_to_sea", "port"), ("s", "t", "sea", "shared_border"), ("b", "c", "strait", "strait")]
    assert [r.adjacency_type for r in spatial.adjacency(land, None, 0.001, 50).collect()] == ["land"]


def test_points_on_borders_count_for_all(spark):
    rows = polygons(spark, [("a", box(0, 0, 1, 1)), ("b", box(1, 0, 2, 1)), ("l", [*L, L[0]])])
    points = spark.createDataFrame([(1, 1.0, 0.5), (2, 0.5, 0.5), (3, 3.0, 3.0), (4, 1.5, 1.5)], "point_id int, x double, y double")
    assert sorted((r.point_id, r.id) for r in spatial.points_in(points, rows, 0.7).collect()) == [(1, "a"), (1, "b"), (1, "l"), (2, "a"), (2, "l")]


def test_ordered_claims_share_out(spark):
    places = polygons(spark, [("x", box(0, 0, 2, 1)), ("y", box(5, 5, 6, 6))])
    references = polygons(spark, [("r1", box(0, 0, 1, 1)), ("r2", box(0.5, 0, 1.5, 1)), ("r3", box(0, 0, 9, 9))])
    rows = {(r.location, r.reference): r for r in partition.ordered_claims(places, references, 1.0).collect()}
    assert {k: round(r.area, 9) for k, r in rows.items()} == {("x", "r1"): 1, ("x", "r2"): 0.5, ("x", "r3"): 0.5, ("y", "r3"): 1}


def test_overlaps_and_gaps(spark):
    rows = polygons(spark, [("a", box(0, 0, 2, 2)), ("b", box(1, 1, 3, 3)), ("c", box(2, 2, 4, 4)), ("z", box(9, 9, 10, 10))])
    assert {r.id: round(r.area, 9) for r in partition.without_overlaps(rows, 1.5).collect()} == {"a": 4, "b": 3, "c": 3, "z": 1}
    masks = polygons(spark, [("m", box(0, 0, 4, 4)), ("n", box(9, 9, 10, 10)), ("o", box(20, 20, 21, 21))])
    assert {r.mask: round(r.area, 9) for r in partition.gaps(masks, rows, 1.5).collect()} == {"m": 16 - 10, "o": 1}


def test_refinement_keeps_area_and_people(spark):
    parents = polygons(spark, [("p", [*L, L[0]], 4, 1000.0), ("q", box(10, 10, 12, 12), 1, 50.0)], ", parts int, population double")
    points = spark.createDataFrame([("p", 0.5, 3.5, 10.0, "settlement", "s1"), ("p", 3.5, 0.5, 5.0, "population", "s2"), ("q", 11.0, 11.0, 1.0, "settlement", "s3")], "id string, x double, y double, weight double, kind string, point_id string")
    rows = partition.refine(parents, points).collect()
    p = [r for r in rows if r.parent == "p"]
    assert sum(r.area for r in p) == pytest.approx(7) and sum(r.population for r in p) == pytest.approx(1000)
    assert len(rows) - len(p) == 1 and sorted(r.part for r in p) == list(range(len(p)))
    assert [tuple(r)[:6] for r in rows] == [tuple(r)[:6] for r in partition.refine(parents, points).collect()]


def test_tiny_cells_are_merged():
    cells = [(kernel.pieces_of(box(0, 0, 1, 1)), 1.0), (kernel.pieces_of(box(1, 0, 1.1, 0.1)), 2.0), (kernel.pieces_of(box(5, 5, 7, 7)), 3.0)]
    merged = partition.merge_tiny(cells, 0.1)
    assert len(merged) == 2 and sum(n for _, n in merged) == 6 and max(n for c, n in merged if kernel.total(c) < 2) == 3


def test_ocean_grid(spark):
    cells = partition.ocean_grid((-10, -5, 10, 5), 5, spark)
    assert cells.count() == 8 and cells.select("id").distinct().count() == 8


def test_hilbert_round_trip(spark):
    rows = spark.range(0, 5461).select("id", geo.tile_of_hilbert(F.col("id")).alias("t")).select("id", "t.*")
    assert rows.withColumn("back", geo.hilbert_tile_id(F.col("z"), F.col("x"), F.col("y"))).where("back <> id").count() == 0


def decoded(data):
    """Fields of a protobuf message: (number, value)."""
    at, out = 0, []
    while at < len(data):
        key, at = tiles.read_varint(data, at)
        if key & 7 == 2:
            n, at = tiles.read_varint(data, at)
            out.append((key >> 3, data[at : at + n]))
            at += n
        elif key & 7 == 1:
            out.append((key >> 3, data[at : at + 8]))
            at += 8
        else:
            v, at = tiles.read_varint(data, at)
            out.append((key >> 3, v))
    return out


def test_archive_round_trip(spark, tmp_path):
    rows = polygons(spark, [(f"p{i}", box(i * 10 - 60, 0, i * 10 - 50, 10), i) for i in range(12)], ", n int")
    encoded = tiles.encode_tiles(rows, (0, 4), "provinces", ["n"])
    path = str(tmp_path / "a.pmtiles")
    n = tiles.write_archive(encoded, path, (0, 4), (-60, 0, 60, 10), {"name": "t"})
    first = open(path, "rb").read()
    tiles.write_archive(encoded, path, (0, 4), (-60, 0, 60, 10), {"name": "t"})
    assert open(path, "rb").read() == first  # byte for byte
    archive = tiles.Archive(path)
    assert (archive.tiles, archive.metadata) == (n, {"name": "t"})
    assert sum(e[3] for e in archive.directory()) == n == encoded.count()
    for r in encoded.collect():
        assert archive.tile(r.tile_id) == gzip.decompress(r.data)
    layer = decoded(decoded(archive.tile(0))[0][1])
    assert (1, b"provinces") in layer and sum(k == 2 for k, _ in layer) == 12
    assert tiles.entries_of(encoded).agg(F.sum("run")).first()[0] == n


def test_large_directories_use_leaves(spark, tmp_path):
    rng = random.Random(3)
    rows = spark.createDataFrame([(i * 3, bytes([rng.randrange(256) for _ in range(rng.randrange(1, 40))])) for i in range(20000)], "tile_id long, data binary").withColumn("data", F.col("data"))
    path = str(tmp_path / "b.pmtiles")
    tiles.write_archive(rows, path, (0, 8), (0, 0, 1, 1), {})
    archive = tiles.Archive(path)
    assert archive.root[1] <= tiles.ROOT_LIMIT and archive.leaves[1] > 0 and len(archive.directory()) == 20000


def test_zigzag_and_varint():
    for n in (0, 1, -1, 63, -64, 2**31, -(2**31)):
        assert tiles.unzigzag(tiles.zigzag(n)) == n
        assert tiles.read_varint(tiles.varint(tiles.zigzag(n)), 0)[0] == tiles.zigzag(n)
