"""Readers and writers by round trips and hand-made files."""

import json
import struct
import zipfile

import pytest
from pyspark.sql import functions as F

from terravane.functions import text
from terravane.operators import ownership, quality
from terravane.sources import pack, tables, vectors
from terravane.streaming import findings

from .conftest import DATA


def test_geojson(spark, tmp_path):
    square = [[[0, 0], [1, 0], [1, 1], [0, 0]]]
    document = {"type": "FeatureCollection", "features": [
        {"type": "Feature", "geometry": {"type": "Polygon", "coordinates": square}, "properties": {"name": "a", "n": 1}},
        {"type": "Feature", "geometry": {"type": "MultiPolygon", "coordinates": [square, square]}, "properties": {}},
        {"type": "Feature", "geometry": {"type": "Point", "coordinates": [2.5, 3]}, "properties": {"pop": "7"}},
        {"type": "Feature", "geometry": {"type": "Point", "coordinates": [2, 3]}, "properties": {"weight": -1}},
        {"type": "Feature", "geometry": None, "properties": {}},
        {"type": "Feature", "geometry": {"type": "LineString", "coordinates": [[0, 0], [1, 1]]}, "properties": {}},
    ]}
    path = tmp_path / "a.geojson"
    path.write_text(json.dumps(document))
    rows = vectors.read_features(spark, str(path)).collect()
    assert [(r.kind, len(r.parts), len(r.parts[0][0])) for r in rows] == [("Polygon", 1, 4), ("MultiPolygon", 2, 4), ("Point", 1, 1), ("Point", 1, 1), ("LineString", 1, 2)]
    assert rows[0].properties == {"name": "a", "n": "1"}
    assert [(r.x, r.y, r.weight) for r in vectors.weighted_points(vectors.read_geojson(spark, str(path))).collect()] == [(2.5, 3.0, 7.0)]
    path.write_text(json.dumps(document | {"crs": {"type": "name", "properties": {"name": "EPSG:3857"}}}))
    with pytest.raises(Exception, match="WGS84"):
        vectors.read_geojson(spark, str(path)).collect()


def test_geojson_round_trip(spark, tmp_path):
    rows = spark.createDataFrame([("b", [(0.0, 0.0), (1.0, 0.0), (1.0, 1.0), (0.0, 0.0)], None), ("a", [(5.0, 0.0), (6.0, 0.0), (6.0, 1.0), (5.0, 0.0)], 2)], "id string, ring array<struct<x:double,y:double>>, n int")
    path = str(tmp_path / "b.geojson")
    assert vectors.to_geojson(rows, path, "id") == 2
    back = vectors.read_geojson(spark, path).collect()
    assert [r.properties["id"] for r in back] == ["a", "b"] and json.load(open(path))["features"][1]["properties"] == {"id": "b", "n": None}


def shapefile(path, shapes, records):
    body = b""
    for i, (kind, rings) in enumerate(shapes):
        points = [p for r in rings for p in r]
        starts = [sum(map(len, rings[:j])) for j in range(len(rings))]
        content = struct.pack("<i4d2i", kind, 0, 0, 0, 0, len(rings), len(points)) + struct.pack(f"<{len(rings)}i", *starts) + b"".join(struct.pack("<2d", *p) for p in points) if kind else struct.pack("<i", 0)
        body += struct.pack(">2i", i + 1, len(content) // 2) + content
    fields = [("NAME", "C", 8), ("POP", "N", 6), ("OK", "L", 1)]
    head = b"".join(n.encode().ljust(11, b"\0") + k.encode() + b"\0" * 4 + bytes([w, 0]) + b"\0" * 14 for n, k, w in fields) + b"\r"
    rows = b"".join(b" " + b"".join(v.ljust(w)[:w] for v, (_, _, w) in zip(r, fields)) for r in records)
    dbf = struct.pack("<B3BIHH", 3, 1, 1, 1, len(records), 32 + len(head), 16) + b"\0" * 20 + head + rows
    with zipfile.ZipFile(path, "w") as z:
        z.writestr("x.shp", b"\0" * 100 + body)
        z.writestr("x.dbf", dbf)


def test_zipped_shapefile(spark, tmp_path):
    outer, hole, far = [(0, 0), (0, 4), (4, 4), (4, 0), (0, 0)], [(1, 1), (2, 1), (2, 2), (1, 2), (1, 1)], [(9, 9), (9, 10), (10, 10), (9, 9)]
    path = str(tmp_path / "x.zip")
    shapefile(path, [(5, [outer, far, hole]), (0, []), (3, [[(0, 0), (1, 1)]])], [("Zoë".encode("latin-1"), b"12", b"T"), (b"none", b"", b"?"), ("Å".encode(), b"1.5", b"n")])
    rows = vectors.read_features(spark, path).collect()
    assert [(r.kind, [len(p) for p in r.parts]) for r in rows] == [("MultiPolygon", [2, 1]), ("LineString", [1])]
    assert rows[0].properties == {"NAME": "Zoë", "POP": "12", "OK": "true"} and rows[1].properties == {"NAME": "Å", "POP": "1.5", "OK": "false"}
    assert vectors.read_features(spark, path).union(vectors.read_features(spark, path)).count() == 4


def test_csv_round_trips(spark, tmp_path):
    edges = spark.createDataFrame([("b", "c", "land", "true", "shared_border", "1.5", '["x","y"]'), ("a", "b", "land", "true", "shared_border", "", "[]")], tables.EDGES)
    path = str(tmp_path / "e.csv")
    assert tables.write_csv(edges, path, ["from_province_id"]) == 2
    first = open(path, "rb").read()
    assert b"\r" not in first and first.count(b"\n") == 3
    assert sorted(map(tuple, tables.read_edges(spark, path).fillna("").collect())) == sorted(map(tuple, edges.collect()))
    (tmp_path / "bad.csv").write_text("from,to\na,b\n")
    with pytest.raises(Exception):
        tables.read_edges(spark, str(tmp_path / "bad.csv")).collect()


def test_ownership_cells(spark, tmp_path):
    names = [c.split()[0] for c in tables.OWNERSHIP.split(", ")]
    (tmp_path / "o.csv").write_text(",".join(names) + '\np1,s,1444-11-11,,A,A,"[""A"",""B""]","C, D",,,Yes,baseline,,,,\np2,s,1444-11-11,,A,A,,"[BUR",,,0,baseline,,,,\n')
    rows = tables.read_ownership(spark, str(tmp_path / "o.csv")).orderBy("province_id").collect()
    assert (rows[0].cores, rows[0].claims, rows[0].disputed) == (["A", "B"], ["C", "D"], True)
    assert (rows[1].cores, rows[1].claims, rows[1].disputed) == ([], ["[BUR"], False)


def test_scenario_document(spark, tmp_path):
    """Every layer of a document, and what a null means in each of its fields."""
    document = {
        "scenario_id": "later",
        "country_rules": [{"match_parent_country_id": "north", "owner": "N1", "cores": ["N1", " N2 ", "N1", ""]}, {"match_parent_country_id": "north", "culture": None}, {"match_parent_country_id": "south", "religion": "sun"}],
        "region_rules": [{"match_parent_region_id": "coast", "controller": "C1"}, {"match_parent_region_id": "hills", "owner": "H1"}],
        "province_overrides": [{"province_id": "k3", "claims": ["X", "Y", "X"], "disputed": True}, {"province_id": "k9", "owner": "gone"}, {"province_id": "k4", "owner": "Z"}, {"province_id": "k4", "notes": "last"}],
    }
    (tmp_path / "s.json").write_text(json.dumps(document))
    _, rules = tables.read_scenario(spark, str(tmp_path / "s.json"))
    rows = [("k1", "land", "north", "coast", "One"), ("k2", None, "north", "hills", "Two"), ("k3", "land", "south", None, "Three"), ("k4", "land", None, "coast", "Four"), ("w1", "sea", "north", "coast", "Water")]
    provinces = spark.createDataFrame(rows, "province_id string, kind string, country string, region string, display_name string")
    found = {r.province_id: r for r in ownership.resolve(provinces, rules, culture="old").collect()}
    assert sorted(found) == ["k1", "k2", "k3", "k4"]
    k1, k2, k3, k4 = (found[f"k{i}"] for i in range(1, 5))
    assert (k1.owner, k1.controller, k1.cores, k1.culture, k1.assignment_source) == ("N1", "C1", ["N1", "N2"], None, "region_rule")
    assert (k2.owner, k2.controller, k2.cores, k2.culture) == ("H1", "H1", ["N1", "N2"], None)
    assert (k3.owner, k3.claims, k3.disputed, k3.religion, k3.culture) == ("south", ["X", "Y"], True, "sun", "old")
    assert (k4.owner, k4.controller, k4.notes) == ("UNK", "C1", "last")  # of rules for one province the last counts alone


def test_profile(tmp_path):
    (tmp_path / "p.toml").write_text('preset = "eu"\nname = "x"\n[refine]\ntarget = 5\n[presets.eu.refine]\ntarget = 1\nmost = 4\n')
    assert tables.read_profile(str(tmp_path / "p.toml")) == {"name": "x", "refine": {"target": 5, "most": 4}}


def test_statuses(spark, tmp_path):
    (tmp_path / "t.json").write_text(json.dumps({"components": [{"territory_component_id": "c1"}], "political_units": [], "provinces": [{"province_id": "p", "territory_component_ids": ["c1"]}], "statuses": [{"subject_id": "c1", "relationship": "owner", "valid_from": "1444"}]}))
    found = tables.read_statuses(spark, str(tmp_path / "t.json"))
    assert {n: t.count() for n, t in found.items()} == {"components": 1, "political_units": 0, "provinces": 1, "statuses": 1}
    held = found["statuses"].where(text.holds_on(F.lit("1444-11-11").cast("date"), F.col("valid_from"), F.col("valid_to")))
    assert held.count() == 1


def test_pack_round_trip(spark, tmp_path):
    nodes = spark.createDataFrame([(n,) for n in "dcbae"], "node string")
    edges = spark.createDataFrame([("a", "b"), ("c", "b"), ("b", "a")], "a string, b string")
    status = lambda rows: spark.createDataFrame(rows, "subject string, relation int, actor string")
    base, later = [("a", 1, "d"), ("b", 2, "d")], [("a", 1, "d"), ("c", 3, "e")]
    manifest = pack.compile_pack(str(tmp_path / "p"), nodes, edges, {"s0": status(base), "s1": status(later)}, "s0")
    unions = spark.createDataFrame([("d", ["c", "a"]), ("b", ["e"])], "actor string, members array<string>")
    assert pack.Pack(str(tmp_path / "p")).unions() == {}
    manifest = pack.compile_pack(str(tmp_path / "p"), nodes, edges, {"s0": status(base), "s1": status(later)}, "s0", unions)
    again = pack.compile_pack(str(tmp_path / "q"), nodes, edges, {"s0": status(base), "s1": status(later)}, "s0", unions)
    assert manifest == again  # byte for byte, by the checksums
    p = pack.Pack(str(tmp_path / "p"))
    assert p.names == list("abcde") and p.neighbours("b") == ["a", "c"] and p.neighbours("e") == []
    assert p.unions() == {"b": ["e"], "d": ["a", "c"]}
    assert p.statuses("s0") == set(base) and p.statuses("s1") == set(later)
    (tmp_path / "p" / "offsets.bin").write_bytes(b"x")
    with pytest.raises(ValueError, match="manifest"):
        pack.Pack(str(tmp_path / "p"))


def test_stream_of_findings(spark, tmp_path):
    rows = spark.createDataFrame([("X", "error", "2024-01-01 00:01:00"), ("X", "error", "2024-01-01 00:02:00"), ("Y", "warning", "2024-01-01 00:21:00")], "code string, severity string, at string").withColumn("at", F.to_timestamp("at"))
    rows.write.parquet(str(tmp_path / "in"))
    stream = findings.counts(spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in")), "at")
    query = stream.writeStream.format("memory").queryName("found").outputMode("complete").trigger(availableNow=True).start()
    query.awaitTermination(60)
    assert sorted(map(tuple, spark.table("found").collect())) == sorted(map(tuple, findings.counts(rows, "at").collect()))


def test_findings_in_order(spark):
    from terravane.plans import registry

    found = registry.adjacency_findings(spark, DATA)
    assert {r.code for r in found.collect()} >= {"MALFORMED_ADJACENCY_ROW", "NONCANONICAL_ADJACENCY_PAIR", "UNKNOWN_ADJACENCY_ENDPOINT", "SELF_ADJACENCY_EDGE", "INVALID_ADJACENCY_SEMANTICS", "ASYMMETRIC_ADJACENCY", "INVALID_SHARED_BORDER_MEASUREMENT", "SHARED_BORDER_BELOW_THRESHOLD", "INVALID_ADJACENCY_LINEAGE"}
    assert quality.summary(found).first().status == "fail"


@pytest.mark.parametrize("tag", ["FRA", "BUR", "x", "Österreich", "T12", "zz9"])
def test_tag_fill_is_hls(spark, tag):
    import colorsys
    import hashlib

    digest = hashlib.sha256(tag.encode()).digest()
    r, g, b = colorsys.hls_to_rgb(digest[0] / 255, 0.40 + digest[2] / 255 * 0.16, 0.48 + digest[1] / 255 * 0.28)
    assert spark.range(1).select(text.tag_fill(F.lit(tag)).alias("c")).first().c == f"#{int(r * 255):02x}{int(g * 255):02x}{int(b * 255):02x}"
