"""Overlays by group and validators, on small cases."""

import pytest
from pyspark.sql import functions as F

from terravane.functions import kernel
from terravane.operators import overlay, validate

from .test_spatial import L, box, polygons


def test_unions_and_equality(spark):
    rows = polygons(spark, [("a", box(0, 0, 2, 1), "g"), ("b", box(1, 0, 3, 1), "g"), ("c", box(9, 9, 10, 10), "h")], ", g string")
    assert {r.g: round(r.area, 9) for r in overlay.union_by(rows, "g").collect()} == {"g": 3, "h": 1}
    left = polygons(spark, [("x", box(0, 0, 1, 1)), ("x", box(1, 0, 2, 1)), ("y", box(0, 0, 1, 1)), ("z", box(5, 5, 6, 6))])
    right = polygons(spark, [("x", box(0, 0, 2, 1)), ("y", box(0, 0, 1, 2))])
    assert {r.id: round(r.off, 9) for r in overlay.unequal(left, right).collect()} == {"y": 1, "z": 1}


def test_simplify_and_triangles(spark):
    ring = [(0, 0), (1, 0.001), (2, 0), (2, 2), (0, 2), (0, 0)]
    assert overlay.simplified(ring, 0.01) == [(0, 0), (2, 0), (2, 2), (0, 2), (0, 0)]
    assert overlay.simplified(ring, 0.0001) == ring
    rows = polygons(spark, [("a", ring), ("l", [*L, L[0]])])
    assert overlay.simplify(rows, 0.01, 4).where("id = 'a'").select(F.size("ring")).first()[0] == 5
    found = overlay.triangles(rows, [0.01, 0.0]).collect()
    for lod, name, want in ((0, "a", 4), (1, "a", kernel.total(kernel.pieces_of(ring))), (0, "l", 7), (1, "l", 7)):
        own = [[(p.x, p.y) for p in r.triangle] for r in found if r.lod == lod and r.id == name]
        assert kernel.total(own) == pytest.approx(want) and all(len(t) == 3 and kernel.area(t) > 0 for t in own)


def test_coastal_claims(spark):
    land = polygons(spark, [("a", box(0, 0, 1, 1)), ("b", box(2, 0, 3, 1))])
    ocean = polygons(spark, [("o", box(-5, -5, 5, 5)), ("p", box(20, 20, 21, 21))])
    rows = {(r.ocean, r.land): round(r.area, 9) for r in overlay.coastal_claims(land, ocean, 1.0, 2.0).collect()}
    assert rows == {("o", "a"): 9 - 1 - 0, ("o", "b"): 9 - 1 - 3}


def test_splits(spark):
    rows = polygons(spark, [("a", box(0, 0, 2, 2)), ("b", box(5, 5, 6, 6))])
    requests = spark.createDataFrame([("a", "r1", 1.0, 0.0, 1.0, 2.0), ("a", "r2", 0.0, 0.5, 2.0, 0.5)], "id string, request string, x1 double, y1 double, x2 double, y2 double")
    found = sorted((r.id, r.part, round(r.area, 9)) for r in overlay.split_by_lines(rows, requests).collect())
    assert found == [("a", 0, 0.5), ("a", 1, 0.5), ("a", 2, 1.5), ("a", 3, 1.5), ("b", 0, 1.0)]


def test_paintability(spark):
    rows = polygons(spark, [("a", box(0, 0, 2, 2)), ("b", box(2, 0, 4, 2))])
    lines = spark.createDataFrame([("along", 2.0, 0.0, 2.0, 2.0), ("through", 1.0, 0.0, 1.0, 2.0), ("across", 0.0, 1.0, 5.0, 1.0)], "line string, lx1 double, ly1 double, lx2 double, ly2 double")
    found = {(r.line, r.id): round(r.length, 9) for r in overlay.unpaintable(lines, rows, 1.0, 1e-6).collect()}
    assert found == {("through", "a"): 2, ("across", "a"): 2, ("across", "b"): 2}


def test_status_document(spark):
    components = spark.createDataFrame([("c1",), ("c2",), ("c3",)], "territory_component_id string")
    provinces = spark.createDataFrame([("p1", ["c1", "c2"]), ("p2", ["c2", "cx"])], "province_id string, territory_component_ids array<string>")
    units = spark.createDataFrame([("u1", ["c1", "c2", "c3"])], "political_unit_id string, territory_component_ids array<string>")
    rows = spark.createDataFrame([("c1", "owner", "u1", "1444", "1450", ["e"]), ("zz", "rules", "u9", "1450", "1444", [])], "subject_id string, relationship string, actor_political_unit_id string, valid_from string, valid_to string, evidence_ids array<string>")
    found = sorted((r.code, r.affected) for r in validate.statuses(components, units, provinces, rows).collect())
    assert found == [("COMPONENT_IN_NONE", ["c3"]), ("COMPONENT_IN_SEVERAL", ["c2"]), ("EMPTY_RANGE", ["zz"]), ("NO_EVIDENCE", ["zz"]), ("UNKNOWN_ACTOR", ["zz"]), ("UNKNOWN_COMPONENT", ["p2", "cx"]), ("UNKNOWN_RELATION", ["zz"]), ("UNKNOWN_SUBJECT", ["zz"])]


def test_row_contracts(spark):
    contract = spark.createDataFrame([("share", "border", "positive", 2, 0, "km")], "relation string, kind string, expectation string, n_subjects int, n_boundaries int, unit string")
    rows = spark.createDataFrame([("a", "share", "border", "positive", ["x", "y"], [], "km", 0.5), ("b", "share", "capital", "positive", ["x"], None, "km", 0.0), ("c", "odd", "border", "positive", [], [], "km", 1.0)], "assertion string, relation string, kind string, expectation string, subjects array<string>, boundaries array<string>, unit string, tolerance double")
    assert sorted(map(tuple, validate.assertions(rows, contract).collect())) == [("b", "kind"), ("b", "subjects"), ("b", "tolerance"), ("c", "relation")]
    ids = lambda *x: spark.createDataFrame([(i,) for i in x], "id string")
    assert sorted(map(tuple, validate.exactly_once(ids("a", "a", "x"), ids("a", "b")).collect())) == [("a", "repeated"), ("b", "missing"), ("x", "extra")]
    assert sorted(map(tuple, validate.migrated(ids("a", "b"), spark.createDataFrame([("a", "z")], "old string, new string")).collect())) == [("a", "z"), ("b", "b")]
    maps = spark.createDataFrame([("m", ["1", "2", "3"], "x", "y"), ("n", ["1"], "x", "x")], "boundary string, control_points array<string>, digitizer string, reviewer string")
    assert sorted(map(tuple, validate.georeferenced(maps).collect())) == [("n", "control_points"), ("n", "reviewer")]
    lineage = spark.createDataFrame([("p", ["a", "b"])], "parent string, children array<string>")
    assert [tuple(r) for r in validate.split_requests(lineage, ids("b", "q"), spark.createDataFrame([("r", "p")], "request string, parent string")).collect()] == [("r", ["p"], ["b"])]
