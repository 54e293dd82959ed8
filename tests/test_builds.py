import math
from collections import defaultdict

import pytest

from terravane.functions import kernel
from terravane.operators import build
from terravane.plans import registry
from terravane.plans.views import view

from .conftest import DATA
from .test_queries import plain_components


def test_location_provinces(spark):
    """Provinces hold together, keep what a part's share asks for, and never cross the hard boundary."""
    found = defaultdict(set)
    for r in registry.queries()["location_provinces"](spark, DATA).collect():
        found[r.province_id].add(r.location)
    n = {r.id: r.n for r in view(spark, DATA, "boxes").collect()}
    assert sorted(i for s in found.values() for i in s) == sorted(n)
    at = {(k % 40, k // 40): i for i, k in n.items()}
    edges = [(i, at[x + dx, y + dy]) for (x, y), i in at.items() for dx, dy in ((1, 0), (0, 1)) if (x + dx, y + dy) in at and not (dx and x == 19)]
    for members in found.values():
        assert len(set(plain_components(members, edges).values())) == 1
    parts = defaultdict(list)
    for i, c in plain_components(n, edges).items():
        parts[c].append(i)
    assert len(found) == sum(math.ceil(0.4 * len(p)) for p in parts.values())


def test_hierarchy_build(spark):
    rows = registry.queries()["hierarchy_build"](spark, DATA).collect()
    provinces = {r.province_id: r for r in view(spark, DATA, "provinces").where("region is not null").collect()}
    assert len(rows) == len(provinces)
    areas = defaultdict(set)
    for r in rows:
        assert (r.parent_area is None) == (provinces[r.province_id].country is None)
        if r.parent_area:
            assert r.parent_superregion == provinces[r.province_id].region
            areas[r.parent_area].add((r.parent_region, provinces[r.province_id].country))
    assert all(len(v) == 1 for v in areas.values())


@pytest.mark.parametrize(
    "ring,areas,changed",
    [
        ([(0, 0), (1, 0), (1, 1), (0, 1), (0, 0)], [1.0], False),
        ([(0, 0), (0, 1), (1, 1), (1, 0), (0, 0)], [1.0], True),
        ([(0, 0), (2, 2), (2, 0), (0, 2), (0, 0)], [1.0, 1.0], True),
        ([(0, 0), (1, 0), (1, 1), (1, 1), (0, 1)], [1.0], True),
        ([(0, 0), (4, 0), (4, 4), (2, 2), (0, 4), (0, 2), (2, 2), (0, 0)], [2.0, 8.0], True),
        ([(0, 0), (1, 0), (2, 0), (0, 0)], [], True),
        ([], [], True),
    ],
)
def test_repaired(ring, areas, changed):
    parts, was = kernel.repaired(ring)
    assert sorted(round(kernel.area(p), 9) for p in parts) == areas and was == changed


def test_gates(spark):
    findings = spark.createDataFrame([("error",)], "severity string")
    table = spark.createDataFrame([(1,)], "a int")
    gates = build.certified(findings.limit(0), table, table, ({"x": "1"}, {"x": "1"}), {"load": 5.0}, {"load": 9.0})
    assert gates == {"qa": True, "parity": True, "determinism": True, "performance": True, "certified": True}
    gates = build.certified(findings, table, table.limit(0), ({"x": "1"}, {"x": "2"}), {}, {"load": 9.0})
    assert not any(gates.values())
    took = build.benchmark({"sum": lambda: sum(range(1000))}, 3)
    assert took["sum"] >= 0 and took["peak_mib"] >= 0
