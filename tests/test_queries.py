"""Every query with SQL against DuckDB on the smallest tables; the others against plain Python."""

import math

import duckdb
import pytest
from pyspark.sql import functions as F

from terravane.functions import geo
from terravane.operators import tiles
from terravane.plans import registry
from terravane.plans.views import TABLES, view

from .conftest import DATA


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"create view {t} as select * from '{DATA}/{t}.parquet'")
    return con


def table(df):
    columns = sorted(df.columns)
    return df[columns].astype(str).sort_values(columns).reset_index(drop=True)


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_equals_sql(spark, con, name):
    got, want = table(registry.queries()[name](spark, DATA).toPandas()), table(con.sql(registry.oracle_sql()[name]).df())
    assert list(got.columns) == list(want.columns)
    assert got.equals(want)


def plain_components(nodes, edges):
    up = {n: n for n in nodes}

    def top(n):
        while up[n] != n:
            n = up[n]
        return n

    for a, b in edges:
        if a in up and b in up:
            a, b = top(a), top(b)
            up[max(a, b)] = min(a, b)
    return {n: top(n) for n in nodes}


def test_area_clusters_partition_and_hold_together(spark):
    rows = registry.area_clusters(spark, DATA).collect()
    nodes = [r.province_id for r in view(spark, DATA, "provinces").where("country is not null").collect()]
    assert sorted(r.node for r in rows) == sorted(nodes)
    areas = {}
    for r in rows:
        areas.setdefault((r.country, r.area), []).append(r.node)
    assert all(min(m) == a for (_, a), m in areas.items())
    assert registry.area_clusters(spark, DATA).collect() and sorted(map(tuple, rows)) == sorted(map(tuple, registry.area_clusters(spark, DATA).collect()))


def test_merged_provinces_are_contiguous(spark):
    rows = registry.merged_provinces(spark, DATA).collect()
    edges = [(r.a, r.b) for r in view(spark, DATA, "edges").collect()]
    groups, region = {}, {r.province_id: r.region for r in view(spark, DATA, "provinces").collect()}
    for r in rows:
        groups.setdefault((r.group, r.merged), []).append(r.node)
    for members in groups.values():
        assert len(set(plain_components(members, edges).values())) == 1
    parts = {}
    for n, c in plain_components(region, [(a, b) for a, b in edges if region[a] == region[b]]).items():
        parts.setdefault((region[n], c), []).append(n)
    assert len(groups) == sum(math.ceil(0.34 * len(p)) for p in parts.values())


def test_refined_parents_split_every_box(spark):
    rows = registry.refined_parents(spark, DATA).collect()
    want = {r.id: r.n for r in view(spark, DATA, "boxes").collect()}
    area, people, parts = {}, {}, {}
    for r in rows:
        area[r.parent] = area.get(r.parent, 0) + r.area
        people[r.parent] = people.get(r.parent, 0) + r.population
        parts[r.parent] = parts.get(r.parent, 0) + 1
    assert max(want.values()) > 60 and area.keys() == want.keys()
    assert all(abs(area[i] - 0.25) < 1e-6 and abs(people[i] - n) < 1e-4 and parts[i] <= 1 + n % 5 for i, n in want.items())


def test_hausdorff_takes_all_orders(spark):
    sets = {}
    for r in view(spark, DATA, "orders").collect():
        sets.setdefault(r.o_custkey, ([], []))[r.o_orderkey % 2].append((r.o_orderkey % 97 / 10, r.o_orderkey % 89 / 10))
    km = lambda p, q: math.hypot((q[0] - p[0]) * 111.32 * math.cos(math.radians((p[1] + q[1]) / 2)), (q[1] - p[1]) * 110.574)
    far = lambda a, b: max(min(km(p, q) for q in b) for p in a)
    want = {k: max(far(a, b), far(b, a)) for k, (a, b) in sets.items() if a and b}
    got = {r.key: r.km for r in registry.queries()["hausdorff_km"](spark, DATA).collect()}
    assert got == pytest.approx(want, abs=1e-5)


def test_main_frame_takes_all_boxes(spark):
    boxes = view(spark, DATA, "boxes").collect()
    got = {r.name: tuple(r)[1:] for r in registry.queries()["main_frame"](spark, DATA).collect()}
    for name, rows in {"boxes": [(b.x1, b.y1, b.x2, b.y2, b.id) for b in boxes], "wide": [(b.x1, b.y1, b.x1 + 0.5 + b.n % 7, b.y2, b.id) for b in boxes]}.items():
        bounds = (min(r[0] for r in rows), min(r[1] for r in rows), max(r[2] for r in rows), max(r[3] for r in rows))
        size = lambda r: max(r[2] - r[0], r[3] - r[1])
        widest = max(rows, key=lambda r: (size(r), r[4]))
        assert got[name] == (widest[:4] if size(bounds) > 12 * size(widest) else bounds)


def test_tile_archive_holds_every_box(spark):
    held = {i for r in registry.tile_archive(spark, DATA).collect() for i in range(r.tile_id, r.tile_id + r.run)}
    middles = [((b.x1 + b.x2) / 2, (b.y1 + b.y2) / 2) for b in view(spark, DATA, "boxes").collect()]
    tile = lambda x, y: (int((x + 180) / 360 * 64), int((1 - math.asinh(math.tan(math.radians(y))) / math.pi) / 2 * 64))
    at = spark.createDataFrame(sorted({(6, *tile(*m)) for m in middles}), "z int, x long, y long")
    want = {r[0] for r in at.select(geo.hilbert_tile_id(F.col("z"), F.col("x"), F.col("y"))).collect()}
    encoded = tiles.encode_tiles(registry.grid(spark, DATA), (3, 6), "provinces", ["n"])
    assert want <= held and held == {r.tile_id for r in encoded.select("tile_id").collect()}
    shas = {r.sha for r in registry.tile_archive(spark, DATA).collect()}
    assert shas == {r[0] for r in encoded.select(F.sha2("data", 256)).collect()}


def test_whole_views_meet_their_operators(spark):
    ids = {r.id for r in view(spark, DATA, "boxes").collect()}
    whole = {n: registry.queries()[n](spark, DATA).collect() for n in ("strait_links", "located_points", "census_gaps", "identity_conflicts")}
    assert {i for r in whole["strait_links"] for i in (r.a, r.b)} == ids
    assert all(r.n != 1 for r in whole["census_gaps"]) and {r.n == 0 for r in whole["census_gaps"]} == {True, False}
    lines = {}
    for r in view(spark, DATA, "lineitem").select("l_partkey", "l_suppkey").collect():
        lines.setdefault(r.l_partkey, set()).add(r.l_suppkey)
    assert {r.l_partkey: r.identities for r in whole["identity_conflicts"]} == {k: len(v) for k, v in lines.items() if len(v) > 1}
    assert whole["located_points"]
