"""Packs, atlases, manifests and the sequential choices, on small maps."""

import hashlib
import json
from pathlib import Path

from pyspark.sql import functions as F

from terravane.operators import hierarchy
from terravane.plans import registry
from terravane.plans.views import view
from terravane.sources import export, tables, vectors

from .conftest import DATA


def small(spark):
    rows = registry.grid(spark, DATA).where("n <= 60").select(F.col("id").alias("province_id"), "ring")
    more = view(spark, DATA, "provinces").select("province_id", "kind", "country", "region", "display_name", F.array(F.lit("ne:1")).alias("lineage"), F.array(F.lit("Natural Earth")).alias("licenses"))
    return more.join(rows, "province_id")


def test_game_pack(spark, tmp_path):
    edges = view(spark, DATA, "edges").select("a", "b", F.lit("land").alias("kind"), F.col("weight").alias("km"))
    countries = spark.createDataFrame([("NATION_1", 'The "First"')], "tag string, display_name string")
    counts = export.game_pack(str(tmp_path / "p"), small(spark), edges, countries)
    assert counts["provinces"] == counts["features"] == 61 and counts["attribution"] == 1
    assert ' country.NATION_1: "The \\"First\\""' in (tmp_path / "p" / "localization.yml").read_text()
    rows = {r.path: r for r in export.manifest(spark, str(tmp_path / "p")).collect()}
    assert set(rows) == {p.name for p in (tmp_path / "p").iterdir()}
    assert all(r.sha256 == hashlib.sha256((tmp_path / "p" / n).read_bytes()).hexdigest() for n, r in rows.items())
    export.game_pack(str(tmp_path / "q"), small(spark), edges, countries)
    assert {r.path: r.sha256 for r in export.manifest(spark, str(tmp_path / "q")).collect()} == {n: r.sha256 for n, r in rows.items()}


def test_atlas(spark, tmp_path):
    rules = view(spark, DATA, "rules")
    found = export.atlas(str(tmp_path), small(spark), {"now": rules, "then": rules.where("level = 'country'")}, (2, 4))
    assert set(found) == {"now", "then"} and found["now"]["choropleth"] == found["now"]["ownership"] > 0
    features = vectors.read_geojson(spark, str(tmp_path / "now" / "choropleth.geojson"))
    assert features.count() == found["now"]["choropleth"] and "owner_color" in features.first().properties
    assert found["then"]["tiles"] > 0 and Path(tmp_path / "then" / "tiles.pmtiles").stat().st_size > 127


def test_refined_cells_equal_a_plain_heap(spark):
    points = view(spark, DATA, "points").select("x", "y", F.greatest("weight", F.lit(0.0)).alias("weight"))
    rows = {r.cell: r.weight for r in hierarchy.refine_cells(points, 1, 5, 6).collect()}
    leaf = [(r.c, r.weight) for r in points.select(hierarchy.cell_of(F.col("x"), F.col("y"), 5).alias("c"), "weight").collect()]
    live = {c[:2] for c, _ in leaf}
    weight = lambda p: sum(w for c, w in leaf if c.startswith(p))
    while len(live) < 6 and any(len(c) < 6 for c in live):
        top = max((c for c in live if len(c) < 6), key=lambda c: (weight(c), [-ord(x) for x in c]))
        live = live - {top} | {c[: len(top) + 1] for c, _ in leaf if c.startswith(top)}
    assert set(rows) == live and abs(sum(rows.values()) - weight("")) < 1e-6


def test_cells_hold_their_points(spark):
    cells = hierarchy.cells(spark, 3)
    points = view(spark, DATA, "points").withColumn("cell", hierarchy.cell_of(F.col("x"), F.col("y"), 3))
    bad = points.join(cells, "cell").where("x < x1 or x > x2 or y < y1 or y > y2")
    assert bad.count() == 0 and points.join(cells, "cell").count() == points.count()


def test_json_is_stable(tmp_path):
    tables.write_json({"b": 1, "a": [2]}, str(tmp_path / "x.json"))
    assert (tmp_path / "x.json").read_text().startswith('{\n  "a"') and json.loads((tmp_path / "x.json").read_text()) == {"a": [2], "b": 1}
