"""Queries on customers whose boxes lie at and beyond the poles, and on many rows, against their SQL or a plain version."""

import math
import shutil

import pytest
from pyspark.sql import functions as F

from terravane.functions import geo, kernel
from terravane.operators import overlay, tiles
from terravane.plans import registry
from terravane.plans.views import view

from .conftest import DATA


@pytest.fixture(scope="module")
def far(tmp_path_factory):
    """Tables whose boxes lie around the latitudes 85, 90 and 270."""
    import duckdb

    d = tmp_path_factory.mktemp("far")
    for t in ("nation", "region", "supplier"):
        shutil.copy(f"{DATA}/{t}.parquet", d)
    keys = [*range(11520, 11640), *range(11960, 12080), *range(26360, 26480)]
    duckdb.sql(f"COPY (SELECT * EXCLUDE (i, k, j) REPLACE (k AS c_custkey) FROM (SELECT *, row_number() OVER (ORDER BY c_custkey) - 1 AS i FROM '{DATA}/customer.parquet') JOIN (SELECT unnest({keys}) AS k, unnest(range({len(keys)})) AS j) ON i = j % 100) TO '{d}/customer.parquet'".replace("SELECT * REPLACE", "SELECT * EXCLUDE (i, k, j) REPLACE"))
    return str(d)


def by_sql(sf_dir, name):
    import duckdb

    con = duckdb.connect()
    for t in ("nation", "region", "supplier", "customer"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con.execute(registry.oracle_sql()[name]).fetchall()


def test_adjacency_rows_on_a_pole(spark, far):
    want = by_sql(far, "adjacency_rows")
    assert ("land", "p0011960", "p0012000") in want
    assert [tuple(r) for r in registry.queries()["adjacency_rows"](spark, far).collect()] == want


def test_shared_borders_on_a_pole(spark, far):
    got = {(r.a, r.b): r.km for r in registry.queries()["shared_borders"](spark, far).collect()}
    want = {(a, b): km for a, b, km in by_sql(far, "shared_borders")}
    assert got == pytest.approx(want, abs=2e-6) and want["p0011960", "p0012000"] == 0


def test_tile_cover_past_the_poles(spark, far):
    got = sorted(tuple(r) for r in registry.queries()["tile_cover"](spark, far).collect())
    assert got == sorted(by_sql(far, "tile_cover"))


def test_tiles_end_at_the_poles(spark, far):
    runs = registry.queries()["tile_archive"](spark, far).collect()
    held = {i for r in runs for i in range(r.tile_id, r.tile_id + r.run)}
    boxes = view(spark, far, "boxes").where("y2 < 85.0511").select("x1", "x2", "y1", "y2").collect()
    row = lambda y: int((1 - math.asinh(math.tan(math.radians(y))) / math.pi) / 2 * 64)
    middles = {(6, int(((b.x1 + b.x2) / 2 + 180) / 360 * 64), row((b.y1 + b.y2) / 2)) for b in boxes}
    number = geo.hilbert_tile_id(F.col("z"), F.col("x"), F.col("y"))
    got = {r[0] for r in spark.createDataFrame(sorted(middles), "z int, x long, y long").select(number).collect()}
    assert got and got <= held
    beyond = registry.grid(spark, far).where("n >= 12000")  # from the pole on
    assert tiles.encode_tiles(beyond, (3, 6), "provinces", ["n"]).isEmpty()
    south = spark.createDataFrame([("s", [{"x": float(x), "y": float(y)} for x, y in ((0, -95), (9, -95), (9, -80), (0, -80), (0, -95))])], "id string, ring array<struct<x:double,y:double>>")
    assert {(r.x, r.y) for r in tiles.encode_tiles(south, (3, 3), "a", []).collect()} == {(4, 7)}


def test_deep_tiles_of_many_rows_in_time(spark, tmp_path):
    import time

    spark.range(100_000).select(F.col("id").alias("c_custkey")).write.parquet(str(tmp_path / "customer.parquet"))
    began = time.time()
    rows = registry.queries()["deep_tiles"](spark, str(tmp_path))
    assert rows.where("z <> 31 or x <> c_custkey * 104729 % 2147483648 or y <> c_custkey * 1299709 % 2147483648").count() == 0
    assert rows.count() == 100_000 and time.time() - began < 60


def test_hilbert_numbers_of_all_zooms(spark):
    def plain(z, x, y):
        d = 0
        for level in range(z - 1, -1, -1):
            rx, ry = x >> level & 1, y >> level & 1
            d += (3 * rx ^ ry) << 2 * level
            x, y = x & (1 << level) - 1, y & (1 << level) - 1
            if not ry:
                x, y = ((1 << level) - 1 - y, (1 << level) - 1 - x) if rx else (y, x)
        return (4**z - 1) // 3 + d

    places = [(z, x % 2**z, y % 2**z) for z in range(32) for x, y in ((0, 0), (-1, -1), (-1, 0), (0, -1), (0x5A5A5A5A, 0x13579BDF), (0x7654321, 0x2468ACE))]
    rows = spark.createDataFrame(places, "z int, x long, y long")
    got = rows.select("z", "x", "y", geo.hilbert_tile_id(F.col("z"), F.col("x"), F.col("y")).alias("id")).select("*", geo.tile_of_hilbert(F.col("id")).alias("t")).collect()
    assert [r.id for r in got] == [plain(*p) for p in places] and [tuple(r.t) for r in got] == places


def test_union_of_many_rings_in_time(spark):
    import time

    square = lambda x, y: F.array(*[F.struct((x + u).alias("x"), (y + v).alias("y")) for u, v in ((0.0, 0.0), (0.75, 0.0), (0.75, 0.75), (0.0, 0.75), (0.0, 0.0))])
    n = F.col("id")
    rows = spark.range(6000).select(n.cast("string").alias("id"), square((n % 60) * 0.5, F.floor(n / 60) * 0.5).alias("ring"), F.when(n % 2 == 0, "even").alias("g"))
    began = time.time()
    got = {r.g: (r.area, sum(map(lambda p: kernel.area([(q.x, q.y) for q in p]), r.pieces))) for r in overlay.union_by(rows.union(rows), "g").collect()}
    assert time.time() - began < 60  # each with its neighbours, not with all of its group
    assert got == {g: (pytest.approx(30 * 0.75 * 50.25), pytest.approx(30 * 0.75 * 50.25)) for g in ("even", None)}
