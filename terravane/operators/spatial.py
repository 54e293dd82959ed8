"""Spatial joins over polygons: shared borders, straits, ports, coverage, overlaps, tiles.

A polygon table has id and ring (array<struct<x, y>>, closed, simple). Candidates come from equi-joins: borders of two
polygons meet on one supporting line, everything else on the cells of a grid that both sides are dealt to. Cells are a fixed
number of degrees wide, so a polygon has as many as its box covers; nothing is compared across cells.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terravane.functions import geo
from terravane.functions.text import distance_text


def segments(polygons: DataFrame) -> DataFrame:
    """One row for each side of each ring: id, x1, y1, x2, y2, the lesser end first."""
    sides = polygons.select("id", F.explode(geo._segments(F.col("ring"))).alias("s")).where("s.x1 <> s.x2 or s.y1 <> s.y2")
    swap = (F.col("s.x1") > F.col("s.x2")) | ((F.col("s.x1") == F.col("s.x2")) & (F.col("s.y1") > F.col("s.y2")))
    ends = {"x1": "x2", "y1": "y2", "x2": "x1", "y2": "y1"}
    return sides.select("id", *[F.when(swap, F.col(f"s.{b}")).otherwise(F.col(f"s.{a}")).alias(a) for a, b in ends.items()])


def _on_lines(sides: DataFrame, digits: int = 9, stretch: float = 1.0) -> DataFrame:
    """Sides with the line that they lie on, their bounds along it, and the stretches of it that they cross."""
    steep = F.col("x1") == F.col("x2")
    slope = F.when(~steep, F.round((F.col("y2") - F.col("y1")) / (F.col("x2") - F.col("x1")), digits))
    cut = F.when(steep, F.round("x1", digits)).otherwise(F.round(F.col("y1") - slope * F.col("x1"), digits))
    low, high = F.when(steep, F.col("y1")).otherwise(F.col("x1")), F.when(steep, F.col("y2")).otherwise(F.col("x2"))
    rows = sides.select("*", F.coalesce(slope, F.lit(1e18)).alias("slope"), cut.alias("cut"), low.alias("low"), high.alias("high"))
    return rows.withColumn("stretch", F.explode(F.sequence(F.floor(F.col("low") / stretch), F.floor(F.col("high") / stretch))))


def contacts(polygons: DataFrame) -> DataFrame:
    """(a, b, p, q): the straight stretches from p to q that the borders of two polygons have in common; a corner is none."""
    lines = _on_lines(segments(polygons))
    left = lines.select(*[F.col(c).alias(f"a_{c}") for c in lines.columns])
    right = lines.select(*[F.col(c).alias(f"b_{c}") for c in lines.columns])
    on = (F.col("a_slope") == F.col("b_slope")) & (F.col("a_cut") == F.col("b_cut")) & (F.col("a_stretch") == F.col("b_stretch")) & (F.col("a_id") < F.col("b_id"))
    low, high = F.greatest("a_low", "b_low"), F.least("a_high", "b_high")
    # the stretch in which the common part begins speaks for it
    pairs = left.join(right, on).where(low < high).where(F.floor(low) == F.col("a_stretch"))
    first = F.when(F.col("a_low") >= F.col("b_low"), F.struct(F.col("a_x1").alias("x"), F.col("a_y1").alias("y"))).otherwise(F.struct(F.col("b_x1").alias("x"), F.col("b_y1").alias("y")))
    last = F.when(F.col("a_high") <= F.col("b_high"), F.struct(F.col("a_x2").alias("x"), F.col("a_y2").alias("y"))).otherwise(F.struct(F.col("b_x2").alias("x"), F.col("b_y2").alias("y")))
    return pairs.select(F.col("a_id").alias("a"), F.col("b_id").alias("b"), first.alias("p"), last.alias("q"))


def shared_borders(polygons: DataFrame, min_km: float) -> DataFrame:
    """(a, b, km) of polygon pairs whose common border is min_km long or more on the sphere; a corner is no border. At 0
    all count, even a side that lies on a pole and has no length."""
    km = F.sum(geo.haversine_km(F.col("p.x"), F.col("p.y"), F.col("q.x"), F.col("q.y")))
    return contacts(polygons).groupBy("a", "b").agg(km.alias("km")).where(F.col("km") + 1e-12 >= min_km)


def boxes(polygons: DataFrame) -> DataFrame:
    """polygons with the bounds x1, y1, x2, y2 of their rings."""
    xs, ys = F.transform("ring", lambda p: p.x), F.transform("ring", lambda p: p.y)
    return polygons.select("*", F.array_min(xs).alias("x1"), F.array_min(ys).alias("y1"), F.array_max(xs).alias("x2"), F.array_max(ys).alias("y2"))


def dealt(rows: DataFrame, size: float, margin: float = 0.0) -> DataFrame:
    """Rows with bounds x1..y2, once for each grid cell (cx, cy) that these, widened by margin, touch."""
    span = lambda low, high: F.explode(F.sequence(F.floor((F.col(low) - margin) / size), F.floor((F.col(high) + margin) / size)))
    return rows.withColumn("cx", span("x1", "x2")).withColumn("cy", span("y1", "y2"))


def box_pairs(left: DataFrame, right: DataFrame, size: float) -> DataFrame:
    """Pairs of rows whose bounds have a point in common, each once; columns under the prefixes a_ and b_."""
    a, b = dealt(left, size), dealt(right, size)
    a, b = a.select(*[F.col(c).alias(f"a_{c}") for c in a.columns]), b.select(*[F.col(c).alias(f"b_{c}") for c in b.columns])
    pairs = a.join(b, (F.col("a_cx") == F.col("b_cx")) & (F.col("a_cy") == F.col("b_cy"))).where(geo.boxes_meet("a_", "b_"))
    # the cell of the common part's lower left corner speaks for the pair
    own = (F.floor(F.greatest("a_x1", "b_x1") / size) == F.col("a_cx")) & (F.floor(F.greatest("a_y1", "b_y1") / size) == F.col("a_cy"))
    return pairs.where(own).drop("a_cx", "a_cy", "b_cx", "b_cy")


def box_overlaps(rows: DataFrame, size: float, tolerance: float = 1e-12) -> DataFrame:
    """(a, b, area) of box pairs of one table that overlap by more than tolerance square degrees."""
    pairs = box_pairs(rows, rows, size).where("a_id < b_id")
    return pairs.select(F.col("a_id").alias("a"), F.col("b_id").alias("b"), geo.box_overlap("a_", "b_").alias("area")).where(F.col("area") > tolerance)


def points_in(points: DataFrame, polygons: DataFrame, size: float) -> DataFrame:
    """points (point_id, x, y, and more) with the id of each polygon that covers them; a border point has all that touch."""
    spread = dealt(boxes(polygons), size)
    keyed = points.withColumn("cx", F.floor(F.col("x") / size)).withColumn("cy", F.floor(F.col("y") / size))
    hits = keyed.join(spread, ["cx", "cy"]).where(F.col("x").between(F.col("x1"), F.col("x2")) & F.col("y").between(F.col("y1"), F.col("y2")))
    return hits.where(geo.covers(F.col("ring"), F.col("x"), F.col("y"))).select(*points.columns, "id")


def straits(polygons: DataFrame, coastal: DataFrame, land_edges: DataFrame, max_km: float) -> DataFrame:
    """(a, b, km) of coastal polygons apart, but within max_km by planar degrees, that share no land edge.

    coastal: ids. The distance is the least of a corner of one from a side of the other, which holds for polygons that don't meet.
    """
    reach = max_km / geo.DEGREE_KM
    size = max(reach, 0.25)
    own = polygons.join(coastal.select("id").distinct(), "id", "left_semi")
    sides = segments(own)
    wide = sides.select("id", F.col("x1").alias("sx1"), F.col("y1").alias("sy1"), F.col("x2").alias("sx2"), F.col("y2").alias("sy2"), F.least("x1", "x2").alias("x1"), F.least("y1", "y2").alias("y1"), F.greatest("x1", "x2").alias("x2"), F.greatest("y1", "y2").alias("y2"))
    wide = dealt(wide, size, reach).drop("x1", "y1", "x2", "y2")
    corners = own.select(F.col("id").alias("corner_id"), F.explode("ring").alias("p")).select("corner_id", F.col("p.x").alias("px"), F.col("p.y").alias("py")).distinct()
    corners = corners.withColumn("cx", F.floor(F.col("px") / size)).withColumn("cy", F.floor(F.col("py") / size))
    near = corners.join(wide, ["cx", "cy"]).where("corner_id <> id")
    gap = geo.segment_distance(F.col("px"), F.col("py"), F.col("sx1"), F.col("sy1"), F.col("sx2"), F.col("sy2"))
    pairs = near.groupBy(F.least("id", "corner_id").alias("a"), F.greatest("id", "corner_id").alias("b")).agg(F.min(gap).alias("gap"))
    km = geo.planar_km(F.col("gap"))
    apart = pairs.where("gap > 0").withColumn("km", km).where(F.col("km") <= max_km + 1e-12).drop("gap")
    return apart.join(land_edges.select("a", "b"), ["a", "b"], "left_anti")


def ports(seas: DataFrame, land: DataFrame) -> DataFrame:
    """(a, b) of each sea zone (id, parent) and its land parent."""
    rows = seas.join(land.select(F.col("id").alias("parent")), "parent", "left_semi")
    return rows.select(F.least("id", "parent").alias("a"), F.greatest("id", "parent").alias("b"))


def adjacency(land: DataFrame, seas: DataFrame | None, min_km: float, max_strait_km: float) -> DataFrame:
    """All adjacency rows in their total order: land, sea, port and strait; without seas land alone.

    land: id, ring. seas: id, ring, parent, sea_class. Distances are text; ports have none.
    """

    def rows(pairs: DataFrame, kind: str, crossing: str, km: Column) -> DataFrame:
        return pairs.select(F.col("a").alias("from_province_id"), F.col("b").alias("to_province_id"), F.lit(kind).alias("adjacency_type"), F.lit(crossing).alias("crossing_type"), km.alias("shared_border_km"))

    text = distance_text(F.col("km"))
    land_edges = shared_borders(land, min_km)
    out = rows(land_edges, "land", "shared_border", text)
    if seas is not None:
        out = out.union(rows(shared_borders(seas, min_km), "sea", "shared_border", text)).union(rows(ports(seas, land), "port_to_sea", "port", F.lit("")))
        coastal = seas.where("sea_class = 'coastal' and parent is not null").select(F.col("parent").alias("id"))
        out = out.union(rows(straits(land, coastal, land_edges, max_strait_km), "strait", "strait", text))
    return out.orderBy("adjacency_type", "from_province_id", "to_province_id", "crossing_type")


def tile_cover(rows: DataFrame, zooms: tuple[int, int], on_map: bool = True) -> DataFrame:
    """(id, z, x, y): the tiles of each zoom that a row's bounds cover.

    What lies beyond the map counts to the tiles at its edge; unless on_map, tiles are numbered by the formula alone, past the edge as
    well, and bounds whose last tile comes before their first, as they do across a pole, have none.
    """
    z = rows.withColumn("z", F.explode(F.sequence(F.lit(zooms[0]), F.lit(zooms[1]))))
    zc = F.col("z")
    column, row = (geo.tile_x, geo.tile_y) if on_map else (geo.tile_column, geo.tile_row)
    ends = z.select("id", "z", column(F.col("x1"), zc).alias("xa"), column(F.col("x2"), zc).alias("xb"), row(F.col("y2"), zc).alias("ya"), row(F.col("y1"), zc).alias("yb")).where("xa <= xb and ya <= yb")
    return ends.withColumn("x", F.explode(F.sequence("xa", "xb"))).withColumn("y", F.explode(F.sequence("ya", "yb"))).select("id", "z", "x", "y")
