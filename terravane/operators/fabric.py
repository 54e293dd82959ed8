"""A fabric of locations: adjacency, features by part, hard pieces, constraints, seas, coverage, and the checks on all of it.

Polygons are (id, ring), rings closed. Everything is joins on keys, on supporting lines or on cells of a grid.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from terravane.functions import geo
from terravane.operators import overlay, partition, spatial
from terravane.operators.quality import finding, gathered

#: Kilometres of a degree in the metric of location borders, and the least factor for longitudes.
KM_DEGREE, LEAST_FACTOR = 111.195, 0.25


def location_adjacency(locations: DataFrame, min_km: float = 0.001) -> DataFrame:
    """(a, b, km): locations with a common border, of its planar length in degrees times KM_DEGREE and the cosine of the latitude of the
    centre of both together, LEAST_FACTOR at least. A corner has no length."""
    area, moment = geo.ring_moments(F.col("ring"))
    weights = locations.select("id", F.abs(area).alias("area"), (moment * F.signum(area)).alias("moment"))
    side = lambda c: weights.select(F.col("id").alias(c), F.col("area").alias(f"{c}_area"), F.col("moment").alias(f"{c}_moment"))
    length = F.sum(F.hypot(F.col("q.x") - F.col("p.x"), F.col("q.y") - F.col("p.y")))
    rows = spatial.contacts(locations).groupBy("a", "b").agg(length.alias("length")).where("length > 1e-12").join(side("a"), "a").join(side("b"), "b")
    middle = (F.col("a_moment") + F.col("b_moment")) / (F.col("a_area") + F.col("b_area"))
    km = F.col("length") * KM_DEGREE * F.greatest(F.lit(LEAST_FACTOR), F.cos(F.radians(middle)))
    return rows.select("a", "b", km.alias("km")).where(F.col("km") >= min_km)


def hard_pieces(pieces: DataFrame) -> DataFrame:
    """pieces (location, piece, layer, ...) of the finest layer that each location has: admin1, else admin0; others don't count."""
    rank = F.when(F.col("layer") == "admin1", 1).when(F.col("layer") == "admin0", 2)
    best = F.min("_rank").over(Window.partitionBy("location"))
    return pieces.withColumn("_rank", rank).where("_rank is not null").withColumn("_best", best).where("_rank = _best").drop("_rank", "_best")


def without_pieces(locations: DataFrame, pieces: DataFrame) -> DataFrame:
    """Locations (location) that no admin1 or admin0 piece refers to; aggregation with hard references can't take them."""
    return locations.select("location").join(pieces.where("layer in ('admin1', 'admin0')").select("location"), "location", "left_anti")


def constrained(contacts: DataFrame, lines: DataFrame, size: float, tolerance: float = 1e-9) -> DataFrame:
    """(a, b, soft): edges from contacts (a, b, p, q) with those gone that a hard constraint touches; soft is 1 where soft evidence does.

    lines: class ('hard_constraint' or 'soft_evidence'), x1, y1, x2, y2. A contact touches a line within tolerance.
    """
    cut = contacts.select("a", "b", F.monotonically_increasing_id().alias("contact"), F.least("p.x", "q.x").alias("x1"), F.least("p.y", "q.y").alias("y1"), F.greatest("p.x", "q.x").alias("x2"), F.greatest("p.y", "q.y").alias("y2"), "p", "q")
    marks = lines.select("class", F.col("x1").alias("lx1"), F.col("y1").alias("ly1"), F.col("x2").alias("lx2"), F.col("y2").alias("ly2"), F.least("x1", "x2").alias("x1"), F.least("y1", "y2").alias("y1"), F.greatest("x1", "x2").alias("x2"), F.greatest("y1", "y2").alias("y2"))
    near = spatial.dealt(cut, size, tolerance).join(spatial.dealt(marks, size, tolerance).drop("x1", "y1", "x2", "y2"), ["cx", "cy"])
    line = [F.col(c) for c in ("lx1", "ly1", "lx2", "ly2")]
    own = [F.col("p.x"), F.col("p.y"), F.col("q.x"), F.col("q.y")]
    gap = F.least(geo.segment_distance(own[0], own[1], *line), geo.segment_distance(own[2], own[3], *line), geo.segment_distance(line[0], line[1], *own), geo.segment_distance(line[2], line[3], *own))
    turn = lambda s, x, y: (s[2] - s[0]) * (y - s[1]) - (s[3] - s[1]) * (x - s[0])
    cross = (turn(line, own[0], own[1]) * turn(line, own[2], own[3]) < 0) & (turn(own, line[0], line[1]) * turn(own, line[2], line[3]) < 0)
    touched = near.where((gap <= tolerance) | cross).select("a", "b", "class").distinct()
    edges = contacts.select("a", "b").distinct().join(touched.where("class = 'hard_constraint'"), ["a", "b"], "left_anti")
    soft = touched.where("class = 'soft_evidence'").select("a", "b", F.lit(1.0).alias("soft"))
    return edges.join(soft, ["a", "b"], "left").select("a", "b", F.coalesce("soft", F.lit(0.0)).alias("soft"))


def location_features(cells: DataFrame, signals: list[str], **about: str) -> DataFrame:
    """One row for each part of each cell: location_id, cell, component_index from 1, component_count, area, a <signal>_signal for each, and
    the columns in `about`. cells: cell, parts (array of ring, area and signals)."""
    rows = cells.select("cell", F.size("parts").alias("component_count"), F.posexplode("parts").alias("_i", "part"))
    key = F.concat_ws("-", F.lit("loc"), "cell", F.substring(F.sha2(F.to_json("part.ring"), 256), 1, 12))
    values = [F.round(F.col(f"part.{s}"), 6).alias(f"{s}_signal") for s in signals]
    return rows.select(key.alias("location_id"), "cell", (F.col("_i") + 1).alias("component_index"), "component_count", F.round("part.area", 6).alias("area"), *values, *[F.lit(v).alias(k) for k, v in about.items()], F.col("part.ring").alias("ring"))


def coastal_flags(provinces: DataFrame, zones: DataFrame) -> DataFrame:
    """provinces with `coastal`: whether a land row has a coastal zone (parent); other rows keep null."""
    has = zones.where("sea_class = 'coastal'").select(F.col("parent").alias("province_id"), F.lit(True).alias("_has")).distinct()
    return provinces.join(has, "province_id", "left").withColumn("coastal", F.when(F.col("kind") == "land", F.coalesce("_has", F.lit(False)))).drop("_has")


def ocean_zones(domain: DataFrame, size: float, least_km2: float) -> DataFrame:
    """(col, row, area, km2, pieces): the parts of a domain (id, ring; rings don't overlap) in the cells of a grid snapped to multiples of size,
    columns and rows counted from the domain's lowest cell; parts of less than least_km2 are left out."""
    bounds = spatial.boxes(domain)
    low = bounds.agg(F.floor(F.min("x1") / size).alias("c0"), F.floor(F.min("y1") / size).alias("r0"))  # one row
    inner = [F.col("x1"), F.col("y1"), F.col("x2") - size * 1e-9, F.col("y2") - size * 1e-9]
    span = lambda a, b: F.explode(F.sequence(F.floor(a / size), F.floor(b / size)))
    cells = bounds.withColumn("c", span(inner[0], inner[2])).withColumn("r", span(inner[1], inner[3])).select("id", "ring", "c", "r")

    def run(batches):
        import pandas as pd

        from terravane.functions import kernel

        for rows in batches:
            out = []
            for ring, c, r in zip(rows.ring, rows.c, rows.r):
                box = [(c * size, r * size), ((c + 1) * size, r * size), ((c + 1) * size, (r + 1) * size), (c * size, (r + 1) * size)]
                part = kernel.intersection(partition._pieces(ring), [box])
                if part:
                    out.append((int(c), int(r), kernel.total(part), partition._rows(part)))
            yield pd.DataFrame(out, columns=["c", "r", "area", "pieces"])

    parts = cells.mapInPandas(run, f"c long, r long, area double, pieces {partition.PIECES}")
    closed = lambda p: F.concat(p, F.slice(p, 1, 1))
    km2 = F.aggregate("pieces", F.lit(0.0), lambda s, p: s + geo.ring_area_km2(closed(p)))
    zones = parts.withColumn("km2", km2).groupBy("c", "r").agg(F.sum("area").alias("area"), F.sum("km2").alias("km2"), F.flatten(F.collect_list("pieces")).alias("pieces"))
    return zones.where(F.col("km2") + 1e-12 >= least_km2).join(F.broadcast(low)).select((F.col("c") - F.col("c0")).alias("col"), (F.col("r") - F.col("r0")).alias("row"), "area", "km2", "pieces")


def sea_zones(land: DataFrame, ocean: DataFrame, width: float, size: float, least_km2: float) -> dict[str, DataFrame]:
    """coastal: (ocean, land, area, pieces) claimed in the order of land ids; deep: ocean_zones of what no claim took; provinces: land with its
    coastal flag."""
    coastal = overlay.coastal_claims(land, ocean, width, size)
    taken = coastal.select(F.col("ocean").alias("mask"), F.explode("pieces").alias("ring"))
    covers = taken.select(F.concat_ws(":", "mask", F.monotonically_increasing_id()).alias("id"), F.concat("ring", F.slice("ring", 1, 1)).alias("ring"))
    left = partition.gaps(ocean, covers.union(land.select("id", "ring")), size).select("mask", F.explode("pieces").alias("piece"))
    deep = left.select(F.concat_ws(":", "mask", F.monotonically_increasing_id()).alias("id"), F.concat("piece", F.slice("piece", 1, 1)).alias("ring"))
    flags = coastal_flags(land.select(F.col("id").alias("province_id"), F.lit("land").alias("kind")), coastal.select(F.lit("coastal").alias("sea_class"), F.col("land").alias("parent")))
    return {"coastal": coastal, "deep": ocean_zones(deep, size, least_km2), "provinces": flags}


def fabric_findings(locations: DataFrame, adjacency: DataFrame, shares: DataFrame, revision: str, size: float, tolerance: float = 1e-8) -> DataFrame:
    """Findings on a fabric: missing, repeated and degenerate locations, overlaps, adjacency rows, shares and revisions.

    locations: location_id, fabric_revision, ring. adjacency: from_location_id, to_location_id. shares: location_id, layer, share.
    """
    text = F.lit
    ids = locations.where("coalesce(location_id, '') <> ''")
    known = ids.select("location_id").distinct()
    counts = ids.groupBy("location_id").agg(F.count("*").alias("n")).where("n > 1")
    area, _ = geo.ring_moments(F.col("ring"))
    degenerate = ids.where(F.coalesce(F.size("ring") < 4, F.lit(True)) | (F.abs(area) <= 1e-15))
    whole = ids.where(F.size("ring") >= 4).select(F.col("location_id").alias("id"), "ring").dropDuplicates(["id"])
    overlaps = partition.without_overlaps(whole, size).join(whole.select("id", F.abs(area).alias("whole")), "id").where(F.col("whole") - F.col("area") > tolerance)
    ends = adjacency.select(F.coalesce("from_location_id", F.lit("")).alias("l"), F.coalesce("to_location_id", F.lit("")).alias("r"))
    held = lambda c: known.select(F.col("location_id").alias(c), F.lit(True).alias(f"has_{c}"))
    ends = ends.join(held("l"), "l", "left").join(held("r"), "r", "left").withColumn("bad", (F.col("l") == F.col("r")) | F.col("has_l").isNull() | F.col("has_r").isNull())
    pairs = ends.groupBy(F.least("l", "r").alias("a"), F.greatest("l", "r").alias("b")).agg(F.count("*").alias("n"), F.bool_or("bad").alias("bad"))
    off = F.coalesce(F.col("share"), F.lit(-1.0))
    sums = shares.withColumn("share", off).groupBy("location_id", "layer").agg(F.sum(F.greatest("share", F.lit(0.0))).alias("total")).where(F.abs(F.col("total") - 1) > 2e-4)
    gaps = sums.groupBy("layer").agg(F.array_sort(F.collect_set("location_id")).alias("ids"))
    return gathered(
        finding(locations.where("coalesce(location_id, '') = ''"), "missing_location_id", "error", F.array().cast("array<string>"), text("A row has no location_id.")),
        finding(counts, "duplicate_location_ids", "error", F.array("location_id"), text("Repeated location id."), times=F.col("n")),
        finding(degenerate, "invalid_geometry", "error", F.array("location_id"), text("Empty or degenerate geometry.")),
        finding(overlaps, "location_overlaps", "error", F.array("id"), text("Overlaps locations of lower id."), area=F.round(F.col("whole") - F.col("area"), 9)),
        finding(pairs.where("bad"), "invalid_adjacency", "error", F.array("a", "b"), text("Unknown or equal ends.")),
        finding(pairs.where("not bad and n > 1"), "duplicate_adjacency", "error", F.array("a", "b"), text("Repeated adjacency."), times=F.col("n")),
        finding(shares.where((off < 0) | (off > 1 + 1e-6)), "invalid_intersection_share", "error", F.array("location_id"), text("A share outside 0 to 1.")),
        finding(gaps, "incomplete_reference_coverage", "warning", F.col("ids"), F.col("layer"), locations=F.size("ids")),
        finding(ids.where(~F.col("fabric_revision").eqNullSafe(F.lit(revision))), "location_revision_mismatch", "error", F.array("location_id"), text("Another revision than the collection's.")),
    )


def coverage_differences(land: DataFrame, fabric: DataFrame, size: float, tolerance: float = 1e-8) -> DataFrame:
    """(side, id, area): land that the fabric leaves open ('gap'), and fabric outside the land ('outside'), by row of the side."""
    one = lambda x, y, side: partition.gaps(x, y, size).select(F.lit(side).alias("side"), F.col("mask").alias("id"), "area").where(F.col("area") > tolerance)
    return one(land, fabric, "gap").union(one(fabric, land, "outside"))


def graph_edges(contacts: DataFrame, province_of: DataFrame, scenarios: DataFrame, declared: DataFrame) -> DataFrame:
    """(kind, a, b): land edges between provinces of components that touch in a scenario that holds both, and declared edges.

    contacts: a, b (components). province_of: component, province. scenarios: scenario, component. declared: kind, a, b (provinces).
    """
    side = lambda c: scenarios.join(province_of, "component").select("scenario", F.col("component").alias(c), F.col("province").alias(f"p{c}"))
    met = contacts.select("a", "b").join(side("a"), "a").join(side("b"), ["scenario", "b"]).where("pa <> pb").select(F.lit("land").alias("kind"), F.col("pa").alias("a"), F.col("pb").alias("b"))
    both = met.union(declared.select(F.coalesce("kind", F.lit("land")), "a", "b"))
    return both.select("kind", F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def union_rows(relations: DataFrame, units: DataFrame) -> DataFrame:
    """(actor, offset, n, members): unions as a table over dense indices of units, in order of the actor's id, members in order; offset counts
    the members before. relations: actor, members (names); units: node, idx."""
    known = relations.select("actor", F.explode("members").alias("member"))
    of = lambda c: units.select(F.col("node").alias(c), F.col("idx").alias(f"{c}_idx"))
    rows = known.join(of("member"), "member").groupBy("actor").agg(F.array_sort(F.collect_list("member_idx")).alias("members")).join(of("actor"), "actor")
    before = Window.orderBy("actor").rowsBetween(Window.unboundedPreceding, -1)  # a row a union; the actors of a pack
    return rows.select(F.col("actor_idx").alias("actor"), F.coalesce(F.sum(F.size("members")).over(before), F.lit(0)).alias("offset"), F.size("members").alias("n"), "members")


def dense_rows(rows: DataFrame, order: list[str], columns: list[str]) -> DataFrame:
    """(dense_index, columns) of rows in the order of the key `order`, ranked by ranges."""
    from terravane.operators.graph import dense_index

    keyed = rows.withColumn("_key", F.struct(*order))
    return keyed.select("_key", *columns).distinct().join(dense_index(keyed, "_key"), "_key").select(F.col("idx").alias("dense_index"), *columns)


def border_pairs(shared: DataFrame, variants: DataFrame, sides: DataFrame) -> DataFrame:
    """(frontier, a, b, variant, km): for each frontier the pair of a left and a right province, and the variant of its segment, of least Hausdorff
    distance between common border and variant; ties fall to the lower names.

    shared: a, b, x, y (points of a common border). variants: frontier, variant, x, y. sides: frontier, province, side. Candidates are the pairs of
    provinces beside one frontier, so work is their points times the variant's.
    """
    from terravane.operators.release import hausdorff

    of = lambda c, side: sides.where(F.col("side") == side).select("frontier", F.col("province").alias(c))
    both = shared.select("a", "b", "x", "y").union(shared.select("b", "a", "x", "y"))
    own = both.join(of("a", "left"), "a").join(of("b", "right"), ["frontier", "b"])
    names = variants.select("frontier", "variant").distinct()
    key = F.struct("frontier", "a", "b", "variant").alias("key")
    left = own.join(names, "frontier").select(key, "x", "y")
    pairs = own.select("frontier", "a", "b").distinct()
    right = variants.join(pairs, "frontier").select(key, "x", "y")
    found = hausdorff(left, right)
    return found.groupBy(F.col("key.frontier").alias("frontier")).agg(F.min(F.struct("km", "key.a", "key.b", "key.variant")).alias("m")).select("frontier", "m.a", "m.b", "m.variant", "m.km")


def side_votes(anchors: DataFrame) -> DataFrame:
    """(frontier, half, votes, side): halves of a corridor named by the anchors around them: each votes 1 / (1 + distance) for its side; the half of
    most votes for the left is left, the first of equals. anchors: frontier, half, side, distance."""
    weight = 1 / (1 + F.col("distance"))
    votes = anchors.groupBy("frontier", "half").agg(F.sum(F.when(F.col("side") == "left", weight).when(F.col("side") == "right", -weight).otherwise(0.0)).alias("votes"))
    rank = F.row_number().over(Window.partitionBy("frontier").orderBy(F.desc("votes"), "half"))
    return votes.withColumn("side", F.when(rank == 1, "left").otherwise("right"))


def substrings(lines: DataFrame, anchors: DataFrame) -> DataFrame:
    """(line, low, high, residual): measures along a line between the outermost anchors projected on it, in planar degrees, and the greatest
    planar distance of an anchor from the line.

    lines: line, ring (its points in order). anchors: line, anchor, x, y. Measures are prefix sums over the segments.
    """
    parts = lines.select("line", F.posexplode(geo._segments(F.col("ring"))).alias("i", "s")).select("line", "i", "s.*")
    long = F.hypot(F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1"))
    before = F.coalesce(F.sum("long").over(Window.partitionBy("line").orderBy("i").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    parts = parts.withColumn("long", long).withColumn("before", before)
    rows = parts.join(anchors, "line")
    share = F.when(F.col("long") > 0, ((F.col("x") - F.col("x1")) * (F.col("x2") - F.col("x1")) + (F.col("y") - F.col("y1")) * (F.col("y2") - F.col("y1"))) / (F.col("long") * F.col("long"))).otherwise(0.0)
    share = F.least(F.greatest(share, F.lit(0.0)), F.lit(1.0))
    gap = F.hypot(F.col("x") - F.col("x1") - F.col("share") * (F.col("x2") - F.col("x1")), F.col("y") - F.col("y1") - F.col("share") * (F.col("y2") - F.col("y1")))
    near = rows.withColumn("share", share).withColumn("gap", gap).groupBy("line", "anchor").agg(F.min(F.struct("gap", "i", (F.col("before") + F.col("share") * F.col("long")).alias("at"))).alias("m"))
    return near.groupBy("line").agg(F.min("m.at").alias("low"), F.max("m.at").alias("high"), F.max("m.gap").alias("residual"))
