"""Samples, definitions, attribution and lookups for packs and reviews."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from terravane.functions import geo
from terravane.functions.text import cleaned
from terravane.operators import spatial
from terravane.operators.ownership import land


def sample(provinces: DataFrame, countries: list[str]) -> DataFrame:
    """Land of the countries, in any case of letters."""
    return land(provinces).where(F.upper(F.trim("country")).isin([c.upper() for c in countries]))


def sample_seas(seas: DataFrame, kept: DataFrame) -> DataFrame:
    """Coastal seas, and those without a class, whose parent is kept. seas: parent, sea_class; kept: province_id."""
    near = seas.where(F.coalesce("sea_class", F.lit("")).isin("coastal", ""))
    return near.join(kept.select(F.col("province_id").alias("parent")), "parent", "left_semi")


def sample_edges(edges: DataFrame, kept: DataFrame) -> DataFrame:
    """Edges (a, b) with both ends kept."""
    ends = lambda c: kept.select(F.col("province_id").alias(c))
    return edges.join(ends("a"), "a", "left_semi").join(ends("b"), "b", "left_semi")


def in_priority(country: Column, countries: list[str], box: tuple[float, float, float, float]) -> Column:
    """Whether a row (bounds x1..y2) is of one of the countries or touches the box."""
    x1, y1, x2, y2 = box
    meets = (F.col("x2") >= x1) & (F.col("x1") <= x2) & (F.col("y2") >= y1) & (F.col("y1") <= y2)
    return F.coalesce(F.upper(F.trim(country)).isin([c.upper() for c in countries]), F.lit(False)) | meets


def localization(provinces: DataFrame, regions: DataFrame, countries: DataFrame) -> DataFrame:
    """(key, value) of names: provinces (province_id, display_name), regions (region_key), countries (tag, display_name)."""
    keyed = lambda df, kind, k, v: df.select(F.concat(F.lit(f"{kind}."), k).alias("key"), F.coalesce(cleaned(v), F.col(k)).alias("value"))
    return keyed(provinces, "province", "province_id", "display_name").unionByName(keyed(regions, "region", "region_key", "region_key")).unionByName(keyed(countries, "country", "tag", "display_name"))


# Text in a licence and the source that it names.
LICENSE_SOURCES = {"natural earth": "natural_earth", "geoboundaries": "geoboundaries", "worldpop": "worldpop", "ghsl": "ghsl"}


def attribution(features: DataFrame) -> DataFrame:
    """Distinct (source_id, license) of features (licenses, sources: lists): the source that the licence names, or the first of the
    lineage up to its colon, or derived."""
    first = F.filter("sources", lambda s: s != "")[0]
    fallback = F.coalesce(F.when(F.size(F.filter("sources", lambda s: s != "")) > 0, F.split(first, ":")[0]), F.lit("derived"))
    rows = features.select(F.explode("licenses").alias("license"), fallback.alias("fallback"))
    named = F.coalesce(*[F.when(F.contains(F.lower("license"), F.lit(t)), F.lit(s)) for t, s in LICENSE_SOURCES.items()], F.col("fallback"))
    return rows.select(named.alias("source_id"), "license").distinct()


def adjacency_index(edges: DataFrame) -> DataFrame:
    """(node, neighbours): both directions of edges (a, b, km), longest border first, then by id."""
    both = edges.select("a", "b", "km").union(edges.select("b", "a", "km"))
    return both.groupBy(F.col("a").alias("node")).agg(F.transform(F.array_sort(F.collect_list(F.struct((-F.col("km")).alias("k"), F.col("b").alias("id")))), lambda s: s.id).alias("neighbours"))


def adjacency_lines(edges: DataFrame, points: DataFrame) -> DataFrame:
    """Edges of kind land or strait as lines between the points (province_id, x, y) of their ends."""
    end = lambda c: points.select(F.col("province_id").alias(c), F.struct("x", "y").alias(f"p{c}"))
    return edges.where("kind in ('land', 'strait')").join(end("a"), "a").join(end("b"), "b").select("a", "b", "kind", F.array("pa", "pb").alias("line"))


def certified_owner(provinces: DataFrame, statuses: DataFrame) -> DataFrame:
    """(province_id, owner, level): the actor of a status on the component, else on the province, else on the unit; the least of
    several. provinces: province_id, component, unit. statuses: subject, actor."""
    actor = statuses.groupBy("subject").agg(F.min("actor").alias("actor"))
    on = lambda c: actor.select(F.col("subject").alias(c), F.col("actor").alias(f"by_{c}"))
    rows = provinces.join(on("component"), "component", "left").join(on("province_id"), "province_id", "left").join(on("unit"), "unit", "left")
    level = F.when(F.col("by_component").isNotNull(), "component").when(F.col("by_province_id").isNotNull(), "province").when(F.col("by_unit").isNotNull(), "unit")
    return rows.select("province_id", F.coalesce("by_component", "by_province_id", "by_unit").alias("owner"), level.alias("level"))


def findings_index(findings: DataFrame, ids: DataFrame) -> DataFrame:
    """(province_id, codes): findings (code, affected) of each known id."""
    rows = findings.select("code", F.explode("affected").alias("province_id")).join(ids.select("province_id"), "province_id", "left_semi")
    return rows.groupBy("province_id").agg(F.array_sort(F.collect_set("code")).alias("codes"))


def locate(points: DataFrame, polygons: DataFrame, size: float, radius: float) -> DataFrame:
    """(point_id, id, gap): the least id that covers a point, else the nearest polygon within radius degrees, the lower id among
    equals; points far from all are left out."""
    inside = spatial.points_in(points.select("point_id", "x", "y"), polygons, size).groupBy("point_id").agg(F.min("id").alias("id")).withColumn("gap", F.lit(0.0))
    outside = points.select("point_id", "x", "y").join(inside.select("point_id"), "point_id", "left_anti")
    sides = spatial.segments(polygons)
    wide = sides.select("id", F.col("x1").alias("sx1"), F.col("y1").alias("sy1"), F.col("x2").alias("sx2"), F.col("y2").alias("sy2"), F.least("x1", "x2").alias("x1"), F.least("y1", "y2").alias("y1"), F.greatest("x1", "x2").alias("x2"), F.greatest("y1", "y2").alias("y2"))
    wide = spatial.dealt(wide, max(size, radius), radius).drop("x1", "y1", "x2", "y2")
    keyed = outside.withColumn("cx", F.floor(F.col("x") / max(size, radius))).withColumn("cy", F.floor(F.col("y") / max(size, radius)))
    gap = geo.segment_distance(F.col("x"), F.col("y"), F.col("sx1"), F.col("sy1"), F.col("sx2"), F.col("sy2"))
    near = keyed.join(wide, ["cx", "cy"]).withColumn("gap", gap).where(F.col("gap") <= radius)
    best = near.groupBy("point_id").agg(F.min_by(F.struct("id", "gap"), F.struct("gap", "id")).alias("b")).select("point_id", "b.id", "b.gap")
    return inside.select("point_id", "id", "gap").unionByName(best)


def compose_eras(layers: list[DataFrame]) -> DataFrame:
    """Rows (scaffold_id, operation, era_id) of packs laid over one another in order: the last that changes a scaffold counts, and a
    mere pass-through never takes the place of a change."""
    rows = None
    for i, layer in enumerate(layers):
        one = layer.select("scaffold_id", "operation", "era_id", F.lit(i).alias("layer"))
        rows = one if rows is None else rows.unionByName(one)
    hard = (F.col("operation") != "scaffold").cast("int")
    best = F.rank().over(Window.partitionBy("scaffold_id").orderBy(F.desc(hard), F.desc("layer")))
    return rows.withColumn("_r", best).where("_r = 1").drop("_r")


def golden(ownership: DataFrame, owners: DataFrame, counts: DataFrame) -> DataFrame:
    """Faults against expectations: owners (province_id, expected) and counts (tag, least, most; null for no bound)."""
    off = owners.join(ownership.select("province_id", cleaned("owner").alias("actual")), "province_id", "left").where(~F.col("expected").eqNullSafe(F.col("actual")))
    first = off.select(F.lit("GOLDEN_OWNER_MISMATCH").alias("code"), F.col("province_id").alias("subject"), "expected", "actual")
    n = ownership.groupBy(cleaned("owner").alias("tag")).agg(F.count("*").alias("n"))
    both = counts.join(n, "tag", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    low = both.where("n < least").select(F.lit("GOLDEN_MIN_OWNER_COUNT"), "tag", F.col("least").cast("string"), F.col("n").cast("string"))
    high = both.where("n > most").select(F.lit("GOLDEN_MAX_OWNER_COUNT"), "tag", F.col("most").cast("string"), F.col("n").cast("string"))
    return first.union(low).union(high)


def golden_borders(ownership: DataFrame, edges: DataFrame, present: DataFrame, disputed: DataFrame, pairs: DataFrame, owner_edges: DataFrame) -> DataFrame:
    """(code, subject, expected, actual): the other expectations. present: tag, wanted (false: forbidden). disputed: province_id, expected.
    pairs: l, r, left_owner, right_owner (null: any), adjacent (whether that is asked for). owner_edges: owner_a, owner_b, least. edges: a, b."""
    owner = ownership.select("province_id", cleaned("owner").alias("owner"), F.coalesce("disputed", F.lit(False)).alias("flag"))
    text = lambda c: F.col(c).cast("string")
    used = owner.groupBy(F.col("owner").alias("tag")).agg(F.count("*").alias("n"))
    tags = present.join(used, "tag", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    lost = tags.where("wanted and n = 0").select(F.lit("GOLDEN_REQUIRED_OWNER_MISSING").alias("code"), F.col("tag").alias("subject"), F.lit("1").alias("expected"), F.lit("0").alias("actual"))
    kept = tags.where("not wanted and n > 0").select(F.lit("GOLDEN_FORBIDDEN_OWNER"), "tag", F.lit("0"), text("n"))
    flags = disputed.join(owner, "province_id", "left").where(~F.col("expected").eqNullSafe(F.col("flag"))).select(F.lit("GOLDEN_DISPUTED_MISMATCH"), "province_id", text("expected"), text("flag"))
    links = edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    near = pairs.withColumn("a", F.least("l", "r")).withColumn("b", F.greatest("l", "r"))
    apart = near.where("coalesce(adjacent, true)").join(links, ["a", "b"], "left_anti").select(F.lit("GOLDEN_BORDER_NOT_ADJACENT"), F.concat_ws("|", "l", "r"), F.lit("adjacent"), F.lit(None).cast("string"))
    ends = pairs.select(F.col("l").alias("province_id"), F.col("left_owner").alias("expected")).union(pairs.select("r", "right_owner")).where("expected is not null")
    owners = ends.join(owner, "province_id", "left").where(~F.col("expected").eqNullSafe(F.col("owner"))).select(F.lit("GOLDEN_BORDER_OWNER_MISMATCH"), "province_id", "expected", "owner")
    side = lambda c: owner.select(F.col("province_id").alias(c), F.col("owner").alias(f"o{c}"))
    shared = links.join(side("a"), "a").join(side("b"), "b").groupBy(F.least("oa", "ob").alias("x"), F.greatest("oa", "ob").alias("y")).agg(F.count("*").alias("n"))
    asked = owner_edges.withColumn("x", F.least("owner_a", "owner_b")).withColumn("y", F.greatest("owner_a", "owner_b"))
    few = asked.join(shared, ["x", "y"], "left").where(F.coalesce("n", F.lit(0)) < F.col("least")).select(F.lit("GOLDEN_OWNER_ADJACENCY_FAILED"), F.concat_ws("|", "owner_a", "owner_b"), text("least"), F.coalesce("n", F.lit(0)).cast("string"))
    return lost.union(kept).union(flags).union(apart).union(owners).union(few)


# The order of changes.
CHANGE_ORDER = ["modified", "added", "removed"]


def first_changes(changes: DataFrame, most: int | None) -> DataFrame:
    """The first `most` changes (change_type, province_id, ...), modified before added before removed, then by province; `truncated` tells
    whether there were more. A report's limit, not the engine's: None keeps all."""
    rank = F.coalesce(F.nullif(F.array_position(F.array(*map(F.lit, CHANGE_ORDER)), F.col("change_type")), F.lit(0)), F.lit(9))
    rows = changes.orderBy(rank, "province_id")
    if most is None:
        return rows.withColumn("truncated", F.lit(False))
    return rows.limit(most).withColumn("truncated", F.lit(changes.limit(most + 1).count() > most))


def hierarchy_regions(entities: DataFrame, provinces: DataFrame, level: str) -> DataFrame:
    """(region_id, display_name, province_count, province_ids): the hierarchy's entities of a level, or where it has none the dissolve of the
    provinces by region. entities: region_id, display_name, region_type, province_ids."""
    from terravane.operators.hierarchy import dissolve_regions

    own = entities.where((F.col("region_type") == level) & (F.coalesce("region_id", F.lit("")) != ""))
    ids = F.coalesce("province_ids", F.array().cast("array<string>"))
    found = own.select("region_id", F.coalesce("display_name", "region_id").alias("display_name"), F.size(ids).cast("long").alias("province_count"), ids.alias("province_ids"))
    if not found.isEmpty():
        return found
    return dissolve_regions(provinces).select(F.col("region_key").alias("region_id"), F.col("region_key").alias("display_name"), "province_count", "province_ids")


LINEAGE = ["era_province_id", "scaffold_province_id", "operation", "display_name", "part_index", "part_count", "in_priority_region", "geometry_mode", "reason"]


def lineage_rows(rows: DataFrame) -> DataFrame:
    """Rows of a lineage table, every field as text, empty where it has none."""
    return rows.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) if c in rows.columns else F.lit("").alias(c) for c in LINEAGE])


def tiny(area: Column, population: Column, least_area: float, least_population: float, share: float = 0.05) -> Column:
    """Whether a cell is below `share` of the least area, or below it with too few people."""
    return (area < least_area * share) | ((area < least_area) & (population < least_population))


def with_fallback(fine: DataFrame, coarse: DataFrame, key: str) -> DataFrame:
    """fine rows, and those coarse rows whose key no fine row has."""
    return fine.unionByName(coarse.join(fine.select(key).distinct(), key, "left_anti"))


def named_like(rows: DataFrame, name: str, part: str, order: str) -> DataFrame:
    """The first row, by `order`, whose name holds `part` in any case of letters; any row's does if it is empty."""
    return rows.where(F.contains(F.lower(F.coalesce(F.col(name), F.lit(""))), F.lit(part.lower()))).orderBy(order).limit(1)


def unique_identities(rows: DataFrame, key: str, identity: list[str]) -> DataFrame:
    """Keys whose identity differs between scenarios, with the number of identities."""
    return rows.groupBy(key).agg(F.countDistinct(F.struct(*identity)).alias("identities")).where("identities > 1")


def frame(rows: DataFrame, trigger: float = 12.0) -> DataFrame:
    """Bounds over all rows, or, where these are more than `trigger` times as wide as the widest row, of the widest row alone."""
    width = F.greatest(F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1"))
    found = rows.agg(F.min("x1").alias("x1"), F.min("y1").alias("y1"), F.max("x2").alias("x2"), F.max("y2").alias("y2"), F.max_by(F.struct("x1", "y1", "x2", "y2"), F.struct(width, "id")).alias("widest"), F.max(width).alias("w"))
    spread = F.greatest(F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1"))
    return found.select(*[F.when(spread > trigger * F.col("w"), F.col(f"widest.{c}")).otherwise(F.col(c)).alias(c) for c in ("x1", "y1", "x2", "y2")])


def hausdorff(left: DataFrame, right: DataFrame) -> DataFrame:
    """(key, km): the discrete Hausdorff distance of two point sets (key, x, y) in local kilometres."""
    a, b = left.select("key", F.col("x").alias("ax"), F.col("y").alias("ay")), right.select("key", F.col("x").alias("bx"), F.col("y").alias("by"))
    pairs = a.join(b, "key").withColumn("d", geo.local_km(F.col("ax"), F.col("ay"), F.col("bx"), F.col("by")))
    one = lambda *p: pairs.groupBy("key", *p).agg(F.min("d").alias("d")).groupBy("key").agg(F.max("d").alias("d"))
    return one("ax", "ay").union(one("bx", "by")).groupBy("key").agg(F.max("d").alias("km"))
