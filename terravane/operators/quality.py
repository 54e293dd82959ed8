"""Checks: each rule gives rows of findings (code, severity, affected, message, measurements)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terravane.functions.text import UNKNOWN_TAG, cleaned

SEVERITIES = ("error", "warning", "info")


def finding(rows: DataFrame, code: str, severity: str, affected: Column, message: Column, **measurements: Column) -> DataFrame:
    """One finding for each row; measurements are text."""
    pairs = [x for k, v in measurements.items() for x in (F.lit(k), v.cast("string"))]
    found = F.create_map(*pairs) if pairs else F.lit(None).cast("map<string,string>")
    return rows.select(F.lit(code).alias("code"), F.lit(severity).alias("severity"), affected.alias("affected"), message.alias("message"), found.alias("measurements"))


def gathered(*parts: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def ordered(findings: DataFrame) -> DataFrame:
    """Findings by severity, code, ids, message and measurements."""
    rank = F.array_position(F.array(*map(F.lit, SEVERITIES)), F.col("severity"))
    return findings.orderBy(rank, "code", F.to_json("affected"), "message", F.to_json("measurements"))


def summary(findings: DataFrame) -> DataFrame:
    counts = findings.agg(F.count_if(F.col("severity") == "error").alias("errors"), F.count_if(F.col("severity") == "warning").alias("warnings"))
    return counts.withColumn("status", F.when(F.col("errors") > 0, "fail").otherwise("pass"))


def coverage(land: DataFrame, ownership: DataFrame) -> DataFrame:
    """Ownership rows without an id, doubled, missing or extra, against land ids (province_id)."""
    named = ownership.select(cleaned("province_id").alias("province_id"))
    counts = named.where("province_id is not null").groupBy("province_id").agg(F.count("*").alias("n"))
    one = F.array("province_id")
    quoted = F.concat(F.lit("'"), F.col("province_id"), F.lit("'"))
    return gathered(
        finding(named.where("province_id is null"), "MALFORMED_OWNERSHIP_ROW", "error", F.array().cast("array<string>"), F.lit("Ownership row has no province_id.")),
        finding(counts.where("n > 1"), "DUPLICATE_OWNERSHIP_ROW", "error", one, F.concat(F.lit("Several ownership rows for province "), quoted), occurrence_count=F.col("n")),
        finding(land.join(counts, "province_id", "left_anti"), "MISSING_OWNERSHIP_ROW", "error", one, F.concat(F.lit("No ownership row for land province "), quoted)),
        finding(counts.join(land, "province_id", "left_anti"), "EXTRA_OWNERSHIP_ROW", "error", one, F.concat(F.lit("Ownership row for unknown province "), quoted)),
    )


def required_fields(ownership: DataFrame) -> DataFrame:
    named = ownership.where(cleaned("province_id").isNotNull())
    return gathered(*[finding(named.where(cleaned(f).isNull()), f"MISSING_{f.upper()}", "error", F.array("province_id"), F.lit(f"Province has no {f}.")) for f in ("owner", "controller")])


def sampled(ids: Column, n: int) -> Column:
    """The first n distinct ids in order."""
    return F.slice(F.array_sort(F.collect_set(ids)), 1, n)


def unknown_tags(ownership: DataFrame, catalog: DataFrame) -> DataFrame:
    """Tags in a role that the catalog (tag) lacks."""
    one = lambda c: ownership.select("province_id", F.lit(c).alias("role"), cleaned(c).alias("tag"))
    many = lambda c, role: ownership.select("province_id", F.lit(role).alias("role"), F.explode(c).alias("tag"))
    used = one("owner").union(one("controller")).union(many("cores", "core")).union(many("claims", "claim")).where(F.col("tag").isNotNull() & (F.col("tag") != UNKNOWN_TAG))
    lost = used.join(catalog.select("tag"), "tag", "left_anti").groupBy("role", "tag").agg(sampled(F.col("province_id"), 20).alias("ids"))
    return gathered(*[finding(lost.where(F.col("role") == r), f"UNKNOWN_{r.upper()}_TAG", "error", F.col("ids"), F.concat(F.lit(f"Unknown {r} tag "), F.col("tag")), tag=F.col("tag")) for r in ("owner", "controller", "core", "claim")])


def orphan_tags(ownership: DataFrame) -> DataFrame:
    """Cores and claims whose tag owns nothing."""
    owners = ownership.select(cleaned("owner").alias("tag")).where("tag is not null").distinct()
    parts = []
    for role, column in (("core", "cores"), ("claim", "claims")):
        used = ownership.select("province_id", F.explode(column).alias("tag")).where(F.col("tag") != UNKNOWN_TAG)
        lost = used.join(owners, "tag", "left_anti").groupBy("tag").agg(sampled(F.col("province_id"), 40).alias("ids"), F.count("*").alias("n"))
        parts.append(finding(lost, f"ORPHAN_{role.upper()}", "warning", F.col("ids"), F.concat(F.lit(f"{role.title()} tag owns no province: "), F.col("tag")), tag=F.col("tag"), province_count=F.col("n")))
    return gathered(*parts)


def unknown_owners(ownership: DataFrame) -> DataFrame:
    rows = ownership.where(cleaned("owner") == UNKNOWN_TAG).agg(sampled(F.col("province_id"), 50).alias("ids"), F.count("*").alias("n")).where("n > 0")
    return finding(rows, "UNK_OWNER", "warning", F.col("ids"), F.lit("Provinces of unknown owner."), province_count=F.col("n"))


def fragments(stats: DataFrame, least: int = 8, limit: int = 25) -> DataFrame:
    """Owners (owner_components) of many provinces in too many parts."""
    rows = stats.where((F.col("province_count") >= least) & (F.col("component_count") > limit))
    return finding(rows, "FRAGMENT_OWNER_COMPONENTS", "warning", F.array("owner"), F.concat(F.lit("Owner in many parts: "), F.col("owner")), component_count=F.col("component_count"), largest=F.col("largest"))


def owner_pairs(ownership: DataFrame, edges: DataFrame) -> DataFrame:
    """(owner_a, owner_b, shared_edges): edges between provinces of two owners, or inside one."""
    own = ownership.select("province_id", "owner")
    rows = edges.join(own.select(F.col("province_id").alias("a"), F.col("owner").alias("oa")), "a").join(own.select(F.col("province_id").alias("b"), F.col("owner").alias("ob")), "b")
    return rows.groupBy(F.least("oa", "ob").alias("owner_a"), F.greatest("oa", "ob").alias("owner_b")).agg(F.count("*").alias("shared_edges"))


def adjacency_rows(rows: DataFrame, provinces: DataFrame, min_km: float) -> DataFrame:
    """Faults of recorded adjacency rows: row, from_province_id, to_province_id, adjacency_type, bidirectional, crossing_type,
    shared_border_km (text), source_lineage (text). provinces: province_id, kind."""
    named = rows.withColumn("f", F.coalesce("from_province_id", F.lit(""))).withColumn("t", F.coalesce("to_province_id", F.lit("")))
    pair = F.array_sort(F.filter(F.array("f", "t"), lambda x: x != ""))
    at = {"row": F.col("row")}
    whole = named.where("f <> '' and t <> ''")
    kinds = provinces.groupBy("province_id").agg(F.bool_or(F.coalesce("kind", F.lit("land")) == "land").alias("is_land"))
    ends = whole.select("row", F.explode(F.array_distinct(F.array("f", "t"))).alias("province_id")).join(kinds, "province_id", "left")
    first = whole.groupBy(F.least("f", "t").alias("p"), F.greatest("f", "t").alias("q")).agg(F.min("row").alias("first"))
    again = whole.join(first, (F.least("f", "t") == F.col("p")) & (F.greatest("f", "t") == F.col("q"))).where("row > first")
    km = F.try_to_number(F.col("shared_border_km"), F.lit("999999999.999999")).cast("double")
    lineage = F.from_json("source_lineage", "array<string>")
    parts = [
        finding(named.where("f = '' or t = ''"), "MALFORMED_ADJACENCY_ROW", "error", pair, F.lit("Both endpoints are needed."), **at),
        finding(ends.where("is_land is null"), "UNKNOWN_ADJACENCY_ENDPOINT", "error", F.array("province_id"), F.lit("Unknown endpoint."), **at),
        finding(ends.where("not is_land"), "NONLAND_ADJACENCY_ENDPOINT", "error", F.array("province_id"), F.lit("Endpoint isn't land."), **at),
        finding(whole.where("f = t"), "SELF_ADJACENCY_EDGE", "error", F.array("f"), F.lit("Edge to itself."), **at),
        finding(whole.where("f > t"), "NONCANONICAL_ADJACENCY_PAIR", "error", pair, F.lit("Endpoints out of order."), **at),
        finding(again, "DUPLICATE_ADJACENCY_EDGE", "error", pair, F.lit("The pair has come before."), **at),
        finding(whole.where("coalesce(bidirectional, '') <> 'true'"), "ASYMMETRIC_ADJACENCY", "error", pair, F.lit("bidirectional must be true."), **at),
        *[finding(whole.where(F.coalesce(F.col(c), F.lit("")) != v), "INVALID_ADJACENCY_SEMANTICS", "error", pair, F.lit(f"{c} must be {v}."), **at) for c, v in (("adjacency_type", "land"), ("crossing_type", "shared_border"))],
        finding(whole.where(km.isNull() | (km <= 0)), "INVALID_SHARED_BORDER_MEASUREMENT", "error", pair, F.lit("The length must be positive."), **at),
        finding(whole.where((km > 0) & (km < min_km)), "SHARED_BORDER_BELOW_THRESHOLD", "error", pair, F.lit("The border is too short."), **at),
        finding(whole.where(lineage.isNull() | F.exists(lineage, lambda x: x.isNull() | (x == ""))), "INVALID_ADJACENCY_LINEAGE", "error", pair, F.lit("The lineage must be a list of texts."), **at),
    ]
    return gathered(*parts)


def lost_edges(expected: DataFrame, recorded: DataFrame) -> DataFrame:
    """Edges (a, b) that should be recorded and aren't."""
    pairs = recorded.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    return expected.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct().join(pairs, ["a", "b"], "left_anti")


def unknown_refs(owners: DataFrame, ids: DataFrame) -> DataFrame:
    """(owner, missing): for each owner with refs (array), those that ids (id) lacks, in order; owners without any are left out."""
    lost = owners.select("owner", F.explode("refs").alias("id")).join(ids.select("id"), "id", "left_anti")
    return lost.groupBy("owner").agg(F.array_sort(F.collect_set("id")).alias("missing"))


def parity(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows of one side only, with the side; multiplicities count."""
    return left.exceptAll(right).withColumn("side", F.lit("left")).union(right.exceptAll(left).withColumn("side", F.lit("right")))


def share_sums(shares: DataFrame, tolerance: float) -> DataFrame:
    """(location, layer, total) where the shares of a location in a layer don't add up to 1."""
    return shares.groupBy("location", "layer").agg(F.sum("share").alias("total")).where(F.abs(F.col("total") - 1) > tolerance)


#: Most names of a census catalog that every row of the other is held against.
CATALOG_ROWS = 4096


def census_gaps(cells: DataFrame, left: DataFrame, right: DataFrame, a: str, b: str) -> DataFrame:
    """(a, b, n) of the cells of two catalogs that don't occur exactly once. ValueError if the right one has more than CATALOG_ROWS names."""
    names = [r[0] for r in right.select(b).distinct().limit(CATALOG_ROWS + 1).collect()]
    if len(names) > CATALOG_ROWS:
        raise ValueError(f"more than {CATALOG_ROWS} names in {b}")
    whole = left.select(a).distinct().select(a, F.explode(F.array(*map(F.lit, names)) if names else F.array().cast("array<string>")).alias(b))
    counts = cells.groupBy(a, b).agg(F.count("*").alias("n"))
    return whole.join(counts, [a, b], "left").select(a, b, F.coalesce("n", F.lit(0)).alias("n")).where("n <> 1")


def independent_evidence(claims: DataFrame, sources: DataFrame) -> DataFrame:
    """(claim, anchored, groups, accepted): accepted with an academic or primary source, two independence groups and all reviewed.

    claims: claim, refs. sources: source, kind, independence_group, reviewed.
    """
    rows = claims.select("claim", F.explode_outer("refs").alias("source")).join(sources, "source", "left")
    out = rows.groupBy("claim").agg(F.coalesce(F.bool_or(F.col("kind").isin("academic", "primary")), F.lit(False)).alias("anchored"), F.countDistinct("independence_group").alias("groups"), F.bool_and(F.coalesce("reviewed", F.lit(False))).alias("reviewed"))
    return out.select("claim", "anchored", "groups", (F.col("anchored") & (F.col("groups") >= 2) & F.col("reviewed")).alias("accepted"))
