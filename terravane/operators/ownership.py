"""Scenario ownership: a baseline under three layers of rules, legends, catalogs, dissolves and comparisons of two tables.

provinces: province_id, kind, country, region, display_name. rules: level ('country', 'region', 'province'), match_id, seq, owner,
controller, cores, claims, has_culture, culture, has_religion, religion, disputed, notes; a null field leaves what is below,
except culture and religion, which a rule sets, even to null, where their has_ flag is true.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from terravane.functions.text import UNKNOWN_TAG, cleaned, tag_fill

FIELDS = ("owner", "controller", "cores", "claims", "disputed", "notes")
LEVELS = ("country", "region", "province")
RULE_SCHEMA = "level string, match_id string, seq int, owner string, controller string, cores array<string>, claims array<string>, has_culture boolean, culture string, has_religion boolean, religion string, disputed boolean, notes string"


def land(provinces: DataFrame) -> DataFrame:
    """Land rows; a missing kind counts as land."""
    return provinces.where(F.coalesce("kind", F.lit("land")) == "land")


def tags(values: Column) -> Column:
    """Trimmed tags, blanks dropped, each once, where it stands first."""
    return F.array_distinct(F.filter(F.transform(values, lambda t: F.trim(t)), lambda t: t != ""))


def folded(rules: DataFrame, level: str) -> DataFrame:
    """The rules of a level as one row for each match_id: what their application in order of seq comes to.

    Fields are independent but for the controller, which a rule that sets the owner sets too. Of repeated rules for a province
    only the last counts.
    """
    own = rules.where(F.col("level") == level).withColumn("match_id", F.trim("match_id"))
    if level == "province":
        last = Window.partitionBy("match_id").orderBy(F.desc("seq"))
        own = own.withColumn("_n", F.row_number().over(last)).where("_n = 1").drop("_n")
    own = own.withColumn("owner", F.trim("owner")).withColumn("controller", F.coalesce(F.trim("controller"), "owner"))
    own = own.withColumn("cores", tags(F.col("cores"))).withColumn("claims", tags(F.col("claims")))
    latest = [F.max_by(F.col(f), F.when(F.col(f).isNotNull(), F.col("seq"))).alias(f"{level}_{f}") for f in FIELDS]
    identity = []
    for f in ("culture", "religion"):
        identity += [F.max_by(cleaned(f), F.when(F.col(f"has_{f}"), F.col("seq"))).alias(f"{level}_{f}"), F.bool_or(F.coalesce(f"has_{f}", F.lit(False))).alias(f"{level}_has_{f}")]
    return own.groupBy("match_id").agg(F.count("*").alias(f"{level}_hits"), *latest, *identity)


def resolve(provinces: DataFrame, rules: DataFrame, culture: str | None = None, religion: str | None = None, disputed: bool = False) -> DataFrame:
    """One ownership row for each land province, fields of later layers over earlier ones, and the rule hits of each row."""
    rows = land(provinces).select("province_id", cleaned("country").alias("country"), cleaned("region").alias("region"), "display_name")
    keys = {"country": "country", "region": "region", "province": "province_id"}
    for level in LEVELS:
        rows = rows.join(folded(rules, level).withColumnRenamed("match_id", f"_{level}"), F.col(keys[level]) == F.col(f"_{level}"), "left").drop(f"_{level}")
    base = {"owner": F.coalesce("country", F.lit(UNKNOWN_TAG)), "controller": F.coalesce("country", F.lit(UNKNOWN_TAG)), "cores": F.when(F.col("country").isNotNull(), F.array("country")).otherwise(F.array().cast("array<string>")), "claims": F.array().cast("array<string>"), "disputed": F.lit(disputed), "notes": F.lit(None).cast("string")}
    found = {f: F.coalesce(*[F.col(f"{level}_{f}") for level in reversed(LEVELS)], base[f]) for f in FIELDS}
    for f, default in (("culture", culture), ("religion", religion)):
        value = F.lit(default).cast("string")
        for level in LEVELS:
            value = F.when(F.col(f"{level}_has_{f}"), F.col(f"{level}_{f}")).otherwise(value)
        found[f] = value
    source = F.when(F.col("province_hits") > 0, "province_override").when(F.col("region_hits") > 0, "region_rule").when(F.col("country_hits") > 0, "country_rule").otherwise("baseline")
    hits = [F.coalesce(f"{level}_hits", F.lit(0)).cast("long").alias(f"{level}_hits") for level in LEVELS]
    return rows.select("province_id", *[c.alias(f) for f, c in found.items()], source.alias("assignment_source"), "country", "region", "display_name", *hits)


def uncertain() -> Column:
    """Disputed, of unknown owner, or held by another than the owner."""
    return F.coalesce(F.col("disputed"), F.lit(False)) | F.coalesce(F.col("owner") == UNKNOWN_TAG, F.lit(False)) | F.coalesce(F.col("owner") != F.col("controller"), F.lit(False))


def choropleth(provinces: DataFrame, ownership: DataFrame) -> DataFrame:
    """Provinces with their ownership row (those without one are left out), fills and the uncertainty flag."""
    rows = land(provinces).select("province_id").join(ownership, "province_id")
    return rows.select("province_id", "owner", "controller", tag_fill("owner").alias("owner_color"), tag_fill("controller").alias("controller_color"), uncertain().alias("uncertain"))


def legend(ownership: DataFrame) -> DataFrame:
    """Every tag that owns, controls, is a core or is claimed, with its counts."""
    one = lambda c, role: ownership.select(F.col(c).alias("tag"), F.lit(role).alias("role"))
    many = lambda c: ownership.select(F.explode(c).alias("tag"), F.lit(c).alias("role"))
    roles = one("owner", "owner").union(one("controller", "controller")).union(many("cores")).union(many("claims"))
    counts = roles.groupBy("tag").agg(F.count_if(F.col("role") == "owner").alias("owned"), F.count_if(F.col("role") == "controller").alias("controlled"))
    return counts.select("tag", "owned", "controlled", tag_fill("tag").alias("color"))


def dissolve(rows: DataFrame, key: str, unassigned: bool = False, measures: dict[str, Column] | None = None) -> DataFrame:
    """One row for each value of key: provinces, their ids in order, disputed ones and the sums of measures; blanks form the
    unassigned group, if asked for."""
    value = cleaned(key)
    rows = rows.withColumn("_key", value)
    if not unassigned:
        rows = rows.where("_key is not null")
    sums = [F.sum(c).alias(n) for n, c in (measures or {}).items()]
    return rows.groupBy("_key").agg(F.countDistinct("province_id").alias("province_count"), F.array_sort(F.collect_set("province_id")).alias("province_ids"), F.count_if(F.coalesce("disputed", F.lit(False))).alias("disputed_count"), *sums).withColumnRenamed("_key", key)


def country_catalog(ownership: DataFrame, names: DataFrame) -> DataFrame:
    """Distinct tags in any role, with the declared display name (names: tag, display_name) or the tag itself."""
    every = ownership.select(F.explode(F.array_distinct(F.concat(F.array("owner", "controller"), "cores", "claims"))).alias("tag")).distinct()
    return every.join(names, "tag", "left").select("tag", F.coalesce(cleaned("display_name"), "tag").alias("display_name"))


def _normal(table: DataFrame) -> DataFrame:
    """Last row of each province (by seq, where it has one), blanks null, lists sorted."""
    if "seq" in table.columns:
        last = Window.partitionBy("province_id").orderBy(F.desc("seq"))
        table = table.withColumn("_n", F.row_number().over(last)).where("_n = 1")
    fields = [cleaned(f).alias(f) for f in ("owner", "controller", "culture", "religion", "assignment_source")]
    lists = [F.array_sort(F.coalesce(tags(F.col(f)), F.array().cast("array<string>"))).alias(f) for f in ("cores", "claims")]
    return table.select("province_id", *fields, F.coalesce("disputed", F.lit(False)).alias("disputed"), *lists)


COMPARED = ("owner", "controller", "culture", "religion", "assignment_source", "disputed", "cores", "claims")


def compare(base: DataFrame, target: DataFrame) -> DataFrame:
    """Changed provinces: change_type (modified, added, removed), the fields that differ, both owners, and contested."""
    left, right = _normal(base), _normal(target)
    for f in COMPARED:
        left, right = left.withColumnRenamed(f, f"base_{f}"), right.withColumnRenamed(f, f"target_{f}")
    both = left.withColumn("_l", F.lit(1)).join(right.withColumn("_r", F.lit(1)), "province_id", "full_outer")
    fields = F.filter(F.array(*[F.when(~F.col(f"base_{f}").eqNullSafe(F.col(f"target_{f}")), F.lit(f)) for f in COMPARED]), lambda f: f.isNotNull())
    kind = F.when(F.col("_l").isNull(), "added").when(F.col("_r").isNull(), "removed").otherwise("modified")
    rows = both.select("province_id", kind.alias("change_type"), F.when(kind == "modified", fields).otherwise(F.array().cast("array<string>")).alias("fields"), "base_owner", "target_owner", "base_disputed", "target_disputed")
    contested = F.when(F.col("change_type") == "modified", F.col("base_disputed") | F.col("target_disputed") | F.array_contains("fields", "claims")).when(F.col("change_type") == "added", F.col("target_disputed")).otherwise(False)
    return rows.where("change_type <> 'modified' or size(fields) > 0").withColumn("contested", contested).drop("base_disputed", "target_disputed")


def owner_delta(base: DataFrame, target: DataFrame) -> DataFrame:
    """Owners whose province counts differ between two tables."""
    count = lambda t, n: t.select(cleaned("owner").alias("tag")).where("tag is not null").groupBy("tag").agg(F.count("*").alias(n))
    rows = count(base, "base").join(count(target, "target"), "tag", "full_outer").select("tag", F.coalesce("base", F.lit(0)).alias("base"), F.coalesce("target", F.lit(0)).alias("target"))
    return rows.where("base <> target").withColumn("delta", F.col("target") - F.col("base"))


def upsert(table: DataFrame, patch: DataFrame, key: str) -> DataFrame:
    """table with the rows of patch in place of those of equal key."""
    return table.join(patch.select(key), key, "left_anti").unionByName(patch)


def apply_era(scaffold: DataFrame, overrides: DataFrame) -> DataFrame:
    """Scaffold provinces under era overrides: identity renames, replace swaps, split gives one row for each child.

    scaffold: province_id, population, area. overrides: scaffold_id, operation, era_id, children array<struct<id, population,
    area>>. A child without a population or area gets an even part of its scaffold's.
    """
    rows = scaffold.join(overrides, F.col("province_id") == F.col("scaffold_id"), "left")
    n = F.size("children")
    kept = F.array(F.struct(F.coalesce("era_id", "province_id").alias("id"), F.col("population"), F.col("area")))
    split = F.transform("children", lambda c: F.struct(c["id"].alias("id"), F.coalesce(c.population, F.col("population") / n).alias("population"), F.coalesce(c.area, F.col("area") / n).alias("area")))
    rows = rows.withColumn("_out", F.when(F.col("operation") == "split", split).otherwise(kept))
    return rows.select(F.col("province_id").alias("scaffold_id"), F.coalesce("operation", F.lit("scaffold")).alias("operation"), F.explode("_out").alias("o")).select("scaffold_id", "operation", F.col("o.id").alias("era_id"), "o.population", "o.area")
