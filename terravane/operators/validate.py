"""Validation of documents that hold rows: canonical statuses, assignments, assertions, evidence, migrations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terravane.operators.quality import finding, gathered

# The relations of a status.
RELATIONS = ["sovereign", "owner", "controller", "core", "claim", "dispute", "protector", "co-administrator", "occupier", "mandate-authority", "lessee", "claimant"]


def statuses(components: DataFrame, units: DataFrame, provinces: DataFrame, rows: DataFrame) -> DataFrame:
    """Findings on a status document: components of no or several provinces or units, unknown references, relations and ranges."""
    text = lambda s: F.lit(s)
    ids = components.select(F.col("territory_component_id").alias("id"))
    parts = []
    for holder, key in ((provinces, "province_id"), (units, "political_unit_id")):
        held = holder.select(F.col(key).alias("holder"), F.explode("territory_component_ids").alias("id"))
        n = held.groupBy("id").agg(F.countDistinct("holder").alias("n"))
        parts += [
            finding(n.where("n > 1"), "COMPONENT_IN_SEVERAL", "error", F.array("id"), text(f"Component in several by {key}."), holders=F.col("n")),
            finding(ids.join(held, "id", "left_anti"), "COMPONENT_IN_NONE", "error", F.array("id"), text(f"Component in none by {key}.")),
            finding(held.join(ids, "id", "left_anti"), "UNKNOWN_COMPONENT", "error", F.array("holder", "id"), text(f"Unknown component by {key}.")),
        ]
    subjects = ids.union(provinces.select("province_id")).union(units.select("political_unit_id"))
    actors = units.select(F.col("political_unit_id").alias("actor_political_unit_id"))
    parts += [
        finding(rows.join(subjects.select(F.col("id").alias("subject_id")), "subject_id", "left_anti"), "UNKNOWN_SUBJECT", "error", F.array("subject_id"), text("Unknown subject.")),
        finding(rows.join(actors, "actor_political_unit_id", "left_anti"), "UNKNOWN_ACTOR", "error", F.array("subject_id"), text("Unknown actor.")),
        finding(rows.where(~F.coalesce(F.col("relationship").isin(RELATIONS), F.lit(False))), "UNKNOWN_RELATION", "error", F.array("subject_id"), text("Unknown relation.")),
        finding(rows.where("valid_from > valid_to"), "EMPTY_RANGE", "error", F.array("subject_id"), text("The range ends before it starts.")),
        finding(rows.where(F.coalesce(F.size("evidence_ids"), F.lit(0)) <= 0), "NO_EVIDENCE", "error", F.array("subject_id"), text("No evidence.")),
    ]
    return gathered(*parts)


def exactly_once(assigned: DataFrame, wanted: DataFrame) -> DataFrame:
    """(id, fault): ids assigned more than once, assigned but not wanted, and wanted but not assigned."""
    n = assigned.groupBy("id").agg(F.count("*").alias("n"))
    return n.where("n > 1").select("id", F.lit("repeated").alias("fault")).union(n.join(wanted, "id", "left_anti").select("id", F.lit("extra"))).union(wanted.select("id").distinct().join(n, "id", "left_anti").select("id", F.lit("missing")))


def assertions(rows: DataFrame, contract: DataFrame) -> DataFrame:
    """(assertion, fault): rows (assertion, relation, kind, expectation, subjects, boundaries, unit, tolerance) that break the contract of
    their relation (relation, kind, expectation, n_subjects, n_boundaries, unit)."""
    asked = contract.select(*[F.col(c).alias(f"c_{c}") for c in contract.columns])
    both = rows.join(asked, F.col("relation") == F.col("c_relation"), "left")
    size = lambda c: F.coalesce(F.size(c), F.lit(0))
    faults = F.array(
        F.when(F.col("c_relation").isNull(), "relation"),
        F.when(F.col("kind") != F.col("c_kind"), "kind"),
        F.when(F.col("expectation") != F.col("c_expectation"), "expectation"),
        F.when(size("subjects") != F.col("c_n_subjects"), "subjects"),
        F.when(size("boundaries") != F.col("c_n_boundaries"), "boundaries"),
        F.when(F.col("unit") != F.col("c_unit"), "unit"),
        F.when(~F.coalesce(F.col("tolerance") > 0, F.lit(False)), "tolerance"),
    )
    return both.select("assertion", F.explode(F.filter(faults, lambda f: f.isNotNull())).alias("fault"))


def migrated(ids: DataFrame, migrations: DataFrame) -> DataFrame:
    """(id, target): ids under migrations (old, new), one step; an id without one stays."""
    return ids.join(migrations.select(F.col("old").alias("id"), "new"), "id", "left").select("id", F.coalesce("new", "id").alias("target"))


def georeferenced(rows: DataFrame) -> DataFrame:
    """(boundary, fault): fewer than three control points, or a reviewer who is the digitizer. rows: boundary, control_points, digitizer,
    reviewer."""
    faults = F.array(F.when(F.coalesce(F.size("control_points"), F.lit(0)) < 3, "control_points"), F.when(F.col("digitizer").eqNullSafe(F.col("reviewer")), "reviewer"))
    return rows.select("boundary", F.explode(F.filter(faults, lambda f: f.isNotNull())).alias("fault"))


def split_requests(lineage: DataFrame, assigned: DataFrame, requests: DataFrame) -> DataFrame:
    """(request, parents, children): requests whose lineage children are assigned, with those. lineage: parent, children; requests:
    request, parent."""
    rows = lineage.select("parent", F.explode("children").alias("id")).join(assigned.select("id").distinct(), "id", "left_semi").join(requests, "parent")
    return rows.groupBy("request").agg(F.array_sort(F.collect_set("parent")).alias("parents"), F.array_sort(F.collect_set("id")).alias("children"))
