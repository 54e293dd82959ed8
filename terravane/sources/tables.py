"""Tables of rules, ownership, edges and statuses: CSV and JSON in, deterministic CSV and JSON out."""

from __future__ import annotations

import csv
import json
import os
import tomllib
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terravane.operators.ownership import RULE_SCHEMA

EDGES = "from_province_id string, to_province_id string, adjacency_type string, bidirectional string, crossing_type string, shared_border_km string, source_lineage string"
OWNERSHIP = "province_id string, scenario_id string, start_date string, end_date string, owner string, controller string, cores string, claims string, culture string, religion string, disputed string, assignment_source string, parent_country_id string, parent_region_id string, display_name string, notes string"


def read_edges(spark: SparkSession, path: str) -> DataFrame:
    """Recorded adjacency rows as texts; a row that doesn't fit raises, and so does another header."""
    return spark.read.schema(EDGES).options(header=True, enforceSchema=False, mode="FAILFAST", quote='"', escape='"').csv(path)


def list_cell(value) -> F.Column:
    """A list in a cell: JSON, or else text between commas; blanks are dropped."""
    listed = F.coalesce(F.from_json(value, "array<string>"), F.split(value, ","))
    return F.filter(F.transform(F.coalesce(listed, F.array().cast("array<string>")), lambda x: F.trim(x)), lambda x: x != "")


def read_ownership(spark: SparkSession, path: str) -> DataFrame:
    """An ownership table, from CSV or from JSON (an array of rows)."""
    if path.endswith(".json"):
        kinds = OWNERSHIP.replace("cores string", "cores array<string>").replace("claims string", "claims array<string>").replace("disputed string", "disputed boolean")
        return spark.read.schema(kinds).option("multiLine", True).json(path)
    rows = spark.read.schema(OWNERSHIP).options(header=True, enforceSchema=False, mode="FAILFAST", quote='"', escape='"').csv(path)
    return rows.withColumns({"cores": list_cell(F.col("cores")), "claims": list_cell(F.col("claims")), "disputed": F.lower(F.trim("disputed")).isin("1", "true", "yes")})


def write_csv(df: DataFrame, path: str, order: list[str]) -> int:
    """One CSV file on the driver's disk: the columns as they are, rows in a total order, LF, lists as JSON, true and false in lower
    case, put in place at once. Rows come one partition at a time."""
    kinds = dict(df.dtypes)
    cells = [F.to_json(c).alias(c) if kinds[c].startswith("array") else F.col(c).cast("string").alias(c) for c in df.columns]
    temporary, n = f"{path}.{uuid.uuid4().hex}", 0
    with open(temporary, "w", encoding="utf-8", newline="") as out:
        writer = csv.writer(out, lineterminator="\n")
        writer.writerow(df.columns)
        for row in df.orderBy(*order).select(*cells).toLocalIterator(prefetchPartitions=True):
            writer.writerow(["" if v is None else v for v in row])
            n += 1
    os.replace(temporary, path)
    return n


def write_json(document: dict, path: str) -> None:
    """A small document, keys in order, put in place at once."""
    temporary = f"{path}.{uuid.uuid4().hex}"
    Path(temporary).write_text(json.dumps(document, indent=2, sort_keys=True, ensure_ascii=False) + "\n", encoding="utf-8")
    os.replace(temporary, path)


def read_profile(path: str) -> dict:
    """A TOML profile; the values of its preset lie under its own."""
    with open(path, "rb") as f:
        document = tomllib.load(f)

    def over(base: dict, more: dict) -> dict:
        return base | {k: over(base[k], v) if isinstance(v, dict) and isinstance(base.get(k), dict) else v for k, v in more.items()}

    preset = document.get("presets", {}).get(document.get("preset", ""), {})
    return over(preset, {k: v for k, v in document.items() if k not in ("presets", "preset")})


def read_scenario(spark: SparkSession, path: str) -> tuple[dict, DataFrame]:
    """A scenario document and its rules as the table that ownership.resolve takes."""
    document = json.loads(Path(path).read_text(encoding="utf-8"))
    rows = []
    for level, key, match in (("country", "country_rules", "match_parent_country_id"), ("region", "region_rules", "match_parent_region_id"), ("province", "province_overrides", "province_id")):
        for seq, rule in enumerate(document.get(key) or [], 1):
            if not str(rule.get(match) or "").strip():
                raise ValueError(f"{key}: a rule has no {match}")
            rows.append((level, str(rule[match]).strip(), seq, rule.get("owner"), rule.get("controller"), rule.get("cores"), rule.get("claims"), "culture" in rule, rule.get("culture"), "religion" in rule, rule.get("religion"), rule.get("disputed"), rule.get("notes")))
    return document, spark.createDataFrame(rows, RULE_SCHEMA)


def read_statuses(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """The four tables of a status document: components, political_units, provinces, statuses."""
    schemas = {
        "components": "territory_component_id string, political_unit_id string, province_id string, historically_required boolean",
        "political_units": "political_unit_id string, territory_component_ids array<string>, documented_status string",
        "provinces": "province_id string, territory_component_ids array<string>",
        "statuses": "subject_id string, relationship string, actor_political_unit_id string, valid_from string, valid_to string, evidence_ids array<string>",
    }
    whole = spark.read.schema(", ".join(f"{n} array<struct<{s.replace(' ', ':').replace(',:', ',')}>>" for n, s in schemas.items())).option("multiLine", True).json(path)
    return {n: whole.select(F.explode(n).alias("r")).select("r.*") for n in schemas}


def pack_rows(df: DataFrame, source: str, value: str = "value") -> DataFrame:
    """A raster as (row, col, x, y, value) cells with a positive value: the point surface that zonal sums take."""
    return df.where(F.col(value) > 0).select(F.lit(source).alias("source"), F.col("x").cast("double").alias("x"), F.col("y").cast("double").alias("y"), F.col(value).cast("double").alias("weight"))
