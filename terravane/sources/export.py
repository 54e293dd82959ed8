"""Packs of files: a game pack, an atlas of scenarios, and the manifest of checksums over them."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terravane.operators import hierarchy, ownership, release, tiles
from terravane.sources import tables, vectors


def manifest(spark: SparkSession, folder: str) -> DataFrame:
    """(path, bytes, sha256) of every file under a folder; paths are relative to it."""
    rows = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder)
    root = Path(folder).resolve().as_posix() + "/"
    return rows.select(F.substring_index("path", root, -1).alias("path"), F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256"))


def game_pack(folder: str, provinces: DataFrame, edges: DataFrame, countries: DataFrame) -> dict:
    """Definitions, adjacency, names, attribution and geometry of provinces (province_id, kind, country, region, display_name,
    lineage, licenses, ring), of edges (a, b, kind, km) and of countries (tag, display_name). Returns the counts."""
    root = Path(folder)
    root.mkdir(parents=True, exist_ok=True)
    regions = hierarchy.dissolve_regions(provinces)
    names = release.localization(provinces, regions, countries)
    notices = release.attribution(provinces.select("licenses", F.col("lineage").alias("sources")))
    found = {
        "provinces": tables.write_csv(provinces.drop("ring"), str(root / "provinces.csv"), ["province_id"]),
        "regions": tables.write_csv(regions, str(root / "regions.csv"), ["region_key"]),
        "adjacency": tables.write_csv(edges, str(root / "adjacency.csv"), ["kind", "a", "b"]),
        "names": tables.write_csv(names, str(root / "localization.csv"), ["key"]),
        "attribution": tables.write_csv(notices, str(root / "attribution.csv"), ["source_id", "license"]),
        "features": vectors.to_geojson(provinces.drop("lineage", "licenses"), str(root / "provinces.geojson"), "province_id"),
    }
    with open(root / "localization.yml", "w", encoding="utf-8", newline="\n") as out:
        out.write("l_english:\n")
        for row in names.orderBy("key").toLocalIterator(prefetchPartitions=True):
            value = row.value.replace("\\", "\\\\").replace('"', '\\"')
            out.write(f' {row.key}: "{value}"\n')
    tables.write_json({"counts": found}, str(root / "pack.json"))
    return found


def atlas(folder: str, provinces: DataFrame, scenarios: dict[str, DataFrame], with_tiles: tuple[int, int] | None = None) -> dict:
    """For each scenario (rules) its choropleth, uncertain provinces, owners, cultures, legend and ownership table; tiles if zooms are
    given. provinces: as for game_pack."""
    out = {}
    for name in sorted(scenarios):
        root = Path(folder) / name
        root.mkdir(parents=True, exist_ok=True)
        owned = ownership.resolve(provinces, scenarios[name])
        colored = ownership.choropleth(provinces, owned)
        shapes = colored.join(provinces.select("province_id", "ring"), "province_id")
        out[name] = {
            "choropleth": vectors.to_geojson(shapes, str(root / "choropleth.geojson"), "province_id"),
            "uncertain": tables.write_csv(colored.where("uncertain").select("province_id", "owner", "controller"), str(root / "uncertain.csv"), ["province_id"]),
            "owners": tables.write_csv(ownership.dissolve(owned, "owner"), str(root / "owners.csv"), ["owner"]),
            "cultures": tables.write_csv(ownership.dissolve(owned, "culture", unassigned=True), str(root / "cultures.csv"), ["culture"]),
            "religions": tables.write_csv(ownership.dissolve(owned, "religion", unassigned=True), str(root / "religions.csv"), ["religion"]),
            "legend": tables.write_csv(ownership.legend(owned), str(root / "legend.csv"), ["tag"]),
            "ownership": tables.write_csv(owned, str(root / "ownership.csv"), ["province_id"]),
        }
        if with_tiles:
            encoded = tiles.encode_tiles(shapes.withColumnRenamed("province_id", "id"), with_tiles, "provinces", ["owner", "owner_color"])
            out[name]["tiles"] = tiles.write_archive(encoded, str(root / "tiles.pmtiles"), with_tiles, (-180.0, -85.0, 180.0, 85.0), {"name": name})
    return out
