"""Queries of the hierarchy, of samples and of releases; they join those of registry."""

from __future__ import annotations

from pyspark.sql import functions as F

from terravane.functions import geo, text
from terravane.operators import hierarchy, measure, quality, release
from terravane.operators.ownership import land
from terravane.plans.registry import APART, apart, grid, owned, query
from terravane.plans.views import view


@query("SELECT province_id, country FROM {provinces} WHERE coalesce(kind, 'land') = 'land' AND country IN ('NATION_1', 'NATION_7')")
def country_sample(spark, sf_dir):
    """land of some countries, in any case of letters."""
    return release.sample(view(spark, sf_dir, "provinces"), ["nation_1", "Nation_7"]).select("province_id", "country")


KEPT = "SELECT province_id FROM {provinces} WHERE coalesce(kind, 'land') = 'land' AND n % 2 = 0"
SEAS = "SELECT province_id, CASE n % 3 WHEN 0 THEN 'coastal' WHEN 1 THEN 'ocean' ELSE CAST(NULL AS STRING) END AS sea_class, concat('p', lpad(CAST(n + 1 AS STRING), 7, '0')) AS parent FROM {provinces} WHERE kind = 'sea'"


@query(f"SELECT province_id FROM ({SEAS}) WHERE coalesce(sea_class, 'coastal') = 'coastal' AND parent IN ({KEPT})")
def sea_sample(spark, sf_dir):
    """seas of kept land."""
    return release.sample_seas(view(spark, sf_dir, SEAS), view(spark, sf_dir, KEPT)).select("province_id")


@query(f"SELECT a, b FROM {{edges}} WHERE a IN ({KEPT}) AND b IN ({KEPT})")
def edge_sample(spark, sf_dir):
    """edges with both ends kept."""
    return release.sample_edges(view(spark, sf_dir, "edges"), view(spark, sf_dir, KEPT)).select("a", "b")


@query("SELECT id FROM {boxes} JOIN {provinces} ON id = province_id WHERE country = 'NATION_3' OR (x2 >= -95 AND x1 <= -90 AND y2 >= -60 AND y1 <= -59)")
def priority_rows(spark, sf_dir):
    """F8: rows of a country or near a box."""
    rows = view(spark, sf_dir, "boxes").join(view(spark, sf_dir, "provinces").select(F.col("province_id").alias("id"), "country"), "id")
    return rows.where(release.in_priority(F.col("country"), ["nation_3"], (-95.0, -60.0, -90.0, -59.0))).select("id")


@query("SELECT c_custkey, c_acctbal < 50 OR (c_acctbal < 1000 AND c_custkey % 100 < 30) AS tiny FROM {customer}")
def tiny_cells(spark, sf_dir):
    """cells too small in area, or in area and people."""
    area, people = F.col("c_acctbal"), F.col("c_custkey") % 100
    return view(spark, sf_dir, "customer").select("c_custkey", release.tiny(area, people, 1000, 30).alias("tiny"))


@query("SELECT s_suppkey, CASE s_suppkey % 5 WHEN 0 THEN ' Pending-7 ' WHEN 1 THEN 'TODO' WHEN 2 THEN 'unknown' WHEN 3 THEN s_name ELSE 'pendings' END AS name, s_suppkey % 5 < 3 AS placeholder FROM {supplier}")
def placeholder_ids(spark, sf_dir):
    """identifiers that stand for none."""
    k = F.col("s_suppkey") % 5
    name = F.when(k == 0, " Pending-7 ").when(k == 1, "TODO").when(k == 2, "unknown").when(k == 3, F.col("s_name")).otherwise("pendings")
    return view(spark, sf_dir, "supplier").select("s_suppkey", name.alias("name")).withColumn("placeholder", text.placeholder(F.col("name")))


@query("SELECT n_name AS country, s_name AS name FROM {supplier} JOIN {nation} ON s_nationkey = n_nationkey UNION ALL SELECT n_name, n_name FROM {nation} WHERE n_nationkey NOT IN (SELECT s_nationkey FROM {supplier})")
def fallback_rows(spark, sf_dir):
    """First-level rows, and whole countries without any."""
    nation = view(spark, sf_dir, "nation").withColumnRenamed("n_nationkey", "s_nationkey")
    fine = view(spark, sf_dir, "supplier").join(nation, "s_nationkey").select(F.col("n_name").alias("country"), F.col("s_name").alias("name"))
    return release.with_fallback(fine, nation.select(F.col("n_name").alias("country"), F.col("n_name").alias("name")), "country")


@query("SELECT 'province.' || province_id AS key, display_name AS value FROM {provinces} UNION ALL SELECT DISTINCT 'region.' || region, region FROM {provinces} UNION ALL SELECT 'country.' || n_name, CASE WHEN n_nationkey % 2 = 0 THEN n_name ELSE lower(n_name) END FROM {nation}")
def localization_keys(spark, sf_dir):
    """names under keys."""
    provinces = view(spark, sf_dir, "provinces")
    countries = view(spark, sf_dir, "nation").select(F.col("n_name").alias("tag"), F.when(F.col("n_nationkey") % 2 == 0, " ").otherwise(F.lower("n_name")).alias("display_name"))
    return release.localization(provinces, provinces.select(F.col("region").alias("region_key")).distinct(), countries)


@query("SELECT CASE WHEN n % 5 = 0 THEN CASE WHEN country IS NULL THEN 'orphan:' || province_id ELSE 'country:' || country END ELSE region END AS region_key, count(*) AS province_count, array_to_string(list_sort(list(province_id)), ',') AS ids, coalesce(array_to_string(list_sort(list(DISTINCT 'src' || CAST(n % 4 AS STRING))), ','), '') AS lineage FROM {provinces} GROUP BY 1")
def region_dissolve(spark, sf_dir):
    """Regions by region, country or alone, with their lineage."""
    provinces = view(spark, sf_dir, "provinces").withColumn("region", F.when(F.col("n") % 5 != 0, F.col("region"))).withColumn("lineage", F.array(F.concat(F.lit("src"), F.col("n") % 4)))
    return hierarchy.dissolve_regions(provinces).select("region_key", "province_count", F.array_join("province_ids", ",").alias("ids"), F.array_join("lineage", ",").alias("lineage"))


AREAS = """SELECT concat('a', lpad(CAST(c_custkey AS STRING), 7, '0')) AS area, CASE WHEN c_custkey % 37 = 0 THEN concat('M', CAST(c_custkey AS STRING)) ELSE n_name END AS country, r_name AS continent,
CASE WHEN c_custkey % 2 = 0 THEN '' ELSE 'sub' END AS subregion, CASE WHEN c_custkey % 37 = 0 THEN c_name ELSE n_name END AS country_name,
CASE WHEN n_nationkey % 3 = 0 AND c_custkey % 4 <> 0 THEN c_mktsegment END AS attr, CAST(2 AS BIGINT) AS votes, CAST(CASE WHEN n_nationkey % 3 = 0 AND c_custkey % 4 <> 0 THEN 2 ELSE 0 END AS BIGINT) AS known,
CAST(c_custkey AS DOUBLE) AS km2 FROM {customer} JOIN {nation} ON c_nationkey = n_nationkey JOIN {region} ON n_regionkey = r_regionkey WHERE n_nationkey % 5 <> 4 OR c_custkey % 3 = 0"""


@query(f"""WITH s AS (SELECT *, count(*) OVER w AS n, sum(km2) OVER w AS k, sum(known) OVER w >= 0.5 * sum(votes) OVER w AS ok, min(attr) OVER w AS lo, max(attr) OVER w AS hi, row_number() OVER (PARTITION BY country ORDER BY area) - 1 AS i FROM ({AREAS}) WINDOW w AS (PARTITION BY country)),
c AS (SELECT *, least(i // 8, (n - 1) // 8 - CASE WHEN n % 8 > 0 AND n % 8 < 4 THEN 1 ELSE 0 END) AS ch FROM s), f AS (SELECT *, min(area) OVER (PARTITION BY country, ch) AS first, max(ch) OVER (PARTITION BY country) + 1 AS chunks, n >= 12 AND k >= 5000 AS mega FROM c),
g AS (SELECT *, CASE WHEN n < 2 THEN 'subregion' WHEN mega AND ok AND coalesce(lo <> hi, false) THEN 'attr' WHEN mega AND n >= 16 AND chunks >= 2 THEN 'chunk' ELSE 'country' END AS kind, coalesce(nullif(subregion, ''), country_name) AS bucket FROM f)
SELECT area, kind, CASE kind WHEN 'subregion' THEN continent || '|' || bucket WHEN 'attr' THEN country || '|' || coalesce(attr, lo) WHEN 'chunk' THEN country || '|' || first ELSE country END AS key,
CASE kind WHEN 'subregion' THEN bucket WHEN 'attr' THEN country_name || ': ' || coalesce(attr, lo) WHEN 'chunk' THEN country_name || ': ' || first ELSE country_name END AS name, CASE WHEN kind <> 'subregion' THEN country END AS country, continent FROM g""")
def region_entities(spark, sf_dir):
    """Micro states joined, large countries split."""
    return hierarchy.regions(view(spark, sf_dir, AREAS), 12, 5000.0, 8)


@query(f"SELECT continent, count(*) AS members, round(sum(km2), 3) AS km2 FROM ({AREAS}) GROUP BY continent")
def superregions(spark, sf_dir):
    """Superregions by continent."""
    members = view(spark, sf_dir, AREAS).select("continent", F.col("area").alias("member"), F.array("area").alias("province_ids"), "km2")
    return hierarchy.entities(members, ["continent"], "sr").select("continent", F.size("members").cast("long").alias("members"), "km2")


@query("SELECT province_id, country AS parent_area, region AS parent_region, CASE WHEN region IS NOT NULL AND country IS NOT NULL THEN substr(region, 1, 2) END AS parent_superregion FROM (SELECT province_id, country, CASE WHEN country IS NOT NULL THEN region END AS region FROM {provinces})")
def parent_fields(spark, sf_dir):
    """Parents of provinces."""
    provinces = view(spark, sf_dir, "provinces")
    area_of = provinces.where("country is not null").select("province_id", F.col("country").alias("area"))
    region_of = provinces.where("country is not null").groupBy(F.col("country").alias("area")).agg(F.min("region").alias("region"))
    above = provinces.select("region").distinct().withColumn("superregion", F.substring("region", 1, 2))
    return hierarchy.with_parents(provinces.select("province_id"), area_of, region_of, above).select("province_id", "parent_area", "parent_region", "parent_superregion")


@query("""WITH RECURSIVE c(cell, x1, y1, s, r) AS (SELECT CAST(i AS STRING), i * 180.0E0 - 180, -90.0E0, 180.0E0, 0 FROM (SELECT unnest([0, 1]) AS i) UNION ALL SELECT cell || CAST(k AS STRING), x1 + (k % 2) * s / 2, y1 + (k // 2) * s / 2, s / 2, r + 1 FROM c, (SELECT unnest([0, 1, 2, 3]) AS k) WHERE r < 4)
SELECT cell, x1, y1, x1 + s AS x2, y1 + s AS y2 FROM c WHERE r = 4""")
def grid_cells(spark, sf_dir):
    """All cells of a resolution."""
    return hierarchy.cells(spark, 4)


DIGITS = " || ".join(f"CAST(2 * ((j >> {k}) & 1) + ((i >> {k}) & 1) AS STRING)" for k in range(5, -1, -1))


@query(f"""WITH p AS (SELECT least(CAST(floor((x + 180) / 2.8125E0) AS BIGINT), 127) AS i, least(CAST(floor((y + 90) / 2.8125E0) AS BIGINT), 63) AS j, CAST(greatest(weight, 0) AS DECIMAL(18, 6)) AS w FROM {{points}}),
leaf AS (SELECT CAST(i // 64 AS STRING) || {DIGITS} AS c, w FROM p), every AS (SELECT substr(c, 1, n) AS cell, sum(w) AS weight FROM leaf, (SELECT unnest([3, 4, 5, 6, 7]) AS n) GROUP BY 1),
kids AS (SELECT substr(cell, 1, length(cell) - 1) AS cell, count(*) AS n FROM every WHERE length(cell) > 3 GROUP BY 1),
live AS (SELECT cell, (SELECT count(*) FROM every WHERE length(cell) = 3) + coalesce(sum(n - 1) OVER (ORDER BY weight DESC, cell ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS n FROM every JOIN kids USING (cell)),
opened AS (SELECT cell FROM live WHERE n < 24)
SELECT cell, CAST(weight AS DOUBLE) AS weight FROM every WHERE (length(cell) = 3 OR substr(cell, 1, length(cell) - 1) IN (SELECT cell FROM opened)) AND cell NOT IN (SELECT cell FROM opened)""")
def refined_cells(spark, sf_dir):
    """The heaviest cells split until the target."""
    points = view(spark, sf_dir, "points").select("x", "y", F.greatest("weight", F.lit(0.0)).alias("weight"))
    return hierarchy.refine_cells(points, 2, 6, 24)


@query("SELECT DISTINCT CASE p_partkey % 4 WHEN 0 THEN 'natural_earth' WHEN 1 THEN 'worldpop' WHEN 2 THEN lower(p_brand) ELSE 'derived' END AS source_id, CASE p_partkey % 4 WHEN 0 THEN 'Natural Earth terms' WHEN 1 THEN 'WorldPop CC BY' ELSE 'own terms' END AS license FROM {part}")
def attribution_records(spark, sf_dir):
    """Sources and licences."""
    k = F.col("p_partkey") % 4
    licenses = F.array(F.when(k == 0, "Natural Earth terms").when(k == 1, "WorldPop CC BY").otherwise("own terms"))
    sources = F.when(k == 2, F.array(F.lit(""), F.concat(F.lower("p_brand"), F.lit(":x")))).otherwise(F.array().cast("array<string>"))
    return release.attribution(view(spark, sf_dir, "part").select(licenses.alias("licenses"), sources.alias("sources")))


@query("SELECT node, string_agg(id, ',' ORDER BY weight DESC, id) AS neighbours FROM (SELECT a AS node, b AS id, weight FROM {edges} UNION ALL SELECT b, a, weight FROM {edges}) GROUP BY node")
def adjacency_index(spark, sf_dir):
    """Neighbours, longest border first."""
    return release.adjacency_index(view(spark, sf_dir, "edges").withColumnRenamed("weight", "km")).select("node", F.array_join("neighbours", ",").alias("neighbours"))


@query("SELECT a, b, s.x1 AS ax, s.y1 AS ay, t.x1 AS bx, t.y1 AS by FROM {edges} JOIN {boxes} s ON a = s.id JOIN {boxes} t ON b = t.id WHERE weight >= 3")
def adjacency_lines(spark, sf_dir):
    """Edges as lines between points."""
    edges = view(spark, sf_dir, "edges").withColumn("kind", F.when(F.col("weight") >= 5, "land").when(F.col("weight") >= 3, "strait").otherwise("port_to_sea"))
    points = view(spark, sf_dir, "boxes").select(F.col("id").alias("province_id"), F.col("x1").alias("x"), F.col("y1").alias("y"))
    rows = release.adjacency_lines(edges, points)
    return rows.select("a", "b", *[F.col("line")[i][c].alias(f"{p}{c}") for i, p in enumerate("ab") for c in "xy"])


@query("""WITH p AS (SELECT province_id, concat('c', CAST(n AS STRING)) AS component, region AS unit FROM {provinces}), s AS (SELECT concat('c', CAST(c_custkey AS STRING)) AS subject, c_mktsegment AS actor FROM {customer} WHERE c_custkey % 3 = 0 UNION ALL SELECT province_id, country FROM {provinces} WHERE n % 5 = 0 AND country IS NOT NULL UNION ALL SELECT r_name, 'UNIT' FROM {region} WHERE r_regionkey < 3), a AS (SELECT subject, min(actor) AS actor FROM s GROUP BY subject)
SELECT province_id, coalesce(x.actor, y.actor, z.actor) AS owner, CASE WHEN x.actor IS NOT NULL THEN 'component' WHEN y.actor IS NOT NULL THEN 'province' WHEN z.actor IS NOT NULL THEN 'unit' END AS level FROM p LEFT JOIN a x ON x.subject = component LEFT JOIN a y ON y.subject = province_id LEFT JOIN a z ON z.subject = unit""")
def certified_owner(spark, sf_dir):
    """Owners by component, province or unit."""
    provinces, customer = view(spark, sf_dir, "provinces"), view(spark, sf_dir, "customer")
    statuses = customer.where("c_custkey % 3 = 0").select(F.concat(F.lit("c"), "c_custkey").alias("subject"), F.col("c_mktsegment").alias("actor"))
    statuses = statuses.union(provinces.where("n % 5 = 0 and country is not null").select("province_id", "country")).union(view(spark, sf_dir, "region").where("r_regionkey < 3").select("r_name", F.lit("UNIT")))
    return release.certified_owner(provinces.select("province_id", F.concat(F.lit("c"), "n").alias("component"), F.col("region").alias("unit")), statuses)


@query("SELECT province_id, array_to_string(list_sort(list(DISTINCT code)), ',') AS codes FROM (SELECT a AS province_id, CASE WHEN weight > 4 THEN 'LONG' ELSE 'SHORT' END AS code FROM {edges} UNION ALL SELECT b, CASE WHEN weight > 4 THEN 'LONG' ELSE 'SHORT' END FROM {edges}) JOIN {provinces} USING (province_id) WHERE n % 2 = 1 GROUP BY province_id")
def findings_index(spark, sf_dir):
    """Findings by province."""
    found = view(spark, sf_dir, "edges").select(F.when(F.col("weight") > 4, "LONG").otherwise("SHORT").alias("code"), F.array("a", "b").alias("affected"))
    return release.findings_index(found, view(spark, sf_dir, "provinces").where("n % 2 = 1")).select("province_id", F.array_join("codes", ",").alias("codes"))


@query(f"""WITH q AS ({APART}), d AS (SELECT point_id, id, sqrt(pow(greatest(b.x1 - p.x, p.x - b.x2, 0), 2) + pow(greatest(b.y1 - p.y, p.y - b.y2, 0), 2)) AS gap FROM {{points}} p JOIN q b ON p.x BETWEEN b.x1 - 0.5 AND b.x2 + 0.5 AND p.y BETWEEN b.y1 - 0.5 AND b.y2 + 0.5)
SELECT point_id, id, round(gap, 9) AS gap FROM (SELECT *, row_number() OVER (PARTITION BY point_id ORDER BY round(gap, 12), id) AS r FROM d WHERE gap <= 0.5) WHERE r = 1""")
def located_points(spark, sf_dir):
    """Points against all boxes, made small."""
    rows = release.locate(view(spark, sf_dir, "points"), apart(spark, sf_dir), 1.0, 0.5)
    return rows.select("point_id", "id", F.round("gap", 9).alias("gap"))


@query("""SELECT province_id AS scaffold_id, CASE WHEN n % 3 = 0 THEN 'replace' WHEN n % 2 = 0 THEN 'identity' ELSE 'scaffold' END AS operation, CASE WHEN n % 3 = 0 THEN 'third_' ELSE CASE WHEN n % 2 = 0 THEN 'first_' ELSE 'third_' END END || province_id AS era_id FROM {provinces}""")
def composed_eras(spark, sf_dir):
    """Packs laid over one another."""
    rows = view(spark, sf_dir, "provinces")
    layer = lambda name, hard, op: rows.select(F.col("province_id").alias("scaffold_id"), F.when(hard, op).otherwise("scaffold").alias("operation"), F.concat(F.lit(f"{name}_"), "province_id").alias("era_id"))
    none = F.lit(False)
    return release.compose_eras([layer("first", F.col("n") % 2 == 0, "identity"), layer("second", none, "split"), layer("third", F.col("n") % 3 == 0, "replace")]).select("scaffold_id", "operation", "era_id")


@query("""WITH c AS (SELECT owner, count(*) AS n FROM {ownership} GROUP BY owner), e AS (SELECT n_name AS tag, CAST(n_nationkey AS BIGINT) AS least, CAST(CASE WHEN n_nationkey % 2 = 0 THEN 30 END AS BIGINT) AS most FROM {nation})
SELECT 'GOLDEN_OWNER_MISMATCH' AS code, p.province_id AS subject, 'OVR' AS expected, o.owner AS actual FROM {provinces} p LEFT JOIN {ownership} o USING (province_id) WHERE p.n % 10 = 0 AND o.owner IS DISTINCT FROM 'OVR'
UNION ALL SELECT 'GOLDEN_MIN_OWNER_COUNT', tag, CAST(least AS STRING), CAST(coalesce(n, 0) AS STRING) FROM e LEFT JOIN c ON owner = tag WHERE coalesce(n, 0) < least UNION ALL SELECT 'GOLDEN_MAX_OWNER_COUNT', tag, CAST(most AS STRING), CAST(coalesce(n, 0) AS STRING) FROM e LEFT JOIN c ON owner = tag WHERE coalesce(n, 0) > most""")
def golden_checks(spark, sf_dir):
    """A10: expectations of owners and counts."""
    owners = view(spark, sf_dir, "provinces").where("n % 10 = 0").select("province_id", F.lit("OVR").alias("expected"))
    counts = view(spark, sf_dir, "nation").select(F.col("n_name").alias("tag"), F.col("n_nationkey").cast("long").alias("least"), F.when(F.col("n_nationkey") % 2 == 0, 30).cast("long").alias("most"))
    return release.golden(owned(spark, sf_dir), owners, counts)


@query("SELECT l_partkey, count(DISTINCT l_suppkey) AS identities FROM {lineitem} GROUP BY 1 HAVING count(DISTINCT l_suppkey) > 1")
def identity_conflicts(spark, sf_dir):
    """Ids whose identity differs in any line."""
    return release.unique_identities(view(spark, sf_dir, "lineitem"), "l_partkey", ["l_suppkey"])


FRAMED = "SELECT id, x1, y1, x1 + 0.5E0 + n % 7 AS x2, y2 FROM {boxes}"
FRAME = """SELECT {name} AS name, CASE WHEN one THEN wx1 ELSE lx END AS x1, CASE WHEN one THEN wy1 ELSE ly END AS y1, CASE WHEN one THEN wx2 ELSE hx END AS x2, CASE WHEN one THEN wy2 ELSE hy END AS y2
FROM (SELECT *, greatest(hx - lx, hy - ly) > 12 * greatest(wx2 - wx1, wy2 - wy1) AS one FROM (SELECT min(x1) AS lx, min(y1) AS ly, max(x2) AS hx, max(y2) AS hy FROM ({rows})), (SELECT x1 AS wx1, y1 AS wy1, x2 AS wx2, y2 AS wy2 FROM ({rows}) ORDER BY greatest(x2 - x1, y2 - y1) DESC, id DESC LIMIT 1))"""


@query(FRAME.replace("{name}", "'boxes'").replace("{rows}", "SELECT * FROM {boxes}") + " UNION ALL " + FRAME.replace("{name}", "'wide'").replace("{rows}", FRAMED))
def main_frame(spark, sf_dir):
    """Bounds of all boxes, and of all boxes made wider."""
    framed = lambda name, sql: release.frame(view(spark, sf_dir, sql)).select(F.lit(name).alias("name"), "x1", "y1", "x2", "y2")
    return framed("boxes", "boxes").union(framed("wide", FRAMED))


@query("""WITH p AS (SELECT o_custkey AS key, (o_orderkey % 97) / 10.0E0 AS x, (o_orderkey % 89) / 10.0E0 AS y, o_orderkey % 2 AS s FROM {orders}), d AS (SELECT a.key, a.x AS ax, a.y AS ay, b.x AS bx, b.y AS qy, sqrt(pow((b.x - a.x) * 111.320E0 * cos(radians((a.y + b.y) / 2)), 2) + pow((b.y - a.y) * 110.574E0, 2)) AS d FROM p a JOIN p b ON a.key = b.key WHERE a.s = 0 AND b.s = 1)
SELECT key, round(max(m), 6) AS km FROM (SELECT key, min(d) AS m FROM d GROUP BY key, ax, ay UNION ALL SELECT key, min(d) FROM d GROUP BY key, bx, qy) GROUP BY key""")
def hausdorff_km(spark, sf_dir):
    """Distances of the point sets of each customer, over all orders."""
    p = view(spark, sf_dir, "orders").select(F.col("o_custkey").alias("key"), (F.col("o_orderkey") % 97 / 10.0).alias("x"), (F.col("o_orderkey") % 89 / 10.0).alias("y"), (F.col("o_orderkey") % 2).alias("s"))
    return release.hausdorff(p.where("s = 0"), p.where("s = 1")).select("key", F.round("km", 6).alias("km"))


@query("SELECT l_orderkey AS location, round(sum(l_extendedprice * l_quantity / (l_quantity + 10)), 6) AS value FROM {lineitem} GROUP BY 1")
def area_weighted(spark, sf_dir):
    """Values by the share of their area."""
    rows = view(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("location"), F.col("l_extendedprice").alias("value"), F.col("l_quantity").alias("overlap"), (F.col("l_quantity") + 10).alias("area"))
    return measure.area_weighted(rows, "location").select("location", F.round("value", 6).alias("value"))


@query("SELECT z, x, y, round(x / pow(2, z) * 360 - 180, 9) AS west, round(degrees(atan(sinh(pi() * (1 - 2 * (y + 1) / pow(2, z))))), 9) AS south FROM (SELECT s_suppkey % 6 AS z, s_suppkey % 3 AS x, (s_suppkey * 5) % 3 AS y FROM {supplier})")
def tile_bounds(spark, sf_dir):
    """Bounds of tiles."""
    rows = view(spark, sf_dir, "supplier").select((F.col("s_suppkey") % 6).alias("z"), (F.col("s_suppkey") % 3).alias("x"), (F.col("s_suppkey") * 5 % 3).alias("y"))
    b = geo.tile_bounds(F.col("z"), F.col("x"), F.col("y"))
    return rows.select("z", "x", "y", F.round(b["west"], 9).alias("west"), F.round(b["south"], 9).alias("south"))


@query("SELECT CAST(count_if(severity = 'error') AS BIGINT) AS errors, CAST(count_if(severity = 'warning') AS BIGINT) AS warnings, 'fail' AS status FROM (SELECT CASE WHEN weight > 4 THEN 'error' ELSE 'warning' END AS severity FROM {edges})")
def finding_summary(spark, sf_dir):
    """Counts of findings and the verdict."""
    return quality.summary(view(spark, sf_dir, "edges").select(F.when(F.col("weight") > 4, "error").otherwise("warning").alias("severity")))


@query("SELECT p.province_id, 'MISSING_OWNER' AS code FROM {provinces} p WHERE coalesce(kind, 'land') = 'land' AND n % 9 = 0")
def required_fields(spark, sf_dir):
    """Q2: rows without an owner."""
    rows = land(view(spark, sf_dir, "provinces")).select("province_id", F.when(F.col("n") % 9 != 0, "X").otherwise(" ").alias("owner"), F.lit("X").alias("controller"))
    return quality.required_fields(rows).select(F.get("affected", F.lit(0)).alias("province_id"), "code")
