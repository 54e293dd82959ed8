"""Map tables drawn from the driver's tables by SQL that Spark and DuckDB both read.

Customers stand for provinces on a grid of half-degree boxes, nations for countries, regions for regions; rules, edges and
points follow from keys. In a text, {name} is a driver table or another view.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")

VIEWS = {
    "provinces": """
SELECT concat('p', lpad(CAST(c_custkey AS STRING), 7, '0')) AS province_id,
       CASE WHEN c_custkey % 11 = 0 THEN 'sea' WHEN c_custkey % 7 = 0 THEN CAST(NULL AS STRING) ELSE 'land' END AS kind,
       CASE WHEN c_custkey % 13 <> 0 THEN n_name END AS country, r_name AS region, c_name AS display_name,
       c_custkey AS n, c_acctbal AS weight, c_custkey % 40 AS gx, CAST(floor(c_custkey / 40) AS BIGINT) AS gy
FROM {customer} JOIN {nation} ON c_nationkey = n_nationkey JOIN {region} ON n_regionkey = r_regionkey""",
    "rules": """
SELECT 'country' AS level, n_name AS match_id, 1 AS seq, CASE WHEN n_nationkey % 2 = 0 THEN concat('T', CAST(n_nationkey AS STRING)) END AS owner,
       CASE WHEN n_nationkey % 5 = 0 THEN 'HOLD' END AS controller, CASE WHEN n_nationkey % 3 = 0 THEN split(concat('T', CAST(n_nationkey AS STRING), ',CORE'), ',') END AS cores,
       CASE WHEN n_nationkey % 7 = 0 THEN split('CLAIM', ',') END AS claims, true AS has_culture, concat('c', CAST(n_nationkey AS STRING)) AS culture,
       false AS has_religion, CAST(NULL AS STRING) AS religion, CAST(NULL AS BOOLEAN) AS disputed, CAST(NULL AS STRING) AS notes
FROM {nation} WHERE n_nationkey % 6 <> 5
UNION ALL
SELECT 'country', n_name, 2, CASE WHEN n_nationkey % 8 = 0 THEN 'LATE' END, CAST(NULL AS STRING), NULL, NULL, n_nationkey % 8 = 4, CAST(NULL AS STRING),
       true, concat('r', CAST(n_nationkey AS STRING)), n_nationkey % 8 = 0, 'second'
FROM {nation} WHERE n_nationkey % 4 = 0
UNION ALL
SELECT 'region', r_name, 1, CAST(NULL AS STRING), CASE WHEN r_regionkey = 1 THEN 'REGENT' END, NULL, NULL, r_regionkey = 3, CAST(NULL AS STRING), r_regionkey = 3, 'regional', CAST(NULL AS BOOLEAN), CAST(NULL AS STRING)
FROM {region} WHERE r_regionkey IN (1, 3)
UNION ALL
SELECT 'province', province_id, 1, 'OVR', CAST(NULL AS STRING), NULL, split('OVR,NONE', ','), false, CAST(NULL AS STRING), false, CAST(NULL AS STRING), n % 2 = 0, 'override'
FROM {provinces} WHERE n % 17 = 0
UNION ALL
SELECT 'province', province_id, 2, 'OV2', 'OVC', NULL, NULL, true, 'own', false, CAST(NULL AS STRING), CAST(NULL AS BOOLEAN), CAST(NULL AS STRING)
FROM {provinces} WHERE n % 34 = 0""",
    "edges": """
SELECT least(s.province_id, t.province_id) AS a, greatest(s.province_id, t.province_id) AS b, CAST(1 + (s.n + t.n) % 7 AS DOUBLE) AS weight
FROM {provinces} s JOIN {provinces} t ON t.gx = s.gx + 1 AND t.gy = s.gy WHERE (s.n + t.n) % 5 <> 0
UNION ALL
SELECT least(s.province_id, t.province_id), greatest(s.province_id, t.province_id), CAST(1 + (s.n + t.n) % 7 AS DOUBLE)
FROM {provinces} s JOIN {provinces} t ON t.gx = s.gx AND t.gy = s.gy + 1 WHERE (s.n + t.n) % 3 = 0""",
    "boxes": """
SELECT province_id AS id, n, gx * 0.5E0 - 100.0E0 AS x1, gy * 0.5E0 - 60.0E0 AS y1, gx * 0.5E0 - 99.5E0 AS x2, gy * 0.5E0 - 59.5E0 AS y2 FROM {provinces}""",
    "points": """
SELECT s_suppkey AS point_id, ((s_suppkey * 7919) % 4000) / 200.0E0 - 100.0E0 AS x, ((s_suppkey * 104729) % 3000) / 100.0E0 - 60.0E0 AS y, s_acctbal AS weight FROM {supplier}""",
}

#: Ownership as SQL on provinces and rules: the last value that is set, over rules in order.
VIEWS["applied"] = """
SELECT p.province_id, p.country, r.*, CASE r.level WHEN 'country' THEN 1 WHEN 'region' THEN 2 ELSE 3 END * 1000 + r.seq AS ord
FROM {provinces} p JOIN {rules} r ON (r.level = 'country' AND r.match_id = p.country) OR (r.level = 'region' AND r.match_id = p.region)
     OR (r.level = 'province' AND r.match_id = p.province_id AND r.seq = CASE WHEN p.n % 34 = 0 THEN 2 ELSE 1 END)
WHERE coalesce(p.kind, 'land') = 'land'"""
VIEWS["ownership"] = """
SELECT p.province_id, coalesce(o.owner, p.country, 'UNK') AS owner, coalesce(o.controller, p.country, 'UNK') AS controller,
       coalesce(o.cores, CASE WHEN p.country IS NULL THEN [] ELSE [p.country] END) AS cores, coalesce(o.claims, []) AS claims,
       o.culture, o.religion, coalesce(o.disputed, false) AS disputed, o.notes,
       CASE WHEN o.top >= 3000 THEN 'province_override' WHEN o.top >= 2000 THEN 'region_rule' WHEN o.top >= 1000 THEN 'country_rule' ELSE 'baseline' END AS assignment_source
FROM {provinces} p LEFT JOIN (
  SELECT province_id, max(ord) AS top, arg_max(owner, ord) FILTER (WHERE owner IS NOT NULL) AS owner,
         arg_max(coalesce(controller, owner), ord) FILTER (WHERE coalesce(controller, owner) IS NOT NULL) AS controller,
         arg_max(cores, ord) FILTER (WHERE cores IS NOT NULL) AS cores, arg_max(claims, ord) FILTER (WHERE claims IS NOT NULL) AS claims,
         nullif(arg_max(coalesce(culture, '~'), ord) FILTER (WHERE has_culture), '~') AS culture,
         nullif(arg_max(coalesce(religion, '~'), ord) FILTER (WHERE has_religion), '~') AS religion,
         arg_max(disputed, ord) FILTER (WHERE disputed IS NOT NULL) AS disputed, arg_max(notes, ord) FILTER (WHERE notes IS NOT NULL) AS notes
  FROM {applied} GROUP BY province_id) o USING (province_id)
WHERE coalesce(p.kind, 'land') = 'land'"""


def names_in(sql: str) -> list[str]:
    return list(dict.fromkeys(re.findall(r"\{(\w+)\}", sql)))


def view(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    """The rows of a SQL text over {views} and {tables}; a single name is a view or a table."""
    if sql in TABLES:
        return spark.read.parquet(f"{sf_dir}/{sql}.parquet")
    sql = VIEWS.get(sql, sql)
    return spark.sql(sql, **{n: view(spark, sf_dir, n) for n in names_in(sql)})


def oracle(sql: str) -> str:
    """The same text for DuckDB, its views as common table expressions."""
    needed: list[str] = []

    def add(text: str) -> None:
        for name in names_in(text):
            if name in VIEWS and name not in needed:
                add(VIEWS[name])
                needed.append(name)

    add(sql)
    plain = lambda text: re.sub(r"\{(\w+)\}", r"\1", text)
    parts = [f"{n} AS ({plain(VIEWS[n])})" for n in needed]
    body = plain(sql).strip()
    if body.upper().startswith("WITH RECURSIVE"):
        return "WITH RECURSIVE " + ", ".join([*parts, body[len("WITH RECURSIVE") :].strip()])
    if body.upper().startswith("WITH "):
        return "WITH " + ", ".join([*parts, body[5:].strip()])
    return ("WITH " + ", ".join(parts) + "\n" if parts else "") + body
