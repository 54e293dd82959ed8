"""URL filters: allow and block rules on host and path, found by sorted sweeps over reversed-host keys.

The key of a host is its labels from the last to the first, each with a dot: all subdomains of a host share its key as a
prefix, so a rule is an interval of the sorted keys, and intervals are nested or apart. A sweep goes over rules and URLs in the order
of keys; a rule brings along the stack of rules that enclose it, and a URL takes the stack of the last rule before it and
keeps the rules that still enclose it. The first sweep finds the rule hosts of a URL's host, the second the rules on a rule
host whose path starts the URL's path. DataFrame functions only.

A sweep deals rows to tasks by ranges of (key, row), so a hot host or URL is spread over many; each range hands the stack at its
end on to the next, one row a range.

Edge cases: a null URL, or one without ://, has empty host and path and no rule. Rules need a host; repeated rules count once,
and of rules that differ only in their verdict block wins. Of the rules that fit the longest (host and path) wins, then
the one of the longer host, then the lower text. Repeated pages are rows of their own. No rules: the default verdict.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from terravane.llm.jobs import read_table, stored

#: (host, path, verdict).
RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"), ("com", "/fr/", "allow"), ("com", "/de/", "block")]
DEFAULT = "allow"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Stands between the host's key and the path.
CUT = "\u0001"


def rule_table(spark: SparkSession, rules: list[tuple[str, str, str]]) -> DataFrame:
    fields = [F.struct(F.lit(h).alias("host"), F.lit(p).alias("path"), F.lit(v).alias("verdict")) for h, p, v in rules]
    empty = F.array().cast("array<struct<host:string,path:string,verdict:string>>")
    return spark.range(1).select(F.explode(F.array(*fields) if fields else empty).alias("r")).select("r.*")


def host_key(host) -> F.Column:
    return F.concat(F.array_join(F.reverse(F.split(host, "\\.")), "."), F.lit("."))


def parsed(pages: DataFrame, url: str = "url") -> DataFrame:
    """pages with host and path of its URL column."""
    at = F.locate("://", F.col(url))
    rest = F.when(at > 0, F.substr(F.col(url), at + 3)).otherwise("")
    host = F.regexp_extract(F.col("_rest"), "^[^/?#]*", 0)
    path = F.regexp_extract(F.col("_rest"), "^[^/?#]*([^?#]*)", 1)
    return pages.withColumn("_rest", F.coalesce(rest, F.lit(""))).withColumn("host", F.translate(host, UPPER, LOWER)).withColumn("path", path).drop("_rest")


def sweep(points: DataFrame, rules: DataFrame, prefixes) -> DataFrame:
    """points (row, key, and more), each with `stack`: the keys of the rules whose key starts its key, shortest first.

    rules: distinct `key`s. prefixes: a Column over `key` with all prefixes of it that could be a rule's key, itself too.
    """
    spark = points.sparkSession
    outer = rules.select(F.col("key").alias("inner"), F.explode(prefixes).alias("key")).distinct()
    stacks = outer.join(rules, "key").groupBy("inner").agg(F.sort_array(F.collect_list("key")).alias("stack"))
    rest = [c for c in points.columns if c not in ("key", "row")]
    starts = stacks.select(F.col("inner").alias("key"), F.lit(-1).cast("long").alias("row"), *[F.lit(None).cast(points.schema[c].dataType).alias(c) for c in rest], "stack")
    events = points.select("key", "row", *rest, F.lit(None).cast("array<string>").alias("stack")).union(starts)
    ranges = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    events = stored(events.repartitionByRange(ranges, "key", "row").withColumn("range", F.spark_partition_id()), "sweep")
    ends = events.where("stack is not null").groupBy("range").agg(F.max_by("stack", "key").alias("end"))
    order = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    # one row a range, at most as many as ranges
    carried = events.select("range").distinct().join(ends, "range", "left").withColumn("carried", F.last("end", ignorenulls=True).over(order)).select("range", "carried")
    running = Window.partitionBy("range").orderBy("key", "row").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    swept = events.withColumn("_last", F.last("stack", ignorenulls=True).over(running)).where("stack is null")
    swept = swept.join(F.broadcast(carried), "range")
    live = F.filter(F.coalesce("_last", "carried", F.array().cast("array<string>")), lambda k: F.startswith(F.col("key"), k))
    return swept.withColumn("stack", live).select("key", "row", *rest, "stack")


def judge(pages: DataFrame, rules: DataFrame, default: str = DEFAULT, page_id: str = "page_id", url: str = "url") -> DataFrame:
    """(page_id, host, path, rule, verdict) for each row of pages."""
    rules = rules.where("host is not null and host <> '' and path is not null").groupBy("host", "path").agg(F.max("verdict").alias("verdict"))
    rules = rules.withColumn("host_key", host_key(F.col("host"))).withColumn("key", F.concat("host_key", F.lit(CUT), "path"))
    rows = parsed(pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("url"))).drop("url")
    rows = rows.withColumn("row", F.monotonically_increasing_id()).withColumn("key", host_key(F.col("host")))

    labels = F.split("key", "\\.")
    by_label = F.transform(F.sequence(F.lit(1), F.size(labels) - 1), lambda n: F.concat(F.array_join(F.slice(labels, 1, n), "."), F.lit(".")))
    hosts = sweep(rows, rules.select(F.col("host_key").alias("key")).distinct(), by_label)

    points = hosts.select("row", "page_id", "host", "path", F.explode_outer("stack").alias("rule_host"))
    points = points.withColumn("key", F.coalesce(F.concat("rule_host", F.lit(CUT), "path"), F.lit("")))
    cut = F.locate(CUT, F.col("key"))
    by_path = F.transform(F.sequence(cut, F.length("key")), lambda n: F.substr(F.col("key"), F.lit(1), n))
    found = sweep(points, rules.select("key"), by_path).withColumn("key", F.try_element_at("stack", F.lit(-1)))

    # one row for each rule host of a URL: few, as a host has few labels
    best = found.join(rules.select("key", F.concat("host", "path").alias("rule"), F.length("host").alias("n"), "verdict"), "key", "left")
    rank = F.when(F.col("rule").isNotNull(), F.struct(-F.length("rule"), -F.col("n"), F.col("rule")))
    out = best.groupBy("row").agg(F.first("page_id").alias("page_id"), F.first("host").alias("host"), F.first("path").alias("path"), F.min_by(F.struct("rule", "verdict"), rank).alias("r"))
    return out.select("page_id", "host", "path", F.col("r.rule").alias("rule"), F.coalesce("r.verdict", F.lit(default)).alias("verdict"))


def op5_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdicts on all pages by RULES."""
    return judge(read_table(spark, sf_dir, "pages"), rule_table(spark, RULES))


ORACLE = r"""
WITH rules(host, path, verdict) AS (
  VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'), ('com', '/fr/', 'allow'), ('com', '/de/', 'block')
), p AS (
  SELECT row_number() OVER () AS rid, page_id,
         coalesce(translate(regexp_extract(url, '://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
         coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages
), fit AS (
  SELECT rid, r.host || r.path AS rule, verdict,
         row_number() OVER (PARTITION BY rid ORDER BY length(r.host || r.path) DESC, length(r.host) DESC, r.host || r.path) AS n
  FROM p JOIN rules r ON (p.host = r.host OR ends_with(p.host, '.' || r.host)) AND starts_with(p.path, r.path)
)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM p LEFT JOIN (SELECT * FROM fit WHERE n = 1) USING (rid)
"""
