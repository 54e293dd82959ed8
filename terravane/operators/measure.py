"""Aggregates over weights: apportionment, hotspots, dominant references, zonal sums, deltas, runs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from terravane.operators.graph import cut


def apportion(parents: DataFrame, target: int, most: int) -> DataFrame:
    """(id, parts): one part each, and the rest of `target` by the highest quotients weight / (parts + 0.5), `most` at most.

    A parent's quotients fall with its parts, so the greedy order is the order of all quotients, and the ones dealt are the
    first target - n by (quotient, id, part). Ids that aren't refinable keep one part.
    """
    n, spare = parents.agg(F.count("*"), F.sum(F.when(F.col("refinable"), most - 1).otherwise(0))).first()
    if not n <= target <= n + (spare or 0):
        raise ValueError(f"the target {target} lies outside {n} to {n + (spare or 0)}")
    bids = parents.where("refinable").withColumn("part", F.explode(F.sequence(F.lit(1), F.lit(most - 1)))).select("id", "part", (F.col("weight") / (F.col("part") + 0.5)).alias("quotient"))
    won = bids.orderBy(F.desc("quotient"), "id", "part").limit(target - n).groupBy("id").agg(F.count("*").alias("more"))
    return parents.select("id").join(won, "id", "left").select("id", (1 + F.coalesce("more", F.lit(0))).alias("parts"))


def hotspots(points: DataFrame, zone: str, weight: str, key: str, k: int) -> DataFrame:
    """(zone, total, n, top): sums and counts of each zone, and its k heaviest points, the lower key first among equals.

    The k are kept by a rank limit that Spark applies before and after the shuffle.
    """
    rank = F.row_number().over(Window.partitionBy(zone).orderBy(F.desc(weight), key))
    best = points.withColumn("_r", rank).where(F.col("_r") <= k).groupBy(zone).agg(F.transform(F.array_sort(F.collect_list(F.struct("_r", F.col(key).alias("_k")))), lambda s: s["_k"]).alias("top"))
    return points.groupBy(zone).agg(F.sum(weight).alias("total"), F.count("*").alias("n")).join(best, zone)


def dominant(rows: DataFrame, key: str, reference: str, weight: Column) -> DataFrame:
    """(key, reference, weight): the reference of greatest summed weight, the lower one among equals."""
    sums = rows.groupBy(key, reference).agg(F.sum(weight).alias("weight"))
    return sums.groupBy(key).agg(F.min_by(F.struct(reference, "weight"), F.struct(-F.col("weight"), F.col(reference))).alias("_b")).select(key, f"_b.{reference}", "_b.weight")


def majority(rows: DataFrame, key: str, value: str, least_share: float) -> DataFrame:
    """(key, value): the commonest present value, where at least the share of rows has one; the lower among equals."""
    counts = rows.groupBy(key, value).agg(F.count("*").alias("n"))
    best = counts.groupBy(key).agg(F.sum("n").alias("all"), F.sum(F.when(F.col(value).isNotNull(), F.col("n"))).alias("known"), F.min_by(F.col(value), F.when(F.col(value).isNotNull(), F.struct(-F.col("n"), F.col(value)))).alias(value))
    return best.where(F.col("known") >= least_share * F.col("all")).select(key, value)


def weighted_score(values: dict[str, tuple[Column, float]]) -> Column:
    """Mean of log1p of the present values by their weights, which are scaled to those present; 0 without any."""
    total = sum((F.when(v.isNotNull(), w).otherwise(0.0) for v, w in values.values()), F.lit(0.0))
    score = sum((F.coalesce(F.log1p(v) * w, F.lit(0.0)) for v, w in values.values()), F.lit(0.0))
    return F.when(total > 0, score / total).otherwise(0.0)


def area_weighted(overlaps: DataFrame, location: str) -> DataFrame:
    """(location, value): sum of value times overlap over the source's area."""
    return overlaps.groupBy(location).agg(F.sum(F.col("value") * F.col("overlap") / F.col("area")).alias("value"))


def delta(base: DataFrame, current: DataFrame) -> DataFrame:
    """Rows of two sets: op 'removed' (in base alone) or 'added' (in current alone)."""
    return base.subtract(current).withColumn("op", F.lit("removed")).union(current.subtract(base).withColumn("op", F.lit("added")))


def applied(base: DataFrame, changes: DataFrame) -> DataFrame:
    """base with the rows of delta taken away and added."""
    take = lambda op: changes.where(F.col("op") == op).drop("op")
    return base.subtract(take("removed")).union(take("added")).distinct()


def run_lengths(rows: DataFrame, group: str, order: str, value: str) -> DataFrame:
    """(group, first, length, value): runs of consecutive numbers in order that have the same value."""
    w = Window.partitionBy(group).orderBy(order)
    fresh = F.when((F.col(order) == F.lag(order).over(w) + 1) & F.col(value).eqNullSafe(F.lag(value).over(w)), 0).otherwise(1)
    runs = rows.withColumn("_new", fresh).withColumn("_run", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return runs.groupBy(group, "_run").agg(F.min(order).alias("first"), F.count("*").alias("length"), F.first(value).alias("value")).drop("_run")


def nearest_rank(values: DataFrame, column: str, share: float) -> DataFrame:
    """The value at index int(share * n), or the last, of the sorted values: the range of distinct values that holds the rank is found by
    the counts of all ranges, and ranked alone."""
    parts = max(1, int(values.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    counts = values.groupBy(column).agg(F.count("*").alias("_n"))
    ranged = cut(counts.repartitionByRange(parts, column).withColumn("_part", F.spark_partition_id()))
    sizes = {r["_part"]: r["_s"] for r in ranged.groupBy("_part").agg(F.sum("_n").alias("_s")).collect()}  # a row a partition
    at, part, before = min(int(share * sum(sizes.values())), sum(sizes.values()) - 1), None, 0
    for part in sorted(sizes):
        if before + sizes[part] > at:
            break
        before += sizes[part]
    ends = ranged.where(F.col("_part") == F.lit(part)).withColumn("_end", before + F.sum("_n").over(Window.partitionBy("_part").orderBy(column).rowsBetween(Window.unboundedPreceding, 0)))
    return ends.where(F.col("_end") > at).agg(F.min(column).alias(column))


def chunks(rows: DataFrame, group: str, order: str, size: int) -> DataFrame:
    """rows with `chunk`: runs of `size` in the group's order; a last one below half of it joins the one before."""
    w = Window.partitionBy(group)
    n, i = F.count("*").over(w), F.row_number().over(w.orderBy(order)) - 1
    last = F.when((n % size > 0) & (2 * (n % size) < size) & (n > size), F.floor(n / size) - 1).otherwise(F.floor((n - 1) / size))
    return rows.withColumn("chunk", F.least(F.floor(i / size), last))
