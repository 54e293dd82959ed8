"""Connected components by alternating large-star and small-star steps, all as DataFrame joins and minima."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terravane.llm.jobs import dropped, stored


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min(F.least("a", "b")).alias("m"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    kept = down.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return kept.union(least.select("a", F.col("m").alias("b"))).distinct()


def _state(edges: DataFrame) -> tuple[int, int]:
    """Edges, and nodes that keep them from being stars: those with two edges up, or with edges both up and down."""
    ends = edges.select(F.col("a").alias("n"), F.lit(1).alias("up"), F.lit(0).alias("down")).union(edges.select("b", F.lit(0), F.lit(1)))
    odd = (F.col("up") > 1) | (F.col("up") * F.col("down") > 0)
    n, left = ends.groupBy("n").agg(F.sum("up").alias("up"), F.sum("down").alias("down")).agg(F.sum("up"), F.sum(odd.cast("long"))).first()
    return n or 0, left or 0


#: Edges in a file of a round's table.
FILE_ROWS = 250_000


def components(edges: DataFrame) -> DataFrame:
    """(node, label) for every end of an edge: label is the least node of the component.

    edges: columns a, b of one orderable type; self-loops, repeated and mirrored edges are allowed, nulls are dropped. No
    edges: no rows. Rounds, about as many as the logarithm of the longest path, go on until every node but the labels
    has one edge, to a label.
    """
    edges = edges.where("a is not null and b is not null")
    loops = edges.where("a = b").select(F.col("a").alias("node"), F.col("a").alias("label"))
    edges = stored(_small_star(edges.where("a <> b")), "star")
    n, left = _state(edges)
    while left:
        before, edges = edges, stored(_small_star(_large_star(edges)).coalesce(1 + n // FILE_ROWS), "star")
        dropped(before)
        n, left = _state(edges)
    named = edges.select(F.col("a").alias("node"), F.col("b").alias("label")).union(edges.select(F.col("b").alias("node"), F.col("b").alias("label")))
    return named.union(loops).groupBy("node").agg(F.min("label").alias("label"))
