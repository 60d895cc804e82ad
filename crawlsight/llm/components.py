"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shelf import Shelf, tasks_for


def _with_least(rows: DataFrame, least: DataFrame) -> DataFrame:
    """``rows`` with the minimum of their node.

    The minima lie by node already; joined by another key, both sides are shuffled for the join, and the rows
    of a node with very many neighbours can be split over several tasks.
    """
    minima = least.select((-F.col("u")).alias("key"), "m")
    return rows.withColumn("key", -F.col("u")).join(minima, "key").drop("key")


def _large_star(edges: DataFrame, tasks: int) -> DataFrame:
    """Every larger neighbour of a node is tied to the smallest of the node and its neighbours."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")).coalesce(tasks)
    tied = _with_least(both.where("v > u"), least).select(F.col("v").alias("u"), F.col("m").alias("v"))
    return tied.where("u != v").coalesce(tasks).distinct().coalesce(tasks)


def _small_star(edges: DataFrame, tasks: int) -> DataFrame:
    """A node and its smaller neighbours are tied to the smallest of these."""
    least = edges.groupBy("u").agg(F.min("v").alias("m")).coalesce(tasks)
    tied = _with_least(edges, least).select(F.col("v").alias("u"), F.col("m").alias("v"))
    return tied.unionByName(least.select("u", F.col("m").alias("v"))).where("u != v").coalesce(tasks).distinct().coalesce(tasks)


def components(edges: DataFrame) -> DataFrame:
    """node, root: the smallest node that can be reached, for every node of ``edges`` (a, b) but the roots.

    Edges may repeat, point either way or tie a node to itself; those with NULL are passed over. A
    node's neighbours are only ever counted down to their minimum, never gathered, so a node may
    have any number of them. Each round is a table in the shared folder, which goes when the next is there.
    """
    spark = edges.sparkSession
    shelf = Shelf(spark, "components")
    a, b = F.col("a"), F.col("b")
    given = edges.where(a.isNotNull() & b.isNotNull() & (a != b))
    current = shelf.put("edges", given.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct())
    state = None
    while True:
        total = current.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(total) == state or total[0] == 0:
            return current.select(F.col("u").alias("node"), F.col("v").alias("root"))
        state = tuple(total)
        tasks = tasks_for(spark, total[0])
        large = shelf.put("large", _large_star(current, tasks))
        current = shelf.put("edges", _small_star(large, tasks))
        shelf.drop("large")
