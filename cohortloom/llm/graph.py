"""Connected components by alternating star contraction, as joins and aggregates.

Each round hangs neighbours on their smallest neighbour, first the larger ones, then the smaller
ones; the number of rounds grows with the logarithm of the graph's size.  No neighbourhood is
gathered: a node meets its minimum by a join, which adaptive execution can split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortloom.llm.text import few_files
from cohortloom.session import durable


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select(F.col("hi").alias("u"), F.col("lo").alias("v")).union(edges.select(F.col("lo").alias("u"), F.col("hi").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.join(least, "u").where("v > u").select(F.col("v").alias("hi"), F.col("m").alias("lo")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("hi").agg(F.min("lo").alias("m"))
    moved = edges.join(least, "hi").where("lo > m").select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
    return moved.union(least.select("hi", F.col("m").alias("lo"))).distinct()


def _settled(edges: DataFrame) -> bool:
    """Every larger node hangs on one node, which hangs on none."""
    several = edges.groupBy("hi").agg(F.count("*").alias("n")).where("n > 1").limit(1)
    chained = edges.select(F.col("lo").alias("hi")).join(edges.select("hi"), "hi", "left_semi").select("hi", F.lit(0).cast("long")).limit(1)
    return several.union(chained).isEmpty()


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """node, component (smallest node reachable) for every node of an edge between two nodes."""
    x, y = F.col(a), F.col(b)
    edges = edges.where(x != y).select(F.greatest(x, y).alias("hi"), F.least(x, y).alias("lo")).distinct()
    edges = durable(few_files(edges), "edges")
    while not _settled(edges):
        edges = durable(few_files(_small_star(_large_star(edges))), "edges")
    roots = edges.select(F.col("lo").alias("node")).distinct().select("node", F.col("node").alias("component"))
    return edges.select(F.col("hi").alias("node"), F.col("lo").alias("component")).union(roots)
