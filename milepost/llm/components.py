"""Connected components of a links table by alternating star contractions, written out after each round."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from milepost.operators.scratch import written


def _large_star(links: DataFrame) -> DataFrame:
    """Every larger neighbour of a node moves to the smallest of the node and its neighbours."""
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("b"), F.least("a", "m").alias("m"))
    return links.join(least, "b").select("a", F.col("m").alias("b")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """A node and its smaller neighbours move to the smallest of these."""
    least = links.groupBy("a").agg(F.min("b").alias("m"))
    moved = links.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b"))).distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, root) of every node that has a link; ``root`` is the smallest node of its component.

    ``links`` has two columns of one orderable type, in either order; loops and links with a null end are ignored, repeated
    links count once, no links give no rows. Only sums leave
    the executors: two numbers a round tell whether anything has moved.
    """
    first, second = links.columns
    a, b = F.greatest(first, second), F.least(first, second)
    now = written(links.select(a.alias("a"), b.alias("b")).where("a <> b").distinct(), "links")
    state = None
    while True:
        told = now.agg(F.count("*"), F.expr("bit_xor(xxhash64(a, b))")).first()
        if told == state or not told[0]:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
                now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
            )
        state = told
        now = written(_small_star(_large_star(now)), "links")
