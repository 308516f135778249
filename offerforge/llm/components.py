"""Connected components of a graph given as links, by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from offerforge.session import written


def components(links: DataFrame) -> DataFrame:
    """``node``, ``component``: the smallest node reachable, for every node of ``links`` (a, b; long).

    A round links all larger neighbours of a node to the smallest node around it, then all smaller ones. The links do
    not grow in number and the rounds are logarithmic in the number of nodes. Minima are combined before the shuffle and
    every round is written to the shared folder. Loops and links with a null give nothing.
    """
    edges = written(
        links.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    )
    seen = _state(edges)
    while True:
        both = edges.union(edges.select("b", "a"))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = written(large.where("a != b").distinct())
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = written(small.union(least).distinct())
        now = _state(edges)
        if now == seen:
            break
        seen = now
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).union(edges.select("b", "b").distinct())


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first())
