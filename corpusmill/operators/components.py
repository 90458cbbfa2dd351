"""Connected components of a graph of any shape, by alternating star contraction.

Every round links the larger neighbours of each node to its least neighbour, then
the smaller ones; a few rounds (about the logarithm of the longest chain) leave
one star per component, with its least node in the centre. Nodes of any degree
are handled by sums and joins; no group is gathered.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.runtime import materialize


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select(F.col("hi").alias("u"), F.col("lo").alias("v")).unionByName(
        edges.select(F.col("lo").alias("u"), F.col("hi").alias("v"))
    )
    least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    above = both.filter("v > u").join(least, "u")
    return above.select(F.col("v").alias("hi"), F.col("m").alias("lo")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("hi").agg(F.min("lo").alias("m"))
    below = edges.join(least, "hi").filter("lo > m").select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
    return below.unionByName(least.select("hi", F.col("m").alias("lo"))).distinct()


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root): every node of `edges` that is not its component's least, and that least node.

    Edges with a null end and loops are left out; repeated edges are fine.
    """
    ends = edges.filter(F.col(a) != F.col(b))
    edges = ends.select(F.greatest(a, b).alias("hi"), F.least(a, b).alias("lo")).distinct()
    mark = None
    while True:
        edges = materialize(edges, "stars")
        told = F.sum(F.xxhash64("hi", "lo").cast("decimal(20,0)"))
        now = edges.agg(F.count("*"), told).first()
        if now == mark or not now[0]:
            return edges.select(F.col("hi").alias("node"), F.col("lo").alias("root"))
        mark = now
        edges = _small_star(_large_star(edges))
