"""Connected components of an undirected graph, as Spark joins.

Alternating large-star and small-star steps: each step hangs neighbours under
the smallest vertex they know, until every vertex points at its component's
smallest.  Minima are taken by aggregation (combined before the shuffle), never
by gathering a vertex's neighbours; each round is cut to the checkpoint folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node with an edge; root is the component's
    smallest node.  ``edges`` has columns a and b; loops and repeats may occur."""
    links = cut(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct())
    mark = None
    while True:
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("_m")).select("u", F.least("u", "_m").alias("m"))
        # large star: the neighbours above a vertex move to its smallest neighbour
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        # small star: a vertex and its neighbours below it move to the smallest
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(least, "u")
        small = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
        links = cut(small.where("u <> v").distinct())
        now = links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == mark:
            return links.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(links.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
        mark = now
