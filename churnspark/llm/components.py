"""Connected components of an edge table, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnspark.session import staged


def components(edges: DataFrame) -> DataFrame:
    """Rows (id, component) for edges (a, b): the smallest id reachable, for every id with an edge to another.

    Each step moves edges towards the smallest neighbour and writes them to the shared folder; a step is two
    aggregations and two joins by node, whatever the shape of the graph, and a node with very many edges is
    aggregated before the shuffle. The steps end when the edges are stars and no longer change.
    """
    high, low = F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")
    stars = staged(edges.where("a <> b").select(high, low).distinct(), "edges")
    mark = None
    while True:
        both = stars.unionByName(stars.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = small.unionByName(least.select("u", F.col("m").alias("v")))
        stars = staged(small.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
        new = stars.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(new) == mark:
            return stars.select(F.col("u").alias("id"), F.col("v").alias("component"))
        mark = tuple(new)
