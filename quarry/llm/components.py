"""Connected components of an edge table, as Spark joins.

Alternates the two star operations on the edges: every node points its larger
(then its smaller) neighbours to the least node it knows.  No neighbourhood is
collected; only minima are aggregated, with partial aggregation before each
shuffle, and each round is written to the shared checkpoint folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.scratch import remove, written


def _star(edges: DataFrame, larger: bool) -> DataFrame:
    if larger:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        moved = F.col("v") > F.col("u")
    else:
        both = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        moved = F.lit(True)
    least = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("c"), F.least("u", "m").alias("m"))
    linked = both.where(moved).join(least, F.col("u") == F.col("c")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    if not larger:  # the node itself points to the least too
        linked = linked.union(least.select(F.col("c").alias("u"), F.col("m").alias("v")))
    return linked.where("u != v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges(u, v)``; the component is
    its least node.  Repeated edges, loops and an empty table are allowed."""
    now = written(edges.where("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    sign = None
    while True:
        # Done when a round changes nothing: then every node hangs on its least one.
        before, now = now, written(_star(_star(now, True), False), "edges")
        remove(before)
        row = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if sign == tuple(row):
            break
        sign = tuple(row)
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).union(now.select("v", "v").distinct())
