"""Connected components as joins and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from abono.llm.store import stored


def components(edges: DataFrame, name: str = "edges") -> DataFrame:
    """edges: (u, v) of any orderable type. (node, root): the least node of each node's
    component, for every node of an edge.

    Alternates two steps until nothing changes: every node hands its larger neighbours to its
    least neighbour, then its smaller ones. Only per-node minima are aggregated, and the joins
    with them can be split by Spark where a node has very many neighbours, so no task ever
    holds a node's neighbours together."""
    now = stored(edges.where("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), name)
    before = None
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u")
        moved = small.select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v")
        now = stored(moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), name)
        state = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if state == before:
            break
        before = state
    roots = now.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
