"""Connected components of an edge table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docloom.llm.shared import written


def connected_components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(node, component) for every node with an edge; component is the least node that can be reached.

    edges has columns a and b (bigint). Each round replaces the edges by ones
    between the same components until every node points at its component's
    least node. Edges of a hub are joined with one row, so that a skewed join
    may be split; no node's neighbours are ever gathered into a row. Lineage is
    cut each round by writing to the shared folder. Beyond most_rounds (paths
    of any real length take a few) an error is raised.
    """
    now = written(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "cc")
    before = None
    for _ in range(most_rounds):
        state = now.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)")).alias("h")).first()
        if state == before:
            return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
        before = state
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        now = written(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "cc")
    raise RuntimeError("components did not settle")
