"""Connected components of an edge table, by alternating large-star and small-star rounds on DataFrames.

Each round moves every edge at most twice and its result is a table in the shared folder; the number of rounds grows with
the logarithm of a component's size.  A node with very many neighbours is no hot group: neighbours are only compared with
the minimum, which is pre-aggregated before the shuffle, and the join back splits skewed keys under adaptive execution.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import stored


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Large star: each node's larger neighbours are linked to the least of its neighbours and itself.
    Small star: each node's smaller neighbours and itself are linked to the least of them."""
    there, back = F.struct("u", "v"), F.struct(F.col("v").alias("u"), F.col("u").alias("v"))
    both = edges.select(F.inline(F.array(there, back))) if large else edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    joined = both.hint("merge").join(least, "u")  # a broadcast would take a job and the driver's memory in every round
    if large:
        out = joined.where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
    return out.where(F.col("u") != F.col("v")).distinct()


def _stars_alone(edges: DataFrame) -> bool:
    """Whether every source has one edge and no target is a source: a further round would leave such edges as they are."""
    ends = edges.select(F.explode(F.array(F.struct(F.col("u").alias("node"), F.lit(1).alias("out"), F.lit(0).alias("in")), F.struct(F.col("v").alias("node"), F.lit(0).alias("out"), F.lit(1).alias("in")))).alias("end")).select("end.*")
    return ends.groupBy("node").agg(F.sum("out").alias("out"), F.max("in").alias("in")).where("out > 1 OR out = 1 AND in = 1").isEmpty()


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) for the nodes of edges (u, v): component is the least node of each."""
    now = stored(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v").distinct(), "edges")
    while True:
        now = stored(_star(_star(now, True), False), "stars")
        if _stars_alone(now):
            break
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
