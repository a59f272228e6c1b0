"""Connected components of a graph of ids, by alternating stars in Spark; nothing is gathered on the driver."""

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from figloom.functions.session import discard, materialise


def components(edges: DataFrame, most_rounds: int = 100) -> DataFrame:
    """node, comp: the least id reachable from each node of edges (u, v), longs; nodes that are least are left out.

    A node's least neighbour is found by an aggregation that sums up before its shuffle, and is sent back by a join that
    Spark can split, so a node of very many links is no task of its own. Null ends and loops are left out. The rounds grow
    with the logarithm of the longest chain; beyond most_rounds of them an error is raised."""
    now = materialise(edges.where("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    before = None
    for _ in range(most_rounds):
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("m", "u"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = large.groupBy("u").agg(F.min("v").alias("m"))
        step = large.join(small, "u").select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v"))
        seen = Observation()
        after = materialise(step.where("u != v").distinct().observe(seen, F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")))
        discard(now)
        now = after
        if seen.get == before:
            return now.select(F.col("u").alias("node"), F.col("v").alias("comp"))
        before = seen.get
    raise RuntimeError(f"links of components still change after {most_rounds} rounds")
