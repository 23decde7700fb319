"""Graph operators on edge tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagemill.runtime import staged


def components(edges: DataFrame, a: str = "a", b: str = "b", rounds: int = 60) -> DataFrame:
    """Connected components by alternating large-star and small-star steps, each an aggregate and a join on the edges' ends.

    Returns (node, component) for each node of an edge; component is the least node reached. Rows with a null end are
    dropped, loops count as a node alone. Every step is a table in the shared folder; the loop ends when no edge changes.
    """
    e = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u is not null and v is not null")
    nodes = e.select(F.explode(F.array("u", "v")).alias("node")).distinct()
    e = staged(e.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    mark = None
    for _ in range(rounds):
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        e = staged(small, "edges")
        now = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == mark:
            break
        mark = now
    else:
        raise RuntimeError("the components did not settle")
    least = e.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("component"))
    return nodes.join(least, "node", "left").select("node", F.coalesce("component", "node").alias("component"))
