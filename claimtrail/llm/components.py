"""Connected components of a graph that is held in tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from claimtrail.sources.scratch import settle


def _state(edges: DataFrame):
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` for every node with an edge; the component is its smallest node.

    ``edges`` has two columns of node numbers. Large-star and small-star steps take turns until the edges are stars around each
    smallest node. Minima are combined before they are shuffled; the joins that follow are equi-joins whose hot nodes adaptive
    execution splits. Each round is written to the shared folder, so a lost executor costs no earlier round.
    """
    first, second = edges.columns
    current = edges.select(F.greatest(first, second).alias("u"), F.least(first, second).alias("v")).where("u <> v").distinct()
    current = settle(current, "components")
    state = _state(current)
    while True:
        both = current.unionByName(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = settle(large, "components")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = small.unionByName(least.select("u", F.col("m").alias("v"))).distinct()
        current = settle(small, "components")
        before, state = state, _state(current)
        if state == before:
            break
    own = current.select(F.col("v").alias("node")).distinct().withColumn("component", F.col("node"))
    return current.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(own)
