"""Connected components of a distributed edge list, by large-star and small-star steps.

Each step sends edges by one endpoint and links all neighbours to the smallest. A node with a great many neighbours is
reduced by partial minima before the shuffle, and its edges go to the other endpoints, so no task gathers a
neighbourhood. Labels and edges stay in tables; nothing is collected but a count that tells when to stop.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common


def _with_least(edges: DataFrame, folder: str) -> DataFrame:
    """(u, v, m): each edge with the smallest neighbour of u. Both sides are tables, so a hot u can be split."""
    least = common.written(edges.groupBy(F.col("u").alias("_u")).agg(F.min("v").alias("m")), folder)
    return edges.join(least, F.col("u") == F.col("_u")).select("u", "v", "m")


def components(edges: DataFrame, folder: str) -> DataFrame:
    """(node, component): the smallest node reachable, for every node of ``edges`` (u, v)."""
    spark = edges.sparkSession
    now = common.written(edges.where("u != v").select(F.least("u", "v").alias("a"), F.greatest("u", "v").alias("b")).distinct(), f"{folder}/e0")
    k, last = 0, None
    while True:
        # large star: neighbours above a node go to its least neighbour (or itself)
        both = now.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(now.select(F.col("b").alias("u"), F.col("a").alias("v")))
        large = _with_least(both, f"{folder}/m{k}").withColumn("m", F.least("u", "m")).where("v > u")
        large = common.written(large.select(F.col("m").alias("v"), F.col("v").alias("u")).where("u != v").distinct(), f"{folder}/l{k}")
        # small star: neighbours below a node and the node itself go to the least of them
        small = _with_least(large, f"{folder}/n{k}")
        linked = small.select(F.col("m").alias("a"), F.col("v").alias("b")).unionByName(small.select(F.col("m").alias("a"), F.col("u").alias("b")))
        after = common.written(linked.where("a != b").distinct(), f"{folder}/e{k + 1}")
        state = after.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        common.drop(spark, *[f"{folder}/{x}{k}" for x in "mln"], *([f"{folder}/e{k}"] if k else []))
        k += 1
        now = after
        if state == last:
            break
        last = state
    return now.select(F.col("b").alias("node"), F.col("a").alias("component")).unionByName(now.select(F.col("a").alias("node"), F.col("a").alias("component")).distinct())
