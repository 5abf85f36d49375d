"""Connected components without a driver-side graph."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def connected_components(edges: DataFrame, cut: Callable[[DataFrame], DataFrame], rounds: int = 60) -> DataFrame:
    """Smallest reachable id of every node in edges(u, v): alternating large and small stars.

    Each round replaces edges by edges to the smallest neighbour; it ends when the edges are stars. Minimum
    per node is a combinable aggregate and the joins are splittable, so a node with very many edges is no hot
    task. ``cut`` ends the lineage after each round (a checkpoint or a written table). Null ends and loops are
    dropped; nodes that no edge names are not returned. Returns node, component.
    """
    edges = cut(edges.select("u", "v").where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    mark = None
    for _ in range(rounds):
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v"))
        edges = cut(small.where("u <> v").distinct())
        now = edges.agg(F.count("*"), F.expr("bit_xor(xxhash64(u, v))")).first()
        if now == mark:
            break
        mark = now
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(edges.select("v", "v").distinct())


def keep_one(df: DataFrame, key: str, order: list[str], pairs: DataFrame, cut: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """df without redundant rows: of the rows that pairs(u, v) of keys connect, the first by order stays.

    Keys of pairs that df does not have connect nothing. Clusters are reduced by a combinable minimum.
    """
    own = df.select(key)
    known = pairs.join(own.withColumnRenamed(key, "u"), "u", "left_semi").join(own.withColumnRenamed(key, "v"), "v", "left_semi").select("u", "v")
    found = connected_components(known, cut).select(F.col("node").alias(key), "component")
    first = df.join(found, key).groupBy("component").agg(F.min_by(key, F.struct(*order)).alias(key)).select(key)
    return df.join(found.select(key), key, "left_anti").unionByName(df.join(first, key, "left_semi"))
