"""Keyed unions and merges (U01-U09 of the survey)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def union_by_key(sources: list[DataFrame], keys: list[str], order: str) -> DataFrame:
    """One row a key: an earlier source wins, within one the last in order."""
    rows = reduce(DataFrame.unionByName, [s.withColumn("_p", F.lit(i)) for i, s in enumerate(sources)])
    pick = Window.partitionBy(*keys).orderBy("_p", F.desc(order))
    return rows.withColumn("_r", F.row_number().over(pick)).where("_r = 1").drop("_r", "_p")


def max_merge(a: DataFrame, b: DataFrame, keys: list[str], counters: list[str], sets: list[str]) -> DataFrame:
    """Counters by maximum, lists by union."""
    b = b.select(*keys, *(F.col(c).alias(f"_{c}") for c in (*counters, *sets)))
    empty = lambda c: F.coalesce(F.col(c), F.array().cast(a.schema[c.lstrip("_")].dataType))
    return a.join(b, keys, "full").select(*keys, *(F.greatest(c, f"_{c}").alias(c) for c in counters), *(F.array_union(empty(c), empty(f"_{c}")).alias(c) for c in sets))


def newer_wins(local: DataFrame, remote: DataFrame, keys: list[str], at: str, tie: str) -> DataFrame:
    """The newest row a key; the remote one on equal times."""
    rows = remote.withColumn("_p", F.lit(0)).unionByName(local.withColumn("_p", F.lit(1)))
    pick = Window.partitionBy(*keys).orderBy(F.desc(at), "_p", tie)
    return rows.withColumn("_r", F.row_number().over(pick)).where("_r = 1").drop("_r", "_p")


def merge_incidents(df: DataFrame, key: str, seen: str, batch: str) -> DataFrame:
    """First and last seen, last batch and distinct batches a key."""
    return df.groupBy(key).agg(F.min(seen).alias("first_seen"), F.max(seen).alias("last_seen"), F.max_by(batch, seen).alias("last_batch"), F.count_distinct(batch).alias("n_batches"), F.array_join(F.array_sort(F.collect_set(batch)), ",").alias("batches"))


def event_stream(sources: list[DataFrame], keys: list[str], t: str, kind: str) -> DataFrame:
    """Typed events in one stream with their place in it, by time, then kind."""
    rows = reduce(DataFrame.unionByName, sources)
    return rows.withColumn("place", F.row_number().over(Window.partitionBy(*keys).orderBy(t, kind)))
