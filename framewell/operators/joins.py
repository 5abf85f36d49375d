"""Join idioms (J01-J20 of the survey; J18 is missing). Equi joins are left to Catalyst; these are the ones it lacks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def latest_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """One row a key: the first in the given order (last row wins with descending order)."""
    return df.withColumn("_r", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("_r = 1").drop("_r")


def asof_backward(probes: DataFrame, points: DataFrame, keys: list[str], t: str, value: str, clip_first: bool = False) -> DataFrame:
    """Each probe with the value of the last point at or before its time (J08); with clip_first, else the first point's.

    Both sides go through one sort by key and time: no join, no cross product. probes keep all their columns.
    """
    carried = [c for c in probes.columns if c not in (*keys, t)]
    left = probes.select(*keys, F.col(t).alias("_t"), F.lit(1).alias("_k"), F.struct(*carried).alias("_row") if carried else F.lit(True).alias("_row"), F.lit(None).cast(points.schema[value].dataType).alias("_v"))
    right = points.select(*keys, F.col(t).alias("_t"), F.lit(0).alias("_k"), F.lit(None).cast(left.schema["_row"].dataType).alias("_row"), F.col(value).alias("_v"))
    seen = Window.partitionBy(*keys).orderBy("_t", "_k").rowsBetween(Window.unboundedPreceding, 0)
    found = F.last("_v", ignorenulls=True).over(seen)
    if clip_first:
        found = F.coalesce(found, F.last("_v", ignorenulls=True).over(Window.partitionBy(*keys).orderBy(F.desc("_t"), F.desc("_k")).rowsBetween(Window.unboundedPreceding, 0)))
    out = left.unionByName(right).withColumn("_found", found).where("_k = 1")
    return out.select(*keys, F.col("_t").alias(t), *([F.col(f"_row.{c}").alias(c) for c in carried]), F.col("_found").alias(value))


def interpolate(probes: DataFrame, points: DataFrame, keys: list[str], t: str, value: str) -> DataFrame:
    """Linear interpolation of points onto the probes' times; NULL outside their span or with fewer than two."""
    points = points.where(F.col(value).isNotNull() & ~F.isnan(value) & F.col(t).isNotNull())
    rows = points.select(*keys, F.col(t).alias("_t"), F.lit(0).alias("_k"), F.col(value).cast("double").alias("_v")).union(probes.select(*keys, F.col(t), F.lit(1), F.lit(None).cast("double")))
    before = Window.partitionBy(*keys).orderBy("_t", "_k").rowsBetween(Window.unboundedPreceding, 0)
    after = Window.partitionBy(*keys).orderBy(F.desc("_t"), "_k").rowsBetween(Window.unboundedPreceding, 0)
    point = F.when(F.col("_k") == 0, F.struct("_t", "_v"))
    rows = rows.withColumns({"a": F.last(point, ignorenulls=True).over(before), "b": F.last(point, ignorenulls=True).over(after), "n": F.count(F.when(F.col("_k") == 0, 1)).over(Window.partitionBy(*keys))}).where("_k = 1")
    line = F.col("a._v") + (F.col("b._v") - F.col("a._v")) * (F.col("_t") - F.col("a._t")) / (F.col("b._t") - F.col("a._t"))
    return rows.select(*keys, F.col("_t").alias(t), F.when(F.col("n") >= 2, F.when(F.col("a._t") == F.col("b._t"), F.col("a._v")).otherwise(F.when(F.col("b._t") > F.col("a._t"), line))).alias(value))


def interval_overlap(left: DataFrame, right: DataFrame, keys: list[str], l0: str, l1: str, r0: str, r1: str, width: float) -> DataFrame:
    """Pairs of intervals that overlap strictly (l1 > r0 and l0 < r1) within equal keys.

    Time is cut in cells of ``width``; both sides are exploded over the cells they touch and met by key and cell,
    and a pair is kept in the cell where the later of the two begins, so that it comes once.
    """
    cells = lambda a, b: F.explode(F.sequence(F.floor(F.col(a) / width), F.floor(F.col(b) / width)))
    a = left.where(F.col(l0) <= F.col(l1)).withColumn("_cell", cells(l0, l1))
    b = right.where(F.col(r0) <= F.col(r1)).withColumn("_cell", cells(r0, r1))
    out = a.join(b, [*keys, "_cell"]).where((F.col(l1) > F.col(r0)) & (F.col(l0) < F.col(r1)))
    return out.where(F.col("_cell") == F.floor(F.greatest(l0, r0) / width)).drop("_cell")


def best_overlap(left: DataFrame, right: DataFrame, keys: list[str], left_id: str, l0: str, l1: str, r0: str, r1: str, order: str, label: str, width: float) -> DataFrame:
    """Each left interval with the label it overlaps most, ties to the first; else the one holding its middle; else 'unknown' (J11)."""
    pairs = interval_overlap(left, right, keys, l0, l1, r0, r1, width).withColumn("_o", F.least(l1, r1) - F.greatest(l0, r0))
    best = pairs.groupBy(*keys, left_id).agg(F.min_by(label, F.struct(-F.col("_o"), F.col(order))).alias("_best"))
    middle = left.withColumn("_m", (F.col(l0) + F.col(l1)) / 2).withColumn("_m2", F.col("_m"))
    inside = interval_overlap(middle.withColumn("_m2", F.col("_m") + 1e-9), right.withColumn("_r1", F.col(r1) + 1e-9), keys, "_m", "_m2", r0, "_r1", width).where((F.col("_m") >= F.col(r0)) & (F.col("_m") <= F.col(r1)))
    inside = inside.groupBy(*keys, left_id).agg(F.min_by(label, order).alias("_inside"))
    return left.join(best, [*keys, left_id], "left").join(inside, [*keys, left_id], "left").withColumn(label, F.coalesce("_best", "_inside", F.lit("unknown"))).drop("_best", "_inside")


def covering_lookup(wanted: DataFrame, provider: DataFrame, keys: list[str]) -> DataFrame:
    """wanted with the provider's columns; raises in the job when a wanted key is missing."""
    have = provider.withColumn("_have", F.lit(True))
    out = wanted.join(have, keys, "left")
    ok = F.when(F.col("_have"), True).otherwise(F.raise_error(F.concat(F.lit("no provider row for "), F.to_json(F.struct(*keys)))).cast("boolean"))
    return out.withColumn("_have", ok).where("_have").drop("_have")


def same_keys(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    """One row: whether both sides hold exactly the same keys (the strict form of J13)."""
    both = a.select(*keys).distinct().withColumn("_a", F.lit(1)).join(b.select(*keys).distinct().withColumn("_b", F.lit(1)), keys, "full")
    return both.agg(F.count_if(F.col("_b").isNull()).alias("only_a"), F.count_if(F.col("_a").isNull()).alias("only_b"), (F.count_if(F.col("_a").isNull() | F.col("_b").isNull()) == 0).alias("same"))


def nearest_match(probes: DataFrame, points: DataFrame, keys: list[str], x: str, position: str) -> DataFrame:
    """Each probe with the position of the nearest point, the smaller position on ties (J20): the last before and the first after.

    No task sees a whole key: distinct values go to range partitions, which look back and ahead by themselves; the last point
    before each partition and the first one after it come from a table of a row for each key and partition. Both looks are
    running ones, since a frame that ends with its partition is worked out anew for each row. Points without x are left out.
    """
    from framewell.sources.files import scratch

    rows = points.where(F.col(x).isNotNull()).select(*keys, F.col(x).alias("_x"), F.lit(0).alias("_n"), F.col(position).alias("_p")).union(probes.select(*keys, F.col(x), F.lit(1), F.lit(None).cast(points.schema[position].dataType)))
    rows = rows.groupBy(*keys, "_x").agg(F.sum("_n").alias("_n"), F.bool_or(F.col("_n") == 0).alias("_k"), F.min("_p").alias("_p"))
    path = scratch(probes.sparkSession)
    dealt = rows.repartitionByRange(*keys, "_x").withColumn("_part", F.spark_partition_id())
    dealt.write.parquet(path)
    dealt = probes.sparkSession.read.schema(dealt.schema).parquet(path)
    point = F.when(F.col("_k"), F.struct(F.col("_x").alias("x"), F.col("_p").alias("p")))
    running = lambda by, order, end: Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, end)
    last = lambda c, *frame: F.last(c, ignorenulls=True).over(running(*frame))
    ends = dealt.groupBy(*keys, "_part").agg(F.max(point).alias("_last"), F.min(point).alias("_first"))
    ends = ends.select(*keys, "_part", last("_last", keys, "_part", -1).alias("_before"), last("_first", keys, F.desc("_part"), -1).alias("_after")).alias("ends")
    own = dealt.select("*", last(point, ["_part", *keys], "_x", 0).alias("_a"), last(point, ["_part", *keys], F.desc("_x"), 0).alias("_b")).where("_n > 0").alias("own")
    same = F.lit(True)
    for k in ("_part", *keys):
        same = same & F.col(f"own.`{k}`").eqNullSafe(F.col(f"ends.`{k}`"))
    rows = own.join(ends, same).select(*(F.col(f"own.`{k}`") for k in keys), "_x", "_n", F.coalesce("_a", "_before").alias("a"), F.coalesce("_b", "_after").alias("b"))
    da, db = F.col("_x") - F.col("a.x"), F.col("b.x") - F.col("_x")
    pick = F.when(F.col("b").isNull() | (da < db), F.col("a.p")).when(F.col("a").isNull() | (db < da), F.col("b.p")).otherwise(F.least("a.p", "b.p"))
    return rows.select(*keys, F.col("_x").alias(x), pick.alias(position), F.explode(F.sequence(F.lit(1), F.col("_n"))).alias("_n")).drop("_n")


def overlay(schedule: DataFrame, override: DataFrame, keys: list[str], value: str, known: list[str]) -> DataFrame:
    """Schedule with overrides, which win and may add rows for known keys only."""
    over = override.join(schedule.select(*known).distinct(), known, "left_semi").withColumnRenamed(value, "_o")
    return schedule.join(over, keys, "full").withColumn(value, F.coalesce("_o", value)).drop("_o")


def cell_compare(a: DataFrame, b: DataFrame, keys: list[str], features: list[str], absolute: float, relative: float) -> DataFrame:
    """Cellwise comparison of two wide tables: keys, feature, reason where they differ."""
    long = lambda df, v: df.select(*keys, *(F.col(f).cast("double").alias(f) for f in features)).unpivot(keys, features, "feature", v)
    both = long(a, "x").join(long(b, "y"), [*keys, "feature"], "full")
    reason = F.when(F.col("x").isNull() & F.col("y").isNull(), None).when(F.col("x").isNull(), "missing_left").when(F.col("y").isNull(), "missing_right").when(F.abs(F.col("x") - F.col("y")) > absolute + relative * F.abs(F.col("y")), "value")
    return both.withColumn("reason", reason).where("reason IS NOT NULL").select(*keys, "feature", "reason")
