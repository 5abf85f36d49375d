"""Rank statistics, splits, top-k and hash order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from framewell.functions.names import free
from framewell.functions.sizes import small
from framewell.functions.values import finite


def running_sums(df: DataFrame, keys: list[str], value: str, sums: list[str]) -> DataFrame:
    """df with, for each column of ``sums``, its sum up to the row within the key in order of value (_upto) and in all (_all).

    No task sees a whole key: rows go to range partitions of (key, value), which sum by themselves; what lies before
    each partition comes from a table of one row for each key and partition. The dealt rows are written to the shared
    folder first, so both uses see the same partitions and lost executors lose nothing. NULL keys are a key.
    """
    from framewell.sources.files import scratch

    part, path = free(df, "_part"), scratch(df.sparkSession)
    dealt = df.repartitionByRange(*keys, value) if keys else df.repartitionByRange(value)
    dealt = dealt.withColumn(part, F.spark_partition_id())
    dealt.write.parquet(path)
    dealt = df.sparkSession.read.schema(dealt.schema).parquet(path)
    before = Window.partitionBy(*keys).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*keys)
    totals = dealt.groupBy(*keys, part).agg(*(F.sum(s).alias(s) for s in sums))
    totals = totals.select(*keys, part, *(F.coalesce(F.sum(s).over(before), F.lit(0)).alias(f"{s}_upto") for s in sums), *(F.sum(s).over(whole).alias(f"{s}_all") for s in sums))
    here = Window.partitionBy(part, *keys).orderBy(value).rowsBetween(Window.unboundedPreceding, 0)
    own = dealt.select(*df.columns, part, *(F.sum(s).over(here).alias(f"{s}_here") for s in sums)).alias("own")
    base = totals.alias("base")
    same = F.lit(True)
    for k in (part, *keys):
        same = same & F.col(f"own.`{k}`").eqNullSafe(F.col(f"base.`{k}`"))
    return own.join(base, same).select(*(F.col(f"own.`{c}`") for c in df.columns), *((F.col(f"own.{s}_here") + F.col(f"base.{s}_upto")).alias(f"{s}_upto") for s in sums), *(F.col(f"base.{s}_all") for s in sums))


def percentile_of(value: str, share: float) -> Column:
    """Aggregate over value counts with running sums (c, c_upto, c_all): the interpolated percentile."""
    place = F.lit(share) * (F.col("c_all") - 1)
    at = lambda i: F.max(F.when((i >= F.col("c_upto") - F.col("c")) & (i < F.col("c_upto")), F.col(value)))
    lo, hi, rest = at(F.floor(place)), at(F.ceil(place)), F.max(place - F.floor(place))
    return lo + (hi - lo) * rest


def average_rank(df: DataFrame, keys: list[str], value: str, out: str = "rank", among: DataFrame | None = None) -> DataFrame:
    """Average rank among equal values (W01), of df's rows or of those of ``among``, from which df's come.

    Ranks come from running counts of distinct values, in range partitions, and join back; a short table of them is
    broadcast. NULL values have no rank and are left out.
    """
    counts = (df if among is None else among).where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count("*").alias("c"))
    ranks = running_sums(counts, keys, value, ["c"]).select(*keys, value, (F.col("c_upto") - (F.col("c") - 1) / 2.0).alias(out))
    return df.join(small(ranks), [*keys, value])


def centred_rank(c: str) -> Column:
    """Average rank less the mean rank, over running sums of the counts c."""
    return F.col(f"{c}_upto") - (F.col(c) - 1) / 2.0 - (F.col(f"{c}_all") + 1) / 2.0


def correlation(x: Column | str, y: Column | str) -> Column:
    """Aggregate: Pearson correlation, NULL without variance (the built-in one raises under ANSI rules)."""
    return F.try_divide(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y))


def spearman(df: DataFrame, keys: list[str], x: str, y: str, least: int = 2) -> DataFrame:
    """Spearman correlation over finite pairs; NULL under ``least`` pairs or without variance."""
    rows = df.select(*keys, finite(x).alias("_x"), finite(y).alias("_y")).where("_x IS NOT NULL AND _y IS NOT NULL")
    rows = average_rank(average_rank(rows, keys, "_x", "_rx"), keys, "_y", "_ry", among=rows)
    return rows.groupBy(*keys).agg(F.count("*").alias("n"), F.when(F.count("*") >= least, correlation("_rx", "_ry")).alias("spearman"))


def mae(y: str, p: str) -> Column:
    """Aggregate: mean absolute error over finite pairs."""
    return F.avg(F.abs(finite(y) - finite(p)))


def redundant_pairs(df: DataFrame, row: str, features: list[str], threshold: float, least_finite: float = 0.5) -> DataFrame:
    """Pairs of features with |Spearman| at or over the threshold, after median fill (A26): feature_a, feature_b, spearman.

    One count of all features' values gives their shares, medians, ranks and variances. Rows join the ranks, of which
    short tables are broadcast, and each pair is one sum over them.
    """
    from framewell.sources.files import cut

    rows = df.select(*(finite(f).alias(f) for f in features))
    counts = cut(rows.unpivot([], features, "feature", "value").groupBy("feature", "value").agg(F.count("*").alias("c")))
    total = {r["feature"]: r["n"] for r in counts.groupBy("feature").agg(F.sum("c").alias("n")).collect()}
    sums = running_sums(counts.where("value IS NOT NULL"), ["feature"], "value", ["c"])
    stats = {r["feature"]: r for r in sums.groupBy("feature").agg(percentile_of("value", 0.5).alias("m"), F.count("*").alias("d"), F.max("c_all").alias("n")).collect()}
    use = [f for f in features if f in stats and stats[f]["n"] / total[f] >= least_finite and stats[f]["d"] > 1]
    pairs = [(a, b) for i, a in enumerate(use) for b in use[i + 1 :]]
    spark = df.sparkSession
    if not pairs:
        return spark.createDataFrame([], "feature_a string, feature_b string, spearman double")
    filled = [(f, stats[f]["m"], total[f] - stats[f]["n"]) for f in use if total[f] > stats[f]["n"]]
    if filled:
        known = counts.where("value IS NOT NULL").union(spark.createDataFrame(filled, counts.schema))
        sums = running_sums(known.groupBy("feature", "value").agg(F.sum("c").alias("c")), ["feature"], "value", ["c"])
    ranks = cut(sums.where(F.col("feature").isin(use)).select("feature", "value", "c", centred_rank("c").alias("r")))
    spread = {r["feature"]: r["v"] for r in ranks.groupBy("feature").agg(F.sum(F.col("c") * F.col("r") * F.col("r")).alias("v")).collect()}
    ranked = rows.select(*(F.coalesce(f, F.lit(stats[f]["m"])).alias(f) for f in use))
    for f in use:
        ranked = ranked.join(small(ranks.where(F.col("feature") == f).select(F.col("value").alias(f), F.col("r").alias(f"r_{f}"))), f)
    wide = ranked.agg(*(F.sum(F.col(f"r_{a}") * F.col(f"r_{b}")).alias(f"{i}") for i, (a, b) in enumerate(pairs)))
    found = [F.struct(F.lit(a).alias("feature_a"), F.lit(b).alias("feature_b"), F.try_divide(F.col(f"{i}"), F.lit((spread[a] * spread[b]) ** 0.5)).alias("spearman")) for i, (a, b) in enumerate(pairs)]
    return wide.select(F.explode(F.array(*found)).alias("x")).select("x.*").where(F.abs("spearman") >= threshold)


def _finite_correlation(a: str, b: str) -> Column:
    both = finite(a).isNotNull() & finite(b).isNotNull()
    return correlation(F.when(both, finite(a)), F.when(both, finite(b)))


def correlation_pairs(df: DataFrame, features: list[str], top: int) -> DataFrame:
    """Pearson correlations of all feature pairs in one pass, the strongest first."""
    pairs = [(a, b) for i, a in enumerate(features) for b in features[i + 1 :]]
    wide = df.agg(*(_finite_correlation(a, b).alias(f"{i}") for i, (a, b) in enumerate(pairs)))
    long = wide.select(F.explode(F.array(*(F.struct(F.lit(a).alias("feature_a"), F.lit(b).alias("feature_b"), F.col(f"{i}").alias("corr")) for i, (a, b) in enumerate(pairs)))).alias("x")).select("x.*")
    return long.orderBy(F.desc(F.abs("corr")), "feature_a", "feature_b").limit(top)


def numeric_features(df: DataFrame, exclude: list[str]) -> list[str]:
    """Numeric columns with at least two distinct finite values, in column order (P04): one pass."""
    names = [f.name for f in df.schema if f.dataType.typeName() in ("double", "float", "integer", "long", "short", "byte", "decimal", "boolean") and f.name not in exclude]
    row = df.agg(*(F.count_distinct(finite(n)).alias(n) for n in names)).first() if names else {}
    return [n for n in names if row[n] > 1]


def median_fill(df: DataFrame, features: list[str], fit_on: Column | None = None) -> DataFrame:
    """Features with missing values replaced by the median of the rows ``fit_on`` names (all by default)."""
    base = df if fit_on is None else df.where(fit_on)
    m = base.agg(*(F.median(finite(f)).alias(f) for f in features)).first()
    return df.withColumns({f: F.coalesce(finite(f), F.lit(m[f])) for f in features})


def top_k(df: DataFrame, keys: list[str], order: list[Column], k: int) -> DataFrame:
    """The first k rows a key in a total order, with their rank; Spark cuts groups before the shuffle."""
    return df.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("rank") <= k)


def hash_order(key: str, seed: str = "1337") -> Column:
    """A stable pseudo-random order of keys."""
    return F.sha2(F.concat(F.lit(f"{seed}::"), F.col(key).cast("string")), 256)


def numbered(df: DataFrame, order: list[Column], out: str = "rn") -> DataFrame:
    """Row numbers from 1 in a total order over all rows, without one task sorting them all.

    Range partitions are sorted by themselves; the rows before each are added from a table of a row for each.
    """
    from framewell.sources.files import scratch

    columns, path = df.columns, scratch(df.sparkSession)
    part, here, ahead = (free(df, n) for n in ("_part", "_here", "_ahead"))
    # The split is written, so that both uses see the same partitions, whatever executors are lost.
    dealt = df.repartitionByRange(*order).withColumn(part, F.spark_partition_id())
    dealt.write.parquet(path)
    dealt = df.sparkSession.read.schema(dealt.schema).parquet(path)
    counts = dealt.groupBy(part).agg(F.count("*").alias("c"))
    before = counts.select(part, (F.sum("c").over(Window.orderBy(part).rowsBetween(Window.unboundedPreceding, 0)) - F.col("c")).alias(ahead))
    rows = dealt.withColumn(here, F.row_number().over(Window.partitionBy(part).orderBy(*order))).join(before, part)
    return rows.select(*(F.col(f"`{c}`") for c in columns), (F.col(here) + F.col(ahead)).alias(out))


def time_split(df: DataFrame, t: str, tie: str, train: float, valid: float) -> DataFrame:
    """Rows with a time, split in time order at the half-even rounded shares."""
    rows = df.where(F.col(t).isNotNull())
    n = rows.count()
    import decimal

    cut = lambda x: int(decimal.Decimal(str(n * x)).quantize(0, decimal.ROUND_HALF_EVEN))
    a, b = cut(train), cut(train) + cut(valid)
    return numbered(rows, [F.col(t), F.col(tie)]).withColumn("split", F.when(F.col("rn") <= a, "train").when(F.col("rn") <= b, "valid").otherwise("test")).drop("rn")


def group_time_split(df: DataFrame, group: str, t: str, train: float, valid: float) -> DataFrame:
    """Whole groups by their first time, ties by name; a missing time is the epoch."""
    first = df.groupBy(group).agg(F.min(F.coalesce(F.col(t), F.expr("timestamp'1970-01-01'"))).alias("_t"))
    n = first.count()
    ranked = numbered(first, [F.col("_t"), F.col(group)])
    split = F.when(F.col("rn") <= int(n * train), "train").when(F.col("rn") <= int(n * (train + valid)), "valid").otherwise("test")
    return df.join(ranked.select(group, split.alias("split")), group)


def lightest_folds(sizes: list[tuple[int, int]], folds: int) -> list[tuple[int, int, int, list[int]]]:
    """Where greedy balancing puts groups: (size, first, end, order) says that of the groups of a size, in order, those numbered
    first .. end - 1 go to the folds of ``order`` in turn.

    sizes holds (size, number of groups), largest first. Each group goes to the fold with the fewest rows, the first of
    equals. With groups of one size a fold of load L takes its j-th at level L + j * size, so folds take turns, and the
    turn only changes where the level reaches another fold: at most one stretch a fold and size, however many groups.
    """
    load, out = [0] * folds, []
    for size, groups in sizes:
        at, taken = 0, [0] * folds
        levels = sorted(range(folds), key=lambda f: (load[f], f))
        for m in range(1, folds + 1):
            if at == groups:
                break
            active, before = levels[:m], groups
            if m < folds:
                # Places before the next fold's own level; of equal levels the first fold goes first.
                new = levels[m]
                before = sum(-(-(load[new] - load[f] + (f < new)) // size) for f in active)
            end = min(groups, before)
            if end > at:
                turn = sorted(active, key=lambda f: (load[f] + taken[f] * size, f))
                out.append((size, at, end, turn))
                for i, f in enumerate(turn):
                    taken[f] += (end - at - i + m - 1) // m
                at = end
        load = [x + n * size for x, n in zip(load, taken)]
    return out


def grouped_folds(df: DataFrame, group: str, folds: int) -> DataFrame:
    """A fold for each group: the largest groups first, each to the fold with the fewest rows so far.

    Only the number of groups of each size comes to the driver. Groups of one size go by their key.
    """
    sizes = df.groupBy(group).agg(F.count("*").alias("_c"))
    counted = sorted(((r["_c"], r["n"]) for r in sizes.groupBy("_c").agg(F.count("*").alias("n")).collect()), reverse=True)
    before, offset = {}, 0
    for size, n in counted:
        before[size], offset = offset, offset + n
    plan = [(size, before[size] + 1, first, end, turn) for size, first, end, turn in lightest_folds(counted, folds)]
    plan = df.sparkSession.createDataFrame(plan, "_c long, _before long, _first long, _end long, _turn array<int>")
    rank = numbered(sizes, [F.desc("_c"), F.col(group)]).join(small(plan), "_c").withColumn("_i", F.col("rn") - F.col("_before"))
    rank = rank.where((F.col("_i") >= F.col("_first")) & (F.col("_i") < F.col("_end")))
    turn = F.get("_turn", F.pmod(F.col("_i") - F.col("_first"), F.size("_turn")).cast("int"))
    return df.join(rank.select(F.col(group).alias("_group"), turn.alias("fold")), F.col(group).eqNullSafe(F.col("_group"))).drop("_group")


def allocate(weights: DataFrame, name: str, weight: str, target: int) -> DataFrame:
    """Whole shares of a target: floors, and one more for the largest weights until it is used up."""
    whole = Window.partitionBy()
    share = F.floor(F.lit(target) * F.col(weight) / F.sum(weight).over(whole))
    rows = weights.withColumn("_f", share).withColumn("_left", F.lit(target) - F.sum("_f").over(whole))
    rank = F.row_number().over(Window.partitionBy().orderBy(F.desc(weight), name))
    return rows.withColumn("_r", rank).select(name, (F.col("_f") + (F.col("_r") <= F.col("_left")).cast("int")).cast("bigint").alias("count"))


def active_cost(df: DataFrame, keys: list[str], valid_from: str, valid_to: str, at: Column, branch: str, preferred: str) -> DataFrame:
    """The row in force at a time: preferred branch, else the first by name, newest first."""
    live = df.where((F.col(valid_from) <= at) & (F.col(valid_to).isNull() | (F.col(valid_to) > at)))
    return top_k(live, keys, [(F.col(branch) != preferred).cast("int").asc(), F.col(branch), F.desc(valid_from)], 1).drop("rank")


def batch_size(free: Column, headroom: Column, per_task: Column, cap: int) -> Column:
    """Tasks that fit in free memory less headroom, between 1 and the cap."""
    return F.greatest(F.lit(1), F.least(F.lit(cap), F.floor(F.try_divide(free - headroom, per_task)))).cast("bigint")
