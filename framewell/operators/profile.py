"""Feature profiling, quality, drift and report aggregates (A01-A20, A25, P08 of the survey)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from framewell.functions.names import free
from framewell.functions.sizes import small
from framewell.functions.values import finite
from framewell.operators.ranks import percentile_of, running_sums


def to_long(df: DataFrame, keys: list[str], features: list[str]) -> DataFrame:
    """One row for each key and feature: keys, feature, value (double)."""
    return df.select(*keys, *(F.col(f).cast("double").alias(f) for f in features)).unpivot(keys, features, "feature", "value")


def array_summary(df: DataFrame, keys: list[str], value: str = "value") -> DataFrame:
    """Finite values only: mean, std (population), min, max, p10, p50, p90, count; is_empty and all_non_finite flags."""
    v = finite(value)
    base = df.groupBy(*keys).agg(
        F.avg(v).alias("mean"), F.stddev_pop(v).alias("std"), F.min(v).alias("min"), F.max(v).alias("max"),
        F.count(v).alias("n"), (F.count(F.col(value)) == 0).alias("is_empty"), ((F.count(F.col(value)) > 0) & (F.count(v) == 0)).alias("all_non_finite"),
    )
    return with_percentiles(base, df.select(*keys, v.alias("v")), keys, {"p10": 0.1, "p50": 0.5, "p90": 0.9})


def with_percentiles(base: DataFrame, rows: DataFrame, keys: list[str], shares: dict[str, float], distinct: str | None = None) -> DataFrame:
    """base with exact percentiles of rows(keys, v), and the number of distinct values if named.

    Values are counted first, which combines before the shuffle, and counts are summed in range partitions: no group's
    values meet in one task.
    """
    counts = rows.where("v IS NOT NULL").groupBy(*keys, "v").agg(F.count("*").alias("c"))
    found = running_sums(counts, keys, "v", ["c"]).groupBy(*keys).agg(*(percentile_of("v", s).alias(n) for n, s in shares.items()), *([F.count("*").alias(distinct)] if distinct else []))
    a, b, same = base.alias("a"), found.alias("b"), F.lit(True)
    for k in keys:
        same = same & F.col(f"a.`{k}`").eqNullSafe(F.col(f"b.`{k}`"))
    return a.join(b, same, "left").select(*(F.col(f"a.`{c}`") for c in base.columns), *(F.col(f"b.{n}") for n in shares), *([F.coalesce(f"b.{distinct}", F.lit(0)).alias(distinct)] if distinct else []))


def health(nan_rate: Column, oor_rate: Column, coverage: Column, constant: Column) -> Column:
    """100 less 40 nan, 30 out of range, 10 uncovered, 20 constant, clipped to 0..100."""
    raw = 100 - 40 * nan_rate - 30 * oor_rate - 10 * (1 - coverage) - 20 * constant.cast("double")
    return F.least(F.lit(100.0), F.greatest(F.lit(0.0), raw))


def severity(score: Column, high: float = 40, medium: float = 70) -> Column:
    return F.when(score < high, "high").when(score < medium, "medium").otherwise("low")


def feature_quality(long: DataFrame, keys: list[str], ranges: DataFrame | None = None) -> DataFrame:
    """Per key: rows, coverage, nan and inf rates over non-empty, distinct, moments, percentiles, out-of-range rate, health.

    ``value`` NULL is empty. ``ranges`` gives keys, lo, hi; a feature without a range is never out of it.
    """
    if ranges is not None:
        long = long.join(small(ranges), keys, "left")
    else:
        long = long.withColumns({"lo": F.lit(None).cast("double"), "hi": F.lit(None).cast("double")})
    v, raw = finite("value"), F.col("value")
    out = long.groupBy(*keys).agg(
        F.count("*").alias("n_rows"), F.count(raw).alias("n_present"), F.count(F.when(F.isnan(raw), 1)).alias("n_nan"),
        F.count(F.when(F.abs(raw) == float("inf"), 1)).alias("n_inf"), F.count(v).alias("n_finite"),
        F.avg(v).alias("mean"), F.stddev_pop(v).alias("std"), F.count(F.when((v < F.col("lo")) | (v > F.col("hi")), 1)).alias("n_oor"),
    )
    out = with_percentiles(out, long.select(*keys, v.alias("v")), keys, {"p01": 0.01, "p50": 0.5, "p99": 0.99}, "n_distinct")
    share = lambda a, b: F.coalesce(F.try_divide(F.col(a).cast("double"), F.col(b)), F.lit(0.0))
    out = out.withColumns({"coverage": share("n_present", "n_rows"), "nan_rate": share("n_nan", "n_present"), "inf_rate": share("n_inf", "n_present"), "oor_rate": share("n_oor", "n_finite"), "is_constant": F.col("n_distinct") <= 1})
    out = out.withColumn("health", health(F.col("nan_rate"), F.col("oor_rate"), F.col("coverage"), F.col("is_constant")))
    return out.withColumn("severity", severity(F.col("health"))).drop("n_inf", "n_oor", "n_nan")


def ks_two_sample(a: DataFrame, b: DataFrame, keys: list[str], value: str = "value") -> DataFrame:
    """Kolmogorov-Smirnov distance per key over finite values; NULL unless both sides have two.

    Both sides are first counted by distinct value, which combines before the shuffle.
    """
    side = lambda df, x, y: df.select(*keys, finite(value).alias("v"), F.lit(x).alias("na"), F.lit(y).alias("nb")).where("v IS NOT NULL")
    counts = side(a, 1, 0).union(side(b, 0, 1)).groupBy(*keys, "v").agg(F.sum("na").alias("na"), F.sum("nb").alias("nb"))
    steps = running_sums(counts, keys, "v", ["na", "nb"])
    gap = F.max(F.abs(F.try_divide(F.col("na_upto").cast("double"), F.col("na_all")) - F.try_divide(F.col("nb_upto").cast("double"), F.col("nb_all"))))
    # The medians of both sides come from the same running sums.
    return steps.groupBy(*keys).agg(F.when((F.max("na_all") >= 2) & (F.max("nb_all") >= 2), gap).alias("ks"), F.max("na_all").alias("n_a"), F.max("nb_all").alias("n_b"), _side_median("na").alias("p50_a"), _side_median("nb").alias("p50_b"))


def _side_median(c: str) -> Column:
    """Aggregate over running sums of c: the interpolated median of the side that c counts."""
    place = (F.col(f"{c}_all") - 1) / 2
    at = lambda i: F.max(F.when((i >= F.col(f"{c}_upto") - F.col(c)) & (i < F.col(f"{c}_upto")), F.col("v")))
    return (at(F.floor(place)) + at(F.ceil(place))) / 2


def drift(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    """Keys on both sides: coverage, nan rate, mean and median differences, KS, score and severity."""
    one = lambda df, s: df.groupBy(*keys).agg((F.count("value") / F.count("*")).alias(f"coverage_{s}"), F.coalesce(F.try_divide(F.count(F.when(F.isnan("value"), 1)).cast("double"), F.count("value")), F.lit(0.0)).alias(f"nan_rate_{s}"), F.avg(finite("value")).alias(f"mean_{s}"))
    out = one(a, "a").join(one(b, "b"), keys).join(ks_two_sample(a, b, keys), keys)
    score = 100 * (0.6 * F.coalesce("ks", F.lit(0.0)) + 0.25 * F.abs(F.col("coverage_a") - F.col("coverage_b")) + 0.15 * F.abs(F.col("nan_rate_a") - F.col("nan_rate_b")))
    out = out.withColumns({"mean_diff": F.col("mean_b") - F.col("mean_a"), "p50_diff": F.col("p50_b") - F.col("p50_a"), "score": score})
    return out.withColumn("severity", F.when(F.col("score") >= 55, "high").when(F.col("score") >= 30, "medium").otherwise("low"))


def emotion_summary(df: DataFrame, keys: list[str], valence: str = "valence", arousal: str = "arousal", chances: str = "chances", micro: str | None = None) -> DataFrame:
    """Stress, confidence, tension and nervousness of a valence and arousal series (L14), each a mean of shares in 0..1.

    ``chances`` maps emotion names to probabilities, a missing one is 0, as is a missing valence or arousal. ``micro`` is
    the rate of microexpressions a second, constant in a key, or none. One aggregation a key; nothing is collected.
    """
    v, a = F.coalesce(finite(valence), F.lit(0.0)), F.coalesce(finite(arousal), F.lit(0.0))
    p = lambda *names: F.avg(sum((F.coalesce(F.try_element_at(F.col(chances), F.lit(n)), F.lit(0.0)) for n in names), F.lit(0.0)))
    share = lambda c: F.avg(c.cast("double"))
    sums = df.groupBy(*keys).agg(
        F.count("*").alias("n"), ((F.var_pop(v) + F.var_pop(a)) / 2).alias("_var"), share((a > 0.3) & (v < 0)).alias("_low"), p("Fear", "Anger").alias("_fa"), share(v > 0.2).alias("_pos"),
        share((a > -0.2) & (a < 0.5)).alias("_mid"), p("Happy", "Neutral").alias("_hn"), share(a > 0.4).alias("_high"), p("Sad", "Anger", "Fear").alias("_neg"), p("Fear", "Surprise").alias("_fs"),
        (F.max(micro) if micro else F.lit(None).cast("double")).alias("_micro"),
    )
    top = lambda c, by: F.least(F.lit(1.0), c * by)
    c = F.col

    def mean(parts: list[Column], rate: float | None = None) -> Column:
        plain = sum(parts, F.lit(0.0)) / len(parts)
        with_micro = (sum(parts, F.lit(0.0)) + F.least(F.lit(1.0), c("_micro") / rate)) / (len(parts) + 1) if rate else plain
        return F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.when(c("_micro").isNotNull(), with_micro).otherwise(plain)))

    return sums.select(
        *keys, "n", mean([c("_low"), c("_fa"), top(c("_var"), 2.0)], 2.0).alias("stress"), mean([c("_pos"), c("_mid"), c("_hn"), 1 - top(c("_var"), 1.0)]).alias("confidence"),
        mean([c("_high"), 1 - top(c("_var"), 2.0), c("_neg")]).alias("tension"), mean([top(c("_var"), 3.0), c("_high"), c("_fs")], 1.5).alias("nervousness"),
    )


def first_non_empty(df: DataFrame, keys: list[str], order: str, columns: list[str]) -> DataFrame:
    """Per key and column the first value, in order, that is not empty text."""
    keep = lambda c: F.nullif(F.trim(F.col(c).cast("string")), F.lit(""))
    return df.groupBy(*keys).agg(*(F.min_by(keep(c), F.when(keep(c).isNotNull(), F.col(order))).alias(c) for c in columns))


def nearest_rank_table(df: DataFrame, keys: list[str], value: str, percents: list[float]) -> DataFrame:
    """The sorted value at the half-even rounded index p / 100 (n - 1) (A12), by value counts and running sums: keys, percent, value."""
    counts = running_sums(df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count("*").alias("c")), keys, value, ["c"])
    want = counts.withColumn("percent", F.explode(F.array(*(F.lit(float(p)) for p in percents))))
    at = F.bround(F.col("percent") / 100.0 * (F.col("c_all") - 1), 0)
    return want.where((at < F.col("c_upto")) & (at >= F.col("c_upto") - F.col("c"))).select(*keys, "percent", value)


def best_run(df: DataFrame, video: str, run: str, ok: Column) -> DataFrame:
    """Per video the run with most ok components, ties to the first run id (A10)."""
    rich = df.groupBy(video, run).agg(F.count(F.when(ok, 1)).alias("richness"))
    best = Window.partitionBy(video).orderBy(F.desc("richness"), run)
    place = free(rich, "_place")
    return rich.withColumn(place, F.row_number().over(best)).where(F.col(place) == 1).drop(place)


def fan_out_counts(df: DataFrame, category: str, fields: list[str]) -> DataFrame:
    """Counts of each field's values by category and for all of them (A15): category NULL becomes "all"."""
    long = df.select(category, *(F.col(f).cast("string").alias(f) for f in fields)).unpivot([category], fields, "field", "item")
    return long.groupingSets([[F.col(category), F.col("field"), F.col("item")], [F.col("field"), F.col("item")]], category, "field", "item").agg(F.count("*").alias("n"), F.grouping(category).alias("g")).select(F.when(F.col("g") == 1, F.lit("all")).otherwise(F.col(category)).alias("category"), "field", "item", "n")


def concentration(df: DataFrame, channel: str) -> DataFrame:
    """Distinct channels, the top one's rows and share, rows a channel."""
    per = df.where(F.col(channel).isNotNull()).groupBy(channel).agg(F.count("*").alias("c"))
    return per.agg(F.count("*").alias("n_channels"), F.max("c").alias("top_count"), (F.max("c") / F.sum("c")).alias("top_share"), (F.sum("c") / F.count("*")).alias("per_channel"))


def readiness(df: DataFrame, key: str, index: str, wanted: list[int]) -> DataFrame:
    """How many keys have each index, and all of them."""
    per = df.groupBy(key).agg(*(F.max((F.col(index) == i).cast("int")).alias(f"h{i}") for i in wanted))
    every = " AND ".join(f"h{i} = 1" for i in wanted)
    return per.agg(F.count("*").alias("n_keys"), *(F.sum(f"h{i}").alias(f"has_{i}") for i in wanted), F.count(F.when(F.expr(every), 1)).alias("has_all"))
