"""Ordered-sequence operators (W02-W27, A39-A42 of the survey): windows by key, never one over all rows."""

from __future__ import annotations

import bisect

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def _w(keys: list[str], *order: str):
    return Window.partitionBy(*keys).orderBy(*order)


def lag_change(df: DataFrame, keys: list[str], t: str, value: str, first_zero: bool = False, least_dt: float = 1e-3) -> DataFrame:
    """Difference to the row before and its rate over max(dt, least_dt); NULL first, or 0 with first_zero."""
    w = _w(keys, t)
    d = F.col(value) - F.lag(value).over(w)
    rate = d / F.greatest(F.col(t) - F.lag(t).over(w), F.lit(least_dt))
    zero = (lambda c: F.coalesce(c, F.lit(0.0))) if first_zero else (lambda c: c)
    return df.withColumns({"delta": zero(d), "rate": zero(rate)})


def position(df: DataFrame, keys: list[str], *order: str) -> DataFrame:
    """Place in the sequence from 0 to 1; a single row is 0."""
    n = F.count("*").over(Window.partitionBy(*keys))
    return df.withColumn("position", F.coalesce(F.try_divide((F.row_number().over(_w(keys, *order)) - 1).cast("double"), n - 1), F.lit(0.0)))


def transitions(df: DataFrame, keys: list[str], order: str, value: str) -> DataFrame:
    """Rows whose value differs from the one before, both present."""
    return df.withColumn("previous", F.lag(value).over(_w(keys, order))).where(F.col("previous").isNotNull() & F.col(value).isNotNull() & (F.col("previous") != F.col(value)))


def switches(df: DataFrame, keys: list[str], t: str, flag: Column) -> DataFrame:
    """Changes of a flag, per row step and per minute."""
    rows = df.select(*keys, t, flag.cast("int").alias("_f"))
    rows = rows.withColumn("_s", (F.col("_f") != F.lag("_f").over(_w(keys, t))).cast("int"))
    span = F.max(t) - F.min(t)
    return rows.groupBy(*keys).agg(F.coalesce(F.sum("_s"), F.lit(0)).alias("switches"), F.coalesce(F.try_divide(F.sum("_s").cast("double"), F.count("*") - 1), F.lit(0.0)).alias("rate"), F.when(span > 0, F.coalesce(F.sum("_s"), F.lit(0)) * 60.0 / span).alias("per_minute"))


def islands(df: DataFrame, keys: list[str], order: list[str], new: Column, out: str = "island") -> DataFrame:
    """Numbers runs: ``new`` tells where one begins (the first row always does)."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_n", F.coalesce(new, F.lit(True)).cast("int")).withColumn(out, F.sum("_n").over(w.rowsBetween(Window.unboundedPreceding, 0))).drop("_n")


def label_segments(df: DataFrame, keys: list[str], order: str, label: str) -> DataFrame:
    """Runs of one label: first and last order value and length."""
    rows = islands(df, keys, [order], F.col(label) != F.lag(label).over(_w(keys, order)))
    return rows.groupBy(*keys, "island").agg(F.first(label).alias(label), F.min(order).alias("first"), F.max(order).alias("last"), F.count("*").alias("n"))


def rolling_anomalies(df: DataFrame, keys: list[str], order: str, value: str, half: int = 2, z: float = 2.0, gap: int = 5) -> DataFrame:
    """Rows over z centred rolling standard deviations (sample), grouped where at most ``gap`` rows apart."""
    w = Window.partitionBy(*keys).orderBy(order)
    frame = w.rowsBetween(-half, half)
    rows = df.withColumns({"_i": F.row_number().over(w), "_z": F.try_divide(F.abs(F.col(value) - F.avg(value).over(frame)), F.stddev_samp(value).over(frame))})
    hits = rows.where(F.col("_z") > z)
    return islands(hits, keys, ["_i"], F.col("_i") - F.lag("_i").over(_w(keys, "_i")) > gap).groupBy(*keys, "island").agg(F.min("_i").alias("first"), F.max("_i").alias("last"), F.count("*").alias("n"))


def uniform_segments(df: DataFrame, keys: list[str], order: str, parts: int) -> DataFrame:
    """Segments of n // parts rows, the remainder in the last (W10); not ntile."""
    n = F.count("*").over(Window.partitionBy(*keys))
    i = F.row_number().over(_w(keys, order)) - 1
    each = F.greatest(F.floor(n / parts), F.lit(1))
    return df.withColumn("segment", F.least(F.floor(i / each), F.lit(parts - 1)).cast("int"))


def z_score(df: DataFrame, keys: list[str], value: str, out: str, eps: float = 1e-6) -> DataFrame:
    """(x - mean) / (population std + eps) within the key."""
    w = Window.partitionBy(*keys)
    return df.withColumn(out, (F.col(value) - F.avg(value).over(w)) / (F.stddev_pop(value).over(w) + eps))


def local_peaks(df: DataFrame, keys: list[str], t: str, value: str) -> DataFrame:
    """Rows with value >= the one before and > the one after."""
    w = _w(keys, t)
    return df.withColumns({"_a": F.lag(value).over(w), "_b": F.lead(value).over(w)}).where((F.col(value) >= F.col("_a")) & (F.col(value) > F.col("_b"))).drop("_a", "_b")


def suppress_by_time(peaks: DataFrame, keys: list[str], t: str, value: str, gap: float) -> DataFrame:
    """Greedy: the highest peak first, none nearer than gap to one kept (W12, W27); ties to the earlier. Sequential by key."""
    schema = peaks.select(*keys, t, value).schema

    def keep(pdf: pd.DataFrame) -> pd.DataFrame:
        chosen: list[float] = []  # sorted, so that only the neighbours of a time can be too near
        rows = []
        order = pdf.sort_values([value, t], ascending=[False, True])
        for i, at in zip(order.index, order[t]):
            p = bisect.bisect_left(chosen, at)
            if all(abs(at - c) >= gap for c in chosen[max(p - 1, 0) : p + 1]):
                chosen.insert(p, at)
                rows.append(i)
        return pdf.loc[rows]

    return peaks.select(*keys, t, value).groupBy(*keys).applyInPandas(keep, schema)


def hook_window(df: DataFrame, keys: list[str], t: str, value: str, seconds: float = 5.0, share: float = 0.15, least: int = 3) -> DataFrame:
    """Statistics of the opening: min(seconds, share of the length), at least ``least`` rows."""
    whole = Window.partitionBy(*keys)
    start, end = F.min(t).over(whole), F.max(t).over(whole)
    rows = df.withColumns({"_i": F.row_number().over(_w(keys, t)), "_end": start + F.least(F.lit(seconds), share * (end - start))})
    rows = rows.withColumn("_inside", F.col(t) <= F.col("_end")).withColumn("_n", F.sum(F.col("_inside").cast("int")).over(whole))
    return rows.where(F.col("_inside") | ((F.col("_n") < least) & (F.col("_i") <= least))).groupBy(*keys).agg(F.count("*").alias("n"), F.avg(value).alias("mean"), F.max(value).alias("max"), F.stddev_pop(value).alias("std"))


def climax(df: DataFrame, keys: list[str], t: str, value: str) -> DataFrame:
    """The first maximum with its place from 0 to 1."""
    rows = position(df.where(F.col(value).isNotNull()), keys, t)
    return rows.groupBy(*keys).agg(F.max(value).alias("peak"), F.min_by("position", F.struct((-F.col(value)).alias("v"), F.col(t).alias("t"))).alias("position"))


def density_bins(df: DataFrame, keys: list[str], t: str, duration: float, width: float) -> DataFrame:
    """Population variance of events per second over all tumbling bins, empty ones included."""
    bins = int(-(-duration // width))
    counts = df.groupBy(*keys, F.least(F.floor(F.col(t) / width), F.lit(bins - 1)).alias("bin")).agg(F.count("*").alias("c"))
    frame = df.select(*keys).distinct().select(*keys, F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(bins - 1).cast("bigint"))).alias("bin"))
    return frame.join(counts, [*keys, "bin"], "left").groupBy(*keys).agg(F.var_pop(F.coalesce("c", F.lit(0)) / width).alias("density_var"), F.sum("c").alias("events"))


def uniform_bins(df: DataFrame, keys: list[str], t: str, value: str, duration: float, bins: int) -> DataFrame:
    """Mean, max, p50, p90 of K time bins with a mask for empty ones; a value on an edge is in the lower bin."""
    width = duration / bins
    at = F.greatest(F.lit(0), F.least(F.ceil(F.col(t) / width) - 1, F.lit(bins - 1))).cast("bigint")
    stats = df.groupBy(*keys, at.alias("bin")).agg(F.avg(value).alias("mean"), F.max(value).alias("max"), F.percentile(value, F.lit(0.5)).alias("p50"), F.percentile(value, F.lit(0.9)).alias("p90"))
    frame = df.select(*keys).distinct().select(*keys, F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(bins - 1).cast("bigint"))).alias("bin"))
    return frame.join(stats, [*keys, "bin"], "left").withColumn("mask", F.col("mean").isNotNull().cast("int"))


def plan_windows(df: DataFrame, length: str, window: int, hop: int, most: int) -> DataFrame:
    """Starts of sliding windows: every hop, the last one too, thinned evenly to ``most`` keeping first and last."""
    last = F.greatest(F.col(length) - window, F.lit(0))
    starts = F.array_distinct(F.concat(F.sequence(F.lit(0).cast("bigint"), last.cast("bigint"), F.lit(hop).cast("bigint")), F.array(last.cast("bigint"))))
    n = F.size("_s")
    thin = F.array_distinct(F.transform(F.sequence(F.lit(0), F.lit(most - 1)), lambda i: F.get(F.col("_s"), F.bround(i * (n - 1) / F.lit(float(most - 1)), 0).cast("int"))))
    return df.withColumn("_s", starts).withColumn("start", F.explode(F.when(n > most, thin).otherwise(F.col("_s")))).drop("_s")


def union_windows(windows: DataFrame, frames: DataFrame, keys: list[str], start: str, size: int, frame: str, place: str) -> DataFrame:
    """Windows of frames as ranges of places in the union of sampled frames, equal ranges once."""
    want = windows.withColumn("_f", F.explode(F.sequence(F.col(start), F.col(start) + (size - 1))))
    hit = want.join(frames.select(*keys, F.col(frame).alias("_f"), place), [*keys, "_f"])
    return hit.groupBy(*keys, start).agg(F.min(place).alias("lo"), F.max(place).alias("hi"), F.count("*").alias("n")).groupBy(*keys, "lo", "hi").agg(F.min(start).alias(start), F.max("n").alias("n"))


def block_means(df: DataFrame, keys: list[str], order: str, value: str, blocks: int = 10) -> DataFrame:
    """Least mean of blocks of max(1, round(n / blocks)) rows."""
    n = F.count("*").over(Window.partitionBy(*keys))
    size = F.greatest(F.lit(1), F.bround(n / F.lit(float(blocks)), 0))
    rows = df.withColumn("_b", F.floor((F.row_number().over(_w(keys, order)) - 1) / size))
    return rows.groupBy(*keys, "_b").agg(F.avg(value).alias("_m")).groupBy(*keys).agg(F.min("_m").alias("least_mean"), F.count("*").alias("blocks"))


def prefix_budget(df: DataFrame, keys: list[str], order: str, size: Column, cap: int) -> DataFrame:
    """Rows in order until the next would exceed the cap."""
    return df.withColumn("_t", F.sum(size).over(_w(keys, order).rowsBetween(Window.unboundedPreceding, 0))).where(F.col("_t") <= cap).drop("_t")


def decreasing(df: DataFrame, keys: list[str], order: str, value: Column) -> DataFrame:
    """Whether a value ever falls below the last finite one before it."""
    rows = df.select(*keys, order, value.alias("_v"))
    before = F.last("_v", ignorenulls=True).over(_w(keys, order).rowsBetween(Window.unboundedPreceding, -1))
    return rows.withColumn("_d", F.col("_v") < before).groupBy(*keys).agg(F.coalesce(F.bool_or("_d"), F.lit(False)).alias("decreasing"))


def running_balance(df: DataFrame, keys: list[str], order: list[str], amount: str) -> DataFrame:
    """Balance after each entry."""
    return df.withColumn("balance", F.sum(amount).over(Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)))


def smoothness(df: DataFrame, keys: list[str], t: str, value: str, jump: float) -> DataFrame:
    """Mean absolute second difference and number of steps over ``jump``."""
    w = _w(keys, t)
    rows = df.withColumn("_d", F.col(value) - F.lag(value).over(w))
    rows = rows.withColumn("_dd", F.col("_d") - F.lag("_d").over(w))
    return rows.groupBy(*keys).agg(F.avg(F.abs("_dd")).alias("smoothness"), F.count_if(F.abs("_d") > jump).alias("jumps"))


def trend(df: DataFrame, keys: list[str], t: str, value: str) -> DataFrame:
    """Least-squares slope and intercept."""
    return df.groupBy(*keys).agg(F.regr_slope(value, t).alias("slope"), F.regr_intercept(value, t).alias("intercept"))


def periodicity(df: DataFrame, keys: list[str], order: str, value: str) -> DataFrame:
    """Strongest period of each sequence by its Fourier transform, in rows, and its share of the power."""
    import numpy as np

    key_schema = ", ".join(f"{k} {df.schema[k].dataType.simpleString()}" for k in keys)

    def strongest(pdf: pd.DataFrame) -> pd.DataFrame:
        x = pdf.sort_values(order)[value].to_numpy(float)
        out = pdf[keys].head(1).assign(period=None, power=None)
        if len(x) >= 4 and np.isfinite(x).all() and x.std() > 0:
            p = np.abs(np.fft.rfft(x - x.mean())) ** 2
            k = int(p[1:].argmax()) + 1
            out = out.assign(period=len(x) / k, power=float(p[k] / p[1:].sum()))
        return out

    return df.select(*keys, order, value).groupBy(*keys).applyInPandas(strongest, f"{key_schema}, period double, power double")


def intervals(df: DataFrame, keys: list[str], t: str) -> DataFrame:
    """Gaps between events: mean, std (population), min, max, median, regularity 1 / (1 + cv), tempo."""
    rows = df.withColumn("_d", F.col(t) - F.lag(t).over(_w(keys, t))).where("_d > 0")
    cv = F.stddev_pop("_d") / F.avg("_d")
    return rows.groupBy(*keys).agg(F.count("*").alias("n"), F.avg("_d").alias("mean"), F.stddev_pop("_d").alias("std"), F.min("_d").alias("min"), F.max("_d").alias("max"), F.median("_d").alias("median"), (1 / (1 + cv)).alias("regularity"), (60 / F.median("_d")).alias("tempo"))


def dominant(df: DataFrame, keys: list[str], order: str, label: str, weight: str) -> DataFrame:
    """Most frequent label, ties to the first seen, and its share of the weight."""
    per = df.groupBy(*keys, label).agg(F.count("*").alias("_c"), F.min(order).alias("_f"), F.sum(weight).alias("_w"))
    return per.groupBy(*keys).agg(F.min_by(label, F.struct((-F.col("_c")).alias("c"), F.col("_f").alias("f"))).alias("dominant"), F.try_divide(F.min_by("_w", F.struct((-F.col("_c")).alias("c"), F.col("_f").alias("f"))), F.sum("_w")).alias("stability"))


def shape(df: DataFrame, keys: list[str], value: str, bins: int = 16, lo: float = 0.0, hi: float = 100.0) -> DataFrame:
    """Skewness, kurtosis (excess, population), histogram entropy and share over median + 3 MAD."""
    stats = df.groupBy(*keys).agg(F.skewness(value).alias("skew"), F.kurtosis(value).alias("kurtosis"), F.median(value).alias("_m"))
    hist = df.groupBy(*keys, F.width_bucket(F.col(value), F.lit(lo), F.lit(hi), F.lit(bins)).alias("_b")).agg(F.count("*").alias("_c"))
    p = F.col("_c") / F.sum("_c").over(Window.partitionBy(*keys))
    entropy = hist.withColumn("_p", p).groupBy(*keys).agg((-F.sum(F.col("_p") * F.ln("_p"))).alias("entropy"))
    dev = df.join(stats.select(*keys, "_m"), keys).withColumn("_d", F.abs(F.col(value) - F.col("_m")))
    mad = dev.groupBy(*keys).agg(F.median("_d").alias("_mad"))
    high = dev.join(mad, keys).groupBy(*keys).agg(F.avg((F.col(value) > F.col("_m") + 3 * F.col("_mad")).cast("int")).alias("high_share"))
    return stats.drop("_m").join(entropy, keys).join(high, keys)


def circular(df: DataFrame, keys: list[str], angle: Column) -> DataFrame:
    """Circular mean and standard deviation of angles in radians."""
    a = df.groupBy(*keys).agg(F.avg(F.sin(angle)).alias("_s"), F.avg(F.cos(angle)).alias("_c"))
    r = F.sqrt(F.col("_s") ** 2 + F.col("_c") ** 2)
    return a.select(*keys, F.atan2("_s", "_c").alias("mean"), F.when(r > 0, F.sqrt(-2 * F.ln(F.least(r, F.lit(1.0))))).alias("std"))


def otsu(df: DataFrame, keys: list[str], value: str, bins: int = 128, default: float = 0.97) -> DataFrame:
    """Otsu threshold over a histogram of [0, 1], the default where there is none."""
    b = F.least(F.floor(F.col(value) * bins), F.lit(bins - 1))
    hist = df.where((F.col(value) >= 0) & (F.col(value) <= 1)).groupBy(*keys, b.alias("b")).agg(F.count("*").alias("c")).withColumn("x", (F.col("b") + 0.5) / bins)
    upto, whole = Window.partitionBy(*keys).orderBy("b").rowsBetween(Window.unboundedPreceding, 0), Window.partitionBy(*keys)
    hist = hist.withColumns({"w0": F.sum("c").over(upto), "m0": F.sum(F.col("c") * F.col("x")).over(upto), "n": F.sum("c").over(whole), "m": F.sum(F.col("c") * F.col("x")).over(whole)})
    w1 = F.col("n") - F.col("w0")
    between = F.when((F.col("w0") > 0) & (w1 > 0), F.col("w0") * w1 * (F.col("m0") / F.col("w0") - (F.col("m") - F.col("m0")) / F.nullif(w1, F.lit(0))) ** 2)
    best = hist.withColumn("v", F.round(between, 9)).groupBy(*keys).agg(F.min_by("x", F.when(F.col("v").isNotNull(), F.struct((-F.col("v")).alias("v"), F.col("b").alias("b")))).alias("t"))
    return best.select(*keys, F.coalesce("t", F.lit(default)).alias("threshold"))


def chunk_by_budget(df: DataFrame, keys: list[str], order: str, size: str, budget: int, overlap: int) -> DataFrame:
    """Greedy chunks of consecutive rows up to a budget, each repeating the last ``overlap`` rows of the one before.

    Sequential by key; rows stream in order, so memory holds one chunk.
    """
    schema = ", ".join(f"{k} {df.schema[k].dataType.simpleString()}" for k in keys) + ", chunk int, first long, last long, total long, n int"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, held, chunk, out = None, [], 0, []

        def close() -> None:
            nonlocal chunk
            out.append((*key, chunk, held[0][0], held[-1][0], sum(s for _, s in held), len(held)))
            chunk += 1

        for pdf in batches:
            for row in pdf[[*keys, order, size]].itertuples(index=False):
                k, at, n = tuple(row[: len(keys)]), row[-2], row[-1]
                if k != key:
                    if held:
                        close()
                    key, held, chunk = k, [], 0
                elif held and sum(s for _, s in held) + n > budget:
                    close()
                    held = held[-overlap:] if overlap else []
                    while held and sum(s for _, s in held) + n > budget:
                        held = held[1:]
                held.append((at, n))
            if out:
                yield pd.DataFrame(out, columns=[*keys, "chunk", "first", "last", "total", "n"])
                out = []
        if held:
            close()
            yield pd.DataFrame(out, columns=[*keys, "chunk", "first", "last", "total", "n"])

    return df.select(*keys, order, size).repartition(*keys).sortWithinPartitions(*keys, order).mapInPandas(run, schema)
