"""Smoothing and peaks of curves (W11, W12, W26, W27 of the survey): fixed weights over frames of neighbouring rows.

A filter sees a frame of a bounded number of rows, so a curve of any length is taken as it streams from its sort. Rows
without a value have no place in a curve and are left out.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from framewell.functions.names import free
from framewell.operators.sequences import suppress_by_time, z_score


def _framed(df: DataFrame, keys: list[str], order: str, value: str, before: int, after: int) -> tuple[DataFrame, Column, Column, Column]:
    """df with the values around each row; each row's place and the curve's length; and how to get the value at a place."""
    i, n, near = (free(df, x) for x in ("_i", "_n", "_near"))
    own = Window.partitionBy(*keys)
    x = F.col(value).cast("double")
    rows = df.where(x.isNotNull()).withColumns({i: F.row_number().over(own.orderBy(order)) - 1, n: F.count("*").over(own), near: F.collect_list(x).over(own.orderBy(order).rowsBetween(-before, after))})
    first = F.greatest(F.lit(0), F.col(i) - before)
    return rows, F.col(i), F.col(n), lambda place: F.get(near, (place - first).cast("int"))


def _without(df: DataFrame, rows: DataFrame, out: str) -> DataFrame:
    return rows.select(*(f"`{c}`" for c in df.columns if c != out), out)


def gaussian_weights(sigma: float, truncate: float = 4.0) -> np.ndarray:
    if sigma <= 0:
        return np.ones(1)
    reach = int(truncate * sigma + 0.5)
    w = np.exp(-0.5 * (np.arange(-reach, reach + 1) / sigma) ** 2)
    return w / w.sum()


def convolve(df: DataFrame, keys: list[str], order: str, value: str, weights: np.ndarray, out: str) -> DataFrame:
    """``out``: the weighted sum of the rows around each one (W11). Beyond its ends a curve goes on as its mirror image, edge row included."""
    reach = len(weights) // 2
    rows, i, n, at = _framed(df, keys, order, value, reach, reach)
    total = F.lit(0.0)
    for j, w in enumerate(weights.tolist()):
        turn = F.pmod(i + (j - reach), 2 * n)
        total = total + F.lit(w) * at(F.when(turn < n, turn).otherwise(2 * n - 1 - turn))
    return _without(df, rows.withColumn(out, total), out)


def gaussian(df: DataFrame, keys: list[str], order: str, value: str, sigma: float, out: str) -> DataFrame:
    return convolve(df, keys, order, value, gaussian_weights(sigma), out)


def polynomial_weights(window: int, degree: int) -> np.ndarray:
    """Row p: the weights of a window's values in the least-squares polynomial's value at its place p."""
    place = np.vander(np.arange(window) - window // 2, degree + 1, increasing=True).astype(float)
    return place @ np.linalg.pinv(place)


def savgol(df: DataFrame, keys: list[str], order: str, value: str, window: int, degree: int, out: str) -> DataFrame:
    """``out``: least-squares polynomials over a moving frame (W26). The first and last half frame take the values of the first
    and last whole frame's polynomial. Curves no longer than the window stay as they are; an even window is one less.
    """
    size = window - 1 + window % 2
    half = size // 2
    weights = polynomial_weights(size, degree)
    rows, i, n, at = _framed(df, keys, order, value, size - 1, size - 1)
    # The frame that a row is fitted in, and the row's place in it.
    start = F.greatest(F.lit(0), F.least(i - half, n - size))
    own = F.element_at(F.array(*(F.array(*map(F.lit, w)) for w in weights.tolist())), (i - start + 1).cast("int"))
    fit = F.lit(0.0)
    for k in range(size):
        fit = fit + own[k] * at(start + k)
    return _without(df, rows.withColumn(out, F.when(n > window, fit).otherwise(F.col(value).cast("double"))), out)


def energy(df: DataFrame, keys: list[str], order: str, one: str, other: str, sigma: float, out: str) -> DataFrame:
    """Two curves, each smoothed and standardised, in equal parts; their sum smoothed and standardised again."""
    rows = df
    parts = []
    for c in (one, other):
        smooth, score = free(rows, f"_{c}_s"), free(rows, f"_{c}_z")
        rows = z_score(gaussian(rows, keys, order, c, sigma, smooth), keys, smooth, score).drop(smooth)
        parts.append(score)
    both, smooth = free(rows, "_both"), free(rows, "_smooth")
    rows = rows.withColumn(both, 0.5 * F.col(parts[0]) + 0.5 * F.col(parts[1])).drop(*parts)
    return z_score(gaussian(rows, keys, order, both, sigma, smooth), keys, smooth, out).drop(both, smooth)


def maxima(df: DataFrame, keys: list[str], order: str, value: str) -> DataFrame:
    """Rows that stand above both neighbours; of a plateau between lower rows its middle one, the earlier of two."""
    i, n, before, run, after, size, place = (free(df, x) for x in ("_i", "_n", "_before", "_run", "_after", "_size", "_place"))
    w = Window.partitionBy(*keys).orderBy(order)
    rows = df.where(F.col(value).isNotNull()).withColumns({before: F.lag(value).over(w), after: F.lead(value).over(w)})
    rows = rows.withColumn(run, F.sum(F.when(F.col(before) == F.col(value), 0).otherwise(1)).over(w))
    own = Window.partitionBy(*keys, run)
    rows = rows.withColumns({place: F.row_number().over(own.orderBy(order)), size: F.count("*").over(own), before: F.first(before).over(own.orderBy(order)), after: F.last(after).over(own.orderBy(order).rowsBetween(0, Window.unboundedFollowing))})
    middle = F.col(place) == F.floor((F.col(size) + 1) / 2)
    return rows.where(middle & (F.col(before) < F.col(value)) & (F.col(after) < F.col(value))).select(*(f"`{c}`" for c in df.columns))


def high_peaks(df: DataFrame, keys: list[str], t: str, value: str, gap: float, share: float = 0.9, least: int = 4) -> DataFrame:
    """Maxima not below the curve's own percentile, the highest first, none nearer than ``gap`` to one kept (W12). Curves of
    fewer than ``least`` rows have none."""
    height, n = free(df, "_height"), free(df, "_n")
    limits = df.where(F.col(value).isNotNull()).groupBy(*keys).agg(F.percentile(value, share).alias(height), F.count("*").alias(n)).where(F.col(n) >= least)
    found = maxima(df, keys, t, value).join(limits, keys).where(F.col(value) >= F.col(height))
    return suppress_by_time(found, keys, t, value, gap)


def top_jumps(df: DataFrame, keys: list[str], order: str, value: str, least: float, distance: int, k: int) -> DataFrame:
    """Inner rows at or above ``least``, not below the row before and above the one after: the k highest that are ``distance``
    rows apart, higher ones first, of equal ones the later (W27). Adds ``place`` (row of the curve, from 0) and ``rank``.
    """
    w = Window.partitionBy(*keys).orderBy(order)
    place, before, after, inner = "place", free(df, "_before"), free(df, "_after"), free(df, "_inner")
    # Neighbours that are no numbers leave a row without a comparison, and no peak.
    rows = df.withColumns({place: F.row_number().over(w) - 1, before: F.lag(value).over(w), after: F.lead(value).over(w), inner: F.lead(F.lit(True), 2).over(w)})
    number = lambda c: F.col(c).isNotNull() & ~F.isnan(F.col(c).cast("double"))
    # The first and last row are no neighbours to compare with either.
    peak = number(value) & number(before) & number(after) & (F.col(place) > 1) & F.col(inner) & (F.col(value) >= least) & (F.col(value) >= F.col(before)) & (F.col(value) > F.col(after))
    peaks = rows.where(peak).drop(before, after, inner)
    # A row has fewer than 2 * distance others in its way, so what is kept lies among so many of the highest.
    top = Window.partitionBy(*keys).orderBy(F.desc(value), F.desc(place))
    reach = free(peaks, "_r")
    peaks = peaks.withColumn(reach, F.row_number().over(top)).where(F.col(reach) <= max(1, k * max(1, 2 * distance)))
    kept = F.array_sort(F.collect_list(F.struct(F.col(reach), F.col(place).cast("int").alias("p"))))
    pick = F.aggregate(kept, F.array().cast("array<int>"), lambda a, x: F.when((F.size(a) < k) & ~F.exists(a, lambda y: F.abs(y - x["p"]) < distance), F.concat(a, F.array(x["p"]))).otherwise(a))
    chosen = peaks.groupBy(*keys).agg(pick.alias("_picked")).select(*keys, F.posexplode("_picked").alias("_at", place)).select(*keys, place, (F.col("_at") + 1).alias("rank"))
    return peaks.drop(reach).join(chosen, [*keys, place])
