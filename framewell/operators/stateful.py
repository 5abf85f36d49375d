"""Order-dependent state in batch form (T01-T18, A45, F13, F06 of the survey); streaming forms are in framewell.streaming."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from framewell.functions.names import free
from framewell.functions.sizes import small


def first_seen(df: DataFrame, keys: list[str], *order: str) -> DataFrame:
    """The first row of each key."""
    place = free(df, "_place")
    return df.withColumn(place, F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col(place) == 1).drop(place)


def due_entries(schedule: DataFrame, done: DataFrame, keys: list[str], due: str, now: Column) -> DataFrame:
    """Scheduled, not completed, due by now."""
    return schedule.join(done.select(*keys), keys, "left_anti").where(F.col(due) <= now)


def reanchor(offsets: DataFrame, completed: DataFrame, key: str, index: str, hours: str, at: str) -> DataFrame:
    """Next due = actual collection + gap to the next offset (F13, T05): key, next index, due."""
    step = offsets.select(F.col(index), F.lead(index).over(Window.orderBy(index)).alias("_n"), (F.lead(hours).over(Window.orderBy(index)) - F.col(hours)).alias("_gap"))
    last = completed.groupBy(key).agg(F.max_by(F.struct(index, at), index).alias("_l")).select(key, f"_l.{index}", f"_l.{at}")
    return last.join(small(step), index).where("_n IS NOT NULL").select(key, F.col("_n").alias(index), F.timestamp_add("MINUTE", (F.col("_gap") * 60).cast("int"), F.col(at)).alias("due"))


def merge_claims(df: DataFrame, key: str, order: str, status: str, expires: str, now: Column) -> DataFrame:
    """The live claim of each key: the last row, if it is a claim that has not expired.

    A release or completion ends earlier claims and a claim after it counts again, so only the last row decides.
    """
    place = free(df, "_place")
    last = df.withColumn(place, F.row_number().over(Window.partitionBy(key).orderBy(F.desc(order)))).where(F.col(place) == 1).drop(place)
    return last.where(~F.col(status).isin("done", "released") & (F.col(expires) > now))


def retry_state(df: DataFrame, key: str, attempt: str, most: int, delay: float) -> DataFrame:
    """Attempts, linear backoff and whether the entry goes to the dead letters."""
    return df.groupBy(key).agg(F.max(attempt).alias("attempts")).select(key, "attempts", (F.col("attempts") * delay).alias("backoff"), (F.col("attempts") >= most).alias("dead"))


def sliding_failures(df: DataFrame, key: str, t: str, failed: Column, window: int, threshold: int) -> DataFrame:
    """Failures within the window up to each row, and whether the circuit opens."""
    w = Window.partitionBy(key).orderBy(t).rangeBetween(-window, 0)
    return df.withColumn("failures", F.sum(failed.cast("int")).over(w)).withColumn("open", F.col("failures") >= threshold)


def rate_limit(df: DataFrame, key: str, t: str, window: float, limit: int) -> DataFrame:
    """Fixed windows that open at the first hit after the last one closed (T10): df's key and t, allowed. Sequential by key."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(t)
        start, used, out = None, 0, []
        for at in pdf[t]:
            if start is None or at - start >= window:
                start, used = at, 0
            used += 1
            out.append(used <= limit)
        return pdf.assign(allowed=out)

    return df.select(key, t).groupBy(key).applyInPandas(run, f"{key} {df.schema[key].dataType.simpleString()}, {t} double, allowed boolean")


def illegal_transitions(df: DataFrame, key: str, order: str, status: str, allowed: list[tuple[str, str]]) -> DataFrame:
    """Status changes that the table does not allow."""
    rows = df.withColumn("_from", F.lag(status).over(Window.partitionBy(key).orderBy(order))).where(F.col("_from").isNotNull() & (F.col("_from") != F.col(status)))
    table = df.sparkSession.createDataFrame(allowed, f"_from string, {status} string")
    return rows.join(small(table), ["_from", status], "left_anti").select(key, order, F.col("_from").alias("previous"), status)


def stale(df: DataFrame, key: str, t: str, now: Column, ttl_seconds: float) -> DataFrame:
    """Keys without a heartbeat within the time to live."""
    last = df.groupBy(key).agg(F.max(t).alias("last"))
    return last.where(F.unix_micros(now.cast("timestamp")) - F.unix_micros(F.col("last").cast("timestamp")) > ttl_seconds * 1e6)


def balance(df: DataFrame, keys: list[str], amount: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.coalesce(F.sum(amount), F.lit(0)).alias("balance"))


def balancer_score(share: Column, target: Column, coefficient: float) -> Column:
    """1 less the coefficient times the overfill of a bucket over its target, not below 0."""
    return F.greatest(F.lit(0.0), 1 - coefficient * F.greatest(F.lit(0.0), F.try_divide(share - target, target)))
