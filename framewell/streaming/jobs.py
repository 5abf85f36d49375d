"""Streaming forms of the state operators (T01-T16 of the survey) and Spark's own event-time windows."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from framewell.sources.files import scratch


def file_stream(spark: SparkSession, path: str, schema, files_per_trigger: int = 4, fmt: str = "parquet") -> DataFrame:
    """Files of a folder as a stream (T13, T16: a rate-limited tail)."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).format(fmt).load(path)


def run_to_end(stream: DataFrame, mode: str = "append") -> DataFrame:
    """Process all that is there now, and read the result (T03: one round of the poll loop)."""
    spark, folder = stream.sparkSession, scratch(stream.sparkSession)
    if mode == "append":
        stream.writeStream.format("parquet").option("path", f"{folder}/out").option("checkpointLocation", f"{folder}/state").trigger(availableNow=True).start().awaitTermination()
        return spark.read.schema(stream.schema).parquet(f"{folder}/out")

    # In complete mode each batch is the whole result; the last confirmed one counts, so a failed write loses nothing.
    stream.writeStream.outputMode(mode).foreachBatch(confirmed_sink(folder)).option("checkpointLocation", f"{folder}/state").trigger(availableNow=True).start().awaitTermination()
    rows = confirmed(spark, folder, stream.schema)
    last = rows.agg(F.max("batch")).first()[0]
    return rows.where(F.col("batch") == F.lit(last)).drop("batch")


def dedup(stream: DataFrame, keys: list[str], t: str, late: str) -> DataFrame:
    """First row of each key; state is dropped once the watermark has passed."""
    return stream.withWatermark(t, late).dropDuplicatesWithinWatermark(keys)


def tumbling(stream: DataFrame, keys: list[str], t: str, late: str, size: str, slide: str | None = None) -> DataFrame:
    """Counts and sums by event-time window (T10, T11; Spark-native windows)."""
    w = F.window(t, size, slide) if slide else F.window(t, size)
    out = stream.withWatermark(t, late).groupBy(w.alias("w"), *keys).agg(F.count("*").alias("n"), F.sum("value").alias("total"))
    return out.select(F.col("w.start").alias("start"), *keys, "n", "total")


def sessions(stream: DataFrame, keys: list[str], t: str, late: str, gap: str) -> DataFrame:
    """Sessions by inactivity gap (Spark-native)."""
    out = stream.withWatermark(t, late).groupBy(F.session_window(t, gap).alias("w"), *keys).agg(F.count("*").alias("n"))
    return out.select(F.col("w.start").alias("start"), *keys, "n")


def not_completed(stream: DataFrame, done: DataFrame, keys: list[str]) -> DataFrame:
    """Stream entries without a completion (T02): a stream-static anti join."""
    return stream.join(done.select(*keys), keys, "left_anti")


def confirmed_sink(folder: str, confirm: Callable[[int], None] | None = None) -> Callable[[DataFrame, int], None]:
    """A foreachBatch function whose batches count once, also after a restart.

    A batch's rows go to a folder named by its id, which a repeated batch overwrites; a mark beside them is written
    last. Readers see marked batches only. ``confirm`` is called between both, for the caller's own acknowledgement.
    """

    def sink(df: DataFrame, batch: int) -> None:
        df.write.mode("overwrite").parquet(f"{folder}/data/batch={batch}")
        if confirm:
            confirm(batch)
        df.sparkSession.range(1).select(F.lit(batch).cast("long").alias("batch")).write.mode("overwrite").parquet(f"{folder}/done/batch={batch}")

    return sink


def confirmed(spark: SparkSession, folder: str, schema) -> DataFrame:
    """Rows of the batches that were confirmed, with the batch's number."""
    rows = spark.read.schema(schema).option("recursiveFileLookup", True).parquet(f"{folder}/data")
    rows = rows.withColumn("batch", F.regexp_extract("_metadata.file_path", r"batch=(\d+)", 1).cast("long"))
    done = spark.read.schema("batch long").option("recursiveFileLookup", True).parquet(f"{folder}/done").distinct()
    return rows.join(done, "batch", "left_semi")


def run_confirmed(stream: DataFrame, folder: str, confirm: Callable[[int], None] | None = None) -> DataFrame:
    """Process what is there now into a confirmed sink with its checkpoint beside it; call it again to go on."""
    writer = stream.writeStream.foreachBatch(confirmed_sink(folder, confirm)).option("checkpointLocation", f"{folder}/state")
    writer.trigger(availableNow=True).start().awaitTermination()
    return confirmed(stream.sparkSession, folder, stream.schema)


def lease_step(ttl: float) -> Callable[[tuple | None, pd.DataFrame], tuple[tuple, pd.DataFrame]]:
    """Named leases (T07): acquire and heartbeat extend a lease that is free, expired or the owner's own; release ends it.

    Rows have key, event_id, owner, action and at (seconds); state is owner and expiry.
    """

    def step(current: tuple | None, rows: pd.DataFrame) -> tuple[tuple, pd.DataFrame]:
        owner, until = current if current else ("", float("-inf"))
        rows, granted = rows.sort_values(["at", "event_id"]).reset_index(drop=True), []
        for who, action, at in zip(rows.owner, rows.action, rows["at"]):
            free = at >= until or owner == ""
            if action == "release":
                ok = owner == who and not free
                owner, until = ("", float("-inf")) if ok else (owner, until)
            else:
                ok = owner == who and not free or action == "acquire" and free
                owner, until = (who, at + ttl) if ok else (owner, until)
            granted.append(ok)
        return (owner, until), pd.DataFrame({"key": rows.key, "event_id": rows.event_id, "granted": granted})

    return step


def stateful(stream: DataFrame, key: str, output: str, state: str, step: Callable[[tuple | None, pd.DataFrame], tuple[tuple, pd.DataFrame]], timeout_ms: int | None = None) -> DataFrame:
    """A keyed fold: step(state, rows) gives the new state and output rows; idle state goes after timeout_ms."""

    def run(keys: tuple, frames: Iterator[pd.DataFrame], held: GroupState) -> Iterator[pd.DataFrame]:
        if held.hasTimedOut:
            held.remove()
            return
        current = held.get if held.exists else None
        rows = pd.concat(list(frames), ignore_index=True)
        current, out = step(current, rows)
        held.update(current)
        if timeout_ms:
            held.setTimeoutDuration(timeout_ms)
        yield out

    kind = GroupStateTimeout.ProcessingTimeTimeout if timeout_ms else GroupStateTimeout.NoTimeout
    return stream.groupBy(key).applyInPandasWithState(run, output, state, "append", kind)


def claim_step(current: tuple | None, rows: pd.DataFrame) -> tuple[tuple, pd.DataFrame]:
    """Claims in order: the last row decides whether the key is claimed."""
    rows = rows.sort_values("event_id")
    last = rows.iloc[-1]
    order = int(current[0]) if current else -1
    if int(last.event_id) >= order:
        current = (int(last.event_id), str(last.status))
    return current, pd.DataFrame({"key": [last.key], "event_id": [current[0]], "status": [current[1]]})


def cap_step(cap: int) -> Callable[[tuple | None, pd.DataFrame], tuple[tuple, pd.DataFrame]]:
    """Accept the first ``cap`` rows of a key over the stream's life (T08's channel cap)."""

    def step(current: tuple | None, rows: pd.DataFrame) -> tuple[tuple, pd.DataFrame]:
        used = int(current[0]) if current else 0
        rows = rows.sort_values("event_id").reset_index(drop=True)
        out = pd.DataFrame({"key": rows.key, "event_id": rows.event_id, "accepted": [used + i < cap for i in range(len(rows))]})
        return (used + int(out.accepted.sum()),), out

    return step


def retry_step(most: int) -> Callable[[tuple | None, pd.DataFrame], tuple[tuple, pd.DataFrame]]:
    """Attempts of a key and whether it is dead."""

    def step(current: tuple | None, rows: pd.DataFrame) -> tuple[tuple, pd.DataFrame]:
        n = (int(current[0]) if current else 0) + len(rows)
        return (n,), pd.DataFrame({"key": [rows.key.iloc[0]], "attempts": [n], "dead": [n >= most]})

    return step
