"""Ordered event logs that are read from any cursor on."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from framewell.functions.sizes import small

#: What an event type is called for readers; types of no entry go by their beginning.
NAMES = {
    "processing_started": "stage",
    "processing_completed": "complete",
    "processing_failed": "complete",
    "processing_error": "error",
    "component_started": "component_start",
    "component_completed": "component_complete",
    "component_failed": "component_complete",
    "progress_update": "progress",
    "recovery_started": "stage",
    "resume_from_checkpoint": "stage",
}

#: The id of an event within its run, which is also a cursor: its millisecond and its number within that.
ID = ["ms", "seq"]


@dataclass(frozen=True)
class Cursor:
    """Before all events; or at an event, which has been read."""

    ms: int = -1
    seq: int = -1


def reader_type(kind: str) -> Column:
    """The name of an event type for readers."""
    c, known = F.col(kind), F.create_map(*(F.lit(x) for pair in NAMES.items() for x in pair))
    part = F.when(c.contains("start"), "component_start").when(c.contains("complete") | c.contains("finish"), "component_complete").otherwise(c)
    rest = F.when(c.startswith("progress"), "progress").when(c.startswith("component"), part).when(c.startswith("stage") | c.startswith("processor"), "stage").otherwise(c)
    return F.coalesce(known[c], rest)


def log_ids(events: DataFrame, run: str, at: str, order: str) -> DataFrame:
    """events with ms and seq: ids that rise within a run with time, and, in one millisecond, with ``order``."""
    rows = events.withColumn("ms", F.unix_millis(F.col(at).cast("timestamp")))
    return rows.withColumn("seq", F.row_number().over(Window.partitionBy(run, "ms").orderBy(order)) - 1)


def write_log(events: DataFrame, path: str, run: str) -> None:
    """Files of whole ranges of runs, in order, so that a run and a range of ids are found by the files' statistics."""
    events.repartitionByRange(run, *ID).sortWithinPartitions(run, *ID).write.mode("append").parquet(path)


def _later(ms: Column, seq: Column) -> Column:
    """Later than a cursor; the first part alone can be pushed to the scan."""
    return (F.col("ms") >= ms) & ((F.col("ms") > ms) | (F.col("seq") > seq))


def cursors_since(events: DataFrame, run: str, since: DataFrame) -> DataFrame:
    """run, ms and seq of the first event of each run at or after its time ``since`` (run, since): where reading begins.

    A run without such an event is read from its beginning, as one without a time is.
    """
    rows = events.join(small(since.select(run, F.unix_millis(F.col("since").cast("timestamp")).alias("_since"))), run).where("ms >= _since")
    first = rows.groupBy(run).agg(F.min(F.struct(*ID)).alias("_at"))
    return since.select(run).join(first, run, "left").select(run, F.coalesce("_at.ms", F.lit(-1)).alias("ms"), F.coalesce("_at.seq", F.lit(-1)).alias("seq"))


def tail_runs(events: DataFrame, run: str, cursors: DataFrame, kind: str, component: Column | None = None) -> DataFrame:
    """All events later than their run's cursor, of the component if one is asked for, with ``place`` (from 1) and ``reader_type``."""
    at = small(cursors.select(run, F.col("ms").alias("_ms"), F.col("seq").alias("_seq")))
    rows = events.join(at, run).where(_later(F.col("_ms"), F.col("_seq"))).drop("_ms", "_seq")
    rows = rows.where(component) if component is not None else rows
    return rows.withColumn("place", F.row_number().over(Window.partitionBy(run).orderBy(*ID))).withColumn("reader_type", reader_type(kind))


def tail(spark: SparkSession, path: str, run: str, value, cursor: Cursor = Cursor(), count: int = 10, component: Column | None = None) -> tuple[DataFrame, Cursor]:
    """The next events of one run, at most ``count``, and the cursor after them: a reader keeps that and comes back with it.

    The run and the cursor's millisecond are pushed to the scan; events of other components move the cursor on unseen.
    """
    rows = spark.read.parquet(path).where((F.col(run) == F.lit(value)) & _later(F.lit(cursor.ms), F.lit(cursor.seq)))
    page = rows.where(component) if component is not None else rows
    page = page.orderBy(*ID).limit(count)
    last = page.agg(F.max(F.struct(*ID)).alias("at"), F.count("*").alias("n")).first()
    if component is not None and last["n"] < count:
        # What is left of the run is of other components.
        last = rows.agg(F.max(F.struct(*ID)).alias("at")).first()
    return page, Cursor(last["at"]["ms"], last["at"]["seq"]) if last["at"] else cursor
