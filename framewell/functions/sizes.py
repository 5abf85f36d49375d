"""Broadcasts behind a check of their size."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Rows of a table that is broadcast, at most.
BROADCAST_ROWS = 10_000


def small(df: DataFrame, most: int = BROADCAST_ROWS) -> DataFrame:
    """df, marked for broadcast if it has at most ``most`` rows; else the join is left to Spark."""
    return F.broadcast(df) if df.limit(most + 1).count() <= most else df
