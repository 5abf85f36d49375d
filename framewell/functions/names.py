"""Names for helper columns that no column of the user's has."""

from __future__ import annotations

from pyspark.sql import DataFrame


def free(df: DataFrame, name: str) -> str:
    """name, with as many underscores before it as it takes to be new."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name
