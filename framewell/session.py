"""Session settings the library expects: UTC, ANSI casts, adaptive execution."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def local_session(app: str = "framewell", cores: int | None = None, memory: str = "8g", partitions: int | None = None) -> SparkSession:
    """A local session for tests and the bench; on a cluster the session comes from outside."""
    cores = cores or int(os.environ.get("BENCH_CPUS", "8"))
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(partitions or cores))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark
