"""Shared scratch space: lineage is cut by tables in the folder the cluster names."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def scratch(spark: SparkSession) -> str:
    """A fresh folder name under spark.checkpoint.dir. Only a local session may do without that setting, as in tests."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="framewell-")
        spark.sparkContext.setCheckpointDir(base)
    return f"{base.rstrip('/')}/framewell-{uuid.uuid4().hex}"


def cut(df: DataFrame) -> DataFrame:
    """Write df as a table in the shared folder and read it again: lost executors lose nothing, lineage ends here."""
    path = scratch(df.sparkSession)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.written_at = path
    return out


def release(*tables: DataFrame) -> None:
    """Delete tables that ``cut`` wrote, once all that reads them has been written itself."""
    for table in tables:
        path = getattr(table, "written_at", None)
        if path:
            spark = table.sparkSession
            where = spark._jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def partitions(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
