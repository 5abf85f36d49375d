"""Readers and writers (S01-S22 of the survey). All paths go through Spark's file systems; nothing opens a local file."""

from __future__ import annotations

import io
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def scratch(spark: SparkSession) -> str:
    """A fresh folder name under the cluster's spark.checkpoint.dir; only a local session may do without it, as in tests."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="framewell-")
    return f"{base.rstrip('/')}/framewell-{uuid.uuid4().hex}"


def cut(df: DataFrame) -> DataFrame:
    """df written in the shared folder and read again: its lineage ends here and lost executors lose nothing."""
    path = scratch(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def read_dataset(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """Parquet, CSV or JSON lines by suffix."""
    reader = spark.read.schema(schema) if schema else spark.read
    suffix = path.rstrip("/").rsplit(".", 1)[-1].lower()
    if suffix == "csv":
        return reader.csv(path, header=True)
    if suffix in ("jsonl", "json", "ndjson"):
        return reader.json(path)
    if suffix == "parquet":
        return reader.parquet(path)
    raise ValueError(f"no reader for {path}")


def require_columns(df: DataFrame, needed: list[str]) -> DataFrame:
    """df, or an error that names the columns it lacks."""
    lacking = [c for c in needed if c not in df.columns]
    if lacking:
        raise ValueError(f"columns are missing: {', '.join(lacking)}")
    return df


def write_table(df: DataFrame, path: str) -> None:
    """Parquet, CSV or JSON lines by suffix (S17); nested columns go to CSV as JSON text."""
    suffix = path.rstrip("/").rsplit(".", 1)[-1].lower()
    if suffix == "csv":
        flat = [F.to_json(f.name).alias(f.name) if f.dataType.typeName() in ("struct", "array", "map") else F.col(f"`{f.name}`") for f in df.schema]
        df.select(*flat).write.mode("overwrite").csv(path, header=True)
    elif suffix in ("jsonl", "json", "ndjson"):
        df.write.mode("overwrite").json(path)
    elif suffix == "parquet":
        df.write.mode("overwrite").parquet(path)
    else:
        raise ValueError(f"no writer for {path}")


def put_files(spark: SparkSession, root: str, files: dict[str, bytes]) -> None:
    """A handful of small files at given paths below root, through Hadoop's file systems (S16); tables are written by Spark."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    for name, data in files.items():
        path = jvm.org.apache.hadoop.fs.Path(f"{root}/{name}")
        stream = path.getFileSystem(conf).create(path, True)
        try:
            stream.write(bytearray(data))
        finally:
            stream.close()


def list_files(spark: SparkSession, root: str, glob: str = "*") -> DataFrame:
    """path and length of all files below root, on any store that Spark reads (S15, S16); contents stay where they are."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", glob).load(root).select("path", "length")


def write_results(df: DataFrame, path: str) -> None:
    """A compressed result store (S20): gzip JSON lines, which appear only when Spark's committer ends the job."""
    df.write.mode("overwrite").option("compression", "gzip").json(path)


MANIFEST = "run struct<platform_id: string, video_id: string, run_id: string, config_hash: string, created_at: string, frames_dir: string>, components array<struct<name: string, status: string, duration_ms: bigint, device_used: string, artifacts array<struct<type: string, path: string>>>>"
MANIFEST = MANIFEST.replace("artifacts array", "artifacts: array")


def run_manifests(spark: SparkSession, root: str) -> DataFrame:
    """Manifests under <root>/<platform>/<video>/<run>/manifest.json, broken ones left out."""
    rows = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "manifest.json").text(root, wholetext=True)
    rows = rows.select(F.col("_metadata.file_path").alias("path"), F.from_json("value", MANIFEST).alias("m"))
    part = lambda i: F.element_at(F.split("path", "/"), -i)
    return rows.where("m.components IS NOT NULL").select(part(4).alias("platform"), part(3).alias("video_id"), part(2).alias("run_id"), "m.run", "m.components", "path")


def component_paths(manifests: DataFrame) -> DataFrame:
    """The first npz artifact of each component."""
    rows = manifests.select("platform", "video_id", "run_id", F.explode("components").alias("c"))
    first = F.get(F.filter("c.artifacts", lambda a: a["type"] == "npz"), F.lit(0))
    return rows.select("platform", "video_id", "run_id", F.col("c.name").alias("component"), F.col("c.status").alias("status"), F.col("c.duration_ms").alias("duration_ms"), first["path"].alias("npz")).where("npz IS NOT NULL")


def artifact_walk(spark: SparkSession, root: str) -> DataFrame:
    """<root>/<video>/rs/<component>/*.npz without manifests: video_id, component, path, content."""
    rows = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.npz").load(root)
    return rows.select(F.regexp_extract("path", r"([^/]+)/rs/[^/]+/[^/]+$", 1).alias("video_id"), F.regexp_extract("path", r"/rs/([^/]+)/[^/]+$", 1).alias("component"), "path", "content").where("video_id <> ''")


def _summary(name: str, a: np.ndarray) -> Iterator[tuple[str, float]]:
    a = a.astype(float).ravel()
    ok = a[np.isfinite(a)]
    if not a.size:
        yield f"{name}__empty", 1.0
    elif not ok.size:
        yield f"{name}__all_non_finite", 1.0
    else:
        yield from ((f"{name}__{k}", float(v)) for k, v in (("mean", ok.mean()), ("std", ok.std()), ("min", ok.min()), ("max", ok.max()), ("p50", np.percentile(ok, 50)), ("p90", np.percentile(ok, 90)), ("count", ok.size)))


def npz_rows(content: bytes, skip: tuple[str, ...] = ("embeddings", "ocr_raw", "meta")) -> list[tuple[str, float]]:
    """Features of an artifact: named values first, else a features mapping, else summaries of loose numeric arrays."""
    try:
        z = np.load(io.BytesIO(content), allow_pickle=False)
        names = set(z.files)
        if {"feature_names", "feature_values"} <= names:
            return [(str(n), float(v)) for n, v in zip(z["feature_names"], z["feature_values"])]
        mapped = [n for n in z.files if n.startswith("features/") and z[n].ndim == 0 and z[n].dtype.kind in "biuf"]
        if mapped:
            return [(n.split("/", 1)[1], float(z[n])) for n in mapped]
        out: list[tuple[str, float]] = []
        for n in sorted(names):
            if n in skip or z[n].dtype.kind not in "biuf":
                continue
            out += [(n, float(z[n]))] if z[n].ndim == 0 else list(_summary(n, z[n]))
        return out
    except (ValueError, OSError, EOFError, KeyError):
        return []


def npz_features(artifacts: DataFrame) -> DataFrame:
    """artifacts(video_id, component, content) as long rows: video_id, component, feature, value. Pickled objects are never loaded."""

    def decode(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            rows = [(v, c, n, x) for v, c, data in zip(pdf.video_id, pdf.component, pdf.content) for n, x in npz_rows(data)]
            yield pd.DataFrame(rows, columns=["video_id", "component", "feature", "value"])

    return artifacts.select("video_id", "component", "content").mapInPandas(decode, "video_id string, component string, feature string, value double")


def keyed_records(spark: SparkSession, path: str, key: str, wanted: DataFrame | None = None) -> DataFrame:
    """Records of JSON shards that are objects by id or lists with an id field; of an id's records the last one wins, by file and
    place (S06-S08, S10, S11). Shards of any size are read by many tasks.

    Wanted ids are joined right after the records are split, so others are never parsed. key, record (JSON), path.
    """
    from framewell.sources.bigjson import json_members, keyed

    rows = keyed(json_members(spark, path), key)
    if wanted is not None:
        rows = rows.join(wanted.select(key).distinct(), key, "left_semi")
    last = rows.groupBy(key).agg(F.max(F.struct("path", "block", "seq", "record")).alias("_last"))
    return last.select(key, "_last.record", "_last.path")


def snapshots(records: DataFrame, key: str, indices: list[int]) -> DataFrame:
    """Long snapshots of records with snapshot_N fields or a snapshots list; counters are text and are cast."""
    fields = "viewCount string, likeCount string, commentCount string, time_get string"
    # One look at a record takes out all its fields.
    parts = records.select(key, F.json_tuple("record", "snapshots", *(f"snapshot_{i}" for i in indices)).alias("_listed", *(f"_{i}" for i in indices)))
    named = [F.struct(F.lit(i).alias("i"), F.from_json(f"_{i}", fields).alias("s")) for i in indices]
    listed = F.transform(F.from_json("_listed", f"array<struct<{fields.replace(' string', ': string')}>>"), lambda s, i: F.struct(i.alias("i"), s.alias("s")))
    rows = parts.select(key, F.explode(F.when(F.col("_listed").isNotNull(), listed).otherwise(F.array(*named))).alias("x")).where("x.s IS NOT NULL")

    def number(c: F.Column) -> F.Column:
        # Text that cannot be a number costs a thrown error in the cast.
        return F.when(c.rlike("(?i)[0-9]|nan|inf"), c.try_cast("double"))

    return rows.select(key, F.col("x.i").alias("snapshot_index"), *(number(F.col(f"x.s.{c}")).alias(n) for c, n in (("viewCount", "views"), ("likeCount", "likes"), ("commentCount", "comments"))), F.col("x.s.time_get").alias("time_get"))


def category_from_path(path: str = "_metadata.file_path") -> F.Column:
    """The value of category=X in a path."""
    return F.nullif(F.regexp_extract(path, r"category=([^/]+)", 1), F.lit(""))


def write_with_sidecar(df: DataFrame, path: str) -> DataFrame:
    """Writes df and, beside it, one row of metadata: rows, columns and their hash."""
    df.write.mode("overwrite").parquet(f"{path}/data")
    spark = df.sparkSession
    written = spark.read.parquet(f"{path}/data")
    meta = written.agg(F.count("*").alias("n_rows")).withColumns({"n_columns": F.lit(len(df.columns)), "column_hash": F.sha2(F.lit(",".join(df.columns)), 256)})
    meta.write.mode("overwrite").json(f"{path}/meta")
    return spark.read.json(f"{path}/meta")


def split_export(df: DataFrame, order: str, parts: int) -> DataFrame:
    """df with the file number of an export into ``parts`` files of ceil(n / parts) rows."""
    from framewell.operators.ranks import numbered

    rows = numbered(df, [F.col(order)])
    n = df.count()
    each = max(1, -(-n // parts))
    return rows.withColumn("file", F.floor((F.col("rn") - 1) / each).cast("int")).drop("rn")


def write_shards(df: DataFrame, path: str, category: str, shard_rows: int) -> None:
    """Files of at most shard_rows rows by category."""
    df.write.mode("overwrite").option("maxRecordsPerFile", shard_rows).partitionBy(category).json(path)


def latest_by_path(df: DataFrame, key: list[str]) -> DataFrame:
    """The row of the last path for each key."""
    from framewell.functions.names import free

    place = free(df, "_place")
    return df.withColumn(place, F.row_number().over(Window.partitionBy(*key).orderBy(F.desc("path")))).where(F.col(place) == 1).drop(place)


def kafka_events(df: DataFrame, key: str, brokers: str, topic: str, checkpoint: str):
    """A streaming sink of JSON events (S22); needs the Kafka connector on the class path."""
    rows = df.select(F.col(key).cast("string").alias("key"), F.to_json(F.struct("*")).alias("value"))
    return rows.writeStream.format("kafka").option("kafka.bootstrap.servers", brokers).option("topic", topic).option("checkpointLocation", checkpoint)
