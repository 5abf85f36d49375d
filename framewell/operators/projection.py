"""Principal components of vectors, and nearest centroids after projection (V09 of the survey)."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from framewell.functions.names import free
from framewell.operators.vectors import top_k_cosine, usable

#: Dimensions at most: the driver holds one square matrix of them.
MOST_DIMENSIONS = 4096
#: Groups in which the partitions' matrices are added up before they meet.
GROUPS = 64


@dataclass(frozen=True)
class Projection:
    """Mean of the vectors, components as columns (largest variance first, largest entry positive) and their variances."""

    mean: np.ndarray
    components: np.ndarray
    variances: np.ndarray


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(len(column), -1)


def fit_projection(df: DataFrame, vector: str, k: int) -> Projection:
    """The first k principal components of all usable vectors of the table's dimension.

    Each partition adds up its rows' outer products in blocks; matrices are added row by row in two steps, so no task
    holds more than one row of each of its partitions. The driver solves one eigenproblem of the dimension's size.
    """
    size = df.where(usable(vector)).agg(F.max(F.size(vector))).first()[0]
    if not size or size > MOST_DIMENSIONS:
        raise ValueError(f"vectors of 1 to {MOST_DIMENSIONS} dimensions are needed, not {size}")
    rows = df.where(usable(vector) & (F.size(vector) == size)).select(F.col(vector).cast("array<double>").alias("v"))
    # Any shift gives the same result; one near the mean keeps its digits.
    shift = np.array(rows.first()["v"])

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        total, outer, n = np.zeros(size), np.zeros((size, size)), 0
        for batch in batches:
            x = _matrix(batch.column("v")) - shift
            total, outer, n = total + x.sum(axis=0), outer + x.T @ x, n + len(x)
        if n:
            group = TaskContext.get().partitionId() % GROUPS
            values = [*outer.tolist(), [*total.tolist(), float(n)]]
            yield pa.record_batch({"g": pa.array([group] * (size + 1), pa.int32()), "i": pa.array(range(size + 1), pa.int32()), "x": pa.array(values, pa.list_(pa.float64()))})

    def add(table: pa.Table) -> pa.Table:
        return pa.table({"g": pa.array([0], pa.int32()), "i": table.column("i").slice(0, 1), "x": pa.array([_matrix(table.column("x")).sum(axis=0).tolist()])})

    sums = rows.mapInArrow(moments, "g int, i int, x array<double>")
    for keys in (["g", "i"], ["i"]):
        sums = sums.groupBy(*keys).applyInArrow(add, "g int, i int, x array<double>")
    got = {r["i"]: np.array(r["x"]) for r in sums.select("i", "x").collect()}
    total, n = got[size][:-1], got[size][-1]
    mean = total / n
    covariance = np.stack([got[i] for i in range(size)]) / n - np.outer(mean, mean)
    variance, axes = np.linalg.eigh((covariance + covariance.T) / 2)
    best = np.argsort(-variance, kind="stable")[:k]
    axes = axes[:, best]
    axes = axes * np.where(np.take_along_axis(axes, np.abs(axes).argmax(axis=0)[None], 0) < 0, -1.0, 1.0)
    return Projection(shift + mean, axes, np.maximum(variance[best], 0.0))


def project(df: DataFrame, vector: str, by: Projection, out: str, centred: bool = True) -> DataFrame:
    """df with ``out``: the vector in the components' space; NULL for vectors that are not usable or of another dimension."""
    size = len(by.mean)
    ready = free(df, "_ready")
    rows = df.withColumn(ready, F.when(usable(vector) & (F.size(vector) == size), F.col(vector).cast("array<double>")))
    schema = df.limit(0).withColumn(out, F.lit(None).cast("array<double>")).schema
    offset = by.mean if centred else np.zeros(size)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = batch.column(ready)
            there = np.asarray(own.is_valid())
            found: list = [None] * batch.num_rows
            if there.any():
                for i, x in zip(np.flatnonzero(there), ((_matrix(own.drop_null()) - offset) @ by.components).tolist()):
                    found[i] = x
            columns = {c: batch.column(c) for c in batch.schema.names if c not in (ready, out)} | {out: pa.array(found, pa.list_(pa.float64()))}
            yield pa.record_batch([columns[f.name] for f in schema], names=[f.name for f in schema])

    return rows.mapInArrow(run, schema)


def nearest_projected(df: DataFrame, centroids: DataFrame, key: str, cluster: str, vector: str, by: Projection, centred: bool = True) -> DataFrame:
    """key, cluster, distance (1 - cosine) and margin (to the second best) among centroids, both projected first.

    centroids has cluster and vector, in the original space. With one centroid alone the margin is NULL. Without
    ``centred`` vectors are multiplied by the components as they are.
    """
    own, given = (project(d.select(k, vector), vector, by, "_p", centred).select(k, F.col("_p").alias(vector)) for d, k in ((df, key), (centroids, cluster)))
    best = top_k_cosine(own, given, key, cluster, vector, 2)
    second = F.max(F.when(F.col("rank") == 2, F.col("score")))
    return best.groupBy(key).agg(F.min_by(cluster, "rank").alias("cluster"), (1 - F.max("score")).alias("distance"), (F.max("score") - second).alias("margin"))
