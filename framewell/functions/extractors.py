"""Batch extractors as table functions for SQL (X02, X03 of the survey).

An extractor is set up once in each worker and then takes Arrow batches of many rows. Spark's Arrow table functions take
tables, not laterally bound values, so a call is ``framewell_x(TABLE(SELECT key, ...))``; what comes from a LATERAL join,
such as a row's segments, is made inside that table.
"""

from __future__ import annotations

from abc import ABC, abstractmethod
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

OUTPUT = "key string, segment int, feature string, value double, error string"
_OUTPUT = pa.schema([("key", pa.string()), ("segment", pa.int32()), ("feature", pa.string()), ("value", pa.float64()), ("error", pa.string())])

#: Extractors that this worker has set up.
_READY: dict[tuple[str, str], BatchExtractor] = {}


class BatchExtractor(ABC):
    """Features of texts: of one, or of a batch at once."""

    name: str
    version: str = "1"

    def set_up(self) -> None:
        """Once a worker: load what is costly."""

    @abstractmethod
    def extract(self, value) -> dict[str, float]: ...

    def extract_batch(self, values: pa.Array) -> dict[str, np.ndarray]:
        """A column for each feature, with a number for each value, NaN for none; by default one value after the other."""
        rows = [self.extract(v) for v in values.to_pylist()]
        names = dict.fromkeys(n for r in rows for n in r)
        return {n: np.array([r.get(n, np.nan) for r in rows], float) for n in names}

    @property
    def supports_batch(self) -> bool:
        return type(self).extract_batch is not BatchExtractor.extract_batch


class SegmentExtractor(BatchExtractor):
    """Features of segments of a signal: lists of numbers with their rate a second."""

    @abstractmethod
    def extract_batch_segments(self, values: pa.ListArray, rate: np.ndarray) -> dict[str, np.ndarray]: ...

    def extract(self, value) -> dict[str, float]:
        out = self.extract_batch_segments(pa.array([value], pa.list_(pa.float64())), np.ones(1))
        return {n: float(x[0]) for n, x in out.items()}


def _ready(extractor: BatchExtractor) -> BatchExtractor:
    known = (extractor.name, extractor.version)
    if known not in _READY:
        extractor.set_up()
        _READY[known] = extractor
    return _READY[known]


def _long(key: pa.Array, segment: pa.Array, found: dict[str, np.ndarray]) -> Iterator[pa.Table]:
    for name, x in found.items():
        some = np.flatnonzero(~np.isnan(x))
        at = pa.array(some)
        n = len(some)
        yield pa.table([key.take(at), segment.take(at), pa.array([name] * n, pa.string()), pa.array(x[some]), pa.nulls(n, pa.string())], schema=_OUTPUT)


def _one_by_one(ready: BatchExtractor, key: pa.Array, segment: pa.Array, values: list) -> Iterator[pa.Table]:
    """After a batch has failed: each row by itself, so that a bad one costs no other; its row says why."""
    for k, s, v in zip(key, segment, values):
        try:
            found = {n: np.array([x], float) for n, x in ready.extract(v).items()}
        except Exception as e:  # an extractor's own error becomes the row's
            yield pa.table([pa.array([k.as_py()], pa.string()), pa.array([s.as_py()], pa.int32()), pa.nulls(1, pa.string()), pa.nulls(1, pa.float64()), pa.array([f"{type(e).__name__}: {e}"])], schema=_OUTPUT)
        else:
            yield from _long(pa.array([k.as_py()], pa.string()), pa.array([s.as_py()], pa.int32()), found)


def table_function(extractor: BatchExtractor):
    """A table function of (key, value), or of (key, segment, values, rate) for segments: key, segment, feature, value, error.

    Null values give no rows.
    """
    segments = isinstance(extractor, SegmentExtractor)

    class Call:
        def eval(self, batch: pa.RecordBatch) -> Iterator[pa.Table]:
            ready = _ready(extractor)
            batch = batch.filter(batch.column(2 if segments else 1).is_valid())
            key = batch.column(0).cast(pa.string())
            segment = batch.column(1).cast(pa.int32()) if segments else pa.nulls(batch.num_rows, pa.int32())
            values = batch.column(2 if segments else 1)
            try:
                found = ready.extract_batch_segments(values.cast(pa.list_(pa.float64())), batch.column(3).cast(pa.float64()).to_numpy(zero_copy_only=False)) if segments else ready.extract_batch(values)
            except Exception:  # whichever row it was is found below
                yield from _one_by_one(ready, key, segment, values.to_pylist())
            else:
                yield from _long(key, segment, found)

    return F.arrow_udtf(Call, returnType=OUTPUT)


def register_extractor(spark: SparkSession, extractor: BatchExtractor) -> str:
    """The name under which SQL finds the extractor."""
    name = f"framewell_{extractor.name}"
    spark.udtf.register(name, table_function(extractor))
    return name


class TextShape(BatchExtractor):
    """Characters, words, and the shares of digits and capitals (A-Z) of a text."""

    name = "text_shape"

    def extract(self, value: str) -> dict[str, float]:
        return {n: float(x[0]) for n, x in self.extract_batch(pa.array([value], pa.string())).items()}

    def extract_batch(self, values: pa.Array) -> dict[str, np.ndarray]:
        number = lambda x: x.to_numpy(zero_copy_only=False).astype(float)
        length = number(pc.utf8_length(values))
        some = np.where(length > 0, length, np.nan)
        words = number(pc.count_substring_regex(values, r"[^ \t\n\r\x0b\x0c]+"))
        return {"characters": length, "words": words, "digits": number(pc.count_substring_regex(values, "[0-9]")) / some, "capitals": number(pc.count_substring_regex(values, "[A-Z]")) / some}


class SignalShape(SegmentExtractor):
    """Root mean square, peak and zero crossings a second of a signal's segments; empty ones give nothing."""

    name = "signal_shape"

    def extract_batch_segments(self, values: pa.ListArray, rate: np.ndarray) -> dict[str, np.ndarray]:
        flat = values.flatten().to_numpy(zero_copy_only=False).astype(float)
        n = pc.list_value_length(values).to_numpy(zero_copy_only=False).astype(np.int64)
        some, start = n > 0, np.concatenate([[0], np.cumsum(n)[:-1]])
        out = {k: np.full(len(n), np.nan) for k in ("rms", "peak", "crossings")}
        if some.any():
            at = start[some]
            out["rms"][some] = np.sqrt(np.add.reduceat(flat**2, at) / n[some])
            out["peak"][some] = np.maximum.reduceat(np.abs(flat), at)
            turn = np.concatenate([[0.0], (np.signbit(flat[1:]) != np.signbit(flat[:-1])).astype(float)])
            turn[at] = 0
            out["crossings"][some] = np.add.reduceat(turn, at) * rate[some] / n[some]
        return out
