"""Functions for SQL text: what the library adds to a session (X05 of the survey), and the shape of an extractor."""

from __future__ import annotations

from typing import Protocol

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType


class Extractor(Protocol):
    """A component (X01-X03): the components it needs, and rows(key, ...) to rows(key, feature, value) as a DataFrame."""

    name: str
    requires: tuple[str, ...]

    def extract(self, df: DataFrame) -> DataFrame: ...


def run_extractors(df: DataFrame, extractors: list[Extractor], key: str) -> DataFrame:
    """Long rows key, component, feature, value of all extractors, dependencies checked and in order."""
    from framewell.operators.learning import topo_order

    by_name = {e.name: e for e in extractors}
    order = topo_order({e.name: list(e.requires) for e in extractors})
    parts = [by_name[n].extract(df).select(key, F.lit(n).alias("component"), "feature", "value") for n in order]
    out = parts[0]
    for p in parts[1:]:
        out = out.union(p)
    return out


@F.udtf(returnType="place int, word string")
class Words:
    """The words of a text as rows, for LATERAL joins."""

    def eval(self, text: str):
        for i, w in enumerate((text or "").split()):
            yield i, w


def register(spark: SparkSession) -> list[str]:
    """Adds the library's functions to the session under these names; Arrow batches, never single rows."""
    from framewell.operators.vectors import _vector_ids

    def unit_hash(keys: pd.Series) -> pd.Series:
        import hashlib

        return keys.map(lambda k: None if k is None else int.from_bytes(hashlib.sha256(k.encode()).digest()[:8]) / 2.0**64)

    spark.udf.register("framewell_vector_id", F.pandas_udf(_vector_ids, StringType()))
    spark.udf.register("framewell_unit_hash", F.pandas_udf(unit_hash, DoubleType()))
    spark.udtf.register("framewell_words", Words)
    return ["framewell_vector_id", "framewell_unit_hash", "framewell_words"]
