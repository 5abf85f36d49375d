"""The corpus pipeline: five stages, each over all that the one before kept.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read again as the next
one's docs. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from framewell.llm.decontam import contaminated
from framewell.llm.jaccard import one_of_each
from framewell.llm.language import fit, held_out, identify
from framewell.llm.packing import pack_documents
from framewell.llm.store import cut, release
from framewell.llm.suffix import dedup


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is identified; rejected ones go.

    A null, empty or letterless text is rejected. A very long text is read whole, in slices. Rows that repeat an id or a
    text are each judged, alike for equal texts. With no labelled row to learn from all are rejected, and an empty table
    stays empty. Other columns are kept as they are.
    """
    named = identify(docs, fit(docs, ~held_out()))
    return named.where(~F.col("lang_rejected")).select("doc.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (five-word shingles, similarity 0.8): the smallest doc_id, null last.

    Texts without words link with nothing and stay. Rows that repeat both id and text of a kept one go; rows that repeat
    an id with another text are documents of their own. An empty table stays empty.
    """
    return one_of_each(docs, k=5, percent=80)


def repeated_strings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without strings of 100 bytes that occur earlier; documents of which nothing is left go.

    The earlier document is that of the smaller doc_id. Null, empty and short texts stay as they are. An empty table stays
    empty. Columns but text and n_chars are kept as they are.
    """
    out = dedup(docs, length=100)
    out = out.where((F.col("n_removed") == 0) | (F.length(F.trim("kept_text")) > 0))
    new = {"text": F.col("kept_text"), "n_chars": F.length("kept_text").cast("long")}
    changed = lambda c: F.when(F.col("n_removed") > 0, new[c]).otherwise(F.col(f"doc.{c}")).alias(c) if c in new else F.col(f"doc.`{c}`")
    return out.select(*(changed(c) for c in docs.columns))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item. A row goes or stays by its text alone, whatever its doc_id, null or repeated.

    Null and empty texts, and rows held against no or only empty items, stay. An empty table stays empty.
    """
    text = F.xxhash64("text")
    found = contaminated(docs.select(text.alias("doc_id"), "text"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    found = cut(found.select(F.col("doc_id").alias("held")).distinct())
    return docs.join(found, text == found["held"], "left_anti")


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The packed sequences of what is left: a row for each piece. A null text is empty, its one token the end; a text longer
    than a sequence is cut into pieces; rows that repeat are packed each. An empty table gives no rows.
    """
    return pack_documents(docs, capacity=1024)


STAGES = [("language", language), ("near_duplicates", near_duplicates), ("repeated_strings", repeated_strings), ("decontaminate", decontaminate), ("pack", pack)]

#: Trained and tokenizer-bound stages have no SQL; tests hold the pipeline against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        before, docs = docs, cut(stage(spark, docs, sf_dir))
        release(before)
    return STAGES[-1][1](spark, docs, sf_dir)
