"""License scans by diagonal voting, in DataFrame operations only.

Texts and templates are words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after A-Z is lower-cased. Hashes of all rolling
GRAM-word grams of the texts are joined to the templates' grams; a hit votes for the diagonal (place in the text less
place in the template). Short phrases must win all votes of one diagonal: their words then stand consecutively. For
longer templates neighbouring diagonals (words put in or left out) are merged into one span, and a span counts when
it holds at least COVER of the template's grams; hits of grams are verified on the words themselves, not on hashes.
Notices that differ in a few words verify each other's spans, so of spans that overlap only those with the largest
share count.

A document's labels are those of its phrases and of its verified spans; its score is the best span's share of the
template's grams (1 for a phrase), 0 without any. Null and empty texts have no words; very long ones are scanned
whole. Repeated rows, and rows that repeat a doc_id with another text, are each scored; a null doc_id stays null.
Other columns, whatever their names, are ignored. Empty tables give an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

GRAM = 3
#: Share of a template's grams that verifies a span.
COVER = 0.5
#: Grams of templates that are broadcast; a larger table is joined by a shuffle.
BROADCAST_GRAMS = 200_000
#: Diagonals that differ by at most so many words are neighbours.
DRIFT = 4
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Phrases and labels of the base rule.
PHRASES = (
    ("under the mit license", "mit"),
    ("apache license version 2", "apache-2"),
    ("cc by nc", "cc-by-nc"),
)
#: Openings of well-known public licence notices, lower-cased words.
NOTICES = (
    ("permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files", "mit"),
    ("licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license", "apache-2"),
    ("redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met", "bsd"),
    ("this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation", "gpl"),
    ("this work is licensed under the gnu general public license", "gpl"),
    ("permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", "isc"),
    ("this source code form is subject to the terms of the mozilla public license v 2 0", "mpl-2"),
    ("this work is licensed under a creative commons attribution noncommercial 4 0 international license", "cc-by-nc"),
    ("this work is licensed under a creative commons attribution 4 0 international license", "cc-by"),
    ("this work is licensed under a creative commons attribution sharealike 4 0 international license", "cc-by-sa"),
    ("this work is licensed under a creative commons attribution noderivatives 4 0 international license", "cc-by-nd"),
    ("this work is licensed under a creative commons attribution noncommercial sharealike 4 0 international license", "cc-by-nc-sa"),
    ("this work is licensed under a creative commons attribution noncommercial noderivatives 4 0 international license", "cc-by-nc-nd"),
    ("licensed under cc by nc 4 0", "cc-by-nc"),
    ("released under the mit license", "mit"),
)
WORD = "[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"
GAP = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"


def lower_ascii(text: Column) -> Column:
    """A-Z to a-z and nothing else; the fast built-in where every character is ASCII."""
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def words(text: Column) -> Column:
    return F.filter(F.split(lower_ascii(F.coalesce(text, F.lit(""))), GAP), lambda w: w != "")


def templates(spark: SparkSession, phrases=PHRASES, notices=NOTICES) -> DataFrame:
    """One row for each gram of each template: gram, template, place, grams (of the template), label, exact.

    notices may be a table (body, label) of whole licence texts. A template needs GRAM words.
    """
    if any(len(body.split(" ")) < GRAM for body, _ in phrases):
        raise ValueError(f"a phrase needs {GRAM} words")
    own = spark.createDataFrame([(n, *p, True) for n, p in enumerate(phrases)], "template long, body string, label string, exact boolean")
    if isinstance(notices, DataFrame):
        more = notices.select(F.xxhash64("label", "body").alias("template"), "body", "label", F.lit(False).alias("exact"))
    else:
        more = spark.createDataFrame([(len(phrases) + n, *p, False) for n, p in enumerate(notices)], own.schema)
    rows = own.union(more).select("template", words(F.col("body")).alias("w"), "label", "exact").where(F.size("w") >= GRAM)
    rows = rows.select("template", "label", "exact", (F.size("w") - (GRAM - 1)).alias("grams"), F.posexplode(F.transform(F.sequence(F.lit(1), F.size("w") - (GRAM - 1)), lambda i: F.array_join(F.slice("w", i, GRAM), " "))).alias("place", "gram"))
    return rows.withColumn("h", F.xxhash64("gram"))


def scan(docs: DataFrame, phrases=PHRASES, notices=NOTICES, cover: float = COVER) -> tuple[DataFrame, DataFrame]:
    """The documents' keys with n_words, and the verified spans: keys, template, label, exact, begin, end, share.

    Keys are doc_id, and hash and length of the text, so that rows sharing a doc_id stay apart.
    """
    table = templates(docs.sparkSession, phrases, notices)
    if not isinstance(notices, DataFrame) or table.count() <= BROADCAST_GRAMS:
        table = F.broadcast(table)
    text = F.coalesce(F.col("text"), F.lit(""))
    keyed = docs.select("doc_id", text.alias("text"))
    key = ["doc_id", "text_hash", "text_bytes"]
    identity = {"text_hash": F.xxhash64("text"), "text_bytes": F.octet_length("text")}
    counted = keyed.select("doc_id", *(c.alias(n) for n, c in identity.items()), F.size(words(F.col("text"))).cast("long").alias("n_words"))
    grams = keyed.select("doc_id", *(c.alias(n) for n, c in identity.items()), words(F.col("text")).alias("w")).where(F.size("w") >= GRAM)
    # Word i's gram is words i .. i + GRAM - 1: the array zipped with itself, shifted.
    shifted = [F.slice("w", i + 1, F.size("w") - (GRAM - 1)) for i in range(GRAM)]
    grams = grams.select(*key, F.posexplode(F.arrays_zip(*(s.alias(f"w{i}") for i, s in enumerate(shifted)))).alias("at", "g"))
    grams = grams.select(*key, "at", F.concat_ws(" ", *(F.col(f"g.w{i}") for i in range(GRAM))).alias("gram"))
    hits = grams.withColumn("h", F.xxhash64("gram")).join(table.withColumnRenamed("gram", "own"), ["h"]).where("gram = own")
    # Identical rows give identical hits; each counts once.
    hits = hits.select(*key, "template", "label", "exact", "grams", "place", "at", (F.col("at") - F.col("place")).alias("diagonal"))
    votes = hits.groupBy(*key, "template", "label", "exact", "grams", "diagonal").agg(F.collect_set("place").alias("places"), F.min("at").alias("lo"), F.max("at").alias("hi"))
    phrase = votes.where(F.col("exact") & (F.size("places") == F.col("grams")))
    phrase = phrase.select(*key, "template", "label", "exact", F.col("diagonal").alias("begin"), (F.col("diagonal") + F.col("grams") + GRAM - 2).alias("end"), F.lit(1.0).alias("share"))
    # Neighbours: by template, in order of the first hit, diagonals close to the one before.
    run = Window.partitionBy(*key, "template").orderBy("lo", "diagonal")
    loose = votes.where(~F.col("exact")).withColumn("new", (F.abs(F.col("diagonal") - F.lag("diagonal").over(run)) > DRIFT) | F.lag("diagonal").over(run).isNull() | (F.col("lo") - F.lag("hi").over(run) > F.col("grams")))
    loose = loose.withColumn("span", F.sum(F.col("new").cast("int")).over(run))
    loose = loose.groupBy(*key, "template", "label", "exact", "grams", "span").agg(F.size(F.array_distinct(F.flatten(F.collect_list("places")))).alias("got"), F.min("lo").alias("begin"), (F.max("hi") + GRAM - 1).alias("end"))
    loose = loose.withColumn("share", F.col("got") / F.col("grams")).where(F.col("share") >= cover)
    # Spans that overlap: of these the best.
    ahead = Window.partitionBy(*key).orderBy("begin", "end", "template")
    loose = loose.withColumn("apart", F.coalesce(F.col("begin") > F.max("end").over(ahead.rowsBetween(Window.unboundedPreceding, -1)), F.lit(True)))
    loose = loose.withColumn("heap", F.sum(F.col("apart").cast("int")).over(ahead.rowsBetween(Window.unboundedPreceding, 0)))
    loose = loose.withColumn("best", F.max("share").over(Window.partitionBy(*key, "heap"))).where("share = best")
    return counted, phrase.unionByName(loose.select(*phrase.columns))


def license_digest(docs: DataFrame, phrases=PHRASES, notices=NOTICES, cover: float = COVER) -> DataFrame:
    """Per row: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score."""
    counted, spans = scan(docs, phrases, notices, cover)
    key = ["doc_id", "text_hash", "text_bytes"]
    base = F.when(F.col("exact"), F.col("begin"))
    joined = lambda c: F.array_join(F.array_sort(F.collect_set(c)), ",")
    found = spans.groupBy(*key).agg(F.count(base).alias("n_base"), F.min(base).cast("long").alias("first_word"), F.max(base).cast("long").alias("last_word"), joined(F.when(F.col("exact"), F.col("label"))).alias("base_labels"), joined(F.col("label")).alias("labels"), F.max("share").alias("score"))
    same = [counted[c].eqNullSafe(found[c]) for c in key]
    out = counted.join(found, same, "left")
    return out.select(counted["doc_id"], "n_words", F.coalesce("n_base", F.lit(0)).alias("n_base"), "first_word", "last_word", F.coalesce("base_labels", F.lit("")).alias("base_labels"), F.coalesce("labels", F.lit("")).alias("labels"), F.coalesce("score", F.lit(0.0)).alias("score"))
