"""Every text operator on texts of some megabytes, with what is looked for at their very end."""

import random

import pytest
from pyspark.sql import functions as F

from framewell.llm import bitslice, collocations, decontam, exact, interpolation, jaccard, language, licenses, order, packing, suffix, wordpiece
from tests.llm.odd import WORDS, prose

ITEM = "seven grey owls counted every lantern beside the frozen canal before dawn arrived"
N = 400_000


@pytest.fixture(scope="module")
def long_docs(spark):
    rng = random.Random(6)
    body = " ".join(f"{WORDS[i % len(WORDS)]}{rng.randrange(100_000)}" for i in range(N))
    passage = prose(rng, 60)
    text = f"{passage} {body} under the MIT license {passage} {ITEM}"
    other = text.replace("lantern", "lamp")
    return spark.createDataFrame([(1, text, "en"), (2, other, "en"), (3, "ein kurzer Text über nichts", "de")], "doc_id long, text string, lang string").repartition(3)


def by_id(df):
    return {r.doc_id: r for r in df.collect()}


def test_counts_scores_and_labels(long_docs):
    n = {r.doc_id: len(r.text.split()) for r in long_docs.collect()}
    assert n[1] > N
    got = by_id(wordpiece.token_counts(long_docs))
    assert all(got[i].n_words == n[i] for i in n)
    got = by_id(interpolation.score_documents(long_docs, F.lit(True)))
    assert all(got[i].n_tokens == n[i] + 1 for i in n)
    got = by_id(licenses.license_digest(long_docs))
    assert got[1].n_words == n[1] and got[1].base_labels == "mit" and got[1].first_word > N
    model = language.fit(long_docs, F.lit(True))
    got = {r.doc.doc_id: r.lang_pred for r in language.identify(long_docs, model).collect()}
    assert got == {1: "en", 2: "en", 3: "de"}


def test_duplicates_and_passages(spark, long_docs):
    got = by_id(jaccard.jaccard_components(long_docs, 5, 80))
    assert got[1].component_id == got[2].component_id == 1 and got[3].component_id == 3 and got[1].n_shingles > 0.9 * N
    got = by_id(suffix.dedup(long_docs, 100, False))
    assert got[1].n_spans == 1 and got[1].n_removed >= 200 and got[2].n_removed > 0.99 * got[2].n_bytes
    bench = spark.createDataFrame([(7, ITEM)], "item_id long, text string")
    got = by_id(decontam.contaminated(long_docs, bench))
    assert set(got) == {1} and got[1].similarity == 1.0 and got[1].start_word > N


def test_tokens(long_docs):
    from framewell.llm.tokens import byte_bpe, default_paths

    bpe = byte_bpe(*default_paths())
    n = {r.doc_id: len(bpe.document(r.text)) for r in long_docs.collect()}
    pieces = packing.pack_documents(long_docs).groupBy("doc_id").agg(F.sum("length").alias("n"), F.max("length").alias("most")).collect()
    assert {r.doc_id: r.n for r in pieces} == n and max(r.most for r in pieces) == 1024
    manifest = order.materialise(long_docs)[0].agg(F.sum("n_ids").alias("n"), F.count("*").alias("c")).first()
    assert manifest.n == sum(n.values()) and manifest.c == -(-manifest.n // 512)


def test_search_phrases_and_copies(spark, long_docs):
    items = spark.createDataFrame([(7, ITEM), (8, "lantern kurzer")], "item_id long, text string")
    got = [(r.item_id, r["rank"], r.doc_id) for r in bitslice.ranked(long_docs, items, 2).collect()]
    assert (7, 1, 1) in got and (7, 2, 2) in got and {d for i, _, d in got if i == 8} == {1, 3}
    # One text without an end of a piece is a shard by itself, longer than others.
    found = {(r.lang, r.phrase): (r.a, r.l, r.r) for r in collocations.collocations(long_docs.where("doc_id < 3"), 3, 2, top=10**6).collect()}
    assert ("en", "seven grey owls") in found and found["en", "seven grey owls"] == (2, 2, 2) and ("en", "kurzer text") not in found
    twice = long_docs.union(long_docs.where("doc_id = 1").select(F.col("doc_id") + 10, F.upper("text"), "lang"))
    got = by_id(exact.exact_groups(twice))
    assert (got[1].keep_id, got[1].group_size, got[1].kept) == (11, 2, False) and got[11].kept and got[2].group_size == 1
