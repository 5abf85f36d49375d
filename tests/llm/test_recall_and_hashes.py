"""Recall of a full shard on data without clusters; words that polynomials modulo 2**64 cannot tell apart."""

import re

import numpy as np
import pytest

from framewell.llm import hnsw, interpolation, jaccard
from framewell.llm import text as T


@pytest.mark.parametrize("dim", [64])
def test_recall_of_a_full_shard(dim):
    rng = np.random.default_rng(dim)
    v = hnsw.normalised(rng.normal(size=(hnsw.SHARD, dim)))
    graph = hnsw.Graph.build(v, np.arange(len(v)))
    q = hnsw.normalised(rng.normal(size=(200, dim)))
    found = graph.search(q, hnsw.BEAM_SEARCH)
    exact = np.argsort(-(q @ v.T), axis=1)[:, :5]
    got = [f[f >= 0][np.argsort(-(v[f[f >= 0]] @ x), kind="stable")[:5]] for f, x in zip(found, q)]
    assert np.mean([len(set(a) & set(b)) / 5 for a, b in zip(got, exact.tolist())]) >= 0.95


def test_shards_are_bounded_by_rows_and_bytes(spark, monkeypatch):
    df = spark.createDataFrame([(i, [float(i), 1.0, float(i % 7)]) for i in range(600)], "id long, v array<double>")
    monkeypatch.setattr(hnsw, "SHARD", 200)
    assert hnsw.build_index(df, 5).count() == 3
    monkeypatch.setattr(hnsw, "SHARD_BYTES", 50 * 24)
    assert hnsw.build_index(df, 5).count() == 12


def thue_morse(n):
    return "".join("ab"[bin(i).count("1") % 2] for i in range(n)), "".join("ba"[bin(i).count("1") % 2] for i in range(n))


@pytest.mark.parametrize("n", [1024, 2048, 4096])
def test_thue_morse_words_have_hashes_of_their_own(n):
    a, b = thue_morse(n)
    words = T.Words([a.encode(), b.encode(), a.encode()])
    assert words.hash[0] != words.hash[1] and words.hash[0] == words.hash[2]


def test_thue_morse_texts_are_different_to_operators(spark):
    a, b = thue_morse(1024)
    rest = " one two three"
    docs = spark.createDataFrame([(1, a + rest), (2, b + rest), (3, f"{a} {b} {a} {b} x {b} {a} {b} {a}")], "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.jaccard_components(docs, 4, 85).collect()}
    assert got == {1: (1, 1), 2: (1, 2), 3: (6, 3)}
    from pyspark.sql import functions as F

    scored = {r.doc_id: (r.n_known, r.base_score) for r in interpolation.score_documents(docs.where("doc_id < 3"), F.col("doc_id") == 1).collect()}
    assert scored[1][0] == 5 and scored[2][0] == 4 and scored[1][1] > scored[2][1]


def test_hashes_do_not_depend_on_the_place():
    rng = np.random.default_rng(2)
    texts = [bytes(rng.integers(97, 123, rng.integers(1, 30)).astype(np.uint8)) for _ in range(400)]
    alone = {t: int(T.Words([t]).hash[0]) for t in texts}
    together = T.Words(texts)
    assert [alone[t] for t in texts] == together.hash.tolist() and len(set(alone.values())) == len(set(texts))


def test_reading_starts_at_any_slot(spark):
    from framewell.llm import order
    from tests.llm.odd import odd_docs

    manifest, folder = order.materialise(odd_docs(spark), length=64, shard_rows=10)
    sizes = {r.slot: r.n_ids for r in manifest.collect()}
    n = len(sizes)
    read = lambda *a: {r.slot: list(r.ids) for r in order.read_sequences(spark, folder, *a, length=64, shard_rows=10).collect()}
    whole = read()
    assert sorted(whole) == list(range(n)) and {s: len(x) for s, x in whole.items()} == sizes
    for start, count in ((0, 1), (7, 25), (10, 10), (n - 3, None), (n, None), (13, 0)):
        assert read(start, count) == {s: x for s, x in whole.items() if start <= s < (n if count is None else start + count)}
    plan = order.read_sequences(spark, folder, 25, 5, length=64, shard_rows=10)._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[isnotnull\(shard#", plan)
