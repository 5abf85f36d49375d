"""Queries over whole tables against numpy and plain Python."""

import hashlib
import re
import struct
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from framewell import catalog
from framewell.operators import vectors

SF = "/root/testdata/sf0.001"


def run(spark, name):
    return catalog.queries()[name](spark, SF).collect()


@pytest.fixture(params=[97, 8_192])
def blocks(request, monkeypatch):
    monkeypatch.setattr(vectors, "QUERY_ROWS", request.param)
    monkeypatch.setattr(vectors, "GALLERY_ROWS", request.param)


@pytest.fixture(scope="module")
def embedded():
    t = pq.read_table(f"{SF}/embeddings.parquet").sort_by("vec_id")
    v = np.array(t["embedding"].to_pylist(), "float64")
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    return t["vec_id"].to_numpy(), t["label"].to_numpy(), np.round(v @ v.T, 12), v


def best(row, k, leave=()):
    return [j for j in np.lexsort((np.arange(len(row)), -row)) if j not in leave][:k]


def test_topk_of_all_rows(spark, blocks, embedded):
    ids, label, s, _ = embedded
    assert (ids == np.arange(len(ids))).all()
    want = {(i, r, j): s[i, j] for i in ids for r, j in enumerate(best(s[i], 5), 1)}
    got = {(x.query_id, x["rank"], x.vec_id): x.score for x in run(spark, "v08_topk_cosine_all")}
    assert got == pytest.approx(want, abs=1e-5)
    assert {(x.query_id, x.vec_id) for x in run(spark, "v11_threshold_after_k_all")} == {(i, j) for (i, _, j), c in want.items() if round(c, 5) >= 0.4}
    want = {i: (np.mean([s[i, j] for j in best(s[i], 4, {i})]), 4) for i in ids}
    got = {x.query_id: (x.mean_score, x.n) for x in run(spark, "v07_corpus_topk_all")}
    assert got.keys() == want.keys() and all(got[i] == pytest.approx(want[i], abs=1e-5) for i in ids)
    odd = set(np.flatnonzero(label % 2))
    assert {tuple(x) for x in run(spark, "v12_filtered_search_all")} == {(i, r, j) for i in ids for r, j in enumerate(best(s[i], 10, odd), 1)}


def test_tracks_meet_all_rows(spark, blocks, embedded):
    ids, label, s, _ = embedded
    t = s.copy()
    np.fill_diagonal(t, -1)
    want = {(k, j, r) for k in set(label) for r, j in enumerate(best(np.round(t[label == k].max(axis=0), 9), 3), 1)}
    assert {tuple(x) for x in run(spark, "a38_track_topk_all")} == want


def test_topics_of_all_rows(spark, blocks, embedded):
    ids, label, s, _ = embedded
    t = s.copy()
    np.fill_diagonal(t, -1)
    per = np.stack([t[:, label == k].max(axis=1) for k in range(10)], axis=1)
    want = {(i, k, r): per[i, k] for i in ids for r, k in enumerate(best(np.round(per[i], 9), 3), 1)}
    assert {(x.vec_id, x.topic, x["rank"]): x.score for x in run(spark, "a37_topics_all")} == pytest.approx(want, abs=1e-5)


def test_topics_behind_many_prompts(spark, tmp_path):
    """Over 1,000 prompts of one topic are nearer than the first of the others."""
    rows = [(0, [1.0, 0.0], 9)] + [(20 * i + 1, [1.0, i / 1e4], 1) for i in range(1100)] + [(20 * i + 1, [1.0, 2.0 * i - 2000], i % 2 + 2) for i in range(1100, 1104)]
    pq.write_table(pa.table({"vec_id": [r[0] for r in rows], "embedding": [r[1] for r in rows], "label": [r[2] for r in rows]}), tmp_path / "embeddings.parquet")
    out = catalog.queries()["a37_topics"](spark, str(tmp_path)).where("vec_id = 0").orderBy("rank").collect()
    assert [(x.vec_id, x.topic) for x in out] == [(0, 1), (0, 2), (0, 3)]


def test_entropy_of_all_rows(spark, embedded):
    ids, label, _, v = embedded
    raw = np.array(pq.read_table(f"{SF}/embeddings.parquet").sort_by("vec_id")["embedding"].to_pylist(), "float64")
    c = np.array([raw[label == k].mean(axis=0) for k in sorted(set(label))])
    s = np.sort(v @ (c / np.linalg.norm(c, axis=1, keepdims=True)).T, axis=1)[:, -5:]
    p = np.exp((s - s.max(axis=1, keepdims=True)) / 0.1)
    p /= p.sum(axis=1, keepdims=True)
    h = -(p * np.log(p + 1e-12)).sum(axis=1)
    assert {x.vec_id: x.entropy for x in run(spark, "v10_cluster_entropy_all")} == pytest.approx(dict(zip(ids, h)), abs=2e-5)


def test_equal_vectors_rank_by_id(spark, monkeypatch):
    """More equal vectors than k, spread over blocks; a zero, a missing and a shorter one."""
    monkeypatch.setattr(vectors, "QUERY_ROWS", 4)
    monkeypatch.setattr(vectors, "GALLERY_ROWS", 4)
    rows = [(i, [1.0, 2.0]) for i in range(30)] + [(30, [2.0, -1.0]), (31, [0.0, 0.0]), (32, None), (33, [1.0])]
    df = spark.createDataFrame(rows, "id long, v array<double>")
    out = defaultdict(list)
    for x in vectors.top_k_cosine_all(df.withColumnRenamed("id", "q"), df, "q", "id", "v", 3, True).orderBy("q", "rank").collect():
        out[x.q].append(x.id)
    assert out[0] == [1, 2, 3] and out[2] == [0, 1, 3] and out[29] == [0, 1, 2] and out[30] == [0, 1, 2] and set(out) == set(range(31))
    few = vectors.top_k_cosine_all(df.where("id < 2").withColumnRenamed("id", "q"), df.where(F.col("id") == 33), "q", "id", "v", 3)
    assert few.count() == 0


def test_long_texts(spark, tmp_path):
    """Tags and windows far behind any prefix; a length that is missing."""
    words = [f"{a}{b}" for a in ("alpha", "gamma", "delta", "X") for b in "abcdefghij"]
    texts = ["", "a short one", " ".join(words) + " zebra End", "Pad " * 1500 + "quartz Late", ("Word " * 90 + "banana ") * 11]
    t = {"doc_id": list(range(5)), "text": texts, "n_chars": [*map(len, texts[:4]), None]}
    pq.write_table(pa.table(t, pa.schema([("doc_id", pa.int64()), ("text", pa.string()), ("n_chars", pa.int64())])), tmp_path / "documents.parquet")
    q, sf = catalog.queries(), str(tmp_path)
    tags = {x.doc_id: x.tags for x in q["f16_hashtags"](spark, sf).collect()}
    assert tags == {i: ",".join(dict.fromkeys(w.lower() for w in re.findall(r"(?<![\w-])#([\w-]{1,12})(?![\w-])", "#Top " + re.sub(" ([a-z]{5,9}) ", r" #\1 ", x)))) for i, x in enumerate(texts)}
    assert "quartz" in tags[3] and "banana" in tags[4] and "zebra" in tags[2]
    canonical = {x.doc_id: x.tags for x in q["f17_tags_all"](spark, sf).collect()}
    assert canonical == {i: "|".join(sorted({w.lower() for w in x.split(" ")} - {""})[:8]) for i, x in enumerate(texts)} and canonical[3] == "late|pad|quartz"
    want = set()
    for i, n in enumerate(map(len, texts)):
        last = max(n - 32, 0)
        s = sorted({*range(0, last + 1, 64), last})
        for a in {s[round(j * (len(s) - 1) / 7)] for j in range(8)} if len(s) > 8 else s:
            f = [x // 4 for x in range(a, a + 16) if x % 4 == 0 and x <= n]
            want.add((i, f[0], f[-1], len(f)))
    assert {tuple(x) for x in q["w18_union_windows_all"](spark, sf).collect()} == want and {x[0] for x in want} == set(range(5))


def test_every_order_is_predicted(spark):
    orders = pq.read_table(f"{SF}/orders.parquet")["o_orderkey"].to_pylist()
    out = run(spark, "l01_fit_predict")
    assert sorted(x.o_orderkey for x in out) == sorted(orders) and all(x.prediction is not None for x in out)
    out = run(spark, "l03_out_of_fold")
    assert sum(x.n for x in out) == sum(x.predicted for x in out) == len(orders)


def test_k_means_of_all_values(spark):
    """A segment for every row, numbered by its mean, and each value nearest to the mean of its own segment."""
    v = pq.read_table(f"{SF}/lineitem.parquet")["l_linenumber"].to_numpy()
    out = {x.v: (x.segment, x.n) for x in run(spark, "l08_segments_all")}
    assert {k: n for k, (_, n) in out.items()} == dict(zip(*np.unique(v.astype(float), return_counts=True)))
    own = np.array([out[x][0] for x in v])
    means = np.array([v[own == k].mean() for k in range(3)])
    assert (np.diff(means) > 0).all() and (np.abs(v[:, None] - means).argmin(axis=1) == own).all()


def test_vector_ids(spark):
    t = pq.read_table(f"{SF}/embeddings.parquet")
    want = {i: hashlib.sha256(struct.pack(f"<{len(v)}f", *v)).hexdigest()[:24] for i, v in zip(t["vec_id"].to_pylist(), t["embedding"].to_pylist())}
    assert {x.vec_id: x.source_id for x in run(spark, "f27_vector_id")} == want
    odd = spark.createDataFrame([(0, [1.0, 0.1]), (1, None), (2, [])], "i long, v array<double>").select("i", vectors.vector_id("v").alias("h")).collect()
    assert {x.i: x.h for x in odd} == {0: hashlib.sha256(struct.pack("<2f", 1.0, 0.1)).hexdigest()[:24], 1: None, 2: hashlib.sha256(b"").hexdigest()[:24]}
