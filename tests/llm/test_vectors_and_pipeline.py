import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np

from framewell.llm import hnsw


def brute(rows, queries, k):
    out = {}
    for q, v in queries:
        a = np.array(v, float)
        scored = []
        for i, u in rows:
            b = np.array(u, float)
            if i != q and len(a) == len(b):
                scored.append((-float((a * b).sum() / np.sqrt((a * a).sum() * (b * b).sum())), i))
        out[q] = [i for _, i in sorted(scored)[:k]]
    return out


def test_recall_and_scores(spark):
    rng = np.random.default_rng(4)
    centre = rng.normal(size=(20, 16))
    rows = [(i, (centre[i % 20] + 0.4 * rng.normal(size=16)).astype("float32").tolist()) for i in range(3000)]
    df = spark.createDataFrame(rows, "id long, v array<float>")
    queries = [(i, v) for i, v in rows if i % 50 == 0]
    index = hnsw.build_index(df, 5, shard=700)
    got = {}
    for r in hnsw.search(index, df.where("id % 50 = 0").withColumnRenamed("id", "query_id"), 5).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id))
        a, b = (np.array(rows[i][1], float) for i in (r.query_id, r.vec_id))
        assert abs(r.score - (a * b).sum() / np.sqrt((a * a).sum() * (b * b).sum())) < 1e-12
    want = brute(rows, queries, 5)
    hit = sum(len({v for _, v in got[q]} & set(want[q])) for q in want)
    assert hit >= 0.9 * 5 * len(want) and all(sorted(r for r, _ in x) == [1, 2, 3, 4, 5] for x in got.values())


def test_ties_copies_and_unusable_vectors(spark):
    rows = [(i, [1.0, 0.0]) for i in range(0, 40)] + [(100, [0.0, 1.0]), (101, [2.0, 0.0]), (102, None), (103, [0.0, 0.0]), (104, [float("nan"), 1.0]), (105, [1.0, None]), (106, [1.0, 0.0, 0.0]), (7, [1.0, 0.0])]
    df = spark.createDataFrame(rows, "id long, v array<double>")
    out = hnsw.search(hnsw.build_index(df, 5), df.where("id in (0, 100, 102, 103, 106)").withColumnRenamed("id", "query_id"), 5).collect()
    by = {}
    for r in sorted(out, key=lambda r: r["rank"]):
        by.setdefault(r.query_id, []).append(r.vec_id)
    assert by[0] == [1, 2, 3, 4, 5] and by[100] == [0, 1, 2, 3, 4] and 102 not in by and 103 not in by and 106 not in by


def test_no_vectors(spark):
    df = spark.createDataFrame([], "id long, v array<float>")
    some = spark.createDataFrame([(1, [1.0, 2.0]), (2, [2.0, 1.0]), (None, [1.0, 1.0])], "id long, v array<float>")
    assert hnsw.search(hnsw.build_index(df, 5), df.withColumnRenamed("id", "query_id"), 5).collect() == []
    assert hnsw.search(hnsw.build_index(some, 5), df.withColumnRenamed("id", "query_id"), 5).collect() == []
    assert hnsw.search(hnsw.build_index(df, 5), some.withColumnRenamed("id", "query_id"), 5).collect() == []


def test_clashing_columns_are_ignored(spark):
    df = spark.createDataFrame([(i, [1.0, float(i)], 9, 8, b"x", 7) for i in range(30)], "id long, v array<double>, shard int, dim int, ids binary, kind int")
    out = hnsw.search(hnsw.build_index(df, 3), df.where("id % 10 = 0").withColumnRenamed("id", "query_id"), 3).collect()
    assert len(out) == 9 and {r.vec_id for r in out if r.query_id == 20} <= {18, 19, 21, 22}


def test_pipeline_stages(spark, tmp_path):
    import corpus_pipeline as C

    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet").limit(200)
    columns, kept = docs.columns, docs.count()
    for name, stage in C.STAGES:
        out = stage(spark, docs, sf)
        if name != "pack":
            assert out.columns == columns
        out.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        if name != "pack":
            assert 0 < docs.count() <= kept and docs.select("doc_id").distinct().count() == docs.count()
            kept = docs.count()
    per = docs.groupBy("sequence_id").agg({"length": "sum"}).collect()
    assert all(r[1] <= 1024 for r in per)


def test_pipeline_bears_odd_rows(spark):
    import corpus_pipeline as C
    from framewell.llm.store import cut
    from tests.llm.odd import empty, repeated

    for docs in (repeated(spark), empty(spark)):
        for _, stage in C.STAGES:
            docs = cut(stage(spark, docs, "/root/testdata/sf0.001"))
    assert docs.count() == 0


def test_decontamination_goes_by_text_not_by_id(spark, tmp_path):
    """Rows of one id, and rows without an id, each go or stay by their own text."""
    import corpus_pipeline as C

    rng = random.Random(3)
    words = lambda n: " ".join(f"w{rng.randrange(9999)}" for _ in range(n))
    item, clean, other = words(30), words(50), words(40)
    spark.createDataFrame([(1, item), (2, None), (3, "")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    rows = [(1, f"{words(5)} {item}", 1), (1, clean, 2), (None, f"{item} {words(9)}", 3), (None, other, 4), (2, None, 5), (3, "", 6), (4, clean, 7), (None, None, 8), (5, item, 9), (5, item, 10)]
    docs = spark.createDataFrame([(i, t, "en", "s", 0, n) for i, t, n in rows], "doc_id long, text string, lang string, source string, n_chars long, held long")
    kept = C.decontaminate(spark, docs, str(tmp_path))
    assert kept.columns == docs.columns and sorted(r.held for r in kept.collect()) == [2, 4, 5, 6, 7, 8]


def plain_pipeline(spark, rows, items):
    """The pipeline in plain Python: rows (doc_id, text), kept and cut stage by stage; ids of each document's tokens."""
    import public_tokenizers
    from tokenizers import Tokenizer

    from framewell.llm import decontam, language
    from tests.llm.test_text_ops import alnum, components

    docs = spark.createDataFrame([(i, t, lang) for i, t, lang in rows], "doc_id long, text string, lang string")
    model = language.fit(docs, ~language.held_out())
    texts = {}
    for i, t, _ in rows:
        _, score = model.predict([(t or "").encode()])
        if t and any(c.isalpha() for c in t) and score[0] >= model.least:
            texts[i] = t
    groups = components(list(texts.items()), 5, 80)
    texts = {i: t for i, t in texts.items() if groups[i][1] == i}
    gone = covered(sorted(texts.items()), 100)
    texts = {i: "".join(c for c, g in zip(t, gone[i]) if not g) for i, t in texts.items()}
    texts = {i: t for i, t in texts.items() if t.strip() or not any(gone[i])}

    def grams(w):
        return Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else Counter([tuple(w)])

    def holds(t, item):
        w, m = alnum(t), alnum(item)
        return any(decontam.weighted_similarity(grams(w[s : s + len(m)]), grams(m)) >= 0.8 for s in range(max(1, len(w) - len(m) + 1))) if w and m else False

    texts = {i: t for i, t in texts.items() if not any(holds(t, x) for x in items)}
    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    return {i: [*tok.encode(t, add_special_tokens=False).ids, 2] for i, t in texts.items()}


def covered(rows, length):
    """Marks of the characters (ASCII texts) that strings which also start earlier cover."""
    seen, out = set(), {}
    for i, t in rows:
        gone = [False] * len(t)
        for p in range(len(t) - length + 1):
            if t[p : p + length] in seen:
                gone[p : p + length] = [True] * length
            seen.add(t[p : p + length])
        out[i] = gone
    return out


def test_pipeline_equals_plain_python(spark, tmp_path):
    import corpus_pipeline as C

    rng = random.Random(12)
    source = [(r.text, r.lang) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").orderBy("doc_id").limit(60).collect()]
    clean = [(re.sub(r"[^\x20-\x7e]", "e", t)[:1500], lang) for t, lang in source]
    words = lambda n: " ".join(f"{rng.choice(['river', 'table', 'window', 'garden', 'paper'])}{rng.randrange(9999)}" for _ in range(n))
    item, passage = words(30), words(25)
    rows = [(i, t, lang) for i, (t, lang) in enumerate(clean)]
    rows += [(100 + i, clean[i][0], clean[i][1]) for i in range(0, 20, 2)]  # exact copies
    for i in range(1, 20, 3):  # near copies: one word changed
        w = clean[i][0].split(" ")
        w[len(w) // 2] = "changed"
        rows.append((200 + i, " ".join(w), clean[i][1]))
    rows += [(300 + i, f"{clean[20 + i][0][:400]} {words(12)} {passage} {words(20)}", "en") for i in range(6)]
    rows += [(400, f"{words(10)} {item} {words(10)}", "en"), (401, None, "en"), (402, "12345 !!! 999", None), (403, " ", "en")]
    docs = spark.createDataFrame([(i, t, lang, f"s{i % 3}", len(t or "")) for i, t, lang in rows], "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, item), (2, words(20))], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    got = defaultdict(list)
    out = C.run(spark, str(tmp_path)).collect()
    for r in out:
        got[r.doc_id].append((r.piece, r.start, r.length, r.ids_crc32))
    want = plain_pipeline(spark, rows, [item])
    assert set(got) == set(want) and 400 not in got and not set(range(100, 120)) & set(got) and len(got) > 50
    for i, ids in want.items():
        assert sum(n for _, _, n, _ in got[i]) == len(ids)
        for _, start, n, crc in got[i]:
            assert crc == zlib.crc32(np.array(ids[start : start + n], "<u4").tobytes())
    per = defaultdict(list)
    for r in out:
        per[r.sequence_id].append((r.offset, r.length))
    for x in per.values():
        at = 0
        for offset, n in sorted(x):
            assert offset == at
            at += n
        assert at <= 1024
