"""Each operator against a brute-force version, and on odd, repeated and missing rows."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from framewell.llm import decontam, interpolation, jaccard, language, licenses, order, packing, suffix, wordpiece
from framewell.llm import text as T
from tests.llm.odd import empty, odd_docs, prose, repeated

LOW = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def words(t):
    return re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(LOW))


def alnum(t):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(LOW))


def components(rows, k, percent):
    sets = {}
    for i, t in rows:
        w = words(t)
        sets[i] = {tuple(w[j : j + k]) for j in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set()
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            both = len(sets[a] & sets[b])
            if a < b and both and 100 * both >= percent * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in ids}


@pytest.mark.parametrize(("block", "classes"), [(2048, (6, 12)), (3, (1, 2)), (5, (2, 3)), (2048, (1, 4))])
def test_jaccard_matches_all_pairs(spark, monkeypatch, block, classes):
    monkeypatch.setattr(jaccard, "BLOCK", block)
    docs = odd_docs(spark)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.jaccard_components(docs, 4, 85, classes).collect()}
    assert got == components([(r.doc_id, r.text) for r in docs.collect()], 4, 85)


def near_copies(count, length, seed):
    """Copies of one text with more or fewer words changed: some link to the first, some only to others, some to none."""
    rng = random.Random(seed)
    base = prose(rng, length).split(" ")
    out = []
    for i in range(count):
        own = list(base)
        for _ in range(rng.choice([0, 1, 2, 3, 4, 6]) * length // 100):
            own[rng.randrange(length)] = f"x{rng.randrange(10**9)}"
        out.append((i, " ".join(own)))
    return out


@pytest.mark.parametrize(("block", "classes"), [(2048, (6, 12)), (16, (2, 5)), (16, (3, 6))])
def test_jaccard_of_a_large_cluster_and_a_common_line(spark, monkeypatch, block, classes):
    monkeypatch.setattr(jaccard, "BLOCK", block)
    rng = random.Random(8)
    line = prose(rng, 12)
    rows = near_copies(90, 150, 3) + [(200 + i, f"{line} {prose(rng, rng.randrange(0, 6))}") for i in range(90)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for percent in (80, 85):
        got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.jaccard_components(docs, 4, percent, classes).collect()}
        want = components(rows, 4, percent)
        assert got == want and len({c for _, c in want.values()}) > 5


def test_jaccard_of_very_long_texts(spark):
    rows = near_copies(70, 20_000, 5)[:100]
    docs = spark.createDataFrame([(i, t) for i, t in rows], "doc_id long, text string").repartition(8)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.jaccard_components(docs, 5, 80).collect()}
    assert got == components(rows, 5, 80)


def test_jaccard_bears_null_repeated_and_no_rows(spark):
    assert jaccard.jaccard_components(repeated(spark)).count() == repeated(spark).count()
    assert jaccard.jaccard_components(empty(spark)).collect() == []
    a, b, c = "one two three four five six", "seven eight nine ten eleven twelve", "red blue green white black grey"
    docs = spark.createDataFrame([(1, a), (1, b), (2, a), (None, c), (None, b), (5, c + " x"), (None, "a lonely text of six words"), (None, None)], "doc_id long, text string")
    got = sorted(((r.doc_id or 0, r.n_shingles, r.component_id) for r in jaccard.jaccard_components(docs, 5, 60).collect()), key=str)
    assert got == sorted([(1, 2, 1), (1, 2, 1), (2, 2, 1), (0, 2, 5), (0, 2, 1), (5, 3, 5), (0, 2, None), (0, 0, None)], key=str)
    kept = jaccard.one_of_each(docs, 5, 60).collect()
    assert sorted(r.text or "" for r in kept) == sorted([a, b, c + " x", "a lonely text of six words", ""])


def test_one_of_each_keeps_columns_of_any_name(spark):
    docs = spark.createDataFrame([(1, "a b c d e f", "keep", 1), (1, "a b c d e f", "other", 2), (2, "a b c d e f", "third", 3)], "doc_id long, text string, _r string, t int")
    out = jaccard.one_of_each(docs).collect()
    assert len(out) == 1 and out[0]._r in ("keep", "other") and jaccard.one_of_each(docs).columns == docs.columns


@pytest.mark.parametrize("percent", [60, 80, 85, 95])
def test_signatures_lose_no_pair(percent):
    rng = np.random.default_rng(3)
    tried = 0
    for _ in range(3000):
        n = int(rng.integers(1, 80))
        a = np.unique(rng.integers(0, 2**63, n).astype(np.uint64))
        b = np.unique(np.concatenate([a[rng.random(len(a)) < 1 - rng.random() * 0.2], rng.integers(0, 2**63, int(rng.integers(0, 1 + n // 6))).astype(np.uint64)]))
        both = len(np.intersect1d(a, b))
        if not both or 100 * both < percent * (len(a) + len(b) - both) or both == len(a) == len(b):
            continue
        # Any level of two or more that both sides see alike, as counts over all sets give.
        shared, low = rng.integers(2, 6), rng.integers(0, 1 << 30)
        level = lambda s: np.where(np.isin(s, a) & np.isin(s, b), shared + (T.mix(s + np.uint64(low)) % np.uint64(12)).astype(np.int64) * (low % 3), rng.integers(1, 16, len(s)))
        assert set(jaccard.signatures(a, level(a), percent).tolist()) & set(jaccard.signatures(b, level(b), percent).tolist())
        assert len(jaccard.signatures(a, level(a), percent)) <= 4 * len(a)
        tried += 1
    assert tried > 100


def removed(rows, length):
    seen, out = set(), {}
    for i, t in sorted(rows):
        b = (t or "").encode()
        gone = bytearray(len(b))
        for p in range(len(b) - length + 1):
            w = b[p : p + length]
            if w in seen:
                gone[p : p + length] = b"\1" * length
            seen.add(w)
        kept = bytes(x for x, g in zip(b, gone) if not g)
        runs = sum(1 for j in range(len(b)) if gone[j] and (j == 0 or not gone[j - 1]))
        out[i] = (len(b), sum(gone), runs, hashlib.sha256(kept).hexdigest())
    return out


@pytest.mark.parametrize(("length", "hot"), [(100, 4096), (100, 0), (40, 2), (20, 4096)])
def test_suffix_removal_matches_brute_force(spark, length, hot):
    docs = odd_docs(spark)
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffix.dedup(docs, length, False, hot).collect()}
    assert got == removed([(r.doc_id, r.text) for r in docs.collect()], length)


def test_suffix_keeps_whole_rows(spark):
    docs = repeated(spark)
    out = suffix.dedup(docs, 40).select("doc.*", "n_removed", F_kept()).collect()
    assert len(out) == docs.count() and all(r["_text"] == "clash" for r in out)
    same = [r for r in out if r.doc_id == 1]
    assert len(same) == 3 and sorted(r.n_removed > 0 for r in same) == [False, True, True] or sum(r.n_removed > 0 for r in same) >= 2
    assert suffix.dedup(empty(spark), 40).collect() == []


def F_kept():
    from pyspark.sql import functions as F

    return F.col("kept_text").alias("kept")


def test_refine_equals_windows():
    rng = np.random.default_rng(5)
    buf = rng.integers(97, 99, 400).astype(np.uint8)
    start = np.arange(400 - 30)
    got = suffix.refine(buf, start, 30)
    by = defaultdict(set)
    for s, b in zip(start, got):
        by[b].add(buf[s : s + 30].tobytes())
    assert all(len(v) == 1 for v in by.values()) and len(by) == len({buf[s : s + 30].tobytes() for s in start})


@pytest.mark.parametrize("lengths", [[1], [700] * 50, list(range(1, 1024)), [1024] * 3 + [1, 2, 3], [512] * 9 + [511] * 9 + [2] * 5])
def test_plan_places_every_piece_once(lengths):
    places, made = packing.plan(dict(Counter(lengths)), 1024)
    fill = defaultdict(list)
    for n, _, count, base, copies, offset in places:
        for i in range(count):
            fill[base + i // copies].append((offset + i % copies * n, n))
    assert sorted(fill) == list(range(made)) and sum(len(x) for x in fill.values()) == len(lengths)
    for x in fill.values():
        at = 0
        for offset, n in sorted(x):
            assert offset == at
            at += n
        assert at <= 1024
    assert made <= max(-(-sum(lengths) // 1024) * 1.12 + 1, sum(n > 512 for n in lengths))


def best_fit_decreasing(lengths, capacity):
    """Sequences that plain best-fit decreasing opens."""
    rooms = Counter()
    for n in sorted(lengths, reverse=True):
        room = min((r for r in rooms if r >= n), default=None)
        if room is not None:
            rooms[room] -= 1
            rooms += Counter()
        rooms[(capacity if room is None else room) - n] += 1
    return sum(rooms.values())


@pytest.mark.parametrize("low, high, count", [(65, 1023, 5000), (1, 1024, 3000), (300, 700, 3000), (1, 200, 5000)])
def test_plan_is_no_worse_than_best_fit_decreasing(low, high, count):
    lengths = np.random.default_rng(low).integers(low, high, count).tolist()
    made = packing.plan(dict(Counter(lengths)), 1024)[1]
    assert -(-sum(lengths) // 1024) <= made <= best_fit_decreasing(lengths, 1024)


def test_plan_of_the_documents(spark):
    from framewell.llm.tokens import byte_bpe, default_paths

    bpe = byte_bpe(*default_paths())
    texts = [r.text for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("text").collect()]
    lengths = [n for t in texts for n in packing.cut_lengths(len(bpe.document(t)), 1024)]
    assert packing.plan(dict(Counter(lengths)), 1024)[1] <= best_fit_decreasing(lengths, 1024)


def test_groups_are_of_equal_cardinality():
    left = dict(Counter(np.random.default_rng(4).integers(65, 1023, 10_000).tolist()))
    classes = packing.grouped(left, 64, 1024, 100)
    assert sum(c for of in classes.values() for _, c in of) == 10_000 and all(n <= s for s, of in classes.items() for n, _ in of)
    assert all(sum(c for _, c in of) % 100 == 0 for of in classes.values())


SPECIAL = [(5000, "before <|endoftext|> after", None, "s", 1, 1, "k", 2, b"x", "clash", 3, "clash"), (5001, "<|endoftext|>", None, "s", 1, 1, "k", 2, b"x", "clash", 3, "clash")]


def test_packing_ids_and_layout(spark):
    docs = odd_docs(spark)
    docs = docs.union(spark.createDataFrame(SPECIAL, docs.schema))
    from tokenizers import Tokenizer

    import public_tokenizers

    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    out = packing.pack_documents(docs, 256).collect()
    by = defaultdict(list)
    for r in out:
        by[r.doc_id].append(r)
    for d in docs.collect():
        ids = tok.encode(d.text or "", add_special_tokens=False).ids + [2]
        pieces = sorted(by[d.doc_id], key=lambda r: r.piece)
        assert [r.piece for r in pieces] == list(range(len(pieces))) and sum(r.length for r in pieces) == len(ids)
        for r in pieces:
            assert r.ids_crc32 == zlib.crc32(np.array(ids[r.start : r.start + r.length], "<u4").tobytes())
            assert r.length == 256 or r.piece == 0
    for seq in {r.sequence_id for r in out}:
        at = 0
        for r in sorted((r for r in out if r.sequence_id == seq), key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 256
    assert packing.pack_documents(empty(spark)).collect() == []
    assert packing.pack_documents(repeated(spark)).select("doc_id").count() >= repeated(spark).count()


def test_wordpiece_equals_greedy(spark):
    import public_tokenizers

    pieces = wordpiece.pieces_of(public_tokenizers.path("piece_bpe_32k.model"))
    known, longest = {*pieces, *(bytes([b]) for b in range(256))}, max(map(len, pieces))

    def greedy(w):
        n = i = 0
        while i < len(w):
            i = next(j for j in range(min(len(w), i + longest), i, -1) if w[i:j] in known)
            n += 1
        return n

    docs = odd_docs(spark)
    got = {r.doc_id: r for r in wordpiece.token_counts(docs).collect()}
    for d in docs.collect():
        own = [greedy(wordpiece.MARK + w) for w in (d.text or "").encode().split()]
        assert (got[d.doc_id].n_words, got[d.doc_id].n_tokens, got[d.doc_id].longest_word) == (len(own), sum(own), max(own, default=0))
    assert wordpiece.token_counts(empty(spark)).collect() == [] and wordpiece.token_counts(repeated(spark)).count() == repeated(spark).count()


def test_shards_read_back(spark):
    import public_tokenizers
    from tokenizers import Tokenizer

    docs = odd_docs(spark)
    docs = docs.union(spark.createDataFrame(SPECIAL, docs.schema)).union(docs.where("doc_id = 7")).union(docs.where("doc_id = 8").selectExpr("NULL", *docs.columns[1:]))
    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    rows = sorted(((r.doc_id, r.h, r.text or "") for r in docs.selectExpr("doc_id", "xxhash64(text) AS h", "text").collect()), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    stream = [(d, x) for d, _, t in rows for x in [*tok.encode(t, add_special_tokens=False).ids, 2]]
    n = -(-len(stream) // 64)
    found = []
    for parts in (1, 3, 50):
        manifest, folder = order.materialise(docs.repartition(parts), length=64, shard_rows=10)
        found.append(sorted((r.slot, r.shard, r.byte_offset, r.n_ids, r.ids_crc32, tuple(r.doc_ids)) for r in manifest.collect()))
    assert found[0] == found[1] == found[2] and [r[0] for r in found[0]] == list(range(n))
    raw = {}
    for r in spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "part-*").load(folder).collect():
        raw[int(re.search(r"shard=(\d+)", r.path)[1])] = bytes(r.content)
    assert all(len(v) % 129 == 0 for v in raw.values()) and sum(len(v) for v in raw.values()) == 129 * n
    at = order.feistel(np.arange(n), n, 20_240_601)
    for number, slot in enumerate(at.tolist()):
        own = stream[64 * number : 64 * number + 64]
        _, shard, offset, n_ids, crc, held = found[0][slot]
        ids = np.frombuffer(raw[shard][offset : offset + 128], "<u2").tolist()
        assert shard == slot // 10 and ids == [x for _, x in own] + [order.PAD] * (64 - len(own)) and n_ids == len(own)
        assert crc == zlib.crc32(np.array(ids[:n_ids], "<u2").tobytes())
        ends = [i for i, (_, x) in enumerate(own[:-1]) if x == 2]
        assert list(held)[0] == own[0][0] and set(held) == {d for d, _ in own} and len(held) >= len({d for d, _ in own}) and len(ends) >= len(held) - 1
    m, f = order.materialise(empty(spark))
    assert m.collect() == [] and f is None


def test_feistel_is_a_permutation():
    for n in (1, 2, 3, 7, 100, 1025):
        x = order.feistel(np.arange(n), n, 9)
        assert sorted(x) == list(range(n)) and (order.feistel(x, n, 9, True) == np.arange(n)).all()


def test_licenses_count_consecutive_words(spark):
    texts = ["Released under the MIT License. under the MIT license", "apache license, version 2.0", "cc by nc CC-BY-NC", "cc by", None, "", "K under the mit licenses", " ".join(licenses.NOTICES[0][0].split()[:14]), licenses.NOTICES[2][0].replace("source and", "source extra and")]
    docs = spark.createDataFrame([(i, t, "clash") for i, t in enumerate(texts)], "doc_id long, text string, label string")
    got = {r.doc_id: r for r in licenses.license_digest(docs).collect()}
    for i, t in enumerate(texts):
        w = alnum(t)
        hits = [(j, lab) for p, lab in licenses.PHRASES for j in range(len(w)) if w[j : j + len(p.split())] == p.split()]
        r = got[i]
        assert (r.n_words, r.n_base, r.first_word, r.last_word) == (len(w), len(hits), min((j for j, _ in hits), default=None), max((j for j, _ in hits), default=None))
        assert r.base_labels == ",".join(sorted({lab for _, lab in hits})) and set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) and 0 <= r.score <= 1
    assert got[7].labels == "mit" and got[8].labels == "bsd" and got[3].labels == ""
    assert licenses.license_digest(empty(spark)).collect() == [] and licenses.license_digest(repeated(spark)).count() == repeated(spark).count()


def test_each_notice_gets_its_own_label_only(spark):
    own = [(i, f"Some words before. {body.upper()} and some after", label) for i, (body, label) in enumerate(licenses.NOTICES)]
    got = {r.doc_id: r.labels for r in licenses.license_digest(spark.createDataFrame(own, "doc_id long, text string, label string")).collect()}
    for i, _, label in own:
        assert label in got[i].split(",") and set(got[i].split(",")) <= {label, *(x for p, x in licenses.PHRASES if p in own[i][1].lower())}
    whole = spark.createDataFrame([(" ".join(f"clause{i} of the long text" for i in range(300)), "own")], "body string, label string")
    text = whole.first().body
    docs = spark.createDataFrame([(1, f"x {text} y"), (2, text[:1000]), (3, text[:8000])], "doc_id long, text string")
    assert [r.labels for r in licenses.license_digest(docs, notices=whole).orderBy("doc_id").collect()] == ["own", "", "own"]


def test_decontamination_matches_all_windows(spark):
    rows = [(r.doc_id, r.text) for r in odd_docs(spark).collect()]
    item = " ".join(words(rows[1][1])[:40])
    near = item.split(" ")
    near[0] = "other"
    bench = spark.createDataFrame([(1, item), (2, "short one"), (3, None), (4, " ".join(near)), (5, "two words")], "item_id long, text string")
    docs = spark.createDataFrame([*rows, (500, f"Intro, {item.upper()}! outro of it"), (501, "Two words")], "doc_id long, text string")
    got = {(r.doc_id, r.item_id): (r.start_word, r.n_words, round(r.similarity, 9)) for r in decontam.contaminated(docs, bench).collect()}

    def grams(w):
        return Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else Counter([tuple(w)] if w else [])

    want = {}
    for d in docs.collect():
        w = alnum(d.text)
        for b in bench.collect():
            m = alnum(b.text)
            if not m or not w:
                continue
            best = None
            for s in range(max(1, len(w) - len(m) + 1)):
                sim = decontam.weighted_similarity(grams(w[s : s + len(m)]), grams(m))
                if sim >= 0.8 and (best is None or sim > best[2] + 1e-12):
                    best = (s, min(len(m), len(w)), sim)
            if best:
                want[d.doc_id, b.item_id] = (best[0], best[1], round(best[2], 9))
    assert got == want and (500, 1) in got
    assert decontam.contaminated(empty(spark), bench).collect() == [] and decontam.contaminated(docs, bench.limit(0)).collect() == []


@pytest.mark.parametrize("size", [60, 150, 400])
def test_near_copies_of_long_items_are_found(size):
    """Windows near similarity 0.8, one edit of adjoining words: almost all lie within the radius."""
    rng = random.Random(size)
    item = [f"w{rng.randrange(10**6)}" for _ in range(size)]
    index = decontam.Index([(1, " ".join(item).encode())])
    found = 0
    for _ in range(200):
        edit = int((size - 4) / 9) - 4 if size > 80 else 2
        at = rng.randrange(size - edit)
        own = [f"v{rng.randrange(10**6)}" for _ in range(30)] + item[:at] + [f"u{rng.randrange(10**6)}" for _ in range(edit)] + item[at + edit :]
        words = T.Words([" ".join(own).encode()], decontam.GAPS)
        grams = decontam.shingles(words.hash)
        found += bool(index.matches(words.hash, np.isin(grams, index.grams), 0.8))
    assert found >= 197


def test_decontamination_in_slices_and_of_null_ids(spark, monkeypatch):
    rng = random.Random(4)
    item = prose(rng, 40)
    long = f"{prose(rng, 90_000)} {item} {prose(rng, 90_000)}"
    bench = spark.createDataFrame([(None, item), (-1, "six words that stand quite alone")], "item_id long, text string")
    docs = spark.createDataFrame([(1, long), (None, item), (1, long), (2, None), (3, "")], "doc_id long, text string")
    got = sorted(((r.doc_id or 0, r.item_id, r.start_word, r.similarity) for r in decontam.contaminated(docs, bench).collect()), key=str)
    assert got == [(0, None, 0, 1.0), (1, None, 90_000, 1.0), (1, None, 90_000, 1.0)]


def test_hamming_blocks_find_all_within_radius():
    rng = np.random.default_rng(2)
    items = [(i, " ".join(f"w{rng.integers(500)}" for _ in range(20)).encode()) for i in range(30)]
    index = decontam.Index(items)
    prints = index.prints[rng.integers(0, 30, 200)].copy()
    for i in range(200):
        for b in rng.choice(64, rng.integers(0, 18), replace=False):
            prints[i] ^= np.uint64(1) << np.uint64(b)
    got = set(zip(*(x.tolist() for x in index.near(20, prints)[:2])))
    assert got == {(i, j) for i in range(200) for j in range(30) if int(np.bitwise_count(prints[i] ^ index.prints[j])) <= decontam.RADIUS}


def deleted_interpolation(rows):
    """Counts, base and model scores of (key, words, train) rows in plain Python, EM on the same half-bit bins."""
    end = None
    grams = lambda w: [((w[i],), (("^",) if i < 1 else (w[i - 1],)) + (w[i],), (("^",) if i < 1 else ("^", w[0]) if i < 2 else (w[i - 2], w[i - 1])) + (w[i],)) for i in range(len(w))]
    counts, texts = Counter(), 0
    for _, w, train in rows:
        if train:
            texts += 1
            counts.update(x for t in grams([*w, end]) for x in enumerate(t))
    one = {g: c for g, c in counts.items() if g[0] == 0}
    n, v = sum(one.values()), len(one)

    def parts(t, less):
        c1, c2 = ((texts if g == ("^",) else counts[k, g]) - less for k, g in ((0, t[1][:-1]), (1, t[2][:-1])))
        k = [counts[x] - less for x in enumerate(t)]
        bucket = min(c2.bit_length(), 39) if c2 > 0 else 40 + min(c1.bit_length(), 39)
        return bucket, [k[2] / c2 if c2 > 0 else 0.0, k[1] / c1 if c1 > 0 else 0.0, k[0] / max(n - less, 1)]

    near = lambda p: 2 ** (-min(max(float(np.round(-2 * math.log2(p))), 0), 62) / 2) if p > 0 else 0.0
    cells = Counter()
    for _, w, train in rows:
        if train:
            for t in grams([*w, end]):
                b, p = parts(t, 1)
                cells[b, *(near(x) for x in p), 1 / (v + 1)] += 1
    start = {b: [0.4 * (b < 40 and b != 0), 0.3 * (b not in (0, 40)), 0.25, 0.05] for b in range(80)}
    weight = {b: [x / sum(s) for x in s] for b, s in start.items()}
    for _ in range(40):
        total = {b: [0.1 * x for x in s] for b, s in start.items()}
        for (b, *p), c in cells.items():
            mix = [x * y for x, y in zip(weight[b], p)]
            for k in range(4):
                total[b][k] += c * mix[k] / sum(mix)
        weight = {b: [x / sum(s) for x in s] for b, s in total.items()}
    out = {}
    for key, w, _ in rows:
        ts = grams([*w, end])
        score = sum(math.log10(sum(x * y for x, y in zip(weight[b], [*p, 1 / (v + 1)]))) for b, p in (parts(t, 0) for t in ts))
        out[key] = (len(ts), sum(counts[0, t[0]] > 0 for t in ts), n, sum(math.log10((counts[0, t[0]] + 1) / (n + v + 1)) for t in ts), score)
    return out


def test_language_model_scores(spark):
    docs = odd_docs(spark)
    docs = docs.union(docs.where("doc_id = 6").selectExpr("NULL", *docs.columns[1:]))
    got = {r.doc_id: r for r in interpolation.score_documents(docs, ~language.held_out("doc_id", 7, 2)).collect()}
    want = deleted_interpolation([(r.doc_id, words(r.text), r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 7 != 2) for r in docs.collect()])
    assert set(got) == set(want) and got[None].held_out
    for key, w in want.items():
        r = got[key]
        assert (r.n_tokens, r.n_known, r.train_tokens) == w[:3] and r.base_score == pytest.approx(w[3]) and r.score == pytest.approx(w[4], rel=1e-6)
    held = [r for r in got.values() if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)
    assert interpolation.score_documents(empty(spark), ~language.held_out()).collect() == []
    assert interpolation.score_documents(repeated(spark), ~language.held_out()).count() == repeated(spark).count()


def test_language_model_tells_repeated_texts_apart(spark):
    rng = random.Random(9)
    texts = [prose(rng, 80) for _ in range(150)]
    rows = [(i, t) for i, t in enumerate(texts)] + [(1000 + i, t) for i, t in enumerate(texts[:20])]
    got = {r.doc_id: r.score / r.n_tokens for r in interpolation.score_documents(spark.createDataFrame(rows, "doc_id long, text string"), ~language.held_out("doc_id", 7, 2)).collect()}
    twice = [got[i] for i in range(20) if all(zlib.crc32(str(j).encode()) % 7 != 2 for j in (i, 1000 + i))]
    assert min(twice) > max(got[i] for i in range(20, 150) if zlib.crc32(str(i).encode()) % 7 == 2)


def test_em_weights_are_distributions():
    b = interpolation.BINS
    w = interpolation.learn_weights(np.array([((3 * b + 4) * b + 5) * b + 40, ((45 * b) * b + 9) * b + 20]), np.array([10, 5]), 100)
    assert np.allclose(w.sum(1), 1) and (w[[0, interpolation.DIGITS], :2] == 0).all() and (w[interpolation.DIGITS :, 0] == 0).all() and (w >= 0).all()


def test_language_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    model = language.fit(docs, ~language.held_out())
    out = language.identify(docs, model).where(language.held_out("doc.doc_id")).collect()
    assert sum(r.lang_pred == r.doc.lang for r in out) >= 0.95 * len(out) and not any(r.lang_rejected for r in out if len(r.doc.text) > 200)


def test_language_slices_change_nothing(monkeypatch):
    text = ("The quick brown fox\njumped over the lazy dog and " * 200).encode()
    whole = language.counted(text)
    monkeypatch.setattr(language, "SLICE", 300)
    assert language.slices(text, 300)[1][:1] in (b" ", b"\n") and b"".join(language.slices(text, 300)) == text
    parts = np.zeros(language.BUCKETS, np.int64)
    for p in language.slices(text, 300):
        parts += np.bincount(language.subwords([p])[0], minlength=language.BUCKETS)
    assert (np.flatnonzero(parts) == whole[0]).all() and (parts[whole[0]] == whole[1]).all()


def test_null_ids_are_held_out(spark):
    docs = spark.createDataFrame([(None, "some text"), (3, "b"), (6, "c")], "doc_id long, text string")
    assert [r.h for r in docs.select(language.held_out().alias("h")).collect()] == [zlib.crc32(b"3") % 4 == 2 if d == 3 else zlib.crc32(b"6") % 4 == 2 if d == 6 else True for d in (None, 3, 6)]


def test_language_bears_odd_rows(spark):
    docs = repeated(spark)
    model = language.fit(docs, ~language.held_out())
    out = language.identify(docs, model).collect()
    assert len(out) == docs.count()
    for r in out:
        letters = any(c.isalpha() for c in r.doc.text or "")
        assert (r.lang_pred == "und") == (not letters) and 0 <= r.lang_score <= 1 and (letters or r.lang_rejected)
        assert r.lang_rejected == (r.lang_score < 0.5)
    assert language.fit(empty(spark), ~language.held_out()) is None
    assert {r.lang_pred for r in language.identify(docs, None).collect()} == {"und"}
    assert language.identify(empty(spark), model).collect() == []


def test_spark_hash_of_longs(spark):
    ids = [0, 1, -1, 2**62, -(2**63), 12345]
    got = [r[0] for r in spark.createDataFrame([(i,) for i in ids], "a long").selectExpr("xxhash64(a)").collect()]
    assert got == T.spark_xxhash64(np.array(ids)).tolist()
