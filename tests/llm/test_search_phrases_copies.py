"""Ranked search, collocations and exact dedup against brute-force versions, and on odd, repeated and missing rows."""

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from framewell.llm import bitslice, collocations, exact, golomb
from tests.llm.odd import empty, odd_docs, prose, repeated

LOW = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def terms(t):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (t or "").translate(LOW))


def ranking(docs, items, k=20):
    own = [(i, Counter(terms(t)), len(terms(t))) for i, t in docs]
    n, total = sum(c > 0 for *_, c in own), sum(c for *_, c in own)
    out = []
    for item, text in items:
        rows = []
        asked = Counter(terms(text))
        weight = {t: math.floor(1000 * math.log((2 * n + 2) / (2 * sum(t in c for _, c, _ in own) + 1))) for t in asked}
        for doc, c, size in own:
            m = 75 + (25 * size * n) // total if total else 0
            score = sum(times * weight[t] * ((1000000000 * c[t]) // (1000 * c[t] + 12 * m)) for t, times in asked.items() if c[t])
            rows += [(-score, doc is None, doc or 0)] if score > 0 else []
        out += [(item, r, None if null else doc, -score) for r, (score, null, doc) in enumerate(sorted(rows)[:k], 1)]
    return sorted(out, key=str)


def searched(docs, items, k=20):
    return sorted(((r.item_id, r["rank"], r.doc_id, r.score) for r in bitslice.ranked(docs, items, k).collect()), key=str)


ITEMS = [(1, "Lorem ipsum, dolor DOLOR dolor sit"), (2, None), (3, "!!"), (4, "unheard of words"), (5, "ñandú 漢字 word"), (None, "magna aliqua12"), (7, "amet " * 40)]


@pytest.mark.parametrize(("block", "kept", "passes"), [(8192, 1 << 26, 1 << 22), (7, 1 << 26, 1 << 22), (64, 1, 40)])
def test_search_matches_brute_force(spark, monkeypatch, block, kept, passes):
    for name, value in (("BLOCK_DOCS", block), ("KEPT_BYTES", kept), ("PASS_BYTES", passes)):
        monkeypatch.setattr(bitslice, name, value)
    items = spark.createDataFrame([(*i, "clash") for i in ITEMS], "item_id long, text string, score string")
    docs = repeated(spark)
    assert searched(docs, items) == ranking([(r.doc_id, r.text) for r in docs.collect()], ITEMS)


def test_search_takes_repeated_items_ties_and_empty_tables(spark):
    items = spark.createDataFrame([(1, "same words"), (1, "same words"), (1, "other")], "item_id long, text string")
    docs = spark.createDataFrame([(i, "same words here") for i in (5, 3, 9, 3)] + [(None, "Same words here"), (8, "none"), (2, "of"), (1, "these"), (0, "at all")], "doc_id long, text string")
    got = searched(docs, items, 3)
    assert [x[:3] for x in got] == sorted([(1, r, d) for r, d in ((1, 3), (2, 3), (3, 5))] * 2)
    assert not searched(empty(spark), items) and not searched(docs, items.limit(0)) and not searched(docs.where("doc_id = 77"), items)


def test_bit_slices_add_and_pick_the_top():
    rng = np.random.default_rng(4)
    for size, k in ((1, 1), (63, 5), (64, 20), (300, 20), (1000, 7)):
        want, total = np.zeros(size, np.int64), []
        for _ in range(9):
            at = np.sort(rng.choice(size, rng.integers(1, size + 1), replace=False))
            value = rng.integers(0, rng.choice([3, 1000, 1 << 40]), len(at))
            want[at] += value
            bitslice.add(total, bitslice.slices(at, value.astype(np.uint64), size))
        at, score = bitslice.top(total, k)
        order = np.lexsort((np.arange(size), -want))[:k]
        assert sorted(at.tolist()) == sorted(x for x in order.tolist() if want[x] > 0) and (want[at] == score).all()


def pieces(t):
    return [[w for w in re.split(r"[\x20\x09]+", p) if w] for p in re.split(r"[.,;:!?\x0A-\x0D]", (t or "").translate(LOW))]


def phrases(rows, longest, least, inside=50, top=2000):
    f, n = defaultdict(Counter), Counter()
    for lang, text in rows:
        for p in pieces(text):
            n[lang or "und"] += len(p)
            for k in range(1, longest + 1):
                f[lang or "und"].update(tuple(p[i : i + k]) for i in range(len(p) - k + 1))
    out = []
    for lang, c in f.items():
        known = {p: a for p, a in c.items() if len(p) > 1 and a >= least}
        rows = []
        for p, a in known.items():
            if any(len(q) > len(p) and 100 * b >= inside * a and any(q[i : i + len(p)] == p for i in range(len(q))) for q, b in known.items()):
                continue
            score, _, left, right = min((1000000 * a * a // (c[p[:k]] * c[p[k:]]), k, c[p[:k]], c[p[k:]]) for k in range(1, len(p)))
            rows.append((-score, -a, " ".join(p).encode(), left, right))
        out += [(lang, r, p.decode(), -a, left, right, n[lang], -s) for r, (s, a, p, left, right) in enumerate(sorted(rows)[:top], 1)]
    return sorted(out)


def mined(docs, *args, **more):
    return sorted((r.lang, r["rank"], r.phrase, r.a, r.l, r.r, r.n, r.score) for r in collocations.collocations(docs, *args, **more).collect())


@pytest.mark.parametrize(("shard", "automaton", "longest", "least"), [(1 << 22, 1 << 18, 3, 10), (3000, 50, 3, 4), (500, 7, 2, 3), (2000, 1 << 18, 4, 3)])
def test_collocations_match_brute_force(spark, monkeypatch, shard, automaton, longest, least):
    monkeypatch.setattr(collocations, "SHARD_BYTES", shard)
    monkeypatch.setattr(collocations, "AUTOMATON", automaton)
    docs = repeated(spark)
    rows = [(r.lang, r.text) for r in docs.collect()]
    want = phrases(rows, longest, least)
    assert want and mined(docs, longest, least) == want
    assert mined(docs, longest, least, top=3) == phrases(rows, longest, least, top=3)


def test_collocations_count_overlaps_within_pieces_only(spark):
    texts = ["a a a a a a", "New York. new york, NEW\tYORK; new  york\nnew\ryork new", "york new" * 3, "x\x85y \x1cz " * 30, "ab c a bc " * 12, None, "", " . , "]
    docs = spark.createDataFrame([(lang, t) for t in texts for lang in ("en", None)], "lang string, text string")
    assert mined(docs, 3, 2) == phrases([(r.lang, r.text) for r in docs.collect()], 3, 2)
    assert not mined(empty(spark)) and not mined(docs.where("text IS NULL"))


def test_collocations_of_a_word_in_a_third_of_all_places(spark):
    rng = random.Random(3)
    docs = spark.createDataFrame([("en", " ".join(w for x in prose(rng, 60).split(" ") for w in (x, "the"))) for _ in range(40)], "lang string, text string")
    assert mined(docs) == phrases([(r.lang, r.text) for r in docs.collect()], 3, 10)


def copies(rows):
    groups = defaultdict(list)
    for doc, text in rows:
        groups[(text or "").translate(LOW)].append(doc)
    best = {t: max((d for d in own if d is not None), default=None) for t, own in groups.items()}
    return sorted(((d, best[(t or "").translate(LOW)], len(groups[(t or "").translate(LOW)]), hashlib.sha256((t or "").translate(LOW).encode()).hexdigest()) for d, t in rows), key=str)


def deduped(docs):
    out = exact.exact_groups(docs).collect()
    kept = defaultdict(list)
    for r in out:
        kept[r.text_sha256] += [r.doc_id] if r.kept else []
        assert not r.kept or r.doc_id == r.keep_id
    assert all(len(x) == 1 for x in kept.values())
    return sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in out), key=str)


@pytest.mark.parametrize(("piece", "spare", "broadcast"), [(8 << 20, 10, 8 << 20), (300, 10, -1), (2000, -6, 8 << 20), (300, -7, -1)])
def test_exact_dedup_matches_brute_force(spark, monkeypatch, piece, spare, broadcast):
    """Also with fingerprints so short that different texts share them."""
    for name, value in (("PIECE_BYTES", piece), ("SPARE", spare), ("BROADCAST_BYTES", broadcast)):
        monkeypatch.setattr(exact, name, value)
    monkeypatch.setattr(exact.T, "CHUNK", 1000)
    rows = [(r.doc_id, r.text) for r in repeated(spark).collect()]
    rng = random.Random(2)
    rows += [(2000 + i, "One third of all rows.".swapcase() if i % 2 else "ONE third of all rows.") for i in range(60)]
    rows += [(None, "only null ids"), (None, "Only null ids"), (7000, "É"), (7001, "é"), (9, "K"), (10, "K"), (11, None)]
    rng.shuffle(rows)
    docs = spark.createDataFrame([(*r, "clash", 1) for r in rows], "doc_id long, text string, sha string, piece int").repartition(5)
    assert deduped(docs) == copies(rows)


def test_exact_dedup_of_odd_and_empty_tables(spark):
    docs = odd_docs(spark)
    assert deduped(docs) == copies([(r.doc_id, r.text) for r in docs.collect()])
    assert exact.exact_groups(empty(spark)).count() == 0


def test_golomb_codes_are_short_and_exact():
    rng = np.random.default_rng(1)
    for n, b in ((0, 4), (1, 5), (3, 63), (1000, 20), (100_000, 40), (1 << 13, 13)):
        first = 1 << b
        x = np.unique(rng.integers(0, (1 << b) - 1, n, dtype=np.uint64, endpoint=True)) + np.uint64(first)
        code = golomb.encode(x, first, 1 << b)
        assert (golomb.decode(code, first) == x).all()
        assert not n or 8 * len(code) < 100 + len(x) * (math.log2((1 << b) / len(x)) + 2)
