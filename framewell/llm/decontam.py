"""Benchmark decontamination by SimHash windows and multi-index Hamming blocks.

Words are runs of digits, letters and bytes from 0x80 after A-Z is lower-cased. For each benchmark item of m words,
every window of m words of a document (the whole document, if it has fewer) that holds at least one five-word
shingle of some item gets a 64-bit SimHash of its words; a window without any cannot reach the similarity. Items of
the same size are indexed by BLOCKS blocks of their fingerprints, each with all values within RADIUS / BLOCKS bits:
by the pigeonhole principle every fingerprint within RADIUS bits of an item's meets one of its entries. Candidates
are verified on whole words: weighted Jaccard similarity of the two multisets of five-word shingles, weights being
their multiplicities, of at least ``similarity``. An item with fewer than five words makes one shingle of all.

The items are taken in blocks of bounded number and bytes, so what a worker holds does not grow with the benchmark.

Null and empty texts, and items without words, match nothing. A null doc_id or item_id stays null in the result.
Repeated rows are matched each; equal rows in the result are not merged. Very long texts are taken in slices of
windows. Other columns, whatever their names, are ignored. Empty tables give an empty result.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from functools import partial, reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from framewell.llm import text as T

SHINGLE = 5
RADIUS = 14
BLOCKS = 5
#: Windows of a document whose fingerprints are held at once.
SLICE = 1 << 16
#: Items, and bytes of their texts, that one pass holds.
PASS_ITEMS = 20_000
PASS_BYTES = 16 << 20

GAPS = np.ones(256, bool)
GAPS[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = False
EDGES = [64 * i // BLOCKS for i in range(BLOCKS + 1)]


def word_bits(hashes: np.ndarray) -> np.ndarray:
    """A row of 64 signs for each hash."""
    return (np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1).astype(np.int8) << 1) - 1


def fingerprints(sums: np.ndarray) -> np.ndarray:
    return np.packbits(sums > 0, axis=1).view(T.U64).reshape(-1)


def shingles(hashes: np.ndarray) -> np.ndarray:
    """Hashes of the five-word shingles of one word sequence."""
    n = len(hashes) - SHINGLE + 1
    if n > 0:
        return T.fold([hashes[i : i + n] for i in range(SHINGLE)])
    return T.fold([hashes[i : i + 1] for i in range(len(hashes))]) if len(hashes) else hashes


def weighted_similarity(a: Counter, b: Counter) -> float:
    both = sum((a & b).values())
    return both / (sum(a.values()) + sum(b.values()) - both)


class Index:
    """The items of one pass: their shingles, and multi-index Hamming blocks for each size."""

    def __init__(self, items: list[tuple[int | None, bytes]]):
        self.ids, self.counts, prints, sizes, grams = [], [], [], [], []
        for item, text in items:
            words = T.Words([text], GAPS)
            if len(words.hash):
                self.ids.append(item)
                own = shingles(words.hash)
                self.counts.append(Counter(own.tolist()))
                grams.append(own)
                sizes.append(len(words.hash))
                prints.append(fingerprints(word_bits(words.hash).sum(0, dtype=np.int32)[None])[0])
        self.prints, self.sizes = np.array(prints, T.U64), np.array(sizes, np.int64)
        self.grams = np.unique(np.concatenate(grams)) if grams else np.zeros(0, T.U64)
        self.by_size = {int(s): self._blocks(np.flatnonzero(self.sizes == s)) for s in np.unique(self.sizes)}

    def _blocks(self, members: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each block, where each value's items start, and these items: all within RADIUS // BLOCKS bits."""
        out = []
        for lo, hi in zip(EDGES, EDGES[1:]):
            width = hi - lo
            own = (self.prints[members] >> T.U64(lo)) & T.U64((1 << width) - 1)
            masks = np.array([sum(1 << b for b in c) for r in range(RADIUS // BLOCKS + 1) for c in combinations(range(width), r)], T.U64)
            value = (own[:, None] ^ masks).reshape(-1).astype(np.int64)
            item = np.repeat(members, len(masks))
            order = np.argsort(value, kind="stable")
            out.append((np.searchsorted(value[order], np.arange((1 << width) + 1)), item[order]))
        return out

    def near(self, size: int, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All (window, item, bits apart) within RADIUS among the items of the size."""
        window, item = [], []
        for (edge, items), lo, hi in zip(self.by_size[size], EDGES, EDGES[1:]):
            value = ((prints >> T.U64(lo)) & T.U64((1 << (hi - lo)) - 1)).astype(np.int64)
            start, count = edge[value], edge[value + 1] - edge[value]
            step = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
            window.append(np.repeat(np.arange(len(prints)), count))
            item.append(items[np.repeat(start, count) + step])
        pairs = np.unique(np.stack([np.concatenate(window), np.concatenate(item)], 1), axis=0)
        apart = np.bitwise_count(prints[pairs[:, 0]] ^ self.prints[pairs[:, 1]])
        ok = apart <= RADIUS
        return pairs[ok, 0], pairs[ok, 1], apart[ok]

    def matches(self, hashes: np.ndarray, hit: np.ndarray, similarity: float) -> list[tuple[int | None, int, int, float, int]]:
        """Of one document's words, with the shingles that items hold marked: (item, start, words, similarity, bits) of each item's best window."""
        own = shingles(hashes)
        seen = np.concatenate([[0], np.cumsum(hit)])
        best: dict[int, tuple[float, int, int, int]] = {}
        longest = max(self.by_size, default=0)
        for lo in range(0, max(len(hashes), 1), SLICE):
            part = hashes[lo : lo + SLICE + longest]
            sums = np.zeros((len(part) + 1, 64), np.int32)
            np.cumsum(word_bits(part), axis=0, out=sums[1:])
            for size in self.by_size:
                if size <= len(hashes):
                    at = np.arange(lo, min(lo + SLICE, len(hashes) - size + 1))
                    per = max(size - SHINGLE + 1, 1)
                    at = at[seen[np.minimum(at + per, len(hit))] > seen[np.minimum(at, len(hit))]] if size >= SHINGLE else at
                    width = size
                else:
                    at, width = np.zeros(0 if lo else 1, np.int64), len(hashes)
                if not len(at):
                    continue
                window, item, apart = self.near(size, fingerprints(sums[at - lo + width] - sums[at - lo]))
                for w, i, d in zip(window.tolist(), item.tolist(), apart.tolist()):
                    start = int(at[w])
                    mine = own[start : start + width - SHINGLE + 1] if width >= SHINGLE and len(hashes) >= SHINGLE else shingles(hashes[start : start + width])
                    s = weighted_similarity(Counter(mine.tolist()), self.counts[i])
                    if s >= similarity and (i not in best or (s, -start) > (best[i][0], -best[i][1])):
                        best[i] = (s, start, width, d)
        return [(self.ids[i], start, width, s, d) for i, (s, start, width, d) in sorted(best.items())]


def _scan(index: Index, similarity: float, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    short = bool((index.sizes < SHINGLE).any())
    # A bit for each value of the low hash bits spares most searches.
    bits = 1 << 22
    maybe = np.zeros(bits, bool)
    maybe[(index.grams & T.U64(bits - 1)).astype(np.int64)] = True
    for batch in T.chunks(batches):
        words = T.Words(T.texts_of(batch), GAPS)
        grams, at = T.gram_hash(words, SHINGLE)
        hit = maybe[(grams & T.U64(bits - 1)).astype(np.int64)]
        if len(index.grams) and hit.any():
            g = grams[hit]
            hit[hit] = index.grams[np.minimum(np.searchsorted(index.grams, g), len(index.grams) - 1)] == g
        place = np.searchsorted(words.doc[at], np.arange(batch.num_rows + 1))
        total = np.concatenate([[0], np.cumsum(hit)])
        some = total[place[1:]] > total[place[:-1]]
        # Documents shorter than a shingle, and items shorter than one, have whole texts as shingles.
        some |= (np.diff(words.first) > 0) & ((np.diff(words.first) < SHINGLE) | short)
        rows = []
        for d in np.flatnonzero(some).tolist():
            doc = batch.column("doc_id")[d].as_py()
            own = words.hash[words.first[d] : words.first[d + 1]]
            rows += [(doc, *m) for m in index.matches(own, hit[place[d] : place[d + 1]], similarity)]
        if rows:
            yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows), (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.int64()))], names=["doc_id", "item_id", "start_word", "n_words", "similarity", "bits_apart"])


SCHEMA = "doc_id long, item_id long, start_word long, n_words long, similarity double, bits_apart long"


def contaminated(docs: DataFrame, benchmark: DataFrame, similarity: float = 0.8) -> DataFrame:
    """Per document and item that it holds: the best window's start, words, similarity and fingerprint distance.

    docs needs doc_id and text, benchmark item_id and text.
    """
    items = T.binary_text(benchmark, F.col("item_id").cast("long").alias("item_id"))
    count, size = items.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    passes = max(1, math.ceil(count / PASS_ITEMS), math.ceil(size / PASS_BYTES))
    source = T.binary_text(docs, F.col("doc_id").cast("long").alias("doc_id"))
    found = []
    for p in range(passes):
        rows = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(passes)) == p).collect()
        index = Index(sorted(((r["item_id"], bytes(r["text"])) for r in rows), key=lambda x: (x[0] is not None, x[0] or 0, x[1])))
        found.append(source.mapInArrow(partial(_scan, index, similarity), SCHEMA))
    return reduce(DataFrame.union, found)
