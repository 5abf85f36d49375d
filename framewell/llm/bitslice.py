"""Ranked lexical search over a bit-sliced impact index.

Terms are the maximal matches of ``[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+`` in the whole text, A-Z lower-cased. With
N documents that hold a term, L terms in all, n terms in a document, df documents that hold a term and tf occurrences
in a document, a term's impact there is

    w * ((1000000000 * tf) div (1000 * tf + 12 * m)),  w = floor(1000 ln((2 N + 2) / (2 df + 1))),  m = 75 + (25 n N) div L

and a document's score for an item is the sum of the impacts of the item's terms, repeats included, in 64-bit integers.

1. Postings. One pass over the texts keeps the postings of the terms that the items ask for, in blocks of documents
   that lie together in a task; they are written once. N, L and every df are added up from the blocks, over all rows.
2. Bit slices. Within a block, in the order of doc_id, a term is a bitmap for each bit of its impacts. An item's terms
   are added slice by slice with carries, which gives the bitmaps of the bits of all scores of the block at once.
3. Top k. From the most significant slice down, documents with the bit set are kept while they are too many, set aside
   as certain when they are too few; equal scores go by ascending doc_id. Each block gives its k best, and the k best
   of all blocks are ranked. Scores are exact, so are the results.

Texts are never shuffled. Items are taken in passes of bounded bytes, blocks hold bounded postings, and the bitmaps
that a task keeps are bounded too, so memory depends neither on the corpus nor on the number of items.

A null or empty text, of a document or an item, has no terms: it is never found, and finds nothing. A very long text is
cut between terms while it is read. Rows that repeat a doc_id are documents of their own; a null doc_id comes after all
others of the same score. Rows that repeat an item_id are items of their own, each with ranks from 1. Other columns,
whatever their names, are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from functools import partial, reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from framewell.llm import text as T
from framewell.llm.store import cut

#: Documents of a block, and its postings, at most (one document may have more).
BLOCK_DOCS, BLOCK_POSTINGS = 8192, 1 << 21
#: Bytes of item text in a pass, and of bitmaps that a task keeps.
PASS_BYTES, KEPT_BYTES = 4 << 20, 64 << 20
#: Bytes of a long text whose terms are listed at once.
SLICE = 1 << 20

#: Bytes outside the term class become spaces, A-Z becomes a-z; bytes of other characters stand.
_TERM = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def terms_of(text: bytes) -> Iterator[list[bytes]]:
    """The terms of a text, in order, in lists of bounded size."""
    text = text.translate(_TERM)
    at = 0
    while at < len(text):
        end = at + SLICE
        if end < len(text):
            end = text.find(b" ", end)
            end = len(text) if end < 0 else end
        yield text[at:end].split()
        at = end


POSTINGS = "docs long, terms long, df binary, data binary"


class _Block:
    """Documents and postings that a task has gathered: rows of doc_id, n and (document, term, tf)."""

    def __init__(self) -> None:
        self.ids: list[int | None] = []
        self.n: list[int] = []
        self.postings: list[np.ndarray] = []
        self.size = 0

    def row(self) -> pa.RecordBatch:
        ids = pa.array(self.ids, pa.int64())
        order = np.asarray(pc.sort_indices(ids, null_placement="at_end"))
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        n, null = np.array(self.n, np.int64)[order], np.asarray(ids.is_null())[order]
        doc, term, tf = np.concatenate(self.postings, axis=1) if self.postings else np.zeros((3, 0), np.int64)
        by_term = np.lexsort((place[doc], term))
        doc, term, tf = place[doc][by_term].astype(np.uint16), term[by_term].astype(np.int32), tf[by_term]
        held, df = np.unique(term, return_counts=True)
        narrow = tf.astype(np.uint8 if not len(tf) or tf.max() < 256 else np.int64)
        data = T.pack(np.asarray(ids.fill_null(0))[order], null.astype(np.uint8), n, doc, narrow, held, df)
        return pa.record_batch({"docs": pa.array([int((n > 0).sum())]), "terms": pa.array([int(n.sum())]), "df": pa.array([T.pack(held, df)], pa.binary()), "data": pa.array([data], pa.binary())})


def _postings(terms: list[bytes], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    known, block = pa.array(terms, pa.binary()), _Block()
    for batch in T.chunks(batches):
        for doc_id, text in zip(batch.column("doc_id").to_pylist(), T.texts_of(batch)):
            n, count = 0, Counter()
            for own in terms_of(text):
                n += len(own)
                at = pc.index_in(pa.array(own, pa.binary()), value_set=known).drop_null()
                hit = np.bincount(at.to_numpy(zero_copy_only=False).astype(np.int64)) if len(at) else np.zeros(0, np.int64)
                some = np.flatnonzero(hit)
                count.update(dict(zip(some.tolist(), hit[some].tolist())))
            if count:
                block.postings.append(np.array([[len(block.ids)] * len(count), list(count), list(count.values())], np.int64))
                block.size += len(count)
            block.ids.append(doc_id)
            block.n.append(n)
            if len(block.ids) >= BLOCK_DOCS or block.size >= BLOCK_POSTINGS:
                yield block.row()
                block = _Block()
    if block.ids:
        yield block.row()


def _df(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents that hold each term, over the blocks of a task."""
    total = np.zeros(0, np.int64)
    for batch in batches:
        for data in batch.column("df").to_pylist():
            term, df = T.unpack(data)
            if len(term):
                total = np.pad(total, (0, max(0, int(term[-1]) + 1 - len(total))))
                total[term] += df
    some = np.flatnonzero(total)
    yield pa.record_batch({"term": pa.array(some), "df": pa.array(total[some])})


def slices(place: np.ndarray, value: np.ndarray, size: int) -> np.ndarray:
    """A bitmap for each bit of the values, least significant first: bit d of slice b is bit b of document d's value."""
    dense = np.zeros(-(-size // 64) * 64, np.uint64)
    dense[place] = value
    bits = int(value.max()).bit_length() if len(value) else 0
    out = np.zeros((bits, len(dense) // 64), np.uint64)
    for b in range(bits):
        out[b] = np.packbits(((dense >> np.uint64(b)) & np.uint64(1)).astype(np.uint8), bitorder="little").view(np.uint64)
    return out


def add(total: list[np.ndarray], term: np.ndarray) -> None:
    """Add a term's slices to those of the scores, in place: a ripple of carries from the least significant slice up."""
    carry = None
    for b in range(len(term)):
        if b == len(total):
            total.append(np.zeros_like(term[b]))
        one = total[b] ^ term[b]
        over = total[b] & term[b]
        if carry is not None:
            over |= one & carry
            one ^= carry
        total[b], carry = one, over
    b = len(term)
    while carry is not None and carry.any():
        if b == len(total):
            total.append(np.zeros_like(carry))
        total[b], carry = total[b] ^ carry, total[b] & carry
        b += 1


def top(total: list[np.ndarray], k: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and scores of the k largest scores above zero; of equal ones, the first places."""
    if not total:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    count = lambda x: int(np.bitwise_count(x).sum())
    open_ = np.bitwise_or.reduce(np.stack(total))
    sure = np.zeros_like(open_)
    left = k
    for bits in reversed(total):
        if count(open_) <= left:
            break
        with_bit = open_ & bits
        n = count(with_bit)
        if n >= left:
            open_ = with_bit
        else:
            sure |= with_bit
            open_ &= ~bits
            left -= n
    places = lambda x: np.flatnonzero(np.unpackbits(x.view(np.uint8), bitorder="little"))
    at = np.concatenate([places(sure), places(open_)[:left]])
    score = np.zeros(len(at), np.int64)
    for b, bits in enumerate(total):
        score |= (((bits[at // 64] >> (at % 64).astype(np.uint64)) & np.uint64(1)) << np.uint64(b)).astype(np.int64)
    return at, score


def impacts(tf: np.ndarray, n: np.ndarray, w: int, docs: int, terms: int) -> np.ndarray:
    m = 75 + (25 * n * docs) // terms
    return w * ((1_000_000_000 * tf) // (1000 * tf + 12 * m))


FOUND = "q int, doc_id long, score long"


def _search(items: list[dict[int, int]], weight: dict[int, int], docs: int, terms: int, k: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for data in batch.column("data").to_pylist():
            ids, null, n, doc, tf, held, df = T.unpack(data)
            edge = np.concatenate([[0], np.cumsum(df)])
            where = {int(t): i for i, t in enumerate(held)}
            kept: dict[int, np.ndarray] = {}
            size = 0
            out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
            for q, item in enumerate(items):
                total: list[np.ndarray] = []
                for t, times in item.items():
                    if t not in where or not weight[t]:
                        continue
                    own = kept.get(t)
                    if own is None:
                        a, b = edge[where[t]], edge[where[t] + 1]
                        at = doc[a:b].astype(np.int64)
                        own = slices(at, impacts(tf[a:b].astype(np.int64), n[at], weight[t], docs, terms), len(ids))
                        size += own.nbytes
                        if size > KEPT_BYTES:
                            kept, size = {}, own.nbytes
                        kept[t] = own
                    for _ in range(times):
                        add(total, own)
                at, score = top(total, k)
                out.append((np.full(len(at), q), at, score))
            q, at, score = (np.concatenate(x) for x in zip(*out)) if out else (np.zeros(0, np.int64),) * 3
            yield pa.record_batch({"q": pa.array(q.astype(np.int32)), "doc_id": pa.array(ids[at], mask=null[at].astype(bool)), "score": pa.array(score)})


RESULT = "item_id long, rank int, doc_id long, score long"


def ranked(docs: DataFrame, items: DataFrame, k: int = 20) -> DataFrame:
    """Per row of items its k best documents: item_id, rank, doc_id, score. docs needs doc_id and text, items item_id and text."""
    spark = docs.sparkSession
    asked = T.binary_text(items, F.col("item_id").cast("long").alias("item_id"))
    size = asked.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    passes = max(1, math.ceil(size / PASS_BYTES))
    source = T.binary_text(docs, F.col("doc_id").cast("long").alias("doc_id"))
    found = []
    for p in range(passes):
        rows = asked.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(passes)) == p).collect()
        words = [(r["item_id"], [w for part in terms_of(bytes(r["text"])) for w in part]) for r in rows]
        number = {w: i for i, w in enumerate(sorted({w for _, own in words for w in own}))}
        if not number:
            continue
        blocks = cut(source.mapInArrow(partial(_postings, list(number)), POSTINGS))
        n, terms = blocks.agg(F.coalesce(F.sum("docs"), F.lit(0)), F.coalesce(F.sum("terms"), F.lit(0))).first()
        # At most a row for each term of the pass.
        df = blocks.select("df").mapInArrow(_df, "term long, df long").groupBy("term").agg(F.sum("df").alias("df")).collect()
        weight = {r["term"]: math.floor(1000 * math.log((2 * n + 2) / (2 * r["df"] + 1))) for r in df}
        asks = [dict(Counter(number[w] for w in own)) for _, own in words]
        best = blocks.select("data").mapInArrow(partial(_search, asks, weight, n, terms, k), FOUND)
        names = F.broadcast(spark.createDataFrame([(q, i) for q, (i, _) in enumerate(words)], "q int, item_id long"))
        order = Window.partitionBy("q").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
        best = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
        found.append(best.join(names, "q").select("item_id", "rank", "doc_id", "score"))
    return reduce(DataFrame.union, found) if found else spark.createDataFrame([], RESULT)
