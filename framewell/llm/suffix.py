"""Exact removal of repeated strings by bucket-pointer refinement over sampled suffixes.

Every byte covered by a string of ``length`` bytes that also starts earlier (smaller doc_id, or same document and
earlier start) is removed; strings never cross documents and are judged on the input.

1. Initial q-gram buckets. The anchor of a window of ``length`` bytes is its q-gram of least hash (q = CORE), so
   equal windows have equal anchors at equal offsets, and only about one position in 35 is an anchor. Anchors are
   dealt out by their q-gram. All windows of one anchor form its context; a context that occurred before is
   removed at once, first inside each map task (so a passage that a third of all documents hold is one row a
   task), then by bucket. A q-gram with one context only repeats nothing and is done.
2. Refinement. The suffixes inside the remaining contexts are sorted by bucket identifiers: of 8 bytes first, then
   by the pair (own bucket, bucket of the suffix 8, 16, 32 ... bytes later), each round reusing the identifiers the
   last one refined, up to ``length`` bytes; buckets of one suffix take no further part. Suffixes in one final
   bucket are equal windows; all but the earliest are removed. A q-gram with more than HOT contexts is refined by
   the identifier of the whole window instead and dealt out by that, so no bucket grows with the corpus.
3. Removed runs go back to their documents by block.

Identifiers of whole contexts and of hot windows are 64-bit polynomial hashes over at most 2 * length bytes.

Null text is empty. Texts shorter than ``length`` are kept; very long ones are anchored whole. Rows that repeat a doc_id are documents of their own, in
the order of their texts; a null doc_id comes before all others. ``dedup`` returns whole rows in a struct, so other
columns pass through whatever their names.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as st
from pyspark.sql.window import Window

from framewell.llm import text as T
from framewell.llm.store import cut, partitions

CORE = 32
#: Contexts of one core above which it is refined by whole windows.
HOT = 4096
#: Bytes of text in a block of documents.
BLOCK_BYTES = 8 << 20
NO_ID = -(1 << 63)
#: A place is the row's number among rows of its doc_id, then the byte.
ROW = 40


def keyed(docs: DataFrame) -> tuple[DataFrame, int]:
    """Rows as struct doc, with _id, _row, _block and _text, and the number of blocks."""
    out = docs.select(F.struct("*").alias("doc")).select("doc", F.coalesce(F.col("doc.doc_id").cast("long"), F.lit(NO_ID)).alias("_id"), F.coalesce(F.col("doc.text").cast("binary"), F.lit(b"")).alias("_text"))
    total, rows = out.agg(F.sum(F.octet_length("_text")), F.count("*")).first()
    again = out.groupBy("_id").agg(F.count("*").alias("c")).where("c > 1").limit(1).count()
    row = F.row_number().over(Window.partitionBy("_id").orderBy("_text")) - 1 if again else F.lit(0)
    blocks = max(partitions(docs.sparkSession), math.ceil((total or 0) / BLOCK_BYTES))
    return out.withColumn("_row", row).withColumn("_block", F.pmod(F.xxhash64("_id"), F.lit(blocks)).cast("int")), blocks


def block_of(ids: np.ndarray, blocks: int) -> np.ndarray:
    return np.mod(T.spark_xxhash64(ids), blocks).astype(np.int64)


def sliding_least(a: np.ndarray, width: int) -> np.ndarray:
    """Where the least of each window of a stands, the first one on ties."""
    out, at, have = a, np.arange(len(a), dtype=np.int32 if len(a) < 1 << 31 else np.int64), 1
    while have < width:
        step = min(have, width - have)
        left = out[:-step] <= out[step:]
        out, at = np.where(left, out[:-step], out[step:]), np.where(left, at[:-step], at[step:])
        have += step
    return at


def find_anchors(texts: list[bytes], length: int) -> tuple[np.ndarray, ...]:
    """Runs of window starts that share an anchor: text, first start, starts after it, anchor's offset from it, core, context."""
    core, width = min(CORE, length), length - min(CORE, length) + 1
    buf = np.frombuffer(b"".join(texts), np.uint8)
    size = np.fromiter(map(len, texts), np.int64, len(texts))
    offset = np.concatenate([[0], np.cumsum(size)])
    none = np.zeros(0, np.int64)
    if not (size >= length).any():
        return none, none, none, none, none.view(T.U64), none.view(T.U64)
    prefix = T.prefix_hash(buf)
    _, down = T.powers(len(prefix))
    hashes = T.mix((prefix[core:] - prefix[:-core]) * down[: len(prefix) - core])
    least = sliding_least(hashes, width)
    ok = np.zeros(len(least) + 1, np.int32)
    has = size >= length
    np.add.at(ok, offset[:-1][has], 1)
    np.add.at(ok, offset[1:][has] - length + 1, -1)
    at = np.flatnonzero(np.cumsum(ok[:-1]))
    anchor = least[at].astype(np.int64)
    edge = np.flatnonzero(np.concatenate([[True], (np.diff(anchor) != 0) | (np.diff(at) != 1), [True]]))
    lo, hi, anchor = at[edge[:-1]], at[edge[1:] - 1], anchor[edge[:-1]]
    context = T.mix(T.span_hash(prefix, lo, hi + length) + ((anchor - lo) * 256 + (hi - lo)).astype(T.U64))
    doc = np.searchsorted(offset, lo, "right") - 1
    return doc, lo - offset[doc], hi - lo, anchor - lo, hashes[anchor], context


def _split_first(keys: list[np.ndarray], ids: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order by keys, then id and place, and which rows in it come first of their key."""
    order = np.lexsort((place, ids, *reversed(keys)))
    first = np.ones(len(order), bool)
    if len(order):
        first[1:] = np.logical_or.reduce([k[order][1:] != k[order][:-1] for k in keys])
    return order, first


def _anchors(length: int, buckets: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Packed anchors by bucket of their core; repeats inside the task go along as found (number of starts over 0: removed)."""
    held: list[tuple[np.ndarray, ...]] = []

    def flush() -> Iterator[pa.RecordBatch]:
        ids, place, more, shift, core, context = (np.concatenate(x) for x in zip(*held))
        held.clear()
        order, first = _split_first([core, context], ids, place)
        ids, place, more, shift, core, context = (x[order] for x in (ids, place, more, shift, core, context))
        ids_g, place_g, more_g = merge_runs(ids[~first], place[~first], more[~first] + length)
        where = np.concatenate([(T.mix(core[first]) % T.U64(buckets)).astype(np.int64), block_of(ids_g, buckets)])
        gone = np.concatenate([np.zeros(int(first.sum()), np.int64), more_g])
        zero = np.zeros(len(ids_g), np.int64)
        join = lambda a, b, kind: np.concatenate([a[first], b]).astype(kind)
        yield from T.packed_rows("bucket", where, buckets, [join(ids, ids_g, np.int64), join(place, place_g, np.int64), join(more, zero, np.uint8 if length < 256 else np.int64), join(shift, zero, np.uint8 if length < 256 else np.int64), join(core, zero, T.U64), join(context, zero, T.U64), gone])

    total = 0
    for batch in T.chunks(batches, "_text"):
        doc, start, more, shift, core, context = find_anchors(T.texts_of(batch, "_text"), length)
        if not len(doc):
            continue
        ids, row = (batch.column(c).to_numpy().astype(np.int64)[doc] for c in ("_id", "_row"))
        held.append((ids, (row << ROW) + start, more, shift, core, context))
        total += len(doc)
        if total > 150_000:
            yield from flush()
            total = 0
    if held:
        yield from flush()


def merge_runs(ids: np.ndarray, place: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs sorted and joined where they touch or overlap."""
    if not len(ids):
        return ids, place, size
    order = np.lexsort((place, ids))
    ids, place, end = ids[order], place[order], (place + size)[order]
    new = np.concatenate([[True], ids[1:] != ids[:-1]])
    reach = _running_max(end, new)
    start = np.concatenate([[True], (ids[1:] != ids[:-1]) | (place[1:] > reach[:-1])])
    at = np.flatnonzero(start)
    last = np.concatenate([at[1:], [len(ids)]]) - 1
    return ids[at], place[at], reach[last] - place[at]


def _running_max(a: np.ndarray, new: np.ndarray) -> np.ndarray:
    """Running maximum that starts anew where new is set."""
    order = np.argsort(a, kind="stable")
    rank = np.empty(len(a), np.int64)
    rank[order] = np.arange(len(a))
    group = np.cumsum(new) - 1
    return a[order[np.maximum.accumulate(group * len(a) + rank) - group * len(a)]]


def _spans(ids: np.ndarray, place: np.ndarray, size: np.ndarray, blocks: int) -> Iterator[pa.RecordBatch]:
    ids, place, size = merge_runs(ids, place, size)
    yield from T.packed_rows("_block", block_of(ids, blocks), blocks, [ids, place, size], kind=0)


def _first_buckets(length: int, hot: int, blocks: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Kind 0: removed runs; kind 1: contexts to refine, with whether their core is hot."""
    got = T.gathered(batches)
    if got is None:
        return
    ids, place, more, shift, core, context, gone = got
    done = gone > 0
    spans = [(ids[done], place[done], gone[done])]
    ids, place, more, shift, core, context = (x[~done] for x in (ids, place, more, shift, core, context))
    order, first = _split_first([core, context], ids, place)
    ids, place, more, shift, core = (x[order] for x in (ids, place, more, shift, core))
    spans.append((ids[~first], place[~first], more[~first].astype(np.int64) + length))
    yield from _spans(*(np.concatenate(x) for x in zip(*spans)), blocks)
    ids, place, more, shift, core = (x[first] for x in (ids, place, more, shift, core))
    if len(core):
        edge = np.concatenate([[True], core[1:] != core[:-1]])
        at = np.flatnonzero(edge)
        count = np.diff(np.concatenate([at, [len(core)]]))
        count = np.repeat(count, count)
        many = count > 1
        yield from T.packed_rows("_block", block_of(ids[many], blocks), blocks, [ids[many], place[many], more[many], core[many], (count[many] > hot).astype(np.uint8)], kind=1)


def _pick(table: pa.Table) -> tuple[list[bytes], np.ndarray, np.ndarray, np.ndarray]:
    """A block's texts, ids and rows, and their order by (id, row)."""
    ids, row = (table.column(c).to_numpy().astype(np.int64) for c in ("_id", "_row"))
    return table.column("_text").to_pylist(), ids, row, np.lexsort((row, ids))


def _rows_of(ids: np.ndarray, row: np.ndarray, order: np.ndarray, want_id: np.ndarray, want_row: np.ndarray) -> np.ndarray:
    """The number of the block's document that each wanted (id, row) names."""
    new = np.concatenate([[True], np.diff(ids[order]) != 0])
    base = np.flatnonzero(new)
    return order[base[np.searchsorted(ids[order][new], want_id)] + want_row]


def _contexts(length: int, blocks: int, buckets: int, docs: pa.Table, asked: pa.Table) -> pa.Table:
    """Texts of the asked contexts by bucket of their core; of hot cores, identifiers of whole windows."""
    schema = pa.schema([("bucket", pa.int32()), ("kind", pa.int32()), ("data", pa.binary())])
    if not asked.num_rows or not docs.num_rows:
        return schema.empty_table()
    ids, place, more, core, hot = T.gathered(asked.to_batches())
    texts, have, row, order = _pick(docs)
    size = np.fromiter(map(len, texts), np.int64, len(texts))
    offset = np.concatenate([[0], np.cumsum(size)])
    buf = np.frombuffer(b"".join(texts), np.uint8)
    lo = offset[_rows_of(have, row, order, ids, place >> ROW)] + (place & ((1 << ROW) - 1))
    out = []
    cold = hot == 0
    for b, at in T.by_bucket(np.where(cold, (T.mix(core) % T.U64(buckets)).astype(np.int64), -1) + 1, buckets + 1):
        if b:
            n = more[at].astype(np.int64) + length
            # The bytes lo .. lo + n of every context, in one gather.
            start = np.concatenate([[0], np.cumsum(n)])
            flat = buf[np.arange(start[-1]) + np.repeat(lo[at] - start[:-1], n)]
            out.append((b - 1, 0, T.pack(ids[at], place[at], more[at], flat)))
    if (~cold).any():
        at = np.flatnonzero(~cold)
        n = more[at].astype(np.int64) + 1
        step = np.arange(n.sum()) - np.repeat(np.concatenate([[0], np.cumsum(n)[:-1]]), n)
        start, wid, wplace = np.repeat(lo[at], n) + step, np.repeat(ids[at], n), np.repeat(place[at], n) + step
        key = np.zeros(len(start), T.U64)
        for a in range(0, len(texts), 256):  # a part of the block's text at a time
            b = min(a + 256, len(texts))
            inside = (start >= offset[a]) & (start < offset[b])
            if inside.any():
                prefix = T.prefix_hash(buf[offset[a] : offset[b]])
                key[inside] = T.mix(T.span_hash(prefix, start[inside] - offset[a], start[inside] - offset[a] + length))
        order, first = _split_first([key], wid, wplace)
        wid, wplace, key = wid[order], wplace[order], key[order]
        again = merge_runs(wid[~first], wplace[~first], np.full(int((~first).sum()), length))
        for b, at in T.by_bucket((key[first] % T.U64(buckets)).astype(np.int64), buckets):
            out.append((b, 1, T.pack(wid[first][at], wplace[first][at], key[first][at])))
        out.append((int(block_of(ids[:1], buckets)[0]), 2, T.pack(*again)))
    return pa.table([pa.array([x[i] for x in out], schema.field(i).type) for i in range(3)], schema=schema)


def refine(buf: np.ndarray, start: np.ndarray, length: int) -> np.ndarray:
    """Bucket identifiers of the windows of length bytes at start: equal exactly when the windows are."""
    padded = np.concatenate([buf, np.zeros(length + 8, np.uint8)])
    depth = min(8, length)
    key = np.zeros(len(buf), T.U64)
    for i in range(depth):
        key = (key << T.U64(8)) | padded[i : i + len(buf)].astype(T.U64)
    _, bucket = np.unique(key, return_inverse=True)
    bucket = np.concatenate([bucket, np.zeros(length, np.int64)])
    n = len(buf)
    while depth < length:
        step = min(depth, length - depth)
        at = start if depth + step == length else np.arange(n)
        size = np.bincount(bucket[:n])
        live = at[size[bucket[at]] > 1]  # a bucket of one needs no refining
        pair = bucket[live].astype(T.U64) * T.U64(len(bucket) + 1) + bucket[live + step].astype(T.U64)
        values, inverse = np.unique(pair, return_inverse=True)
        fresh = bucket.copy()
        # Identifiers of refined buckets lie beyond those of the buckets of one.
        fresh[live] = inverse + len(size)
        bucket = np.concatenate([np.unique(fresh[:n], return_inverse=True)[1], np.zeros(length, np.int64)]) if depth + step < length else fresh
        depth += step
    return bucket[start]


def _refine_buckets(length: int, blocks: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    texts: dict[int, list[list[np.ndarray]]] = {}  # a bucket's contexts are refined by themselves
    windows, spans = [], []
    for batch in batches:
        for bucket, kind, data in zip(*(batch.column(c).to_pylist() for c in ("bucket", "kind", "data"))):
            (texts.setdefault(bucket, []), windows, spans)[kind].append(T.unpack(data))
    out = [tuple(x) for x in spans]

    def later(keys: np.ndarray, ids: np.ndarray, place: np.ndarray) -> None:
        order, first = _split_first([keys], ids, place)
        out.append((ids[order][~first], place[order][~first], np.full(int((~first).sum()), length)))

    for bucket in [b for b, x in texts.items() if x]:
        ids, place, more, buf = (np.concatenate(x) for x in zip(*texts.pop(bucket)))
        n = more.astype(np.int64) + 1
        base = np.concatenate([[0], np.cumsum(n + length - 1)])[:-1]
        step = np.arange(n.sum()) - np.repeat(np.concatenate([[0], np.cumsum(n)[:-1]]), n)
        later(refine(buf, np.repeat(base, n) + step, length), np.repeat(ids, n), np.repeat(place, n) + step)
    if windows:
        ids, place, key = (np.concatenate(x) for x in zip(*windows))
        later(key, ids, place)
    if out:
        yield from _spans(*(np.concatenate(x) for x in zip(*out)), blocks)


def _finish(schema: pa.Schema, docs: pa.Table, spans: pa.Table) -> pa.Table:
    """Each document of a block with the bytes that remain, and the digest of what was removed."""
    if not docs.num_rows:
        return schema.empty_table()
    texts, have, row, order = _pick(docs)
    got = T.gathered(spans.to_batches())
    runs: dict[int, list[tuple[int, int]]] = {}
    if got is not None:
        ids, place, size = merge_runs(*got)
        at = _rows_of(have, row, order, ids, place >> ROW)
        for d, a, n in zip(at.tolist(), (place & ((1 << ROW) - 1)).tolist(), size.tolist()):
            runs.setdefault(d, []).append((a, a + n))
    kept, removed, count = [], [], []
    for d, t in enumerate(texts):
        mine = runs.get(d, ())
        if mine:
            cuts = [0, *(x for r in mine for x in r), len(t)]
            t = b"".join(t[a:b] for a, b in zip(cuts[::2], cuts[1::2]))
        kept.append(t)
        removed.append(sum(b - a for a, b in mine))
        count.append(len(mine))
    # A cut inside a character leaves bytes that are no text; these are left out of the text, not of the digest.
    made = {"n_bytes": [len(t) for t in texts], "n_removed": removed, "n_spans": count, "kept_sha256": [hashlib.sha256(t).hexdigest() for t in kept], "kept_text": [t.decode("utf-8", "ignore") for t in kept]}
    return pa.table([pa.array(made[f.name], f.type) if f.name in made else docs.column(f.name).cast(f.type) for f in schema], schema=schema)


def _arrow(schema: st.StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)


def dedup(docs: DataFrame, length: int = 100, keep_text: bool = True, hot: int = HOT) -> DataFrame:
    """n_bytes, n_removed, n_spans, kept_sha256 (of the remaining bytes) of each row, with the row as struct ``doc``
    and kept_text if keep_text, else with its doc_id.
    """
    spark = docs.sparkSession
    source, blocks = keyed(docs if keep_text else docs.select("doc_id", "text"))
    buckets = 2 * partitions(spark)
    key = source.select("_id", "_row", "_block", "_text")
    packed = key.select("_id", "_row", "_text").mapInArrow(partial(_anchors, length, buckets), "bucket int, data binary").repartition(buckets, "bucket")
    first = cut(packed.mapInArrow(partial(_first_buckets, length, hot, blocks), "_block int, kind int, data binary"))
    context = key.groupBy("_block").cogroup(first.where("kind = 1").select("_block", "data").groupBy("_block")).applyInArrow(partial(_contexts, length, blocks, 8 * buckets), "bucket int, kind int, data binary")
    refined = context.repartition(buckets, "bucket").mapInArrow(partial(_refine_buckets, length, blocks), "_block int, kind int, data binary")
    spans = first.where("kind = 0").select("_block", "data").union(refined.select("_block", "data"))
    made = st.StructType([st.StructField("n_bytes", st.LongType()), st.StructField("n_removed", st.LongType()), st.StructField("n_spans", st.LongType()), st.StructField("kept_sha256", st.StringType())])
    if keep_text:
        out = st.StructType([source.schema["doc"], *made.fields, st.StructField("kept_text", st.StringType())])
        left = source
    else:
        out = st.StructType([docs.schema["doc_id"], *made.fields])
        left = source.select("doc.doc_id", "_id", "_row", "_block", "_text")
    return left.groupBy("_block").cogroup(spans.groupBy("_block")).applyInArrow(partial(_finish, _arrow(out)), out)
