"""Training-order materialisation: fixed-stride shards in the order of a keyed Feistel permutation.

Documents are taken in order of doc_id (null first), rows of one doc_id in order of their texts' hashes. Their token
ids, each document's with its end id, form one stream that is cut into sequences of ``length`` ids; only the last one
is padded. A balanced Feistel network on the least even number of bits that holds all sequence numbers, walked until
the result is a number again, gives every sequence a global slot: the same key and documents give the same slots,
however the input is partitioned. Slots are dealt out in ranges of ``shard_rows``: shard s holds slots
s * shard_rows and up, each as ``length`` little-endian unsigned 16-bit ids and one line feed, so slot k is at byte
(k mod shard_rows) * (2 * length + 1) of its shard and reading can start at any slot (``read_sequences``). A task writes some whole shards;
Spark's committer puts them in the shared folder. Ids of 65,535 and up raise an error.

Null text is empty (one end id). Very long texts run over many sequences. Rows that repeat are written each. Other
columns, whatever their names, are ignored. An empty table gives no shards.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from framewell.llm import text as T
from framewell.llm.store import partitions, scratch
from framewell.llm.tokens import byte_bpe, default_paths

ROUNDS = 6
PAD = 0xFFFF
#: Bytes of text that a task turns into ids, and bytes of records that a task writes as whole shards.
TASK_BYTES, WRITE_BYTES = 64 << 20, 32 << 20
#: Ids that a task deals out at once.
DEAL = 8 << 20
#: Tasks whose offsets are broadcast, 12 bytes each; more are joined.
BROADCAST_TASKS = 1_000_000


def feistel(x: np.ndarray, n: int, key: int, inverse: bool = False) -> np.ndarray:
    """The keyed permutation of 0 .. n - 1 at the places x."""
    half = max(1, (max(n - 1, 1).bit_length() + 1) // 2)
    mask = T.U64((1 << half) - 1)
    keys = T.mix(np.arange(1, ROUNDS + 1, dtype=T.U64) * T.U64(T.BASE) + T.U64(key & (1 << 64) - 1))
    out = x.astype(T.U64).copy()
    todo = np.arange(len(out))
    while len(todo):
        left, right = out[todo] >> T.U64(half), out[todo] & mask
        for k in reversed(keys) if inverse else keys:
            if inverse:
                left, right = right ^ (T.mix(left ^ k) & mask), left
            else:
                left, right = right, left ^ (T.mix(right ^ k) & mask)
        out[todo] = left << T.U64(half) | right
        todo = todo[out[todo] >= T.U64(n)]
    return out.astype(np.int64)


def _squeeze(ids: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=6).compress(ids.astype("<u2").tobytes())


def _ids(blob: bytes) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(blob, max_output_size=1 << 34), "<u2")


MANIFEST = "slot long, shard long, byte_offset long, n_ids int, ids_crc32 long, doc_ids array<long>"
TOKENS = "part int, first long, count long, docs binary, ids binary"


def _tokenise(paths: tuple[str, str], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """This task's stream, some hundred documents a row: their ids (0 and a mark for null), sizes, and token ids."""
    from pyspark import TaskContext

    part, first = TaskContext.get().partitionId(), 0
    bpe = byte_bpe(*paths)
    for batch in T.chunks(batches, limit=1 << 20):
        names = batch.column("doc_id")
        ids = [bpe.document(text.decode("utf-8", "replace")) for text in T.texts_of(batch)]
        size = np.fromiter(map(len, ids), np.int64, len(ids))
        flat = np.concatenate(ids)
        if flat.max() >= PAD:
            raise ValueError("an id does not fit the shards' 16 bits")
        docs = T.pack(names.fill_null(0).to_numpy(), np.asarray(names.is_null().to_numpy(zero_copy_only=False), np.uint8), size)
        yield pa.record_batch({"part": pa.array([part], pa.int32()), "first": pa.array([first], pa.int64()), "count": pa.array([len(flat)], pa.int64()), "docs": pa.array([docs], pa.binary()), "ids": pa.array([_squeeze(flat)], pa.binary())})
        first += len(flat)


def _fragments(start: int, size: np.ndarray, n: int, key: int, length: int) -> tuple[np.ndarray, ...]:
    """Where sequences and documents part a row's tokens, of which the first is number start: slot, place in it, tokens and document number of each fragment."""
    edge = np.cumsum(size)
    at = np.unique(np.concatenate([[0], edge[:-1], np.arange(-start % length, edge[-1], length)]))
    number, place = np.divmod(start + at, length)
    return feistel(number, n, key), place, np.diff(np.append(at, edge[-1])), np.searchsorted(edge, at, "right")


def _deal(n: int, key: int, length: int, group_rows: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Fragments of sequences by group of shards: slot, place in it and size of each, and their ids."""
    held: list[tuple[np.ndarray, ...]] = []

    def flush() -> Iterator[pa.RecordBatch]:
        slot, place, size, ids = (np.concatenate([h[i] for h in held]) for i in range(4))
        held.clear()
        start = np.cumsum(size) - size
        group, where = np.unique(slot // group_rows, return_inverse=True)
        for g, at in T.by_bucket(where, len(group)):
            c = size[at]
            take = np.arange(c.sum()) + np.repeat(start[at] - (np.cumsum(c) - c), c)
            yield pa.record_batch({"group": pa.array([group[g]], pa.int32()), "parts": pa.array([T.pack(slot[at], place[at].astype(np.int32), c.astype(np.int32))], pa.binary()), "ids": pa.array([_squeeze(ids[take])], pa.binary())})

    have = 0
    for batch in batches:
        for start, docs, blob in zip(batch.column("start").to_pylist(), batch.column("docs").to_pylist(), batch.column("ids").to_pylist()):
            held.append((*_fragments(start, T.unpack(docs)[2], n, key, length)[:3], _ids(blob)))
            have += len(held[-1][3])
            if have >= DEAL:
                yield from flush()
                have = 0
    if held:
        yield from flush()


def _assemble(n: int, length: int, shard_rows: int, group_rows: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Whole records in the order of their slots. A task holds one group of shards: group_rows records."""
    held: dict[int, list[tuple[bytes, bytes]]] = {}
    for batch in batches:
        for g, p, b in zip(*(batch.column(c).to_pylist() for c in ("group", "parts", "ids"))):
            held.setdefault(g, []).append((p, b))
    width = 2 * length
    for g in sorted(held):
        low, count = g * group_rows, min(group_rows, n - g * group_rows)
        records = np.full(count * length, PAD, "<u2")
        for parts, blob in held.pop(g):
            (slot, place, size), ids = T.unpack(parts), _ids(blob)
            records[np.arange(len(ids)) + np.repeat((slot - low) * length + place - (np.cumsum(size) - size), size)] = ids
        for a in range(0, count, 2048):
            raw, slots = records[a * length : (a + 2048) * length].tobytes(), low + np.arange(a, min(a + 2048, count))
            yield pa.record_batch({"shard": pa.array(slots // shard_rows), "slot": pa.array(slots), "record": pa.array([raw[i * width : i * width + width] for i in range(len(slots))], pa.binary())})


def _holders(n: int, key: int, length: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Which document stands where in which slot."""
    for batch in batches:
        for start, docs in zip(batch.column("start").to_pylist(), batch.column("docs").to_pylist()):
            doc, null, size = T.unpack(docs)
            slot, place, _, of = _fragments(start, size, n, key, length)
            yield pa.record_batch({"slot": pa.array(slot), "place": pa.array(place.astype(np.int32)), "doc_id": pa.array(doc[of], mask=null[of].astype(bool))})


def _written(length: int, shard_rows: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Slot, size and checksum of each record of a written shard."""
    stride = 2 * length + 1
    for batch in batches:
        for shard, i in zip(batch.column("shard").to_pylist(), range(batch.num_rows)):
            raw = np.frombuffer(batch.column("content")[i].as_buffer(), np.uint8).reshape(-1, stride)
            ids = np.ascontiguousarray(raw[:, :-1]).view("<u2")
            n_ids = (ids != PAD).sum(1)
            sums = [zlib.crc32(x[:k]) for x, k in zip(ids, n_ids.tolist())]
            yield pa.record_batch({"slot": pa.array(shard * shard_rows + np.arange(len(ids))), "n_ids": pa.array(n_ids.astype(np.int32)), "ids_crc32": pa.array(sums, pa.int64())})


def materialise(docs: DataFrame, length: int = 512, shard_rows: int = 16_384, key: int = 20_240_601, paths: tuple[str, str] | None = None) -> tuple[DataFrame, str | None]:
    """Write the shards; the manifest (slot, shard, byte_offset, n_ids, ids_crc32, doc_ids) and the shards' folder.

    docs needs doc_id and text. See the module's text for the order and the edge cases.
    """
    spark = docs.sparkSession
    paths = paths or default_paths()
    folder = scratch(spark)
    source = T.binary_text(docs, F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("t"))
    size = source.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    source = source.repartitionByRange(max(partitions(spark), math.ceil(size / TASK_BYTES)), "doc_id", "t").sortWithinPartitions("doc_id", "t")
    made = source.select("doc_id", "text").mapInArrow(partial(_tokenise, paths), TOKENS)
    # The ids are compressed already.
    made.write.option("compression", "lz4_raw").parquet(f"{folder}/tokens")
    made = spark.read.schema(made.schema).parquet(f"{folder}/tokens")
    # A row for each task, in the order of the documents: the number of its first token.
    tasks = made.groupBy("part").agg(F.sum("count").alias("c"))
    total, parts = tasks.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    n = -(-total // length)
    base = tasks.select("part", (F.sum("c").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, 0)) - F.col("c")).alias("base"))
    placed = made.join(F.broadcast(base) if parts <= BROADCAST_TASKS else base, "part").select((F.col("base") + F.col("first")).alias("start"), "docs", "ids")
    if not n:
        return spark.createDataFrame([], MANIFEST), None
    group_rows = shard_rows * max(1, WRITE_BYTES // (2 * length * shard_rows))
    dealt = placed.mapInArrow(partial(_deal, n, key, length, group_rows), "group int, parts binary, ids binary")
    # Partition g is group g: a range of slots.
    dealt = dealt.repartitionById(max(1, -(-n // group_rows)), F.col("group"))
    records = dealt.mapInArrow(partial(_assemble, n, length, shard_rows, group_rows), "shard long, slot long, record binary").sortWithinPartitions("shard", "slot")
    records.select("shard", F.col("record").cast("string").alias("value")).write.partitionBy("shard").text(f"{folder}/shards")
    # The manifest tells what stands in the written shards.
    holders = placed.select("start", "docs").mapInArrow(partial(_holders, n, key, length), "slot long, place int, doc_id long")
    holders = holders.groupBy("slot").agg(F.array_sort(F.collect_list(F.struct("place", "doc_id"))).alias("held"))
    shards = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "part-*").load(f"{folder}/shards")
    shards = shards.select(F.regexp_extract("path", r"shard=(\d+)", 1).cast("long").alias("shard"), "content")
    written = shards.mapInArrow(partial(_written, length, shard_rows), "slot long, n_ids int, ids_crc32 long")
    manifest = written.join(holders, "slot").select("slot", F.expr(f"slot div {shard_rows}").alias("shard"), (F.col("slot") % shard_rows * (2 * length + 1)).alias("byte_offset"), "n_ids", "ids_crc32", F.col("held.doc_id").alias("doc_ids"))
    return manifest, f"{folder}/shards"


def read_sequences(spark: SparkSession, folder: str, start: int = 0, count: int | None = None, length: int = 512, shard_rows: int = 16_384) -> DataFrame:
    """slot and ids (padding left out) of the slots from ``start`` on, at most ``count``: what a trainer reads that goes on there.

    Only the shards that hold these slots are listed as input; a shard's records are found by their place, one task a
    shard. Slots beyond the last one give nothing.
    """
    end = start + count if count is not None else 1 << 62
    stride = 2 * length + 1

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, content in zip(batch.column("shard").to_pylist(), batch.column("content")):
                raw = np.frombuffer(content.as_buffer(), np.uint8).reshape(-1, stride)
                low = shard * shard_rows
                for a in range(max(start - low, 0), min(len(raw), end - low), 4096):
                    b = min(a + 4096, len(raw), end - low)
                    ids = np.ascontiguousarray(raw[a:b, :-1]).view("<u2")
                    some = ids != PAD
                    sizes = pa.array(np.concatenate([[0], np.cumsum(some.sum(1))]).astype(np.int32))
                    yield pa.record_batch({"slot": pa.array(np.arange(low + a, low + b)), "ids": pa.ListArray.from_arrays(sizes, pa.array(ids[some].astype(np.int32)))})

    shards = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(folder).select(F.col("shard").cast("long").alias("shard"), "content")
    shards = shards.where((F.col("shard") >= start // shard_rows) & (F.col("shard") < -(-end // shard_rows)))
    return shards.mapInArrow(records, "slot long, ids array<int>")
