"""Exact dedup by an exchange of Golomb-coded fingerprints.

Texts are equal when identical after A-Z is lower-cased; of equal ones the row with the largest doc_id stays.

1. Pieces. Documents that lie together in a task are written once as pieces of some MB: normalised texts, compressed,
   with their ids and SHA-256. A piece never changes afterwards, whatever executors are lost.
2. Exchange. Fleets of pieces take the fingerprints of their documents (leading bits of the SHA-256, 10 more than the
   number of documents has), sort them, and send each owner its range as a Golomb code: about 12 bits a fingerprint.
   Owners answer each fleet with a bitmap of those that another fleet has sent too; fleets know their own repeats.
   Fleets and owners are of bounded size, and a message between two holds hundreds of fingerprints at any size.
3. Suspects. Only documents whose fingerprint repeats travel as texts. A piece sends each distinct text once, with the
   number of its rows and the best of them; texts are grouped by all their bytes, added up in the map tasks first, so
   that a text which holds a third of all rows meets as one row a task. Chance repeats of a fingerprint end here alone.
   Pieces find the verdict on their texts by SHA-256; should two different texts ever share one, the job stops.

Nothing is cut, capped or sampled. A null text is empty, and equal to empty ones. Of rows with equal text and equal
largest doc_id exactly one stays; a null doc_id is smaller than all others, and keep_id is null where all of a group
are. A very long text is a piece of its own. Other columns, whatever their names, are ignored. An empty table gives an
empty result.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from framewell.llm import golomb
from framewell.llm import text as T
from framewell.llm.store import cut, partitions, release

#: Bytes of text and documents of a piece, at most (a longer text is one by itself).
PIECE_BYTES, PIECE_DOCS = 8 << 20, 1 << 16
#: Documents of a fleet, and of an owner's range, on average.
FLEET_DOCS = 1 << 20
#: Bits of a fingerprint beyond those of the number of documents: the share of chance suspects is 2 ** -SPARE.
SPARE = 10
#: Bytes of suspects' bitmaps that are broadcast; more are joined by a shuffle of the pieces.
BROADCAST_BYTES = 8 << 20

PIECES = "piece long, n long, ids binary, sha binary, data binary"


class _Piece:
    def __init__(self) -> None:
        self.ids: list[pa.Array] = []
        self.texts: list[bytes] = []
        self.size = 0

    def row(self, name: int) -> pa.RecordBatch:
        ids = pa.concat_arrays(self.ids)
        sha = b"".join(hashlib.sha256(t).digest() for t in self.texts)
        sizes = np.fromiter(map(len, self.texts), np.int64, len(self.texts))
        packed = T.pack(np.asarray(ids.fill_null(0)), np.asarray(ids.is_null()).astype(np.uint8), sizes)
        press = zstandard.ZstdCompressor(level=3)
        return pa.record_batch({"piece": pa.array([name]), "n": pa.array([len(self.texts)]), "ids": pa.array([press.compress(packed)], pa.binary()), "sha": pa.array([sha], pa.binary()), "data": pa.array([press.compress(b"".join(self.texts))], pa.binary())})


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    from pyspark import TaskContext

    name, piece = TaskContext.get().partitionId() << 32, _Piece()
    for batch in T.chunks(batches):
        texts = [t.lower() for t in T.texts_of(batch)]  # of bytes, so A-Z only
        size = sum(map(len, texts))
        if piece.texts and (piece.size + size > PIECE_BYTES or len(piece.texts) + len(texts) > PIECE_DOCS):
            yield piece.row(name)
            name, piece = name + 1, _Piece()
        piece.ids.append(batch.column("doc_id"))
        piece.texts += texts
        piece.size += size
    if piece.texts:
        yield piece.row(name)


def _plain(blob: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(blob, max_output_size=1 << 31)


def _prints(sha: list[bytes], bits: int) -> np.ndarray:
    """Fingerprints: the leading bits of each SHA-256."""
    lead = np.frombuffer(b"".join(sha), ">u8").reshape(-1, 4)[:, 0].astype(np.uint64)
    return lead >> np.uint64(64 - bits)


def _ranges(owners: int, bits: int) -> list[int]:
    """Where each owner's range of fingerprints begins, and the end of the last."""
    return [-(-(o << bits) // owners) for o in range(owners + 1)]


def _send(bits: int, owners: int, table: pa.Table) -> pa.Table:
    """A fleet's distinct fingerprints, sorted and coded, to each owner of some."""
    prints = np.unique(_prints(table.column("sha").to_pylist(), bits))
    edge = _ranges(owners, bits)
    at = np.concatenate([np.searchsorted(prints, np.array(edge[:-1], np.uint64)), [len(prints)]])
    rows = [(o, golomb.encode(prints[at[o] : at[o + 1]], edge[o], edge[o + 1] - edge[o])) for o in range(owners) if at[o + 1] > at[o]]
    return pa.table([pa.array(c, k) for c, k in zip(zip(*((table.column("fleet")[0].as_py(), o, d) for o, d in rows)), (pa.int32(), pa.int32(), pa.binary()))], names=["fleet", "owner", "data"])


def _own(bits: int, owners: int, table: pa.Table) -> pa.Table:
    """For each fleet, which of its fingerprints another fleet has sent too."""
    owner = table.column("owner")[0].as_py()
    first = _ranges(owners, bits)[owner]
    lists = [golomb.decode(d, first) for d in table.column("data").to_pylist()]
    value, count = np.unique(np.concatenate(lists), return_counts=True)
    more = count > 1
    answers = [np.packbits(more[np.searchsorted(value, own)]).tobytes() for own in lists]
    return pa.table([table.column("fleet"), pa.array([owner] * len(lists), pa.int32()), pa.array(list(map(len, lists)), pa.int64()), pa.array(answers, pa.binary())], names=["fleet", "owner", "n", "data"])


def _suspects(bits: int, pieces: pa.Table, answers: pa.Table) -> pa.Table:
    """A bitmap of suspects for each piece of a fleet."""
    sha = pieces.column("sha").to_pylist()
    own = [_prints([s], bits) for s in sha]
    prints, count = np.unique(np.concatenate(own), return_counts=True) if own else (np.zeros(0, np.uint64),) * 2
    by_owner = np.argsort(answers.column("owner").to_numpy())
    n, data = answers.column("n").to_pylist(), answers.column("data").to_pylist()
    told = np.concatenate([np.unpackbits(np.frombuffer(data[i], np.uint8), count=n[i]) for i in by_owner]) if len(by_owner) else np.zeros(0, np.uint8)
    mask = (count > 1) | told.astype(bool)
    bitmaps = [np.packbits(mask[np.searchsorted(prints, p)]).tobytes() for p in own]
    return pa.table([pieces.column("piece"), pa.array(bitmaps, pa.binary())], names=["piece", "suspects"])


SPLIT = "doc_id long, sha binary, piece long, best long, n long, members binary, text binary"
_SPLIT = pa.schema([("doc_id", pa.int64()), ("sha", pa.binary()), ("piece", pa.int64()), ("best", pa.int64()), ("n", pa.int64()), ("members", pa.binary()), ("text", pa.binary())])


def _split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows that nothing repeats, and, a row for each distinct text of a piece, the suspects."""
    for batch in batches:
        for piece, ids, sha, data, bits in zip(*(batch.column(c).to_pylist() for c in ("piece", "ids", "sha", "data", "suspects"))):
            doc_id, null, size = T.unpack(_plain(ids))
            shas = [sha[i : i + 32] for i in range(0, len(sha), 32)]
            mask = np.unpackbits(np.frombuffer(bits, np.uint8), count=len(doc_id)).astype(bool)
            alone = np.flatnonzero(~mask)
            none = [None] * len(alone)
            if len(alone):
                yield pa.record_batch([pa.array(doc_id[alone], mask=null[alone].astype(bool)), pa.array([shas[i] for i in alone], pa.binary()), *(pa.array(none, f.type) for f in list(_SPLIT)[2:])], schema=_SPLIT)
            if not mask.any():
                continue
            joined, start = _plain(data), np.concatenate([[0], np.cumsum(size)])
            groups: dict[bytes, list[int]] = {}
            for i in np.flatnonzero(mask).tolist():
                groups.setdefault(joined[start[i] : start[i + 1]], []).append(i)
            rows, held = [], 0
            for text, own in groups.items():
                known = [i for i in own if not null[i]]
                # The row that would stay comes first.
                first = max(known, key=lambda i: (doc_id[i], -i)) if known else own[0]
                own = np.array([first, *(i for i in own if i != first)])
                rows.append((None, shas[first], piece, int(doc_id[first]) if known else None, len(own), T.pack(doc_id[own], null[own]), text))
                held += len(text)
                if held > T.CHUNK:
                    yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*rows), _SPLIT)], schema=_SPLIT)
                    rows, held = [], 0
            if rows:
                yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*rows), _SPLIT)], schema=_SPLIT)


RESULT = "doc_id long, keep_id long, group_size long, kept boolean, sha binary"


def _members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each document of a piece's distinct text."""
    for batch in batches:
        for sha, members, keep, size, here in zip(*(batch.column(c).to_pylist() for c in ("sha", "members", "keep_id", "group_size", "here"))):
            doc_id, null = T.unpack(members)
            n = len(doc_id)
            kept = np.zeros(n, bool)
            kept[0] = here
            yield pa.record_batch({"doc_id": pa.array(doc_id, mask=null.astype(bool)), "keep_id": pa.array([keep] * n, pa.int64()), "group_size": pa.array([size] * n, pa.int64()), "kept": pa.array(kept), "sha": pa.array([sha] * n, pa.binary())})


def exact_groups(docs: DataFrame) -> DataFrame:
    """Per row of docs (doc_id, text): doc_id, keep_id, group_size, kept, text_sha256."""
    spark = docs.sparkSession
    pieces = cut(T.binary_text(docs, F.col("doc_id").cast("long").alias("doc_id")).mapInArrow(_pieces, PIECES))
    count, held = pieces.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    fleets = max(partitions(spark), math.ceil(count / FLEET_DOCS))
    bits = min(64, count.bit_length() + SPARE)
    listed = pieces.select(F.pmod(F.hash("piece"), F.lit(fleets)).cast("int").alias("fleet"), "piece", "sha").groupBy("fleet")

    def send(table: pa.Table) -> pa.Table:
        return _send(bits, fleets, table)

    def own(table: pa.Table) -> pa.Table:
        return _own(bits, fleets, table)

    def suspects(pieces: pa.Table, answers: pa.Table) -> pa.Table:
        return _suspects(bits, pieces, answers)

    answers = listed.applyInArrow(send, "fleet int, owner int, data binary").groupBy("owner").applyInArrow(own, "fleet int, owner int, n long, data binary")
    bitmaps = listed.cogroup(answers.groupBy("fleet")).applyInArrow(suspects, "piece long, suspects binary")
    bitmaps = F.broadcast(bitmaps) if count // 8 + 64 * held <= BROADCAST_BYTES else bitmaps.hint("shuffle_hash")
    rows = cut(pieces.join(bitmaps, "piece").mapInArrow(_split, SPLIT))
    release(pieces)
    classes = rows.where("members IS NOT NULL")
    texts = classes.groupBy("sha", "text").agg(F.sum("n").alias("group_size"), F.max(F.struct("best", (-F.col("piece")).alias("piece"))).alias("keep"))
    texts = texts.groupBy("sha").agg(F.max("keep").alias("keep"), F.max("group_size").alias("group_size"), F.count("*").alias("texts"))
    verdict = F.when(F.col("texts") > 1, F.raise_error(F.lit("two texts share a SHA-256")).cast("long")).otherwise(F.col("group_size"))
    # Written, so that a text of very many pieces is met by a join that Spark can split.
    verdicts = cut(texts.select("sha", "keep", verdict.alias("group_size")))
    here = F.col("keep.best").eqNullSafe(F.col("best")) & (F.col("keep.piece") == -F.col("piece"))
    repeated = classes.select("sha", "piece", "best", "members").join(verdicts, "sha").select("sha", "members", F.col("keep.best").alias("keep_id"), "group_size", here.alias("here")).mapInArrow(_members, RESULT)
    alone = rows.where("members IS NULL").select("doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), "sha")
    return alone.union(repeated).select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("sha")).alias("text_sha256"))
