"""Language-model scoring by deleted interpolation.

Tokens are the words ``[^\\x20\\x09-\\x0D]+`` after A-Z is lower-cased and one end for each text. The model mixes
maximum-likelihood estimates of order three, two, one and zero,

    p(w | g h) = a[b] c(g, h, w) / c(g, h) + d[b] c(h, w) / c(h) + m[b] c(w) / N + z[b] / (V + 1),

with weights by bucket b of the context's frequency: the number of binary digits of c(g, h), or, where that is 0, of
c(h). The weights are learned by expectation-maximisation on the training tokens' counts with each token itself left
out (c - 1), which holds it out of the estimates. N and V are the training tokens' and types'; a context never seen
gives its order no weight.

Documents are dealt out in blocks. Each block sends its distinct hashes of one, two and three tokens with their
training counts, packed by hash range; ranges add them up and send each block the totals of what it asked for. Blocks
and ranges are of bounded bytes of text, so memory does not grow with the corpus, while what is counted does. EM sees
a histogram of binned estimates of fixed size (counts exact, estimates to half a bit).

Tokens are told apart by 64 bits of their hashes, pairs and triples by 9 bits more than the number of the corpus's
bytes has, so at any size about one in some thousands shares its count with another. Null text is empty: its one token is
the end. A null doc_id stays null and counts as held out. A very long text is one block's whole. Repeated rows are
scored, and counted, each. With nothing to train on, N = V = 0 and every token gets 1 / (V + 1). Other columns,
whatever their names, are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from framewell.llm import text as T
from framewell.llm.store import cut

END_WORD, START = T.U64(0x6A09E667F3BCC908), T.U64(0xBB67AE8584CAA73B)
#: Bytes of text in a block of documents, and of those whose hashes make one range.
BLOCK_BYTES, RANGE_BYTES = 6 << 20, 8 << 20
ORDERS = (1, 2, 3)
#: Bits of a pair's or triple's hash that are sent, beyond those of the corpus's bytes, and at least.
SPARE, LEAST = 9, 40
#: Binary digits of a context's frequency that are told apart: of pairs, then of single tokens.
DIGITS = 40
BUCKETS = 2 * DIGITS
#: Bins of an estimate: zero, then halves of a bit.
BINS = 64


def _pack_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of one block and batch as one compressed row: texts travel three times, so they travel small."""
    press = zstandard.ZstdCompressor(level=3)
    for batch in T.chunks(batches, "text", 4 << 20):
        block = batch.column("block").to_numpy()
        keys, data = [], []
        for b in np.unique(block):
            own = batch.filter(pa.array(block == b)).select(["doc_id", "train", "text"])
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, own.schema) as out:
                out.write_batch(own)
            keys.append(int(b))
            data.append(press.compress(sink.getvalue().to_pybytes()))
        yield pa.record_batch({"block": pa.array(keys, pa.int32()), "data": pa.array(data, pa.binary())})


class Block:
    """The tokens of a block: ids of documents, distinct hashes of one, two and three tokens and where each token finds them."""

    def __init__(self, packed: list[bytes], sent: dict[int, int]):
        parts = [pa.ipc.open_stream(zstandard.ZstdDecompressor().decompress(p, max_output_size=1 << 31)).read_all() for p in packed]
        table = pa.concat_tables(parts)
        self.doc_id, self.train = table.column("doc_id"), np.array(table.column("train").to_pylist(), bool)
        tokens, counts = [], []
        for batch in T.chunks(iter(table.to_batches())):
            words = T.Words(T.texts_of(batch))
            n = np.diff(words.first)
            at = np.zeros(len(words.hash) + batch.num_rows, T.U64)
            ends = np.cumsum(n + 1) - 1
            at[:] = END_WORD
            inside = np.ones(len(at), bool)
            inside[ends] = False
            at[inside] = words.hash
            tokens.append(at)
            counts.append(n + 1)
        token, self.n = np.concatenate(tokens), np.concatenate(counts)
        self.start = np.concatenate([[0], np.cumsum(self.n)])
        first = self.start[:-1]
        self.doc = np.repeat(np.arange(len(self.n)), self.n)
        #: By order, the distinct hashes and each token's place among them.
        self.grams: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        gram = token
        for order in ORDERS:
            if order > 1:  # the gram before, and the token
                before = np.concatenate([[START], gram[:-1]])
                before[first] = START
                gram = T.fold([before, token])
            self.grams[order] = np.unique(gram >> T.U64(64 - sent[order]), return_inverse=True)
        #: Whether a token is its text's first.
        self.head = np.zeros(len(token), bool)
        self.head[first] = True

    def trained(self, order: int) -> np.ndarray:
        """Training tokens of this block at each distinct hash."""
        hashes, at = self.grams[order]
        return np.bincount(at[self.train[self.doc]], minlength=len(hashes))


def sent_bits(size: int) -> dict[int, int]:
    """Bits of the hashes of one, two and three tokens that are sent, for a corpus of so many bytes."""
    return {1: 64} | dict.fromkeys((2, 3), min(64, max(LEAST, size.bit_length() + SPARE)))


def _range_of(hashes: np.ndarray, bits: int, ranges: int) -> np.ndarray:
    return ((hashes >> T.U64(bits - 32)) * T.U64(ranges) >> T.U64(32)).astype(np.int64)


def _press(*arrays: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(T.pack(*arrays))


def _unpress(blob: bytes) -> list[np.ndarray]:
    return T.unpack(zstandard.ZstdDecompressor().decompress(blob, max_output_size=1 << 31))


def _small(a: np.ndarray) -> np.ndarray:
    """Counts in the narrowest unsigned kind that holds them."""
    top = int(a.max()) if len(a) else 0
    return a.astype(np.uint8 if top < 1 << 8 else np.uint16 if top < 1 << 16 else np.uint32 if top < 1 << 32 else np.uint64)


def _ask(ranges: int, sent: dict[int, int], table: pa.Table) -> pa.Table:
    """What a block holds: hashes as differences, and training counts, by order and range."""
    block = Block(table.column("data").to_pylist(), sent)
    name, rows = table.column("block")[0].as_py(), []
    for order in ORDERS:
        hashes, count = block.grams[order][0], block.trained(order)
        edge = np.searchsorted(_range_of(hashes, sent[order], ranges), np.arange(ranges + 1))
        for r in range(ranges):
            a, b = edge[r], edge[r + 1]
            if b > a:
                rows.append((r, name, order, _press(_small(np.diff(hashes[a:b], prepend=T.U64(0))), _small(count[a:b]))))
    return pa.table([pa.array(c, k) for c, k in zip(zip(*rows), (pa.int32(), pa.int32(), pa.int32(), pa.binary()))], names=["range", "block", "order", "data"])


ASKED = "range int, block int, order int, data binary"
ANSWER = "block int, order int, range int, data binary, types long, tokens long, texts long"


def _answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Totals of each range for each block that asked; and types, tokens and texts of the training part."""
    held: dict[tuple[int, int], list[tuple[int, np.ndarray, np.ndarray]]] = {}
    for batch in batches:
        for r, b, o, data in zip(*(batch.column(c).to_pylist() for c in ("range", "block", "order", "data"))):
            step, count = _unpress(data)
            held.setdefault((r, o), []).append((b, np.cumsum(step, dtype=T.U64), count))
    end = END_WORD
    for (r, o), parts in held.items():
        hashes = np.concatenate([h for _, h, _ in parts])
        values, inverse = np.unique(hashes, return_inverse=True)
        total = np.bincount(inverse, np.concatenate([c for _, _, c in parts]).astype(np.float64)).astype(np.int64)
        if o == 1:
            ends = int(total[np.searchsorted(values, end)]) if end in values else 0
            yield _answers([(-1, o, r, b"", int((total > 0).sum()), int(total.sum()), ends)])
        at, rows = 0, []
        for b, h, _ in parts:
            rows.append((b, o, r, _press(_small(total[inverse[at : at + len(h)]])), None, None, None))
            at += len(h)
        for i in range(0, len(rows), 256):
            yield _answers(rows[i : i + 256])


def _answers(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.int64(), pa.int64(), pa.int64())
    return pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=[x.split()[0] for x in ANSWER.split(", ")])


def _known(block: Block, answers: pa.Table, texts: int) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """For each token, by order: the training count of its gram, and of the gram's context (of order two and three)."""
    order, where = (answers.column(c).to_numpy() for c in ("order", "range"))
    data = answers.column("data").to_pylist()
    count, context = [], []
    for o in ORDERS:
        at = np.flatnonzero(order == o)
        count.append(np.concatenate([_unpress(data[i])[0].astype(np.int64) for i in at[np.argsort(where[at])]])[block.grams[o][1]])
        if o < max(ORDERS):
            before = np.concatenate([[texts], count[-1][:-1]])
            before[block.head] = texts
            context.append(before)
    return count, context


def bucket_of(context: list[np.ndarray]) -> np.ndarray:
    """Number of binary digits of the pair's count, or, beyond DIGITS, of the single token's where no pair was seen."""
    one, two = (np.minimum(np.frexp(c.astype(np.float64))[1], DIGITS - 1).astype(np.int64) for c in context)
    return np.where(context[1] > 0, two, DIGITS + one)


def estimates(count: list[np.ndarray], context: list[np.ndarray], n: int) -> list[np.ndarray]:
    """Maximum-likelihood estimates of order three, two and one."""
    share = lambda a, b: np.divide(a, b, out=np.zeros(len(a)), where=b > 0)
    return [share(count[2], context[1]), share(count[1], context[0]), count[0] / max(n, 1)]


def _bin(p: np.ndarray) -> np.ndarray:
    return np.where(p > 0, np.clip(1 + np.round(-2 * np.log2(np.maximum(p, 1e-300))), 1, BINS - 1), 0).astype(np.int64)


def cells_of(count: list[np.ndarray], context: list[np.ndarray], n: int) -> np.ndarray:
    """The histogram's cell of each training token, left out of its own counts: bucket, then the bins of order three, two and one."""
    count, context = [c - 1 for c in count], [c - 1 for c in context]
    cell = bucket_of(context)
    for p in estimates(count, context, n - 1):
        cell = cell * BINS + _bin(p)
    return cell


def _histogram(n: int, texts: int, sent: dict[int, int], docs: pa.Table, answers: pa.Table) -> pa.Table:
    """How many training tokens each cell has."""
    schema = pa.schema([("group", pa.int32()), ("data", pa.binary())])
    if not docs.num_rows:
        return schema.empty_table()
    block = Block(docs.column("data").to_pylist(), sent)
    own = block.train[block.doc]
    count, context = ([c[own] for c in x] for x in _known(block, answers, texts))
    at, number = np.unique(cells_of(count, context, n), return_counts=True)
    return pa.table([[docs.column("block")[0].as_py() % 64], [T.pack(at, number)]], schema=schema)


def _sum_cells(table: pa.Table) -> pa.Table:
    at, number = (np.concatenate(x) for x in zip(*(T.unpack(d) for d in table.column("data").to_pylist())))
    cell, where = np.unique(at, return_inverse=True)
    total = np.zeros(len(cell), np.int64)
    np.add.at(total, where, number)
    return pa.table([pa.array([0], pa.int32()), pa.array([T.pack(cell, total)], pa.binary())], names=["group", "data"])


START_WEIGHTS = np.array([0.4, 0.3, 0.25, 0.05])


def learn_weights(at: np.ndarray, count: np.ndarray, types: int, rounds: int = 40) -> np.ndarray:
    """EM for the weights of each context bucket over the histogram's cells: of order three, two, one and zero."""
    bins, rest = [], at
    for _ in range(3):
        bins.append(rest % BINS)
        rest = rest // BINS
    p = np.stack([np.where(b > 0, np.exp2((1 - b) / 2.0), 0.0) for b in reversed(bins)] + [np.full(len(at), 1 / (types + 1))], 1)
    allowed = np.ones((BUCKETS, 4))
    allowed[DIGITS:, 0] = 0  # no such pair was seen
    allowed[[0, DIGITS], :2] = 0  # nor such a token
    start = START_WEIGHTS * allowed
    weight = start / start.sum(1, keepdims=True)
    for _ in range(rounds):
        share = weight[rest] * p
        share *= (count / share.sum(1))[:, None]
        total = np.stack([np.bincount(rest, share[:, k], BUCKETS) for k in range(4)], 1)
        # A little of the start keeps buckets without tokens, and every weight, above zero.
        total += start * 0.1
        weight = total / total.sum(1, keepdims=True)
    return weight


SCORES = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def _score(n: int, types: int, texts: int, sent: dict[int, int], weight: np.ndarray, docs: pa.Table, answers: pa.Table) -> pa.Table:
    names = [c.split()[0] for c in SCORES.split(", ")]
    if not docs.num_rows:
        return pa.schema([(x, k) for x, k in zip(names, (pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64()))]).empty_table()
    block = Block(docs.column("data").to_pylist(), sent)
    count, context = _known(block, answers, texts)
    base = np.log10((count[0] + 1) / (n + types + 1))
    w = weight[bucket_of(context)]
    p = w[:, 3] / (types + 1)
    for k, share in enumerate(estimates(count, context, n)):
        p += w[:, k] * share
    add = lambda x: np.add.reduceat(x, block.start[:-1])
    columns = [block.doc_id.combine_chunks(), pa.array(~block.train), pa.array(block.n.astype(np.int64)), pa.array(add((count[0] > 0).astype(np.int64))), pa.array(np.full(len(block.n), n)), pa.array(add(base)), pa.array(add(np.log10(p)))]
    return pa.table(columns, names=names)


def score_documents(docs: DataFrame, train: F.Column) -> DataFrame:
    """Per row: doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score (log10). ``train`` marks rows to learn from."""
    spark = docs.sparkSession
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(train, F.lit(False)).alias("train"), F.coalesce(F.col("text").cast("binary"), F.lit(b"")).alias("text"))
    size = source.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    # Both from the bytes alone: a block sends a message to each range.
    blocks, ranges, bits = max(1, math.ceil(size / BLOCK_BYTES)), max(1, math.ceil(size / RANGE_BYTES)), sent_bits(size)
    packed = source.withColumn("block", F.pmod(F.xxhash64("doc_id"), F.lit(blocks)).cast("int")).mapInArrow(_pack_texts, "block int, data binary").groupBy("block")

    def ask(table: pa.Table) -> pa.Table:
        return _ask(ranges, bits, table)

    asked = packed.applyInArrow(ask, ASKED)
    answers = cut(asked.repartition(ranges, "range").mapInArrow(_answer, ANSWER))
    types, n, texts = (x or 0 for x in answers.where("block < 0").agg(F.sum("types"), F.sum("tokens"), F.sum("texts")).first())
    sent = answers.where("block >= 0").select("block", "order", "range", "data").groupBy("block")
    cells = packed.cogroup(sent).applyInArrow(partial(_histogram, n, texts, bits), "group int, data binary")
    for _ in range(2):
        cells = cells.groupBy("group").applyInArrow(_sum_cells, "group int, data binary")
    row = cells.first()
    weight = learn_weights(*T.unpack(bytes(row["data"])), types) if row and n else np.tile([0.0, 0.0, 0.0, 1.0], (BUCKETS, 1))
    return packed.cogroup(sent).applyInArrow(partial(_score, n, types, texts, bits, weight), SCORES)
