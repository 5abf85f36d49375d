"""Language identification by averaged hashed subword embeddings and a linear softmax.

A text is the mean of the embeddings of its subwords: the runs of 1 to 4 bytes inside its words, word ends included,
lower-cased (A-Z and the two-byte capitals of Latin-1), hashed to BUCKETS rows. Embeddings and output weights are
trained together by stochastic gradient descent in numpy. Since the output is linear, a subword's embedding times
the weights is one row of logits, and prediction sums such rows over the whole text.

Training reads whole texts of labelled rows; the fit uses at most ``sample`` of them, those whose hash of doc_id is
least, which is the documented bound. Workers count their subwords, so that a text of any length is at most BUCKETS
counts to the driver. Half of these rows train the weights; the other half sets the temperature, so that confidence
is the chance of being right: the least cross-entropy against smoothed labels, which never claims more than so many
texts can show. A text is rejected when it is null, has no letter, or its calibrated confidence is below ``least``.

Null texts and texts without letters get ``und`` and score 0. With no labelled row every text is ``und``. Language,
source and doc_id are never inputs of a prediction. Very long texts are summed in slices. Repeated rows are predicted
each; a null doc_id counts as held out. Columns of any name pass through in a struct.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from framewell.llm import text as T

BUCKETS = 1 << 16
DIM = 16
ORDERS = (1, 2, 3, 4)
#: Steps of training at least, and texts of one step.
STEPS, TEXTS = 500, 32
#: Bytes of texts whose subwords are held at once.
SLICE = 1 << 18
UNKNOWN = "und"


def held_out(column: str = "doc_id", parts: int = 4, part: int = 2) -> Column:
    """Whether crc32 of the id as text leaves the remainder; a null id does."""
    return F.coalesce(F.crc32(F.col(column).cast("string").cast("binary")) % parts == part, F.lit(True))


def subwords(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all subwords of the texts in order, and where each text's begin."""
    buf = np.frombuffer(b" ".join([b"", *texts, b""]), np.uint8)
    size = np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts))
    start = np.concatenate([[1], 1 + np.cumsum(size)])
    low = T.lower(buf).copy()
    after = np.zeros(len(buf), bool)
    after[1:] = buf[:-1] == 0xC3
    low[after & (buf >= 0x80) & (buf <= 0x9E) & (buf != 0x97)] += 0x20
    # Everything that is no letter parts words: one kind of gap.
    gap = (low < 0x80) & ~((low >= 97) & (low <= 122))
    code = np.where(gap, 32, low).astype(np.uint32)
    keys, where = [], []
    n = len(code)
    key = np.zeros(n, np.uint32)
    inside = np.ones(n, bool)
    for k in range(1, max(ORDERS) + 1):
        m = n - k + 1
        if m <= 0:
            break
        key = key[:m] * np.uint32(0x01000193) ^ code[k - 1 :]
        # A gap may be the first or the last byte of a subword, never inside, and not both without a letter.
        inside = inside[:m] & (~gap[k - 2 : k - 2 + m] if k > 2 else True)
        if k in ORDERS:
            ok = inside & (~gap[:m] if k == 1 else ~(gap[:m] & gap[k - 1 :]) if k == 2 else True)
            at = np.flatnonzero(ok)
            h = (key[at] + np.uint32(k * 0x3C6EF372)) * np.uint32(0x9E3779B1)
            keys.append((h >> np.uint32(16)) % np.uint32(BUCKETS))
            where.append(np.searchsorted(at, start))
    order_start = np.array(where)
    out = [k[w[i] : w[i + 1]] for i in range(len(texts)) for k, w in zip(keys, order_start)]
    lengths = np.diff(order_start, axis=1).sum(0)
    return np.concatenate(out) if out else np.zeros(0, np.uint32), np.concatenate([[0], np.cumsum(lengths)])


def slices(text: bytes, limit: int = SLICE) -> list[bytes]:
    """The text in parts, parted where a space or line end stands if there is one, so that no word's subwords change."""
    out, at = [], 0
    while len(text) - at > limit:
        gap = max(text.rfind(b" ", at, at + limit), text.rfind(b"\n", at, at + limit))
        to = gap if gap > at else at + limit
        out.append(text[at:to])
        at = to
    return [*out, text[at:]]


def counted(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """The text's distinct subwords and how often each occurs."""
    total = np.zeros(BUCKETS, np.int64)
    for part in slices(text):
        total += np.bincount(subwords([part])[0], minlength=BUCKETS)
    keys = np.flatnonzero(total)
    return keys.astype(np.uint16), total[keys]


@dataclass
class Model:
    labels: list[str]
    logits: np.ndarray  # BUCKETS x labels, float32
    bias: np.ndarray
    temperature: float
    least: float

    def predict(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Label number and confidence of each text with letters; -1 and 0 without subwords."""
        sums, n = np.zeros((len(texts), len(self.labels))), np.zeros(len(texts), np.int64)
        parts = [(i, p) for i, t in enumerate(texts) for p in slices(t)]
        edge = np.concatenate([[0], np.flatnonzero(np.diff(np.cumsum([len(p) for _, p in parts]) // SLICE)) + 1, [len(parts)]]).tolist()
        for a, b in zip(edge, edge[1:]):
            keys, start = subwords([p for _, p in parts[a:b]])
            size = np.diff(start)
            some = size > 0
            owner = np.array([i for i, _ in parts[a:b]])
            np.add.at(n, owner, size)
            if some.any():
                np.add.at(sums, owner[some], np.add.reduceat(self.logits[keys], start[:-1][some], axis=0, dtype=np.float64))
        z = (sums / np.maximum(n, 1)[:, None] + self.bias) / self.temperature
        p = softmax(z)
        best = p.argmax(1)
        return np.where(n > 0, best, -1), np.where(n > 0, p[np.arange(len(p)), best], 0.0)


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def train(rows: list[tuple[np.ndarray, np.ndarray]], names: list[str], least: float = 0.5, seed: int = 7) -> Model:
    """Fit embeddings and weights by SGD on texts' mean subwords, then the temperature on every other text, held back."""
    labels = sorted(set(names))
    y = np.array([labels.index(x) for x in names])
    rng = np.random.default_rng(seed)
    share = [(keys, (count / count.sum()).astype(np.float32)) for keys, count in rows]
    keep = np.array([len(keys) > 0 for keys, _ in rows], bool)
    held = keep & (np.arange(len(rows)) % 2 == 1)
    use = np.flatnonzero(keep & ~held)
    if not len(use):
        use = np.flatnonzero(keep)
    table = rng.normal(0, 0.1, (BUCKETS, DIM)).astype(np.float32)
    out = np.zeros((DIM, len(labels)), np.float32)
    bias = np.zeros(len(labels), np.float32)
    epochs = max(8, -(-STEPS * TEXTS // max(len(use), 1)))
    for epoch in range(epochs):
        rate = 2.0 * (1 - epoch / epochs)
        for batch in np.array_split(rng.permutation(use), max(1, len(use) // TEXTS)):
            if not len(batch):
                continue
            n = np.fromiter((len(share[i][0]) for i in batch), np.int64, len(batch))
            flat, part = (np.concatenate([share[i][j] for i in batch]) for j in (0, 1))
            mean = np.add.reduceat(table[flat] * part[:, None], np.cumsum(n) - n, axis=0)
            grad = softmax(mean @ out + bias)
            grad[np.arange(len(batch)), y[batch]] -= 1
            back = (rate * (grad @ out.T)).astype(np.float32)
            out -= rate * (mean.T @ grad / len(batch)).astype(np.float32)
            bias -= (0.1 * rate * grad.mean(0)).astype(np.float32)
            # One text after the other: its subwords are distinct.
            at = 0
            for size, own in zip(n.tolist(), back):
                table[flat[at : at + size]] -= part[at : at + size, None] * own
                at += size
    model = Model(labels, (table @ out).astype(np.float32), bias, 1.0, least)
    check = np.flatnonzero(held) if held.any() else use
    if not len(check):
        return model
    z = np.array([share[i][1] @ model.logits[share[i][0]] for i in check]) + bias
    # Platt's targets: one more right text, and one of each other label.
    target = np.full(z.shape, 1 / (len(check) + len(labels)))
    target[np.arange(len(z)), y[check]] = (len(check) + 1) / (len(check) + len(labels))
    grid = np.geomspace(0.1, 20, 80)
    model.temperature = float(grid[np.argmin([-(target * np.log(softmax(z / t) + 1e-300)).sum() for t in grid])])
    return model


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in T.chunks(batches, "text", SLICE):
        rows = [T.pack(keys, count.astype(np.uint16 if count.max(initial=0) < 1 << 16 else np.uint32 if count.max() < 1 << 32 else np.int64)) for keys, count in map(counted, T.texts_of(batch))]
        yield pa.record_batch([batch.column("h"), batch.column("lang"), pa.array(rows, pa.binary())], names=["h", "lang", "counts"])


def fit(docs: DataFrame, allowed: Column, sample: int = 4000, least: float = 0.5) -> Model | None:
    """Train on at most `sample` labelled rows that `allowed` names, with the least hashes of doc_id."""
    rows = docs.where(allowed & F.col("lang").isNotNull() & F.col("text").isNotNull()).select(F.xxhash64("doc_id", "lang").alias("h"), "lang", F.col("text").cast("binary").alias("text"))
    # The hashes first: only the counts of the texts that are used travel.
    last = rows.select("h").orderBy("h").limit(sample).agg(F.max("h")).first()[0]
    if last is None:
        return None
    got = rows.where(F.col("h") <= last).mapInArrow(_count, "h long, lang string, counts binary").orderBy("h", "lang", "counts").limit(sample).collect()
    return train([tuple(T.unpack(bytes(r["counts"]))) for r in got], [r["lang"] for r in got], least) if got else None


def _predict(model: Model | None, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in T.chunks(batches, "_bytes", 1 << 18):
        names, scores, rejected = [UNKNOWN] * batch.num_rows, np.zeros(batch.num_rows), np.ones(batch.num_rows, bool)
        letters = batch.column("_letters").to_pylist()
        at = np.array([i for i, ok in enumerate(letters) if ok], np.int64)
        if model is not None and len(at):
            texts = batch.column("_bytes").to_pylist()
            best, score = model.predict([texts[i] for i in at])
            for i, b, s in zip(at, best, score):
                # Letters beyond the subwords' reach still get a learned value: the one the bias favours.
                names[i] = model.labels[b] if b >= 0 else model.labels[int(model.bias.argmax())]
                scores[i] = s
                rejected[i] = s < model.least
        kept = [c for c in batch.schema.names if c not in ("_bytes", "_letters")]
        yield pa.record_batch([*(batch.column(c) for c in kept), pa.array(names, pa.string()), pa.array(scores), pa.array(rejected)], names=[*kept, "lang_pred", "lang_score", "lang_rejected"])


def identify(docs: DataFrame, model: Model | None) -> DataFrame:
    """Each row as struct ``doc`` with lang_pred, lang_score (0 to 1) and lang_rejected."""
    from pyspark.sql import types as st

    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(F.struct("*").alias("doc"), text.cast("binary").alias("_bytes"), text.rlike(r"\p{L}").alias("_letters"))
    schema = st.StructType([rows.schema["doc"], st.StructField("lang_pred", st.StringType()), st.StructField("lang_score", st.DoubleType()), st.StructField("lang_rejected", st.BooleanType())])
    return rows.mapInArrow(partial(_predict, model), schema)
