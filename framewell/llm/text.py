"""Byte-level text work in numpy, shared by the operators: word tables, rolling hashes, packed columns."""

from __future__ import annotations

import ctypes
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

U64 = np.uint64
#: Odd multiplier of the byte polynomial and its inverse modulo 2**64.
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)
#: White space of the word rule [^\x20\x09-\x0D]+.
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: Bytes of texts handled at once in numpy.
CHUNK = 1 << 19


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64: spreads every input bit over the word."""
    x = x.astype(U64, copy=True)
    x ^= x >> U64(30)
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


BYTE_CODE = mix(np.arange(1, 257, dtype=U64) * U64(BASE))
_POWERS: list[np.ndarray] = [np.ones(1, U64), np.ones(1, U64)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and BASE**-i for i < n."""
    if len(_POWERS[0]) < n:
        size = max(n, CHUNK + 1024)
        for k, root in enumerate((BASE, INVERSE)):
            steps = np.full(size, root, U64)
            steps[0] = 1
            _POWERS[k] = np.cumprod(steps, dtype=U64)
    return _POWERS[0][:n], _POWERS[1][:n]


def prefix_hash(buf: np.ndarray) -> np.ndarray:
    """Running polynomial; (h[e] - h[s]) * BASE**-s identifies buf[s:e]."""
    up, _ = powers(len(buf) + 1)
    out = np.zeros(len(buf) + 1, U64)
    np.cumsum(BYTE_CODE[buf] * up[:-1], out=out[1:])
    return out


def span_hash(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    _, down = powers(len(prefix))
    return (prefix[end] - prefix[start]) * down[start]


#: A second polynomial, modulo a prime: what the first one cannot tell apart at any odd base (Thue-Morse words) differs here.
PRIME = (1 << 31) - 1
SIDE = 0x4F1BBCDC
_SIDE_POWERS: list[np.ndarray] = [np.ones(1, U64), np.ones(1, U64)]


def _fold31(x: np.ndarray) -> np.ndarray:
    """x modulo PRIME but for one addend; below 2**33."""
    return (x & U64(PRIME)) + (x >> U64(31))


def side_powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_SIDE_POWERS[0]) < n:
        size = max(n, CHUNK + 1024)
        for k, root in enumerate((SIDE, pow(SIDE, -1, PRIME))):
            steps = np.ones(1, U64)
            while len(steps) < size:
                steps = np.concatenate([steps, steps * U64(pow(root, len(steps), PRIME)) % U64(PRIME)])
            _SIDE_POWERS[k] = steps[:size]
    return _SIDE_POWERS[0][:n], _SIDE_POWERS[1][:n]


def side_hash(buf: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Values of buf[s:e] below PRIME."""
    up, down = side_powers(len(buf) + 1)
    prefix = np.zeros(len(buf) + 1, U64)
    np.cumsum(_fold31((BYTE_CODE >> U64(34))[buf] * up[:-1]), out=prefix[1:])
    return (prefix[end] - prefix[start]) % U64(PRIME) * down[start] % U64(PRIME)


def lower(buf: np.ndarray) -> np.ndarray:
    """A-Z to a-z, all other bytes as they are."""
    return buf + (((buf >= 65) & (buf <= 90)).astype(np.uint8) << 5)


class Words:
    """The words of several texts: start, end, hash and text number of each, in order."""

    def __init__(self, texts: list[bytes], gaps: np.ndarray = SPACE):
        joined = b"\n".join([*texts, b""])
        self.buf = lower(np.frombuffer(joined, np.uint8))
        sizes = np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts))
        self.offset = np.concatenate([[0], np.cumsum(sizes)])
        word = ~gaps[self.buf]
        edge = np.diff(np.concatenate([[False], word, [False]]).astype(np.int8))
        self.start, self.end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        value = span_hash(prefix_hash(self.buf), self.start, self.end)
        if gaps is SPACE:  # operators that count and compare these words take their hashes for the words themselves
            value += mix(side_hash(self.buf, self.start, self.end))
        self.hash = mix(value)
        self.doc = np.searchsorted(self.offset, self.start, "right") - 1
        #: Words of text i are first[i] .. first[i + 1].
        self.first = np.searchsorted(self.doc, np.arange(len(texts) + 1))


def fold(hashes: list[np.ndarray]) -> np.ndarray:
    """One hash for each row of several hash columns; order and number of columns matter."""
    out = np.full(len(hashes[0]), len(hashes), U64)
    for h in hashes:
        out = mix(out * U64(BASE) + h)
    return out


def gram_hash(words: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all k-word grams that stay in one text, and the number of each one's first word."""
    n = len(words.hash) - k + 1
    if n <= 0:
        return np.zeros(0, U64), np.zeros(0, np.int64)
    at = np.flatnonzero(words.doc[:n] == words.doc[k - 1 :])
    return fold([words.hash[at + i] for i in range(k)]), at


def shingle_sets(texts: list[bytes], k: int) -> list[np.ndarray]:
    """Each text's set of k-word shingles as sorted hashes; fewer words make one shingle of all, none an empty set."""
    size = np.cumsum([len(t) for t in texts])
    edge = [0, *(np.flatnonzero(np.diff(size // CHUNK)) + 1).tolist(), len(texts)]
    return [s for a, b in zip(edge, edge[1:]) for s in _shingle_sets(texts[a:b], k)]


def _shingle_sets(texts: list[bytes], k: int) -> list[np.ndarray]:
    words = Words(texts)
    grams, at = gram_hash(words, k)
    doc = words.doc[at]
    first = np.searchsorted(doc, np.arange(len(texts) + 1))
    out = []
    for i in range(len(texts)):
        a, b = words.first[i], words.first[i + 1]
        if b - a >= k:
            out.append(np.unique(grams[first[i] : first[i + 1]]))
        else:
            out.append(fold([words.hash[j : j + 1] for j in range(a, b)]) if b > a else np.zeros(0, U64))
    return out


def binary_text(docs: DataFrame, *keep: str) -> DataFrame:
    """The named columns and the text as bytes; a null text is empty."""
    return docs.select(*keep, F.coalesce(F.col("text").cast("binary"), F.lit(b"")).alias("text"))


def trim() -> None:
    """Give freed memory back to the system: workers live on between tasks, and several of them share an executor's memory."""
    pa.default_memory_pool().release_unused()
    own = ctypes.CDLL(None)
    if hasattr(own, "malloc_trim"):
        own.malloc_trim(0)


def chunks(batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = CHUNK) -> Iterator[pa.RecordBatch]:
    """The rows again, in batches of at most limit bytes in the column, or one row. Freed memory goes back before and after."""
    trim()
    yield from _chunks(batches, column, limit)
    trim()


def _chunks(batches: Iterator[pa.RecordBatch], column: str, limit: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        size = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        at = 0
        while at < len(size):
            base = size[at - 1] if at else 0
            to = max(int(np.searchsorted(size, base + limit, "right")), at + 1)
            yield batch.slice(at, to - at)
            at = to


def texts_of(batch: pa.RecordBatch, column: str = "text") -> list[bytes]:
    return batch.column(column).to_pylist()


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays of one dimension as bytes, byte planes apart, so that small values compress."""
    out = [struct.pack("<B", len(arrays))]
    for a in arrays:
        a = np.ascontiguousarray(a)
        out += [struct.pack("<2sq", a.dtype.str[1:].encode(), len(a)), a.view(np.uint8).reshape(len(a), a.itemsize).T.tobytes()]
    return b"".join(out)


def unpack(data: bytes) -> list[np.ndarray]:
    at, out = 1, []
    for _ in range(data[0]):
        kind, n = struct.unpack_from("<2sq", data, at)
        dtype = np.dtype("<" + kind.decode())
        at += 10
        planes = np.frombuffer(data, np.uint8, n * dtype.itemsize, at).reshape(dtype.itemsize, n)
        out.append(np.ascontiguousarray(planes.T).reshape(-1).view(dtype))
        at += n * dtype.itemsize
    return out


def by_bucket(bucket: np.ndarray, count: int) -> Iterator[tuple[int, np.ndarray]]:
    """The non-empty buckets with the places of their members, in order."""
    order = np.argsort(bucket, kind="stable")
    edge = np.searchsorted(bucket[order], np.arange(count + 1))
    for b in range(count):
        if edge[b + 1] > edge[b]:
            yield b, order[edge[b] : edge[b + 1]]


def spark_xxhash64(a: np.ndarray) -> np.ndarray:
    """What Spark's xxhash64 gives for a column of longs, so that both sides deal rows alike."""
    p1, p2, p3, p4, p5 = (U64(x) for x in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5))
    turn = lambda x, r: (x << U64(r)) | (x >> U64(64 - r))
    with np.errstate(over="ignore"):
        h = np.full(len(a), 42 + 8, U64) + p5
        h ^= turn(a.astype(np.int64).view(U64) * p2, 31) * p1
        h = turn(h, 27) * p1 + p4
        h ^= h >> U64(33)
        h *= p2
        h ^= h >> U64(29)
        h *= p3
        h ^= h >> U64(32)
    return h.view(np.int64)


def packed_rows(key: str, where: np.ndarray, count: int, arrays: list[np.ndarray], **same: int) -> Iterator[pa.RecordBatch]:
    """One row per non-empty bucket with its members of all arrays, few rows at a time."""
    out = [(b, pack(*(a[at] for a in arrays))) for b, at in by_bucket(where, count)]
    for i in range(0, len(out), 32):
        part = out[i : i + 32]
        yield pa.record_batch({key: pa.array([b for b, _ in part], pa.int32()), **{k: pa.array([v] * len(part), pa.int32()) for k, v in same.items()}, "data": pa.array([d for _, d in part], pa.binary())})


def gathered(batches: Iterator[pa.RecordBatch]) -> list[np.ndarray] | None:
    """The packed arrays of all rows, each joined to one."""
    trim()
    held = [unpack(d) for batch in batches for d in batch.column("data").to_pylist()]
    return [np.concatenate(x) for x in zip(*held)] if held else None
