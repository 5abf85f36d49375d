"""Golomb codes of sorted numbers: gaps are split by a power of two near their mean into a unary and a fixed part."""

from __future__ import annotations

import struct

import numpy as np


def _bits(a: np.ndarray) -> bytes:
    return np.packbits(a, bitorder="little").tobytes()


def encode(sorted_: np.ndarray, first: int, span: int) -> bytes:
    """Sorted distinct numbers out of first .. first + span - 1."""
    n = len(sorted_)
    if not n:
        return struct.pack("<IB", 0, 0)
    gap = np.diff(sorted_.astype(np.uint64), prepend=np.uint64(first))
    gap[1:] -= np.uint64(1)
    k = max(0, (max(1, span // n) * 7 // 10).bit_length() - 1)
    ends = np.cumsum((gap >> np.uint64(k)).astype(np.int64) + 1)
    unary = np.zeros(int(ends[-1]), np.uint8)
    unary[ends - 1] = 1
    # The lowest k bits of each gap, from its bytes.
    low = np.unpackbits(gap.view(np.uint8).reshape(n, 8)[:, : -(-k // 8) or 1], axis=1, bitorder="little")[:, :k]
    return struct.pack("<IB", n, k) + struct.pack("<I", len(unary)) + _bits(unary) + _bits(low.reshape(-1))


def decode(data: bytes, first: int) -> np.ndarray:
    n, k = struct.unpack_from("<IB", data)
    if not n:
        return np.zeros(0, np.uint64)
    size = struct.unpack_from("<I", data, 5)[0]
    at = 9 + -(-size // 8)
    ends = np.flatnonzero(np.unpackbits(np.frombuffer(data, np.uint8, -(-size // 8), 9), count=size, bitorder="little"))
    gap = (np.diff(ends, prepend=-1) - 1).astype(np.uint64) << np.uint64(k)
    if k:
        low = np.zeros((n, 64), np.uint8)
        low[:, :k] = np.unpackbits(np.frombuffer(data, np.uint8, -(-n * k // 8), at), count=n * k, bitorder="little").reshape(n, k)
        gap |= np.packbits(low, axis=1, bitorder="little").view(np.uint64).reshape(-1)
    gap[1:] += np.uint64(1)
    gap[0] += np.uint64(first)
    return np.cumsum(gap, dtype=np.uint64)
