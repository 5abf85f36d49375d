"""Best-fit packing by linear grouping, planned on the histogram of lengths.

A document is cut only when it is longer than ``capacity``: whole sequences from its end, the remainder first. Whole
sequences stand alone. The other lengths number at most ``capacity - 1``, however many documents there are, so the
plan is made on their counts:

1. pieces longer than ``small`` are put, longest first, into GROUPS groups of equal cardinality (the last may be
   smaller; pieces of one length may lie in several groups) and rounded up to their group's longest;
2. configurations of few rounded sizes are optimised one after another: the longest size left, with the fullest
   filling of what it leaves that the remaining counts allow (a bounded knapsack, longer sizes first), used as often
   as the counts allow;
3. actual lengths are substituted, longest first in each size, which splits configurations into runs of sequences
   with equal contents;
4. the other lengths are best-fitted, longest first, into the runs with the least room that holds them, and open new
   sequences when none does.

The plan is made for ``small`` of a sixteenth, a quarter, half and all of the capacity (then everything is best-fitted),
and the one with the fewest sequences is used.

Documents take their places by their rank within their length: a count per task and length, summed over tasks.

Null text is empty: one end id. Very long texts are cut like others. Rows that repeat a doc_id are packed each. Other
columns, whatever their names, are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from framewell.llm import text as T
from framewell.llm.store import cut
from framewell.llm.tokens import byte_bpe, default_paths

GROUPS = 4096

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, part int, rank long"


def cut_lengths(n: int, capacity: int) -> list[int]:
    """Lengths of a document's pieces: the remainder, then whole sequences."""
    if n <= capacity:
        return [n]
    return ([n % capacity] if n % capacity else []) + [capacity] * (n // capacity)


def _pieces(capacity: int, paths: tuple[str, str], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces with their rank among this task's pieces of their length."""
    from pyspark import TaskContext

    part = TaskContext.get().partitionId()
    bpe = byte_bpe(*paths)
    seen = [0] * (capacity + 1)
    for batch in T.chunks(batches):
        rows = []
        for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
            ids = bpe.document(text.decode("utf-8", "replace"))
            at = 0
            for k, n in enumerate(cut_lengths(len(ids), capacity)):
                rows.append((doc, k, at, n, zlib.crc32(ids[at : at + n].astype("<u4").tobytes()), part, seen[n]))
                seen[n] += 1
                at += n
        kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64())
        names = [c.split()[0] for c in PIECES.split(", ")]
        yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows), kinds)] if rows else [pa.array([], k) for k in kinds], names=names)


def fullest(sizes: list[int], counts: list[int], room: int) -> list[tuple[int, int]]:
    """The fullest multiset of sizes (falling) within counts and room, of the longest sizes that fill it: (index, copies).

    Reachable totals are the bits of a number, kept before each size for the way back.
    """
    totals, mask, before = 1, (1 << room + 1) - 1, []
    for i, s in enumerate(sizes):
        rest = min(counts[i], room // s)
        if not rest:
            continue
        before.append((i, totals))
        step = 1
        while rest:
            step = min(step, rest)
            totals |= totals << s * step & mask
            rest -= step
            step *= 2
        if totals >> room:
            break
    left, out = totals.bit_length() - 1, []
    for i, old in reversed(before):
        copies = 0
        while not old >> left & 1:
            left -= sizes[i]
            copies += 1
        if copies:
            out.append((i, copies))
    return out[::-1]


def grouped(left: dict[int, int], small: int, capacity: int, groups: int) -> dict[int, list[list[int]]]:
    """Rounded sizes of the pieces longer than small, falling, each with the [length, pieces] that it stands for, falling."""
    total = sum(c for n, c in left.items() if small < n < capacity)
    share, out, free, size = max(1, -(-total // groups)), {}, 0, 0
    for n in sorted((n for n in left if small < n < capacity), reverse=True):
        c = left[n]
        while c:
            if not free:
                free, size = share, n
            take = min(c, free)
            of = out.setdefault(size, [])
            if of and of[-1][0] == n:
                of[-1][1] += take
            else:
                of.append([n, take])
            c, free = c - take, free - take
            if not free and c >= share:  # whole groups of one length at once
                whole = c // share * share
                of = out.setdefault(n, [])
                if of and of[-1][0] == n:
                    of[-1][1] += whole
                else:
                    of.append([n, whole])
                c -= whole
    return out


class Run:
    """Equal sequences: base .. base + count - 1, filled up to room."""

    __slots__ = ("base", "count", "room")

    def __init__(self, base: int, count: int, room: int):
        self.base, self.count, self.room = base, count, room


Places = list[tuple[int, int, int, int, int, int]]


def plan(histogram: dict[int, int], capacity: int, small: int | None = None, groups: int = GROUPS) -> tuple[Places, int]:
    """Places for all pieces: (length, first rank, pieces, first sequence, copies a sequence, offset), and the number of sequences.

    Piece number r of a length, r from first rank on, goes to sequence first + (r - rank) // copies at
    offset + ((r - rank) % copies) * length.
    """
    tries = (capacity // 16, capacity // 4, capacity // 2, capacity) if small is None else (small,)
    return min((_plan(histogram, capacity, s, groups) for s in tries), key=lambda p: p[1])


def _plan(histogram: dict[int, int], capacity: int, small: int, groups: int) -> tuple[Places, int]:
    left = {n: c for n, c in histogram.items() if c and n > 0}
    taken = dict.fromkeys(left, 0)
    places: Places = []
    made = 0

    def put(n: int, count: int, base: int, copies: int, offset: int) -> None:
        places.append((n, taken[n], count, base, copies, offset))
        taken[n] += count
        left[n] -= count

    if left.get(capacity):
        put(capacity, left[capacity], 0, 1, 0)
        made = taken[capacity]
    classes = grouped(left, small, capacity, groups)
    sizes = list(classes)
    counts = [sum(c for _, c in of) for of in classes.values()]
    runs: list[Run] = []
    while sizes:
        shape = dict(fullest(sizes, [counts[0] - 1, *counts[1:]], capacity - sizes[0]))
        shape[0] = shape.get(0, 0) + 1
        times = min(counts[i] // c for i, c in shape.items())
        done = 0
        while done < times:
            # As many of these sequences as have the same actual lengths in all places.
            content: list[tuple[list[int], int]] = []
            for i, need in shape.items():
                for of in classes[sizes[i]]:
                    k = min(need, of[1])
                    if k:
                        content.append((of, k))
                        need -= k
                    if not need:
                        break
            fit = min(times - done, *(of[1] // k for of, k in content))
            offset = 0
            for of, k in content:
                put(of[0], fit * k, made, k, offset)
                of[1] -= fit * k
                offset += of[0] * k
            runs.append(Run(made, fit, capacity - offset))
            made += fit
            done += fit
        for i, c in shape.items():
            counts[i] -= c * times
            classes[sizes[i]] = [of for of in classes[sizes[i]] if of[1]]
        keep = [i for i, c in enumerate(counts) if c]
        sizes, counts = [sizes[i] for i in keep], [counts[i] for i in keep]
    by_room: dict[int, list[Run]] = {}
    for r in runs:
        by_room.setdefault(r.room, []).append(r)
    for n in sorted((n for n in left if left[n]), reverse=True):
        while left[n]:
            room = min((r for r, x in by_room.items() if r >= n and x), default=None)
            if room is None:
                each = capacity // n
                whole, rest = divmod(left[n], each)
                for count, copies in ((whole, each), (1, rest)):
                    if count and copies:
                        put(n, count * copies, made, copies, 0)
                        by_room.setdefault(capacity - n * copies, []).append(Run(made, count, capacity - n * copies))
                        made += count
                continue
            run = by_room[room].pop()
            copies = min(room // n, left[n])
            count = min(run.count, left[n] // copies)
            put(n, count * copies, run.base, copies, capacity - room)
            by_room.setdefault(room - n * copies, []).append(Run(run.base, count, room - n * copies))
            if count < run.count:
                by_room[room].append(Run(run.base + count, run.count - count, room))
    return places, made


def _place(places: list[tuple[int, int, int, int, int, int]], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    by_length: dict[int, np.ndarray] = {}
    for p in places:
        by_length.setdefault(p[0], []).append(p[1:])
    by_length = {n: np.array(sorted(p)) for n, p in by_length.items()}
    for batch in batches:
        length, rank = (batch.column(c).to_numpy() for c in ("length", "rank"))
        where, offset = np.zeros(len(rank), np.int64), np.zeros(len(rank), np.int64)
        for _, at in T.by_bucket(length, int(length.max()) + 1 if len(length) else 0):
            n = int(length[at[0]])
            table = by_length[n]
            row = table[np.searchsorted(table[:, 0], rank[at], "right") - 1]
            step = rank[at] - row[:, 0]
            where[at] = row[:, 2] + step // row[:, 3]
            offset[at] = row[:, 4] + step % row[:, 3] * n
        yield pa.record_batch([*(batch.column(c) for c in ("doc_id", "piece", "start", "length", "ids_crc32")), pa.array(where), pa.array(offset)], names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])


def pack_documents(docs: DataFrame, capacity: int = 1024, paths: tuple[str, str] | None = None, small: int | None = None) -> DataFrame:
    """Per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset. docs needs doc_id and text."""
    paths = paths or default_paths()
    pieces = cut(T.binary_text(docs, F.col("doc_id").cast("long").alias("doc_id")).mapInArrow(partial(_pieces, capacity, paths), PIECES))
    tasks = pieces.groupBy("length", "part").agg(F.count("*").alias("c"))
    # At most `capacity` rows reach the driver.
    histogram = {r["length"]: r["c"] for r in tasks.groupBy("length").agg(F.sum("c").alias("c")).collect()}
    places, _ = plan(histogram, capacity, small)
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = tasks.select("length", "part", F.coalesce(F.sum("c").over(before), F.lit(0)).alias("base"))
    ranked = pieces.join(base, ["length", "part"]).withColumn("rank", F.col("rank") + F.col("base")).select("doc_id", "piece", "start", "length", "ids_crc32", "rank")
    return ranked.mapInArrow(partial(_place, places), "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
