"""Exact n-gram Jaccard join by token-combination prefixes.

A document is its set of distinct k-word shingles (64-bit hashes; words ``[^\\x20\\x09-\\x0D]+`` after A-Z is
lower-cased; fewer words than k make one shingle of all). Two documents link when the similarity of their sets is at
least ``percent`` / 100. Documents with equal sets are one node of the join.

1. Token classes. The number of sets that hold each token is counted over all of them, by token range: pieces of the
   corpus send their tokens, ranges add up and answer. Its bit length is the token's level; levels up to RARE are
   rare, those up to FREQUENT frequent, those beyond hot. Tokens are ordered by level, then hash: rare ones first.
2. Extended prefixes. Two linked sets of n and m tokens share at least o = ceil(percent (n + m) / (100 + percent)),
   and differ in at most D = n + m - 2 o. The first L tokens that they share lie within the first n - o + L of each.
   A shared token that is rare is met in the basic prefix (L = 1) and is indexed by itself. If the first is not rare,
   none is, and combinations are indexed: runs of c tokens that follow each other among the set's tokens beyond the
   rare ones, with c = 2 from a frequent token on and c = 3 from a hot one. A token that only one of the two sets
   holds breaks at most c - 1 of the L - c + 1 runs of shared tokens, so with L = (c - 1) (D + 1) + 1 one run stands in
   both. The number of a set's runs is below n. Small sets, for which L may exceed o, are indexed by shorter runs too.
   Tokens that one set only holds are not indexed.
3. Posting groups are never expanded into pairs. Each member is first held against the group's smallest one (its
   pivot). The links that verify give components. Members of one pivot that lie in several components are then
   compared in blocks: first each with its best partner of another component, at last all that may still join two
   components. Sizes, tokens that nobody shares and parity bitmaps bound the overlap from above and discard only pairs
   that cannot link; what is left is verified on whole sets. The largest component of a pivot meets the others but not
   itself. No link between different texts is lost that could join two components, and no cap is set.

Null, empty and white-space texts have empty sets and link with nothing. Rows that repeat a doc_id count as one
document each; a null doc_id takes part, and the smallest doc_id of its component is shown (null where no member has
one). Very long texts give as many tokens as they have shingles, and no more postings than that. Other columns are
ignored. An empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from framewell.llm import text as T
from framewell.llm.store import cut, partitions, release
from framewell.operators.graph import connected_components

#: Bit lengths of the number of sets that hold a token: rare up to 63 sets, frequent up to 4,095, hot beyond.
RARE, FREQUENT = 6, 12
#: Bits, beyond those of the number of tokens, of a token's hash by which it is counted. Tokens that share them share a
#: level, which keeps the order common to all.
SPARE = 10
#: Bytes of text in a piece of the corpus, and tokens of one range of counts.
PIECE, RANGE_TOKENS = 2 << 20, 1 << 20
#: Members of a pivot compared in one block, and bytes of bitmaps that a task gathers before it compares.
BLOCK, HELD = 2048, 16 << 20
#: Kept documents whose ids and hashes are broadcast, 16 bytes each; more are joined by a shuffle.
BROADCAST_ROWS = 1_000_000
#: Rounds of best partners before all that is left is tried.
ROUNDS = 2


def _describe(k: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Size and 128-bit identity of each text's set, and the text, compressed."""
    press = zstandard.ZstdCompressor(level=1)
    for batch in T.chunks(batches):
        texts = T.texts_of(batch)
        one, two, n = [], [], []
        for s in T.shingle_sets(texts, k):
            at = np.arange(1, len(s) + 1, dtype=T.U64)
            one.append(int(np.bitwise_xor.reduce(T.mix(s)).view(np.int64)) if len(s) else 0)
            two.append(int(np.sum(T.mix(s * at), dtype=T.U64).view(np.int64)) if len(s) else 0)
            n.append(len(s))
        z = [press.compress(t) if size else None for t, size in zip(texts, n)]
        yield pa.record_batch({"doc_id": batch.column("doc_id"), "t": batch.column("t"), "n": pa.array(n, pa.int64()), "h1": pa.array(one, pa.int64()), "h2": pa.array(two, pa.int64()), "z": pa.array(z, pa.binary())})


def _unpressed(blobs: list[bytes]) -> list[bytes]:
    press = zstandard.ZstdDecompressor()
    return [press.decompress(z, max_output_size=1 << 31) for z in blobs]


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Nodes and texts of some MB as one row."""
    from pyspark import TaskContext

    name, press = TaskContext.get().partitionId() << 32, zstandard.ZstdCompressor(level=3)
    for batch in T.chunks(batches, "z", PIECE // 3):
        nodes, texts = batch.column("node").to_numpy(), _unpressed(batch.column("z").to_pylist())
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        edge = np.concatenate([[0], np.flatnonzero(np.diff(np.cumsum(sizes) // PIECE)) + 1, [len(texts)]])
        for a, b in zip(edge[:-1].tolist(), edge[1:].tolist()):
            if b > a:
                data = press.compress(b"".join(texts[a:b]))
                yield pa.record_batch({"piece": pa.array([name], pa.int64()), "nodes": pa.array([T.pack(nodes[a:b], sizes[a:b])], pa.binary()), "data": pa.array([data], pa.binary())})
                name += 1


def _sets_of(nodes: bytes, data: bytes, k: int) -> tuple[np.ndarray, list[np.ndarray]]:
    ids, sizes = T.unpack(nodes)
    joined = _unpressed([data])[0]
    edge = np.concatenate([[0], np.cumsum(sizes)]).tolist()
    return ids, T.shingle_sets([joined[a:b] for a, b in zip(edge, edge[1:])], k)


def _counted(sets: list[np.ndarray], bits: int) -> np.ndarray:
    return np.concatenate(sets) >> T.U64(64 - bits)


def _press(*arrays: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(T.pack(*arrays))


def _unpress(blob: bytes) -> list[np.ndarray]:
    return T.unpack(_unpressed([blob])[0])


def _narrow(a: np.ndarray) -> np.ndarray:
    top = int(a.max()) if len(a) else 0
    return a.astype(np.uint8 if top < 1 << 8 else np.uint16 if top < 1 << 16 else np.uint32 if top < 1 << 32 else np.uint64)


def _ask(k: int, bits: int, ranges: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each piece's distinct tokens and the number of its sets that hold them, by range."""
    for batch in batches:
        for piece, nodes, data in zip(*(batch.column(c).to_pylist() for c in ("piece", "nodes", "data"))):
            tokens, count = np.unique(_counted(_sets_of(nodes, data, k)[1], bits), return_counts=True)
            edge = np.searchsorted((tokens >> T.U64(bits - 32)) * T.U64(ranges) >> T.U64(32), np.arange(ranges + 1))
            rows = [(r, _press(_narrow(np.diff(tokens[a:b], prepend=T.U64(0))), _narrow(count[a:b]))) for r, (a, b) in enumerate(zip(edge[:-1], edge[1:])) if b > a]
            for i in range(0, len(rows), 256):
                own = rows[i : i + 256]
                yield pa.record_batch({"range": pa.array([r for r, _ in own], pa.int32()), "piece": pa.array([piece] * len(own), pa.int64()), "data": pa.array([d for _, d in own], pa.binary())})


def _levels(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bit length of each asked token's total. A task holds its ranges: about RANGE_TOKENS tokens each."""
    held = [(r, p, *_unpress(d)) for batch in batches for r, p, d in zip(*(batch.column(c).to_pylist() for c in ("range", "piece", "data")))]
    if not held:
        return
    tokens = np.concatenate([np.cumsum(h[2], dtype=T.U64) for h in held])
    values, inverse = np.unique(tokens, return_inverse=True)
    total = np.bincount(inverse, np.concatenate([h[3] for h in held]).astype(np.float64), len(values))
    level, at = np.frexp(total)[1].astype(np.uint8)[inverse], 0
    for i in range(0, len(held), 256):
        own = held[i : i + 256]
        data = []
        for h in own:
            data.append(_press(level[at : at + len(h[2])]))
            at += len(h[2])
        yield pa.record_batch({"piece": pa.array([h[1] for h in own], pa.int64()), "range": pa.array([h[0] for h in own], pa.int32()), "data": pa.array(data, pa.binary())})


@lru_cache(100_000)
def reach(n: int, percent: int) -> tuple[tuple[int, ...], int, int, int]:
    """Longest runs that a set of n tokens is indexed by, and the lengths of its prefixes for runs of 1, 2 and 3."""
    m = np.arange(-(-percent * n // 100), 100 * n // percent + 1)
    o = -(-percent * (n + m) // (100 + percent))
    d = n + m - 2 * o
    ok = (o <= np.minimum(n, m)) & (o > 0) & (d > 0)
    if not ok.any():  # only an equal set is similar enough
        return (), 0, 0, 0
    o, d = o[ok], d[ok]
    runs = np.where(2 * (d + 1) + 1 <= o, 3, np.where(d + 2 <= o, 2, 1))
    return tuple(np.unique(runs).tolist()), *(min(n, int((n - o + c * (d + 1) + 1).max())) for c in (0, 1, 2))


def signatures(tokens: np.ndarray, level: np.ndarray, percent: int, classes: tuple[int, int] = (RARE, FREQUENT)) -> np.ndarray:
    """What a set is indexed by; see the module's text for why no link is lost."""
    rare, frequent = classes
    n = len(tokens)
    longest, one, two, three = reach(n, percent) if n else ((), 0, 0, 0)
    if not longest:
        return tokens[:0]
    order = np.lexsort((tokens, level))
    tokens, level = tokens[order], level[order]
    single = tokens[:one][(level[:one] <= rare) & (level[:one] > 1)]
    if level[one - 1] <= rare:
        return single
    out, first = [single], int(np.searchsorted(level, rare, "right"))
    for c in longest:
        if c == 1:
            out.append(tokens[first:one])
            continue
        end = three if c == 3 and level[two - 1] > frequent else two
        part = tokens[first:end]
        hot = int(np.searchsorted(level[first:end], frequent, "right")) if c == 3 else len(part)
        i = np.arange(max(min(hot, len(part) - 1), 0))
        out.append(T.fold([part[i], part[i + 1]]))
        i = np.arange(hot, max(len(part) - 2, hot))
        out.append(T.fold([part[i], part[i + 1], part[i + 2]]))
    return np.unique(np.concatenate(out))


def parity(tokens: np.ndarray) -> bytes:
    """A bit for each value of the low hash bits: whether an odd number of tokens has it. Four to eight bits a token."""
    width = max(64, 1 << (4 * len(tokens) - 1).bit_length())
    return np.packbits((np.bincount((tokens & T.U64(width - 1)).astype(np.int64), minlength=width) & 1).astype(np.uint8)).tobytes()


INDEX = "node long, n long, own long, bits binary, sigs array<long>"


def _index(k: int, percent: int, bits: int, classes: tuple[int, int], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted: a piece, then its levels by range. Gives each node's size, unshared tokens, bitmap and signatures."""
    now: list = []

    def finish() -> Iterator[pa.RecordBatch]:
        ids, sets = _sets_of(*now[0], k)
        _, inverse = np.unique(_counted(sets, bits), return_inverse=True)
        level = np.concatenate(now[1])[inverse]
        edge = np.concatenate([[0], np.cumsum([len(s) for s in sets])])
        own, sigs = [], []
        for s, a, b in zip(sets, edge[:-1].tolist(), edge[1:].tolist()):
            own.append(int((level[a:b] == 1).sum()))
            sigs.append(signatures(s, level[a:b], percent, classes).view(np.int64))
        sizes = np.concatenate([[0], np.cumsum([len(s) for s in sigs])]).astype(np.int32)
        lists = pa.ListArray.from_arrays(pa.array(sizes), pa.array(np.concatenate(sigs)))
        yield pa.record_batch({"node": pa.array(ids), "n": pa.array([len(s) for s in sets], pa.int64()), "own": pa.array(own, pa.int64()), "bits": pa.array([parity(s) for s in sets], pa.binary()), "sigs": lists})

    for batch in batches:
        for nodes, data in zip(batch.column("nodes").to_pylist(), batch.column("data").to_pylist()):
            if nodes is not None:
                if now:
                    yield from finish()
                now = [(nodes, data), []]
            else:
                now[1].append(_unpress(data)[0])
    if now:
        yield from finish()


def index_nodes(reps: DataFrame, k: int, percent: int, classes: tuple[int, int] = (RARE, FREQUENT)) -> DataFrame:
    """The index of reps(node, n, z): one row a node."""
    spark = reps.sparkSession
    tokens = reps.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    pieces = cut(reps.select("node", "z").mapInArrow(_pieces, "piece long, nodes binary, data binary"))
    ranges, bits = max(partitions(spark), math.ceil(tokens / RANGE_TOKENS)), min(64, max(32, tokens.bit_length() + SPARE))
    asked = pieces.mapInArrow(partial(_ask, k, bits, ranges), "range int, piece long, data binary")
    levels = asked.repartition(ranges, "range").mapInArrow(_levels, "piece long, range int, data binary")
    rows = pieces.select("piece", F.lit(-1).alias("range"), "nodes", "data").unionByName(levels, allowMissingColumns=True)
    rows = rows.repartition(ranges, "piece").sortWithinPartitions("piece", "range")
    index = cut(rows.mapInArrow(partial(_index, k, percent, bits, classes), INDEX))
    release(pieces)
    return index


def _may_link(n: np.ndarray, m: np.ndarray, most: np.ndarray, percent: int) -> np.ndarray:
    return 100 * most >= percent * (n + m - most)


class Bitmaps:
    """Parity bitmaps of several widths; a wider one folds to a narrower one."""

    def __init__(self, bits: list[bytes]):
        self.width = np.fromiter(map(len, bits), np.int64, len(bits))
        self.row = np.zeros(len(bits), np.int64)
        self.tables: dict[tuple[int, int], np.ndarray] = {}
        for w in np.unique(self.width).tolist():
            at = np.flatnonzero(self.width == w)
            self.row[at] = np.arange(len(at))
            self.tables[w, w] = np.frombuffer(b"".join(bits[i] for i in at), np.uint64).reshape(len(at), w // 8)

    def table(self, width: int, to: int) -> np.ndarray:
        if (width, to) not in self.tables:
            wide = self.table(width, 2 * to)
            half = wide.shape[1] // 2
            self.tables[width, to] = wide[:, :half] ^ wide[:, half:]
        return self.tables[width, to]


def differing(a: Bitmaps, left: np.ndarray, b: Bitmaps, right: np.ndarray) -> np.ndarray:
    """Places in which the bitmaps of each pair differ, at the narrower one's width."""
    out = np.zeros(len(left), np.int64)
    kind = a.width[left] << 32 | b.width[right]
    for v in np.unique(kind).tolist():
        wa, wb = v >> 32, v & ((1 << 32) - 1)
        width = min(wa, wb)
        x, y = a.table(wa, width), b.table(wb, width)
        at = np.flatnonzero(kind == v)
        for i in range(0, len(at), max(1, (8 << 20) // width)):
            p = at[i : i + max(1, (8 << 20) // width)]
            out[p] = np.bitwise_count(x[a.row[left[p]]] ^ y[b.row[right[p]]]).sum(1, dtype=np.int64)
    return out


def _bound(percent: int) -> F.Column:
    """Whether sets of n and m tokens, own and own_m of which nobody shares, can link."""
    return F.expr(f"100 * least(n - own, m - own_m) >= {percent} * (n + m - least(n - own, m - own_m))")


def _bitmap_filter(percent: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in T.chunks(batches, "bits", 4 << 20):
        n, m, own, own_m = (batch.column(c).to_numpy() for c in ("n", "m", "own", "own_m"))
        x, y = (Bitmaps(batch.column(c).to_pylist()) for c in ("bits", "bits_m"))
        at = np.arange(batch.num_rows)
        most = np.minimum(np.minimum(n - own, m - own_m), (n + m - differing(x, at, y, at)) // 2)
        yield batch.select(["a", "b"]).filter(pa.array(_may_link(n, m, most, percent)))


def _verify(percent: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keep = []
        for i in range(batch.num_rows):
            s, t = (np.frombuffer(batch.column(c)[i].as_buffer(), T.U64) for c in ("x", "y"))
            both = len(np.intersect1d(s, t, assume_unique=True))
            keep.append(100 * both >= percent * (len(s) + len(t) - both))
        yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))


def _sets(k: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in T.chunks(batches, "z", T.CHUNK // 3):
        sets = T.shingle_sets(_unpressed(batch.column("z").to_pylist()), k)
        yield pa.record_batch({"node": batch.column("node"), "x": pa.array([s.tobytes() for s in sets], pa.binary())})


def verify_pairs(reps: DataFrame, pairs: DataFrame, k: int, percent: int) -> DataFrame:
    """The pairs (a, b) of nodes whose whole sets link."""
    pairs = cut(pairs)
    ids = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
    sets = cut(reps.select("node", "z").join(ids, "node", "left_semi").mapInArrow(partial(_sets, k), "node long, x binary"))
    both = pairs.join(sets.toDF("a", "x"), "a").join(sets.toDF("b", "y"), "b")
    links = cut(both.select("a", "b", "x", "y").mapInArrow(partial(_verify, percent), "a long, b long"))
    release(pairs, sets)
    return links


def _runs(key: np.ndarray) -> np.ndarray:
    """Where runs of equal rows start, and the end."""
    return np.concatenate([[0], np.flatnonzero((key[1:] != key[:-1]).any(1)) + 1, [len(key)]])


def _across(rows: pa.Table, percent: int, best: bool) -> Iterator[pa.RecordBatch]:
    """Pairs of whole blocks that lie in different components and may link. Rows are sorted by pivot, i, j, part."""
    node, comp, n, own, part, i, j = (rows.column(c).to_numpy() for c in ("node", "comp", "n", "own", "part", "i", "j"))
    bits = Bitmaps(rows.column("bits").to_pylist())
    edge = _runs(np.stack([rows.column("pivot").to_numpy(), i, j], 1))
    size = np.diff(edge)
    at, end = np.arange(len(node)), np.repeat(edge[1:], size)
    # Within a part every row meets the later ones; across two parts those of the first meet the second's.
    first_of_j = np.repeat(np.add.reduceat((part == i) & (i != j), edge[:-1]) + edge[:-1], size)
    begin = np.where(i == j, at + 1, np.where(part == i, first_of_j, end))
    count = end - begin
    total = np.cumsum(count)
    lo = 0
    while lo < len(at):
        hi = max(lo + 1, int(np.searchsorted(total, (total[lo - 1] if lo else 0) + 1_000_000, "right")))
        c = count[lo:hi]
        left = np.repeat(at[lo:hi], c)
        right = np.arange(c.sum()) - np.repeat(np.cumsum(c) - c, c) + np.repeat(begin[lo:hi], c)
        most = np.minimum(n[left] - own[left], n[right] - own[right])
        ok = (comp[left] != comp[right]) & _may_link(n[left], n[right], most, percent)
        left, right, most = left[ok], right[ok], most[ok]
        most = np.minimum(most, (n[left] + n[right] - differing(bits, left, bits, right)) // 2)
        ok = _may_link(n[left], n[right], most, percent)
        left, right, most = left[ok], right[ok], most[ok]
        lo = hi
        if best and len(left):
            far = -most / (n[left] + n[right] - most)
            chosen = []
            for side, other in ((left, right), (right, left)):
                order = np.lexsort((other, far, side))
                chosen.append(order[np.concatenate([[True], np.diff(side[order]) != 0])])
            chosen = np.unique(np.concatenate(chosen))
            left, right = left[chosen], right[chosen]
        if len(left):
            pairs = np.unique(np.stack([np.minimum(node[left], node[right]), np.maximum(node[left], node[right])], 1), axis=0)
            yield pa.record_batch({"a": pa.array(np.ascontiguousarray(pairs[:, 0])), "b": pa.array(np.ascontiguousarray(pairs[:, 1]))})


def _open_pairs(percent: int, best: bool, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: list[pa.RecordBatch] = []
    have = 0
    for batch in T.chunks(batches, "bits", HELD):
        held.append(batch)
        have += batch.num_rows * 64 + sum(map(len, batch.column("bits").to_pylist()))
        if have >= HELD:  # whole blocks of BLOCK members or two; the last, perhaps not whole, is kept
            rows = pa.Table.from_batches(held).combine_chunks()
            last = int(_runs(np.stack([rows.column(c).to_numpy() for c in ("pivot", "i", "j")], 1))[-2])
            if last:
                yield from _across(rows.slice(0, last), percent, best)
                rows = rows.slice(last)
            held, have = rows.to_batches(), rows.num_rows * 64 + sum(map(len, rows.column("bits").to_pylist()))
    if held and sum(b.num_rows for b in held):
        yield from _across(pa.Table.from_batches(held).combine_chunks(), percent, best)


def open_pairs(members: DataFrame, found: DataFrame, side: DataFrame, percent: int, best: bool) -> DataFrame:
    """Pairs (a, b) of members of one pivot that lie in different components and may link; only each one's best in its block, if so."""
    inside = members.join(found.toDF("node", "c"), "node", "left").select("pivot", "node", F.coalesce("c", "node").alias("comp"))
    shares = inside.groupBy("pivot", "comp").agg(F.count("*").alias("c"))
    shares = shares.groupBy("pivot").agg(F.max_by("comp", F.struct("c", "comp")).alias("giant"), F.max("c").alias("most"), F.sum("c").alias("all")).where("all > most")
    parts = shares.select("pivot", "giant", F.expr(f"cast(ceil((all - most) / {BLOCK}) AS int)").alias("few"), F.expr(f"cast(ceil(most / {BLOCK}) AS int)").alias("many"))
    rows = inside.join(parts, "pivot").join(side, "node")
    deal = F.xxhash64("node")
    rows = rows.withColumn("part", F.when(F.col("comp") == F.col("giant"), F.col("few") + F.pmod(deal, F.col("many"))).otherwise(F.pmod(deal, F.col("few"))).cast("int"))
    # Parts of the largest component meet the others' parts, not each other.
    rows = rows.withColumn("other", F.explode(F.expr("sequence(0, if(part < few, few + many, few) - 1)")))
    rows = rows.select("pivot", F.least("part", "other").alias("i"), F.greatest("part", "other").alias("j"), "part", "node", "comp", "n", "own", "bits")
    return rows.repartition("pivot", "i", "j").sortWithinPartitions("pivot", "i", "j", "part").mapInArrow(partial(_open_pairs, percent, best), "a long, b long").distinct()


def resolve(docs: DataFrame, k: int, percent: int, classes: tuple[int, int] = (RARE, FREQUENT)) -> tuple[DataFrame, DataFrame]:
    """The documents' doc_id, text hash t, n and set identity (h1, h2); and of each distinct set its component and first document."""
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("t"), F.coalesce(F.col("text").cast("binary"), F.lit(b"")).alias("text"))
    described = source.mapInArrow(partial(_describe, k), "doc_id long, t long, n long, h1 long, h2 long, z binary")
    # One node for each distinct set; min and first combine before the shuffle.
    first = F.struct(F.col("doc_id").isNull().alias("missing"), "doc_id", "t")
    whole = cut(described)
    described = cut(whole.drop("z"))
    reps = whole.where("n > 0").groupBy("n", "h1", "h2").agg(F.min(first).alias("first"), F.first("z").alias("z"))
    reps = cut(reps.withColumn("node", F.monotonically_increasing_id()))
    release(whole)
    index = index_nodes(reps, k, percent, classes)
    side = index.select("node", "n", "own", "bits")
    posts = cut(index.select("node", F.explode("sigs").alias("sig")))
    heads = posts.groupBy("sig").agg(F.min("node").alias("pivot"), F.count("*").alias("c")).where("c > 1").select("sig", "pivot")
    members = cut(posts.join(heads, "sig").where("node <> pivot").select("pivot", "node").distinct())
    release(posts)
    pairs = members.toDF("a", "b").join(side.toDF("a", "n", "own", "bits"), "a").join(side.toDF("b", "m", "own_m", "bits_m"), "b").where(_bound(percent))
    links = verify_pairs(reps, pairs.select("a", "b", "n", "m", "own", "own_m", "bits", "bits_m").mapInArrow(partial(_bitmap_filter, percent), "a long, b long"), k, percent)
    found = cut(connected_components(links.toDF("u", "v"), cut))
    for best in [True] * ROUNDS + [False]:
        tried = cut(open_pairs(members, found, side, percent, best))
        if tried.isEmpty():
            break
        links = verify_pairs(reps, tried, k, percent)
        release(tried)
        if not links.isEmpty():
            found = cut(connected_components(found.toDF("u", "v").union(links), cut))
        release(links)
    sets = cut(reps.join(found.toDF("node", "c"), "node", "left").select("n", "h1", "h2", "first", F.coalesce("c", "node").alias("comp")))
    release(reps, index, members, found)
    return described, sets


def jaccard_components(docs: DataFrame, k: int = 5, percent: int = 80, classes: tuple[int, int] = (RARE, FREQUENT)) -> DataFrame:
    """Per document: doc_id, n_shingles, component_id (smallest doc_id reachable by links, its own included).

    docs needs doc_id and text; classes are the greatest levels of rare and of frequent tokens. See the module's text
    for the method and the edge cases.
    """
    described, sets = resolve(docs, k, percent, classes)
    named = sets.groupBy("comp").agg(F.min("first").alias("least")).select("comp", F.col("least.doc_id").alias("component_id"))
    of_set = sets.join(named, "comp").select("n", "h1", "h2", "component_id")
    linked = described.where("n > 0").join(of_set, ["n", "h1", "h2"]).select("doc_id", F.col("n").alias("n_shingles"), "component_id")
    return linked.union(described.where("n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id")))


def one_of_each(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """The rows of docs, but of each component only the first document: of smallest doc_id, null last.

    Texts without words link with nothing and stay. Of rows that repeat both doc_id and text of a kept one, one stays.
    Every row belongs to a component or has no words, so a null or repeated doc_id loses no text.
    """
    described, sets = resolve(docs, k, percent)
    kept = cut(sets.groupBy("comp").agg(F.min("first").alias("least")).select(F.col("least.doc_id").alias("_id"), F.col("least.t").alias("_t")))
    if kept.count() <= BROADCAST_ROWS:
        kept = F.broadcast(kept)
    rows = docs.select(F.struct("*").alias("doc"), F.col("doc_id").cast("long").alias("id"), F.xxhash64("text").alias("t"))
    some = F.coalesce(F.col("doc.text"), F.lit("")).rlike(r"[^\x20\x09-\x0D]")
    out = rows.where(some).join(kept, F.col("id").eqNullSafe(F.col("_id")) & (F.col("t") == F.col("_t")), "left_semi")
    if not described.where("n > 0").groupBy("doc_id", "t").agg(F.count("*").alias("c")).where("c > 1").isEmpty():
        order = Window.partitionBy("id", "t").orderBy(F.xxhash64("doc"))
        out = out.withColumn("r", F.row_number().over(order)).where("r = 1")
    return out.select("doc.*").union(rows.where(~some).select("doc.*"))
