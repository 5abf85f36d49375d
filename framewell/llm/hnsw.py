"""Approximate nearest neighbours: a hierarchical navigable small-world graph per shard, results merged.

Vectors are dealt out by hash in shards of about SHARD distinct vectors, or SHARD_BYTES of them. A shard's graph is kept as flat neighbour
arrays, one row of fixed width for each node and layer, beside its vectors, in one table row. Layers are built from
the top; nodes enter a layer in batches, each found by a beam search of many nodes at once in what stands already,
linked to diverse near nodes and linked back. A search takes packed blocks of queries through each shard the same way.
A shard's size depends neither on the table nor on the cluster, so recall at scale is that of one full shard, which is
measured. Every query visits every shard.

Equal vectors are one node that carries the smallest ``k + 1`` of their ids, which is all that k results (and the
query's own row left out) can need; so one vector held by a third of the rows is one node. Found vectors are scored
by cosine in double precision on the original components; ties go to the smaller id.

Vectors that are null, zero, or hold null or non-finite components take no part. Only vectors of equal dimension are
compared. Rows that repeat an id and a vector count once. Fewer candidates than k give all. Other columns, whatever
their names, are ignored. Without vectors or queries the result is empty.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from framewell.llm import text as T
from framewell.llm.store import cut, partitions

#: Distinct vectors of a shard, and their bytes in double precision, on average.
SHARD, SHARD_BYTES = 8192, 64 << 20
#: Links of a node on upper layers; the lowest has twice as many.
LINKS = 16
BEAM_BUILD, BEAM_SEARCH = 64, 96
BATCH = 512
#: Nodes of a beam that are expanded in one step.
STRIDE = 4


def dot(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Similarities of each row of a to its own rows of b."""
    return np.matmul(b, a[:, :, None])[:, :, 0]


def beam(unit: np.ndarray, links: np.ndarray, queries: np.ndarray, entry: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Beam search of all queries at once: (ids, similarities), best first, -1 where fewer were reached.

    links holds for each node its neighbours, -1 beyond; entry holds for each query where it starts.
    """
    q, n = len(queries), len(unit)
    seen = np.zeros((q, n + 1), bool)  # the last column takes what is no node
    seen[:, n] = True
    rows = np.arange(q)[:, None]
    ids = np.full((q, width), n)
    start = np.where(entry < 0, n, entry)[:, :width]
    ids[:, : start.shape[1]] = start
    known = np.concatenate([unit, np.zeros((1, unit.shape[1]), unit.dtype)])
    sims = np.where(ids < n, dot(queries, known[ids]), -np.inf)
    seen[rows, ids] = True
    done = ids == n
    live = np.arange(q)
    while len(live):
        i, s, d = ids[live], sims[live], done[live]
        pick = np.argsort(np.where(d, np.inf, -s), axis=1, kind="stable")[:, :STRIDE]
        at = np.arange(len(live))[:, None]
        chosen = np.where(d[at, pick], n, i[at, pick])
        d[at, pick] = True
        near = np.concatenate([links, np.full((1, links.shape[1]), -1, links.dtype)])[chosen].reshape(len(live), -1)
        near = np.where(near < 0, n, near)
        near.sort(axis=1)
        near[:, 1:][near[:, 1:] == near[:, :-1]] = n
        near[seen[live[:, None], near]] = n
        seen[live[:, None], near] = True
        score = np.where(near < n, dot(queries[live], known[near]), -np.inf)
        i, s, d = np.concatenate([i, near], 1), np.concatenate([s, score], 1), np.concatenate([d, near == n], 1)
        top = np.argsort(-s, axis=1, kind="stable")[:, :width]
        ids[live], sims[live], done[live] = i[at, top], s[at, top], d[at, top]
        live = live[~done[live].all(1)]
    return np.where(ids < n, ids, -1), sims


def diverse(unit: np.ndarray, ids: np.ndarray, sims: np.ndarray, count: int) -> np.ndarray:
    """Up to count links of each row's candidates (best first): those nearer to the node than to any link chosen before, then the nearest left."""
    rows, width = ids.shape
    vec = unit[np.maximum(ids, 0)]
    between = np.matmul(vec, vec.transpose(0, 2, 1))
    valid = ids >= 0
    nearest = np.full((rows, width), -np.inf, unit.dtype)
    chosen = np.zeros((rows, width), bool)
    got = np.zeros(rows, np.int64)
    for c in range(width):
        take = valid[:, c] & (sims[:, c] > nearest[:, c]) & (got < count)
        chosen[:, c] = take
        got += take
        nearest = np.where(take[:, None], np.maximum(nearest, between[:, c]), nearest)
    rank = np.where(chosen, np.arange(width), np.where(valid, width + np.arange(width), 3 * width))
    order = np.argsort(rank, axis=1, kind="stable")[:, :count]
    at = np.arange(rows)[:, None]
    out = np.full((rows, count), -1, np.int32)
    out[:, : order.shape[1]] = np.where(valid[at, order], ids[at, order], -1)
    return out


def _link_back(unit: np.ndarray, links: np.ndarray, new: np.ndarray) -> None:
    """Add the reverse of the new nodes' links, choosing anew where a node would have too many."""
    count = links.shape[1]
    to = links[new].reshape(-1)
    back = np.repeat(new, count)[to >= 0]
    to = to[to >= 0]
    order = np.argsort(to, kind="stable")
    to, back = to[order], back[order]
    node, first, size = np.unique(to, return_index=True, return_counts=True)
    for part in np.array_split(np.arange(len(node)), max(1, len(node) // 1024)):
        if not len(part):
            continue
        wide = int(size[part].max())
        extra = np.full((len(part), wide), -1, np.int64)
        col = np.arange(size[part].sum()) - np.repeat(np.cumsum(size[part]) - size[part], size[part])
        extra[np.repeat(np.arange(len(part)), size[part]), col] = back[np.repeat(first[part], size[part]) + col]
        all_ids = np.concatenate([links[node[part]], extra], 1)
        all_ids.sort(axis=1)
        all_ids[:, 1:][all_ids[:, 1:] == all_ids[:, :-1]] = -1
        sims = np.where(all_ids >= 0, dot(unit[node[part]], unit[np.maximum(all_ids, 0)]), -np.inf)
        best = np.argsort(-sims, axis=1, kind="stable")[:, : 2 * count]
        at = np.arange(len(part))[:, None]
        links[node[part]] = diverse(unit, all_ids[at, best], sims[at, best], count)


class Graph:
    """Layers of flat neighbour arrays over unit vectors; layer 0 holds all nodes."""

    def __init__(self, unit: np.ndarray, layers: list[tuple[np.ndarray, np.ndarray]]):
        self.unit, self.layers = unit, layers  # for each layer, top last: its nodes, and their links as numbers of nodes

    @classmethod
    def build(cls, unit: np.ndarray, keys: np.ndarray) -> Graph:
        n = len(unit)
        # Levels from the ids' hashes: the same graph for the same rows.
        u = (T.mix(keys.view(T.U64)) >> T.U64(11)).astype(np.float64) / (1 << 53)
        level = np.minimum((-np.log(np.maximum(u, 1e-18)) / math.log(LINKS)).astype(np.int64), 6)
        if n:
            level[int(level.argmax())] = level.max()
        graph = cls(unit, [])
        for layer in range(int(level.max(initial=0)), -1, -1):
            nodes = np.flatnonzero(level >= layer)
            nodes = nodes[np.argsort(-level[nodes], kind="stable")]
            links = np.full((n, LINKS * (1 if layer else 2)), -1, np.int32)
            done = 0
            while done < len(nodes):
                new = nodes[done : done + BATCH]
                near = unit[new] @ unit[new].T
                np.fill_diagonal(near, -np.inf)
                ids, sims = np.broadcast_to(new, near.shape), near
                if done:
                    found, score = beam(unit, links, unit[new], graph.entries(unit[new], nodes[:1]), BEAM_BUILD)
                    ids, sims = np.concatenate([found, ids], 1), np.concatenate([score, sims], 1)
                best = np.argsort(-sims, axis=1, kind="stable")[:, :BEAM_BUILD]
                at = np.arange(len(new))[:, None]
                ids, sims = ids[at, best], sims[at, best]
                links[new] = diverse(unit, np.where(np.isfinite(sims), ids, -1), sims, links.shape[1])
                _link_back(unit, links, new)
                done += len(new)
            graph.layers.insert(0, (nodes, links))
        return graph

    def entries(self, queries: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Where each query enters the layer below those that stand: the nearest nodes by descent."""
        entry = np.broadcast_to(first, (len(queries), len(first)))
        for _, links in reversed(self.layers):
            entry = beam(self.unit, links, queries, entry, 4)[0]
        return entry

    def search(self, queries: np.ndarray, width: int) -> np.ndarray:
        n = len(self.unit)
        if n <= width:
            return np.broadcast_to(np.arange(n), (len(queries), n))
        upper = Graph(self.unit, self.layers[1:])
        entry = upper.entries(queries, self.layers[-1][0][:1])
        return beam(self.unit, self.layers[0][1], queries, entry, width)[0]


def usable(vector: str) -> Column:
    return F.expr(f"{vector} IS NOT NULL AND size({vector}) > 0 AND forall({vector}, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('Infinity')) AND exists({vector}, x -> x <> 0)")


def normalised(v: np.ndarray) -> np.ndarray:
    """Unit vectors; scaled first, so that no square overflows or vanishes."""
    v = v / np.abs(v).max(1, keepdims=True)
    return (v / np.sqrt((v * v).sum(1, keepdims=True))).astype(np.float32)


def cosine(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row by row in double precision, the same for equal rows wherever they stand."""
    a, b = (x / np.abs(x).max(1, keepdims=True) if len(x) and not 1e-100 < np.abs(x).max() < 1e100 else x for x in (a, b))
    return (a * b).sum(1) / np.sqrt((a * a).sum(1) * (b * b).sum(1))


INDEX = "dim int, shard int, nodes int, ids binary, sizes binary, vectors binary, graph binary"


def _build(table: pa.Table) -> pa.Table:
    members = table.column("ids").to_pylist()
    vectors = table.column("v").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(table.num_rows, -1)
    first = np.array([m[0] for m in members], np.int64)
    order = np.argsort(first)
    vectors, members = vectors[order], [members[i] for i in order]
    graph = Graph.build(normalised(vectors), first[order])
    flat = [x for nodes, links in graph.layers for x in (nodes.astype(np.int32), links[nodes].reshape(-1))]
    row = (table.column("dim")[0].as_py(), table.column("shard")[0].as_py(), len(members), T.pack(np.array([x for m in members for x in m], np.int64)), T.pack(np.array([len(m) for m in members], np.int32)), vectors.tobytes(), T.pack(*flat))
    kinds = (pa.int32(), pa.int32(), pa.int32(), *[pa.binary()] * 4)
    return pa.table([pa.array([c], k) for c, k in zip(row, kinds)], names=[c.split()[0] for c in INDEX.split(", ")])


def build_index(vectors: DataFrame, k: int, shard: int | None = None) -> DataFrame:
    """The index table of vectors(id, v): one row for each shard. It serves searches for up to k results."""
    spark = vectors.sparkSession
    rows = vectors.where(usable("v")).select(F.col("id").cast("long").alias("id"), F.transform("v", lambda x: x.cast("double") + F.lit(0.0)).alias("v")).where("id IS NOT NULL")
    # Ids beyond the first k + 1 of a vector are dropped before the shuffle and after it: none of them can be a result.
    ranked = rows.withColumn("r", F.dense_rank().over(Window.partitionBy("v").orderBy("id"))).where(F.col("r") <= k + 1)
    distinct = cut(ranked.groupBy("v").agg(F.array_sort(F.collect_set("id")).alias("ids")))
    count, width = distinct.agg(F.count("*"), F.coalesce(F.max(F.size("v")), F.lit(1))).first()
    shards = max(1, math.ceil(count / (shard or max(1, min(SHARD, SHARD_BYTES // (8 * max(1, width)))))))
    dealt = distinct.select(F.size("v").alias("dim"), F.pmod(F.xxhash64(F.col("ids")[0]), F.lit(shards)).cast("int").alias("shard"), "ids", "v")
    return cut(dealt.groupBy("dim", "shard").applyInArrow(_build, INDEX))


def _load(row: dict) -> tuple[Graph, np.ndarray, list[np.ndarray]]:
    vectors = np.frombuffer(row["vectors"], np.float64).reshape(row["nodes"], row["dim"])
    flat, layers = T.unpack(row["graph"]), []
    for i in range(0, len(flat), 2):
        nodes = flat[i].astype(np.int64)
        links = np.full((row["nodes"], LINKS * (1 if i else 2)), -1, np.int32)
        links[nodes] = flat[i + 1].reshape(len(nodes), -1)
        layers.append((nodes, links))
    ids = np.split(T.unpack(row["ids"])[0], np.cumsum(T.unpack(row["sizes"])[0])[:-1])
    return Graph(normalised(vectors), layers), vectors, ids


def _pack_queries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of up to BATCH queries of one dimension: their ids and vectors as bytes."""
    for batch in batches:
        dim = pc.list_value_length(batch.column("v")).to_numpy(zero_copy_only=False)
        for d in np.unique(dim).tolist():
            own = batch.filter(pa.array(dim == d))
            for lo in range(0, own.num_rows, BATCH):
                part = own.slice(lo, BATCH)
                vectors = part.column("v").flatten().to_numpy(zero_copy_only=False).astype(np.float64)
                yield pa.record_batch({"dim": pa.array([d], pa.int32()), "ids": pa.array([T.pack(part.column("query_id").to_numpy())], pa.binary()), "vectors": pa.array([vectors.tobytes()], pa.binary())})


def _search(k: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted: a shard's index row, then its queries. Gives each query's k best found in the shard."""
    loaded = None
    for batch in batches:
        key = np.stack([batch.column(c).to_numpy() for c in ("dim", "shard", "kind")], 1)
        edge = np.concatenate([[0], np.flatnonzero((key[1:] != key[:-1]).any(1)) + 1, [len(key)]])
        for a, b in zip(edge[:-1].tolist(), edge[1:].tolist()):
            part = batch.slice(a, b - a)
            if not len(part):
                continue
            if key[a, 2] == 0:
                loaded = (tuple(key[a, :2]), _load(part.slice(len(part) - 1).to_pylist()[0]))
                continue
            if loaded is None or loaded[0] != tuple(key[a, :2]):
                continue  # no vector of this dimension in the shard
            graph, vectors, ids = loaded[1]
            for packed, raw in zip(part.column("ids").to_pylist(), part.column("vectors").to_pylist()):
                query_id = T.unpack(packed)[0]
                queries = np.frombuffer(raw, np.float64).reshape(len(query_id), -1)
                found = graph.search(normalised(queries), max(BEAM_SEARCH, 2 * k))
                at, col = np.nonzero(found >= 0)
                node = found[at, col]
                score = cosine(queries[at], vectors[node])
                size = np.array([len(x) for x in ids])[node]
                at, score, vec = np.repeat(at, size), np.repeat(score, size), np.concatenate([ids[x] for x in node])
                keep = vec != query_id[at]
                at, score, vec = at[keep], score[keep], vec[keep]
                order = np.lexsort((vec, -score, at))
                at, score, vec = at[order], score[order], vec[order]
                rank = np.arange(len(at)) - np.searchsorted(at, at)
                keep = rank < k
                yield pa.record_batch({"query_id": pa.array(query_id[at[keep]]), "vec_id": pa.array(vec[keep]), "score": pa.array(score[keep])})


def search(index: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """For each of queries(query_id, v): query_id, rank (from 1), vec_id, score. The query's own id is left out."""
    spark = index.sparkSession
    asked = queries.where(usable("v")).select(F.col("query_id").cast("long").alias("query_id"), F.transform("v", lambda x: x.cast("double") + F.lit(0.0)).alias("v"))
    shards = index.agg(F.max("shard")).first()[0]
    if shards is None:
        shards = 0
    asked = asked.where("query_id IS NOT NULL").mapInArrow(_pack_queries, "dim int, ids binary, vectors binary")
    asked = asked.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards)))).withColumn("kind", F.lit(1))
    rows = index.withColumn("kind", F.lit(0)).unionByName(asked, allowMissingColumns=True)
    rows = rows.repartition(max(partitions(spark), 1), "dim", "shard").sortWithinPartitions("dim", "shard", "kind")
    found = rows.mapInArrow(partial(_search, k), "query_id long, vec_id long, score double")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    found = found.distinct().withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return found.select("query_id", "rank", "vec_id", "score")
