"""Approximate nearest neighbours by largest inner product: a navigable small-world graph per shard.

1. Equal vectors are one node; a node keeps the ``k + 1`` smallest ids of its copies, more can never be among the nearest.
2. Nodes are dealt into shards of about ``SHARD_ROWS`` by hash. A shard's graph has geometric levels; a node's neighbours on a
   level are chosen from its nearest ones so that they lie in different directions, with links back. Vectors of unequal
   length get one more coordinate that makes them equally long, which turns inner products into distances. The index is a table,
   a row per node with its neighbours on all levels in one flat array.
3. Every query meets every shard, in groups of ``QUERY_ROWS``: a task reads a shard's arrays, then streams a group's queries
   through it with a beam of ``BEAM`` nodes, a block at a time. The beam begins at nodes far apart from each other and in every part
   of the graph that links do not lead to from there, so that no cluster is out of reach.
4. Shard results are merged by query; scores are computed anew from the original vectors in double precision.

Defined results: vectors that are null, zero, hold null or non-finite components or differ in length from most others take no
part, nor do rows with a null ``vec_id``; equal rows count once; fewer candidates than ``k`` give fewer ranks; ties go to the
smaller id; other columns are not carried. Searches run on scaled copies in single precision, scores on the original vectors in
double precision; components beyond about 1e150 overflow there.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rtmart.llm import shared as S

K = 20
SHARD_ROWS = 8192
QUERY_ROWS = 1 << 16
LINKS = 16  # a node chooses so many; with links back it has at most twice as many
BEAM = 320
SEEDS = 64
_BLOCK = 256
_INDEX = "shard int, place int, vec_id long, vector array<double>, level int, links array<int>"
_ROW = "shard int, part int, role int, place int, vec_id long, vector array<double>, level int, links array<int>"


# --- one shard --------------------------------------------------------------------------------------------------


def scaled(x: np.ndarray) -> np.ndarray:
    """The same directions and order of inner products, with the largest component 1, so that single precision holds them."""
    most = np.abs(x).max(initial=0.0)
    return x / most if most > 0 else x


def lengthened(x: np.ndarray) -> np.ndarray:
    """Vectors, scaled, with one more coordinate, all of equal length."""
    x = scaled(x)
    square = (x * x).sum(axis=1)
    return np.column_stack((x, np.sqrt(np.maximum(square.max(initial=0.0) - square, 0.0)))).astype(np.float32)


def levels_of(ids: np.ndarray, links: int = LINKS) -> np.ndarray:
    u = (S.mix(S.mix(ids.astype(np.int64).astype(np.uint64) + np.uint64(1))) >> np.uint64(11)).astype(np.float64) / (1 << 53)
    return np.minimum(8, (-np.log(np.maximum(u, 1e-15)) / np.log(links)).astype(np.int64))


def _spread_links(x: np.ndarray, links: int) -> np.ndarray:
    """Neighbours of each row among all rows (-1: none): near ones that are not nearer to one chosen before, then the nearest."""
    n = len(x)
    wanted = min(3 * links, n - 1)
    out = np.full((n, links), -1, np.int32)
    if wanted < 1:
        return out
    for low in range(0, n, _BLOCK):
        base = x[low : low + _BLOCK]
        near = base @ x.T
        rows = np.arange(len(base))
        near[rows, low + rows] = -np.inf
        pick = np.argpartition(-near, wanted - 1, axis=1)[:, :wanted]
        value = np.take_along_axis(near, pick, 1)
        order = np.argsort(-value, axis=1, kind="stable")
        pick, value = np.take_along_axis(pick, order, 1), np.take_along_axis(value, order, 1)
        among = np.einsum("bcd,bed->bce", x[pick], x[pick])
        chosen, count = np.zeros(pick.shape, bool), np.zeros(len(base), np.int64)
        for c in range(wanted):
            rival = np.where(chosen, among[:, c], -np.inf).max(axis=1)
            take = (value[:, c] > rival) & (count < links)
            chosen[:, c] = take
            count += take
        first = np.argsort(~chosen, axis=1, kind="stable")[:, :links]  # chosen ones, then the nearest others
        own = np.take_along_axis(pick, first, 1)
        out[low : low + len(base), : own.shape[1]] = own
    return out


def _with_links_back(own: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Each link in both directions, the nearest of twice the number."""
    n, links = own.shape
    a = np.repeat(np.arange(n), links)
    b = own.ravel().astype(np.int64)
    a, b = a[b >= 0], b[b >= 0]
    pairs = np.unique(np.concatenate((a * n + b, b * n + a)))
    a, b = pairs // n, pairs % n
    near = np.einsum("ij,ij->i", x[a], x[b])
    order = np.lexsort((b, -near, a))
    a, b = a[order], b[order]
    rank = np.arange(len(a)) - np.searchsorted(a, a)
    out = np.full((n, 2 * links), -1, np.int32)
    keep = rank < 2 * links
    out[a[keep], rank[keep]] = b[keep]
    return out


def build(vectors: np.ndarray, ids: np.ndarray, links: int = LINKS) -> tuple[np.ndarray, list[np.ndarray]]:
    """Levels of the nodes, and per level the neighbours (places, -1: none) of all nodes that reach it."""
    x, level = lengthened(vectors), levels_of(ids, links)
    tables = []
    for k in range(int(level.max(initial=0)) + 1):
        here = np.flatnonzero(level >= k)
        local = _with_links_back(_spread_links(x[here], links), x[here])
        tables.append(np.where(local >= 0, here[local], -1).astype(np.int32))
    return level, tables


def entries(x: np.ndarray, table: np.ndarray, seeds: int = SEEDS) -> np.ndarray:
    """Places where a search begins: nodes far apart from each other, each the farthest from those before, and one of every part of
    the graph that links do not lead to from there."""
    n = len(x)
    chosen, apart = [0] if n else [], np.full(n, np.inf)
    while chosen and len(chosen) < min(n, seeds):
        apart = np.minimum(apart, ((x - x[chosen[-1]]) ** 2).sum(axis=1))
        chosen.append(int(apart.argmax()))
    chosen = sorted(set(chosen))
    reached, front = np.zeros(n, bool), np.array(chosen, np.int64)
    while n:
        while len(front):
            reached[front] = True
            near = np.unique(table[front])
            near = near[near >= 0]
            front = near[~reached[near]]
        if reached.all():
            break
        chosen.append(int(reached.argmin()))
        front = np.array(chosen[-1:])
    return np.array(chosen, np.int64)


class Graph:
    def __init__(self, vectors: np.ndarray, ids: np.ndarray, level: np.ndarray, flat: list[np.ndarray], width: int):
        self.exact, self.ids = vectors, ids
        self.x = scaled(vectors).astype(np.float32)
        n = len(vectors)
        self.neighbours = [np.full((n, width), -1, np.int32) for _ in range(int(level.max(initial=0)) + 1)]
        for i, row in enumerate(flat):
            for k, part in enumerate(row.reshape(-1, width)):
                self.neighbours[k][i] = part
        self.top = np.flatnonzero(level == level.max(initial=0))[:_BLOCK]
        self.seeds = entries(lengthened(vectors), self.neighbours[0])

    def _near(self, q: np.ndarray, places: np.ndarray) -> np.ndarray:
        value = np.einsum("qd,qpd->qp", q, self.x[places])
        return np.where(places >= 0, value, -np.inf)

    def search(self, queries: np.ndarray, k: int, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """Places and inner products of about the k nearest of each query, nearest first (-1: none)."""
        parts = [self._block(queries[low : low + _BLOCK], k, beam) for low in range(0, len(queries), _BLOCK)]
        return tuple(np.concatenate(x) for x in zip(*parts))

    def _block(self, queries: np.ndarray, k: int, beam: int) -> tuple[np.ndarray, np.ndarray]:
        most = np.abs(queries).max(axis=1, keepdims=True, initial=0.0)
        q = (queries / np.where(most > 0, most, 1.0)).astype(np.float32)
        n, rows = len(self.x), np.arange(len(q))
        at = self.top[np.argmax(q @ self.x[self.top].T, axis=1)]
        value = self._near(q, at[:, None])[:, 0]
        for table in self.neighbours[:0:-1]:
            while True:
                around = table[at]
                near = self._near(q, around)
                best = near.argmax(axis=1)
                better = near[rows, best] > value
                if not better.any():
                    break
                at = np.where(better, around[rows, best], at)
                value = np.where(better, near[rows, best], value)
        seen = np.zeros((len(q), n + 1), bool)  # the last column stands for "none"
        seen[:, n] = True
        found = np.concatenate((np.tile(self.seeds, (len(q), 1)), at[:, None]), axis=1).astype(np.int64)
        twice = (found[:, :-1] == found[:, -1:]).any(axis=1)
        found[twice, -1] = -1
        near = self._near(q, found)
        seen[rows[:, None], found] = True
        open_ = found >= 0
        while True:
            waiting = np.where(open_, near, -np.inf)
            step = min(4, waiting.shape[1])
            pick = np.argpartition(-waiting, step - 1, axis=1)[:, :step]
            live = np.take_along_axis(waiting, pick, 1) > -np.inf
            active = live.any(axis=1)
            if not active.any():
                break
            nodes = np.where(live, np.take_along_axis(found, pick, 1), -1)
            np.put_along_axis(open_, pick, False, axis=1)
            new = np.where(nodes[:, :, None] >= 0, self.neighbours[0][nodes], -1).reshape(len(q), -1).astype(np.int64)
            new.sort(axis=1)
            new[:, 1:][new[:, 1:] == new[:, :-1]] = -1
            new[seen[rows[:, None], new]] = -1
            seen[rows[:, None], new] = True
            found = np.concatenate((found, new), axis=1)
            near = np.concatenate((near, self._near(q, new)), axis=1)
            open_ = np.concatenate((open_, new >= 0), axis=1)
            if found.shape[1] > beam:
                keep = np.argpartition(-near, beam - 1, axis=1)[:, :beam]
                found, near, open_ = (np.take_along_axis(v, keep, 1) for v in (found, near, open_))
        most = min(found.shape[1], 2 * k)
        keep = np.argpartition(-near, most - 1, axis=1)[:, :most]
        found = np.take_along_axis(found, keep, 1)
        exact = np.where(found >= 0, np.einsum("qd,qpd->qp", queries, self.exact[found]), -np.inf)
        order = np.lexsort((np.where(found >= 0, self.ids[found], 0), -exact), axis=1)[:, :k]
        return np.take_along_axis(found, order, 1), np.take_along_axis(exact, order, 1)


# --- tables -----------------------------------------------------------------------------------------------------


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 0))


def _build_shards(links: int):
    def made(shard: int, ids: list[np.ndarray], vectors: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        own, x = np.concatenate(ids), np.concatenate(vectors)
        level, tables = build(x, own, links)
        at = [np.cumsum(level >= k) - 1 for k in range(len(tables))]
        for low in range(0, len(own), 2048):
            part = range(low, min(len(own), low + 2048))
            flat = [np.concatenate([tables[k][at[k][i]] for k in range(level[i] + 1)]) for i in part]
            columns = [
                pa.array(np.full(len(part), shard, np.int32)), pa.array(np.array(part, np.int32)), pa.array(own[low : part.stop]),
                pa.array(list(x[low : part.stop]), pa.list_(pa.float64())), pa.array(level[low : part.stop].astype(np.int32)),
                pa.array(flat, pa.list_(pa.int32())),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["shard", "place", "vec_id", "vector", "level", "links"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, ids, vectors = None, [], []
        for batch in batches:
            shards = batch.column(0).to_numpy()
            own, x = batch.column(1).to_numpy(), _matrix(batch.column(2))
            for low, high in _runs(shards):
                if shards[low] != at and ids:
                    yield from made(at, ids, vectors)
                    ids, vectors = [], []
                at = int(shards[low])
                ids.append(own[low:high])
                vectors.append(x[low:high])
        if ids:
            yield from made(at, ids, vectors)

    return run


def _runs(values: np.ndarray) -> list[tuple[int, int]]:
    cuts = [0, *(np.flatnonzero(np.diff(values)) + 1).tolist(), len(values)]
    return [(a, b) for a, b in zip(cuts, cuts[1:]) if b > a]


def _search_shards(k: int, beam: int, links: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, graph, rows = None, None, []
        for batch in batches:
            shard, part, role = (batch.column(i).to_numpy() for i in range(3))
            key = (shard.astype(np.int64) << 33) | (part.astype(np.int64) << 1) | role
            for low, high in _runs(key):
                own = batch.slice(low, high - low)
                ids, x = own.column(4).to_numpy(), _matrix(own.column(5))
                if (shard[low], part[low]) != at:
                    at, graph, rows = (shard[low], part[low]), None, []
                if role[low] == 0:
                    flat = [r.values.to_numpy() for r in own.column(7)]
                    rows.append((ids, x, own.column(6).to_numpy(), flat))
                    continue
                if graph is None:
                    if not rows:
                        continue
                    parts = list(zip(*rows))
                    graph = Graph(np.concatenate(parts[1]), np.concatenate(parts[0]), np.concatenate(parts[2]), sum(parts[3], []), 2 * links)
                    rows = []
                places, score = graph.search(x, k, beam)
                query = np.repeat(ids, places.shape[1])
                ok = (places >= 0).ravel()
                yield pa.RecordBatch.from_arrays(
                    [pa.array(query[ok]), pa.array(graph.ids[places.ravel()[ok]]), pa.array(score.ravel()[ok])],
                    ["query_id", "node", "score"],
                )

    return run


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, vector) of the rows that take part."""
    x = F.col("vector")
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("vector"))
    finite = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    rows = rows.where(F.col("vec_id").isNotNull() & x.isNotNull() & (F.array_size(x) > 0) & finite & F.exists(x, lambda c: c != 0))
    usual = rows.groupBy(F.array_size(x).alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    return rows.where(F.array_size(x) == (usual["d"] if usual else 0))


def nodes(rows: DataFrame, copies: int) -> DataFrame:
    """(vec_id, vector, node): the smallest ids of each distinct vector, and the smallest one of all as its node.

    The rank limit works before the shuffle, so a vector with very many copies costs ``copies`` rows per task.
    """
    by = Window.partitionBy("vector").orderBy("vec_id")
    least = rows.distinct().withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= copies)
    return least.select("vec_id", "vector", F.min("vec_id").over(Window.partitionBy("vector")).alias("node"))


def index(distinct: DataFrame, shards: int, links: int = LINKS) -> DataFrame:
    """The graph of every shard: a row per node with its place in the shard, its level and its flat neighbour array."""
    dealt = distinct.select(F.pmod(F.xxhash64("vec_id"), F.lit(shards)).cast("int").alias("shard"), "vec_id", "vector")
    return dealt.repartition("shard").sortWithinPartitions("shard", "vec_id").mapInArrow(_build_shards(links), _INDEX)


def search(index_rows: DataFrame, queries: DataFrame, shards: int, groups: int, k: int, beam: int = BEAM, links: int = LINKS) -> DataFrame:
    """(query_id, node, score): about the k nearest nodes of each query in every shard."""
    part = F.pmod(F.xxhash64("vec_id"), F.lit(groups)).cast("int")
    empty = [F.lit(0).alias("level"), F.array().cast("array<int>").alias("links")]
    graph = index_rows.select(
        "shard", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("part"), F.lit(0).alias("role"), "place", "vec_id", "vector", "level", "links"
    )
    asked = queries.select(
        F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"), part.alias("part"), F.lit(1).alias("role"), F.lit(0).alias("place"), "vec_id", "vector", *empty
    )
    rows = graph.unionByName(asked).repartition("shard", "part").sortWithinPartitions("shard", "part", "role", "place")
    return rows.mapInArrow(_search_shards(k, beam, links), "query_id long, node long, score double")


def nearest(vectors: DataFrame, every: int = 20, k: int = K, shard_rows: int = SHARD_ROWS, beam: int = BEAM) -> DataFrame:
    """query_id, rank, vec_id and score for the rows whose id is divisible by ``every``, against all others."""
    rows = S.stored(nodes(usable(vectors), k + 1), "nodes")
    distinct = rows.where("vec_id = node").select("vec_id", "vector")
    queries = usable(vectors).where(F.col("vec_id") % every == 0).distinct()
    shards = max(1, -(-distinct.count() // shard_rows))
    groups = max(1, -(-queries.count() // QUERY_ROWS))
    graphs = S.stored(index(distinct, shards), "graphs")
    found = search(graphs, queries, shards, groups, k + 1, beam)
    # The nearest nodes of a query first, so that copies are joined to few rows.
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "node")
    found = found.withColumn("at", F.row_number().over(best)).where(F.col("at") <= k + 1)
    out = found.join(rows.select("node", "vec_id"), "node").where("vec_id <> query_id")
    ranked = out.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")))
    return ranked.where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
