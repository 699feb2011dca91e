"""Approximate nearest neighbours by largest inner product: one navigable small-world graph per shard.

Equal vectors are one point, which knows the smallest ids it stands for. Points are dealt into shards of bounded size. A shard becomes one row that holds its vectors and, for each layer,
a flat array of neighbour numbers. Blocks of queries meet the shards in pairs, and the results of all shards
are merged. Vectors get one more component that makes all lengths equal, so that the largest inner product with a query
is the smallest distance and graphs work as for distances.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from postmill.llm.common import kept

SHARD_ROWS = 8192
QUERY_ROWS = 1024
#: Links of a node on layers above 0 (twice as many on layer 0), candidates considered for them, beam of a search.
LINKS, CANDIDATES, BEAM = 16, 64, 128
_BATCH = 1024
_WAYS = 4  # nodes that a beam expands in one step


def lengthened(vectors: np.ndarray) -> np.ndarray:
    """Vectors over the longest length, with one more component that makes every length 1."""
    squares = (vectors.astype(np.float64) ** 2).sum(1)
    scale = math.sqrt(squares.max())
    return np.concatenate([vectors / scale, np.sqrt(np.maximum(0, 1 - squares / scale**2))[:, None]], axis=1).astype(np.float32)


def _levelled(n: int, rng: np.random.Generator) -> np.ndarray:
    """Layers per node, in the order of insertion: each layer holds about one in LINKS nodes of the one below."""
    return np.minimum((-np.log(1 - rng.random(n)) / math.log(LINKS)).astype(int), 8)


def _select(points: np.ndarray, own: np.ndarray, candidates: np.ndarray, near: np.ndarray, links: int) -> np.ndarray:
    """Up to ``links`` neighbours of each node: nearest first, passing over those nearer to a chosen one than to the node.

    Places that stay empty are filled with the nearest ones passed over; -1 where there are no more.
    """
    order = np.argsort(-near, axis=1, kind="stable")
    candidates, near = np.take_along_axis(candidates, order, 1), np.take_along_axis(near, order, 1)
    real = (candidates >= 0) & (candidates != own[:, None])
    vectors = points[candidates]
    among = vectors @ vectors.transpose(0, 2, 1)
    chosen = np.zeros(candidates.shape, bool)
    closest = np.full(candidates.shape, -np.inf, np.float32)  # to a chosen one
    for j in range(candidates.shape[1]):
        take = real[:, j] & (closest[:, j] < near[:, j]) & (chosen.sum(1) < links)
        chosen[:, j] = take
        closest = np.where(take[:, None], np.maximum(closest, among[:, j, :]), closest)
    rank = np.where(chosen, 0, np.where(real, 1, 2))
    pick = np.argsort(rank, axis=1, kind="stable")[:, :links]
    found = np.full((len(own), links), -1, np.int64)
    found[:, :pick.shape[1]] = np.where(np.take_along_axis(rank, pick, 1) < 2, np.take_along_axis(candidates, pick, 1), -1)
    return found


def _layer(points: np.ndarray, nodes: np.ndarray, links: int) -> np.ndarray:
    """Neighbours (rows of node numbers, -1 padded) of the nodes of one layer, which come in the order of insertion.

    Nodes enter in batches that double in size; candidates are the nearest of all nodes that are in by then.
    """
    n = len(nodes)
    table = np.full((n, links), -1, np.int64)  # places within ``nodes``
    own = points[nodes]
    low = 0
    while low < n:
        high = min(n, max(2 * low, 2 * links), low + _BATCH)
        near = own[low:high] @ own[:high].T
        near[np.arange(high - low), np.arange(low, high)] = -np.inf
        k = min(CANDIDATES, high)
        best = np.argpartition(-near, k - 1, axis=1)[:, :k]
        table[low:high] = _select(own, np.arange(low, high), best, np.take_along_axis(near, best, 1), links)
        # links back, each node again choosing from what it had and what it was offered
        source = np.repeat(np.arange(low, high), links)
        target = table[low:high].ravel()
        source, target = source[target >= 0], target[target >= 0]
        offered = (own[source] * own[target]).sum(1)
        order = np.lexsort((-offered, target))
        source, target = source[order], target[order]
        touched, first, count = np.unique(target, return_index=True, return_counts=True)
        place = np.arange(len(target)) - np.repeat(first, count)
        room = place < CANDIDATES
        offers = np.full((len(touched), CANDIDATES), -1, np.int64)
        offers[np.repeat(np.arange(len(touched)), count)[room], place[room]] = source[room]
        for a in range(0, len(touched), _BATCH):
            t = touched[a:a + _BATCH]
            both = np.concatenate([table[t], offers[a:a + _BATCH]], axis=1)
            both = np.where(_repeats(both), -1, both)
            near = np.einsum("nd,nkd->nk", own[t], own[both])
            table[t] = _select(own, t, both, np.where(both >= 0, near, -np.inf), links)
        low = high
    return np.where(table >= 0, nodes[table], -1)


def _repeats(rows: np.ndarray) -> np.ndarray:
    """True where a value stood further left in its row already."""
    order = np.argsort(rows, axis=1, kind="stable")
    ordered = np.take_along_axis(rows, order, 1)
    again = np.zeros(rows.shape, bool)
    np.put_along_axis(again, order[:, 1:], ordered[:, 1:] == ordered[:, :-1], 1)
    return again


def build(vectors: np.ndarray, seed: int = 11) -> tuple[np.ndarray, list[np.ndarray], list[np.ndarray]]:
    """Lengthened vectors, and per layer (0 first) its nodes and their neighbours."""
    points = lengthened(vectors)
    rng = np.random.default_rng(seed)
    order = rng.permutation(len(vectors))
    level = _levelled(len(vectors), rng)
    nodes = [order[level >= k] for k in range(level.max() + 1)]
    return points, nodes, [_layer(points, x, LINKS if k else 2 * LINKS) for k, x in enumerate(nodes)]


def search(points: np.ndarray, nodes: list[np.ndarray], neighbours: list[np.ndarray], queries: np.ndarray,
           beam: int = BEAM) -> np.ndarray:
    """Node numbers (-1 padded) of the beam of each query, after a descent through the layers."""
    queries = np.concatenate([queries, np.zeros((len(queries), 1))], axis=1).astype(np.float32)
    top = nodes[-1]
    near = queries @ points[top].T
    width = min(8, len(top))
    found = top[np.argpartition(-near, width - 1, axis=1)[:, :width]]
    for k in range(len(nodes) - 2, -1, -1):
        place = np.full(len(points), -1, np.int64)
        place[nodes[k]] = np.arange(len(nodes[k]))
        found = _beam(points, place, neighbours[k], queries, found, beam if k == 0 else 16)
    if len(nodes) == 1:
        place = np.full(len(points), -1, np.int64)
        place[nodes[0]] = np.arange(len(nodes[0]))
        found = _beam(points, place, neighbours[0], queries, found, beam)
    return found


def _beam(points, place, neighbours, queries, entry, width) -> np.ndarray:
    """Best-first search of all queries side by side: expand the nearest nodes of each beam until none is new."""
    n = len(queries)
    width = min(width, len(points))
    rows = np.arange(n)
    beam = np.full((n, width), -1, np.int64)
    near = np.full((n, width), -np.inf, np.float32)
    fresh = np.zeros((n, width), bool)
    seen = np.zeros((n, len(points)), bool)
    e = min(width, entry.shape[1])
    near_entry = np.where(entry >= 0, np.einsum("nd,nkd->nk", queries, points[entry]), -np.inf)
    best = np.argsort(-near_entry, axis=1)[:, :e]
    beam[:, :e] = np.take_along_axis(entry, best, 1)
    near[:, :e] = np.take_along_axis(near_entry, best, 1)
    fresh[:, :e] = beam[:, :e] >= 0
    seen[rows[:, None], np.where(beam[:, :e] >= 0, beam[:, :e], beam[:, :1])] = True
    active = rows
    while len(active):
        score = np.where(fresh[active], near[active], -np.inf)
        ways = min(_WAYS, width)
        pick = np.argpartition(-score, ways - 1, axis=1)[:, :ways]
        good = np.take_along_axis(score, pick, 1) > -np.inf
        expanded = np.take_along_axis(beam[active], pick, 1)
        fresh[active[:, None], pick] = False
        reached = np.where(good[:, :, None], neighbours[place[np.where(good, expanded, beam[active][:, :1])]], -1).reshape(len(active), -1)
        new = (reached >= 0) & ~seen[active[:, None], reached] & ~_repeats(reached)
        seen[np.repeat(active, new.sum(1)), reached[new]] = True
        distance = np.full(reached.shape, -np.inf, np.float32)
        at, column = np.nonzero(new)
        distance[at, column] = np.einsum("nd,nd->n", queries[active[at]], points[reached[at, column]])
        all_near = np.concatenate([near[active], distance], axis=1)
        keep = np.argpartition(-all_near, width - 1, axis=1)[:, :width]
        beam[active] = np.take_along_axis(np.concatenate([beam[active], np.where(new, reached, -1)], axis=1), keep, 1)
        near[active] = np.take_along_axis(all_near, keep, 1)
        fresh[active] = np.take_along_axis(np.concatenate([fresh[active], new], axis=1), keep, 1)
        beam[active] = np.where(near[active] > -np.inf, beam[active], -1)
        active = active[fresh[active].any(1)]
    return beam


def usable(vectors: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """Rows (vec_id, v) that take part: an id, no null or non-finite component, not all zero."""
    v = F.col(vector_column)
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    return vectors.select(F.col(id_column).alias("vec_id"), v.cast("array<double>").alias("v")).where(
        F.col("vec_id").isNotNull() & F.col("v").isNotNull() & F.forall("v", finite) & F.exists("v", lambda x: x != 0))


def _points(rows: DataFrame, ids: int) -> DataFrame:
    """Rows (h, v, ids): distinct vectors, and the ``ids`` smallest vec_ids of each; more of a hot one are cut before the shuffle."""
    smallest = Window.partitionBy("h", "v").orderBy("vec_id")
    first = rows.select(F.xxhash64("v").alias("h"), "v", "vec_id").distinct().withColumn("r", F.row_number().over(smallest)).where(F.col("r") <= ids)
    return first.groupBy("h", "v").agg(F.array_sort(F.collect_list("vec_id")).alias("ids"))


def _matrix(column: pa.ChunkedArray, rows: int) -> np.ndarray:
    return column.combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(rows, -1)


def nearest(vectors: DataFrame, is_query: Column, k: int = 20, shard_rows: int = SHARD_ROWS,
            query_rows: int = QUERY_ROWS, beam: int = BEAM) -> DataFrame:
    """Rows (query_id, rank, vec_id, score): the k best found candidates of each query, best first, ties to smaller ids.

    ``vectors`` has vec_id and embedding; ``is_query`` selects queries by vec_id. All other rows are candidates of a query, but rows
    with its own vec_id are not. score is the inner product of the original vectors in double precision; the graphs
    only propose. Vectors that are null, zero or not finite take no part, nor do null ids, nor vectors whose
    dimension is not the most frequent one (the largest of several). Rows that repeat a vec_id are one candidate;
    of their vectors the best one counts. Other columns are ignored.

    A point keeps k + 1 ids: without the query's own id, and without as many as better points hold, enough are left for the rest of k.
    """
    rows = usable(vectors).withColumn("v", F.transform("v", lambda x: x + F.lit(0.0)))  # no -0.0, which is equal to 0.0
    sizes = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    dimension = sizes.d if sizes else 0
    rows = rows.where(F.size("v") == dimension)
    points_of = kept(_points(rows, k + 1))
    queries = rows.where(is_query)
    shards = max(1, math.ceil(points_of.count() / shard_rows))
    blocks = max(1, math.ceil(queries.count() / query_rows))
    sharded = points_of.select(F.pmod("h", F.lit(shards).cast("bigint")).alias("shard"), "h", F.col("ids")[0].alias("first_id"), "ids", "v")
    kind = rows.schema["vec_id"].dataType.simpleString()

    def graph(key: tuple, table: pa.Table) -> pa.Table:
        table = table.sort_by([("first_id", "ascending"), ("h", "ascending")])
        original = _matrix(table.column("v"), len(table))
        _, nodes, neighbours = build(original)
        ids = table.column("ids").combine_chunks()
        copies = np.diff(ids.offsets.to_numpy())
        return pa.table({
            "shard": [key[0].as_py()], "ids": pa.array([ids.flatten().to_pylist()], pa.list_(ids.type.value_type)),
            "copies": pa.array([copies.astype("<i4").tobytes()], pa.binary()),
            "original": pa.array([original.astype("<f8").tobytes()], pa.binary()),
            "nodes": pa.array([[x.astype("<i4").tobytes() for x in nodes]], pa.list_(pa.binary())),
            "neighbours": pa.array([[x.astype("<i4").tobytes() for x in neighbours]], pa.list_(pa.binary())),
        })

    def find(key: tuple, asked: pa.Table, shard: pa.Table) -> pa.Table:
        row = shard.slice(0, 1)
        ids = row.column("ids").combine_chunks().flatten()
        copies = np.frombuffer(row.column("copies")[0].as_py(), "<i4").astype(np.int64)
        original = np.frombuffer(row.column("original")[0].as_py(), "<f8").reshape(len(copies), -1)
        nodes = [np.frombuffer(x, "<i4").astype(np.int64) for x in row.column("nodes")[0].as_py()]
        neighbours = [np.frombuffer(x, "<i4").astype(np.int64).reshape(len(n), -1)
                      for x, n in zip(row.column("neighbours")[0].as_py(), nodes)]
        points = lengthened(original)
        matrix = _matrix(asked.column("v"), len(asked))
        found = search(points, nodes, neighbours, matrix, beam)
        at, column = np.nonzero(found >= 0)
        node = found[at, column]
        score = (matrix[at] * original[node]).sum(1)  # in double precision
        many = copies[node]  # from here on, ``node`` is a place in the ids of all points
        place = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
        at, score, node = np.repeat(at, many), np.repeat(score, many), np.repeat((np.cumsum(copies) - copies)[node], many) + place
        asked_ids = asked.column("vec_id").to_numpy()
        other = asked_ids[at] != ids.to_numpy(zero_copy_only=False)[node]
        at, node, score = at[other], node[other], score[other]
        rank = np.unique(ids.to_numpy(zero_copy_only=False), return_inverse=True)[1][node]  # ascending with the ids
        order = np.lexsort((-score, rank, at))  # the best row of each id first
        at, node, score, rank = at[order], node[order], score[order], rank[order]
        first = np.append(True, (at[1:] != at[:-1]) | (rank[1:] != rank[:-1]))[:len(at)]
        at, node, score, rank = at[first], node[first], score[first], rank[first]
        order = np.lexsort((rank, -score, at))
        at, node, score = at[order], node[order], score[order]
        best = np.arange(len(at)) - np.searchsorted(at, at) < k  # no others of this shard can be among the k best
        return pa.table({
            "query_id": asked.column("vec_id").combine_chunks().take(pa.array(at[best])),
            "vec_id": ids.take(pa.array(node[best])), "score": pa.array(score[best]),
        })

    graphs = sharded.groupBy("shard").applyInArrow(
        graph, f"shard bigint, ids array<{kind}>, copies binary, original binary, nodes array<binary>, neighbours array<binary>")
    spread = graphs.select("*", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"))
    asked = queries.select(
        "vec_id", "v", F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int").alias("block"),
        F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(shards - 1).cast("bigint"))).alias("shard"))
    found = asked.groupBy("shard", "block").cogroup(spread.groupBy("shard", "block")).applyInArrow(
        lambda key, a, b: find(key, a, b) if len(a) and len(b) else _none(kind), f"query_id {kind}, vec_id {kind}, score double")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def _none(kind: str) -> pa.Table:
    ids = {"bigint": pa.int64(), "int": pa.int32()}.get(kind, pa.string())
    return pa.table({"query_id": pa.array([], ids), "vec_id": pa.array([], ids), "score": pa.array([], pa.float64())})
