"""Maximum inner product search by a navigable small-world graph per shard.

Rows with equal vectors are one node, the class; only its ``k + 1`` smallest
ids can be among a query's ``k`` nearest, and a window with a limit before
the shuffle finds them.  Nodes are dealt by hash to shards, whose size grows
with the root of the table (from ``SHARD`` nodes up to what ``CELLS`` numbers
hold), so that the copies of queries grow slower than rows times rows.
Nearness is the inner product in the graph, too: made equally long by one more
coordinate, vectors of unequal length crowd where that one is large, and
recall falls below a half.  A node is in layer l with probability ``M ** -l``.

A graph is built by insertion: nodes come in random order, in batches no
larger than what is there already, are looked up in the graph built so far,
and are linked in each of their layers to near ones of what that search found
and of their batch, chosen so that none is nearer to another choice than to
the node, and back.  A node with too many links chooses among them anew by the
same rule.  Early nodes so keep links over long ways, between groups of near
copies too, as a group's later members are mostly reached by its first ones.
A shard is one row of flat arrays: vectors, and per layer the nodes and their
neighbours, in the shared folder.

Queries, in blocks of ``BLOCK``, go to every shard.  A search enters at the
top layer and descends; at the bottom it expands the nearest open node of a
beam of ``ef`` until none is open, all queries of a block at once.  The
shards' best classes are merged per query and replaced by their members;
scores are inner products of the original vectors in double precision.

Defined results: vectors that are null, empty, zero or hold null or
non-finite components, and rows without an id, take no part; vectors of
another length than a query's have no inner product with it; repeated rows
(equal id and vector) count once; of equal scores the smaller id comes first;
an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from bankmart.llm.common import ship, written

SHARD, CELLS = 8192, 1 << 23
BLOCK = 4096
M = 16
EF = 160
#: Beams of an insertion: at the bottom, and in upper layers.
BUILD_EF, UPPER_EF = 80, 24
#: Nodes inserted at once at most, and queries searched at once.
BATCH, TOGETHER = 1024, 256


def shard_size(n: int, dim: int) -> int:
    return max(1, min(max(SHARD, 32 * math.isqrt(n)), CELLS // max(1, dim)))


class Layer:
    """Nodes of a layer in the order of insertion, and the neighbours of each, -1 where fewer."""

    def __init__(self, nodes: np.ndarray, n: int, links: np.ndarray | None = None):
        self.nodes = nodes
        self.place = np.full(n + 1, -1, np.int32)
        self.place[nodes] = np.arange(len(nodes))
        self.links = np.full((len(nodes), 2 * M), -1, np.int32) if links is None else links

    def search(self, x: np.ndarray, q: np.ndarray, entry: np.ndarray, width: int) -> np.ndarray:
        """The best ``width`` nodes found for each query from ``entry`` on, best first, -1 where fewer."""
        n, rows = len(x), np.arange(len(q))
        beam = np.full((len(q), width), -1, np.int64)
        beam[:, :min(width, entry.shape[1])] = entry[:, :width]
        value = np.where(beam >= 0, np.einsum("qd,qbd->qb", q, x[beam]), -np.inf)
        open_ = beam >= 0
        seen = np.zeros((len(q), n + 1), bool)
        seen[rows[:, None], beam] = True  # -1 is the place beyond the last
        seen[:, n] = True
        while True:
            act = np.flatnonzero(open_.any(1))
            if not len(act):
                break
            best = np.where(open_[act], value[act], -np.inf).argmax(1)
            open_[act, best] = False
            near = self.links[self.place[beam[act, best]]]
            near = np.where(near >= 0, near, n)
            fresh = ~seen[act[:, None], near]
            seen[act[:, None], near] = True
            got = np.where(fresh, np.einsum("qd,qbd->qb", q[act], x[np.where(fresh, near, 0)]), -np.inf)
            all_value = np.concatenate([value[act], got], 1)
            keep = np.argpartition(-all_value, width - 1, axis=1)[:, :width]
            value[act] = np.take_along_axis(all_value, keep, 1)
            beam[act] = np.take_along_axis(np.concatenate([beam[act], np.where(fresh, near, -1)], 1), keep, 1)
            open_[act] = np.take_along_axis(np.concatenate([open_[act], fresh], 1), keep, 1) & np.isfinite(value[act])
        order = np.argsort(-value, axis=1, kind="stable")
        found = np.take_along_axis(beam, order, 1)
        return np.where(np.isfinite(np.take_along_axis(value, order, 1)), found, -1)


def choose(x: np.ndarray, node: np.ndarray, near: np.ndarray, most: int) -> np.ndarray:
    """Of the candidates ``near`` (-1 where fewer) of each node up to ``most``, nearest
    first, none nearer to another choice than to the node; others only up to half of that."""
    out = np.full((len(node), most), -1, np.int32)
    for lo in range(0, len(node), 128):
        mine, c = x[node[lo:lo + 128]], near[lo:lo + 128]
        dots = np.where(c >= 0, np.einsum("nd,ncd->nc", mine, x[c]), -np.inf)
        order = np.argsort(-dots, axis=1, kind="stable")
        c, dots = np.take_along_axis(c, order, 1), np.take_along_axis(dots, order, 1)
        between = x[c] @ x[c].transpose(0, 2, 1)
        there = c >= 0
        chosen = np.zeros(c.shape, bool)
        for j in range(c.shape[1]):
            nearer = ((between[:, j, :] > dots[:, j, None]) & chosen).any(1)
            chosen[:, j] = there[:, j] & ~nearer & (chosen.sum(1) < most)
        spare = there & ~chosen
        chosen |= spare & (np.cumsum(spare, 1) <= np.maximum(0, most // 2 - chosen.sum(1))[:, None])
        order = np.argsort(~chosen, axis=1, kind="stable")[:, :most]
        picked = np.where(np.take_along_axis(chosen, order, 1), np.take_along_axis(c, order, 1), -1)
        out[lo:lo + 128, :picked.shape[1]] = picked
    return out


def _link_back(x: np.ndarray, layer: Layer, new: np.ndarray) -> None:
    """Links to the new nodes from those that they chose."""
    to = layer.links[layer.place[new]]
    at = to >= 0
    a, b = to[at], np.broadcast_to(new[:, None], to.shape)[at]
    order = np.lexsort((-np.einsum("pd,pd->p", x[a], x[b]), a))
    a, b = a[order], b[order]
    first = np.searchsorted(a, a)
    rank = np.arange(len(a)) - first
    near = rank < 2 * M  # of more than a node can hold the nearest
    a, b, rank = a[near], b[near], rank[near]
    targets, which = np.unique(a, return_inverse=True)
    coming = np.full((len(targets), 2 * M), -1, np.int32)
    coming[which, rank] = b
    held = layer.links[layer.place[targets]]
    coming = np.where((coming[:, :, None] == held[:, None, :]).any(2), -1, coming)
    both = np.concatenate([held, coming], 1)
    both = np.take_along_axis(both, np.argsort(both < 0, axis=1, kind="stable"), 1)
    full = (both >= 0).sum(1) > 2 * M
    out = both[:, :2 * M].copy()
    if full.any():
        out[full] = choose(x, targets[full], both[full], 2 * M)
    layer.links[layer.place[targets]] = out


def build(vectors: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Layers, bottom first: nodes, and the neighbours of each."""
    n = len(vectors)
    rng = np.random.default_rng(7)
    order = rng.permutation(n)
    x = vectors.astype(np.float32)[order]
    level = np.floor(-np.log(1 - rng.random(n)) / np.log(M)).astype(int)
    level[0] = level.max()  # the entry
    layers = [Layer(np.flatnonzero(level >= k), n) for k in range(level.max() + 1)]
    t = 0
    while t < n:
        new = np.arange(t, min(n, t + min(BATCH, max(t, 32))))
        entry = np.zeros((len(new), 1), np.int64) if t else np.full((len(new), 1), -1)
        for k in range(len(layers) - 1, -1, -1):
            layer, width = layers[k], UPPER_EF if k else BUILD_EF
            if t:
                entry = np.concatenate([layer.search(x[:t], x[new[lo:lo + TOGETHER]], entry[lo:lo + TOGETHER], width)
                                        for lo in range(0, len(new), TOGETHER)])
            own = level[new] >= k
            mine = new[own]
            if not len(mine):
                continue
            peers = x[mine] @ x[mine].T
            np.fill_diagonal(peers, -np.inf)
            c = min(M, len(mine) - 1)
            beside = mine[np.argpartition(-peers, c - 1, axis=1)[:, :c]] if c > 0 else np.zeros((len(mine), 0), np.int64)
            layer.links[layer.place[mine], :M] = choose(x, mine, np.concatenate([entry[own], beside], 1), M)
            _link_back(x, layer, mine)
        t = int(new[-1]) + 1
    return [(order[layer.nodes].astype(np.int32), np.where(layer.links >= 0, order[layer.links], -1).astype(np.int32)) for layer in layers]


def search(vectors: np.ndarray, layers: list[Layer], queries: np.ndarray, ef: int) -> np.ndarray:
    """Places of the best ``ef`` nodes found for each query, best first, -1 where fewer."""
    x, q = vectors.astype(np.float32), queries.astype(np.float32)
    top = layers[-1].nodes
    m = min(len(top), 16)
    scores = q @ x[top].T
    entry = top[np.argpartition(-scores, m - 1, axis=1)[:, :m]].astype(np.int64)
    for layer in layers[::-1]:
        entry = layer.search(x, q, entry, UPPER_EF if layer is not layers[0] else ef)
    return entry


GRAPH = "shard int, dim int, ids binary, vectors binary, layers array<struct<nodes binary, links binary>>"
_GRAPH = pa.schema([("shard", pa.int32()), ("dim", pa.int32()), ("ids", pa.binary()), ("vectors", pa.binary()),
                    ("layers", pa.list_(pa.struct([("nodes", pa.binary()), ("links", pa.binary())])))])


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    flat = pa.concat_arrays(column.chunks).flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1)


def _build(key: tuple, got: pa.Table) -> pa.Table:
    got = got.sort_by("node")
    ids, vectors = got["node"].to_numpy().astype(np.int64), _matrix(got["v"])
    layers = [{"nodes": nodes.tobytes(), "links": links.tobytes()} for nodes, links in build(vectors)]
    return pa.Table.from_pylist([{"shard": key[0].as_py(), "dim": vectors.shape[1], "ids": ids.tobytes(),
                                  "vectors": vectors.tobytes(), "layers": layers}], schema=_GRAPH)


FOUND = "query_id long, node long, score double"


def _search(k: int, ef: int):
    empty = pa.table({"query_id": pa.array([], pa.int64()), "node": pa.array([], pa.int64()), "score": pa.array([], pa.float64())})

    def run(key: tuple, graph: pa.Table, queries: pa.Table) -> pa.Table:
        if not graph.num_rows or not queries.num_rows:
            return empty
        g = graph.to_pylist()[0]
        ids = np.frombuffer(g["ids"], np.int64)
        x = np.frombuffer(g["vectors"], np.float64).reshape(len(ids), g["dim"])
        layers = [Layer(a := np.frombuffer(y["nodes"], np.int32), len(ids), np.frombuffer(y["links"], np.int32).reshape(len(a), -1)) for y in g["layers"]]
        own, q = queries["query_id"].to_numpy(), _matrix(queries["v"])
        out = []
        for lo in range(0, len(q), TOGETHER):
            part = q[lo:lo + TOGETHER]
            found = search(x, layers, part, max(ef, k + 1))
            scores = np.where(found >= 0, np.einsum("qd,qbd->qb", part, x[found]), -np.inf)
            # best k + 1 classes, ties to the smaller id
            order = np.lexsort((np.where(found >= 0, ids[found], 0), -scores), axis=1)[:, :k + 1]
            node, score = ids[np.take_along_axis(found, order, 1)], np.take_along_axis(scores, order, 1)
            hit = np.isfinite(score)
            who = np.broadcast_to(own[lo:lo + TOGETHER, None], hit.shape)
            out.append(pa.table({"query_id": who[hit], "node": node[hit], "score": score[hit]}))
        return pa.concat_tables(out)

    return run


def nearest(vectors: DataFrame, queries, id_col: str = "vec_id", vector_col: str = "embedding", k: int = 20,
            shard: int | None = None, ef: int = EF) -> DataFrame:
    """query_id, rank, vec_id and score of the ``k`` nearest found for the rows
    of which ``queries(id column)`` holds; ``shard`` sets the size of shards."""
    spark = vectors.sparkSession
    ship(spark)
    # adding 0 makes -0.0 and 0.0 equal
    slim = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v")).select(
        "vec_id", F.transform("v", lambda c: c + F.lit(0.0)).alias("v"))
    bad = F.exists("v", lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    slim = slim.where("vec_id is not null and v is not null").where(~bad & F.exists("v", lambda c: c != 0))
    slim = slim.withColumns({"h": F.xxhash64("v"), "dim": F.size("v")})

    first = slim.withColumn("n", F.dense_rank().over(Window.partitionBy("h", "v").orderBy("vec_id"))).where(F.col("n") <= k + 1)
    first = first.withColumn("node", F.min("vec_id").over(Window.partitionBy("h", "v"))).dropDuplicates(["h", "v", "vec_id"])
    members = written(first.select("node", "dim", "h", "vec_id", "n", "v"), "hnsw-members")
    node_n = members.where("n = 1").groupBy("dim").agg(F.count(F.lit(1)).alias("c")).collect()  # a row for each vector length
    if not node_n:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    shards_of = {r.dim: -(-r.c // (shard or shard_size(r.c, r.dim))) for r in node_n}
    before, parts = 0, []
    for dim, s in sorted(shards_of.items()):
        parts.append((dim, before, s))
        before += s
    base = F.create_map(*[F.lit(x) for d, b, _ in parts for x in (d, b)])
    many = F.create_map(*[F.lit(x) for d, _, s in parts for x in (d, s)])
    dealt = members.where("n = 1").select(
        (base[F.col("dim")] + F.pmod(F.xxhash64("node", F.lit(3)), many[F.col("dim")])).cast("int").alias("shard"), "node", "v")
    graph = written(dealt.groupBy("shard").applyInArrow(_build, GRAPH), "hnsw-graph")

    asked = slim.where(queries(F.col("vec_id"))).dropDuplicates(["vec_id", "h"])
    blocks = max(1, -(-asked.count() // BLOCK))
    asked = asked.select(F.col("vec_id").alias("query_id"), "v", F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int").alias("block"),
                         F.explode(F.sequence(base[F.col("dim")], base[F.col("dim")] + many[F.col("dim")] - 1)).alias("shard")
                         ).withColumn("shard", F.col("shard").cast("int"))
    spread = graph.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    found = (spread.groupBy("shard", "block").cogroup(asked.groupBy("shard", "block")).applyInArrow(_search(k, ef), FOUND))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "node")
    found = found.withColumn("r", F.row_number().over(order)).where(F.col("r") <= k + 1)
    hits = found.join(members.select("node", "vec_id"), "node").where("vec_id <> query_id")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))
