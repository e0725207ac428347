"""Approximate nearest neighbours by learned partitions.

On a bounded sample the graph of ``GRAPH_K`` nearest neighbours is cut into
``PARTS`` balanced parts (recursive bisection by the graph's second eigenvector,
then swaps that cut fewer edges), and a small softmax classifier learns which
parts hold a vector's neighbours. Every vector is indexed under its most
probable part; a query goes to its most probable parts and is reranked there by
exact distance (Dong et al., 2020). The number of parts that a query visits is
calibrated on the sample: the least that finds ``TARGET`` of the sample's own
nearest neighbours.

Parts and the queries that visit them are dealt over chunks of ``CHUNK`` vectors, so
that a part that holds a large share of the table is searched by many tasks. Each
returns a query's nearest only: of each id its nearest row, so that repeated rows
take no places.

Nearness is Euclidean distance in doubles, without overflow for any finite vectors;
ties go to the smaller id. Vectors that are null, zero or hold null or non-finite
components take no part; vectors of different lengths have no distance, so each
length is searched on its own. A query is never its own neighbour, and rows that
repeat its id are not either; a query id in several rows stands for its least vector.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskflow.llm._tables import saved, table
from riskflow.llm._vectors import lists, matrix, sample, usable

SAMPLE = 4096
GRAPH_K = 10
PARTS = 16
TARGET = 0.94
CHUNK = 4096
NEAREST = 10
SAFE = 2.0 ** 500  # squares of components up to this, and down to its inverse, are doubles


def neighbour_graph(m: np.ndarray, k: int) -> np.ndarray:
    """Indices of each row's k nearest others."""
    sq = (m ** 2).sum(axis=1)
    out = np.empty((len(m), min(k, len(m) - 1)), np.int64)
    for s in range(0, len(m), 512):
        d = sq[s:s + 512, None] - 2 * m[s:s + 512] @ m.T + sq[None, :]
        d[np.arange(len(d)), s + np.arange(len(d))] = np.inf
        part = np.argpartition(d, out.shape[1] - 1, axis=1)[:, :out.shape[1]]
        out[s:s + 512] = np.take_along_axis(part, np.argsort(np.take_along_axis(d, part, 1), axis=1, kind="stable"), 1)
    return out


def bisect(nodes: np.ndarray, graph: np.ndarray, steps: int = 60) -> tuple[np.ndarray, np.ndarray]:
    """Two halves of ``nodes``, few edges between them."""
    inside = np.full(len(graph), -1)
    inside[nodes] = np.arange(len(nodes))
    a = np.repeat(np.arange(len(nodes)), graph.shape[1])
    b = inside[graph[nodes].reshape(-1)]
    a, b = a[b >= 0], b[b >= 0]
    a, b = np.concatenate([a, b]), np.concatenate([b, a])
    degree = np.bincount(a, minlength=len(nodes)) + 1e-9
    root = np.sqrt(degree)
    x = np.random.default_rng(len(nodes)).standard_normal(len(nodes))
    for _ in range(steps):  # power iteration on the lazy walk, without its first eigenvector
        x = x - root * (root @ x) / (root @ root)
        x = 0.5 * x + 0.5 * np.bincount(a, weights=(x / root)[b], minlength=len(nodes)) / root
        x = x / (np.linalg.norm(x) + 1e-30)
    side = np.zeros(len(nodes), bool)
    side[np.argsort(x / root, kind="stable")[len(nodes) // 2:]] = True
    for _ in range(8):  # swap the nodes that gain most by changing sides, as many from each
        cross = np.bincount(a, weights=(side[a] != side[b]).astype(float), minlength=len(nodes))
        gain = 2 * cross - degree
        zero, one = np.flatnonzero(~side & (gain > 0)), np.flatnonzero(side & (gain > 0))
        k = min(len(zero), len(one)) // 2
        if not k:
            break
        side[zero[np.argsort(-gain[zero], kind="stable")[:k]]] = True
        side[one[np.argsort(-gain[one], kind="stable")[:k]]] = False
    return nodes[~side], nodes[side]


def balanced_parts(graph: np.ndarray, parts: int) -> np.ndarray:
    """Part of each node; parts are a power of two and of equal size, give or take one."""
    groups = [np.arange(len(graph))]
    while len(groups) < parts:
        groups = [half for g in groups for half in bisect(g, graph)]
    out = np.empty(len(graph), np.int64)
    for i, g in enumerate(groups):
        out[g] = i
    return out


class Router:
    """Softmax over parts from the scaled vector and its signs' strength (one hidden layer)."""

    def __init__(self, parts: int, hidden: int = 64):
        self.parts, self.hidden = parts, hidden

    def fit(self, m: np.ndarray, want: np.ndarray, steps: int = 300):
        rng = np.random.default_rng(7)
        self.mean, self.scale = m.mean(axis=0), m.std(axis=0) + 1e-9
        x = (m - self.mean) / self.scale
        w = [rng.standard_normal((x.shape[1], self.hidden)) / np.sqrt(x.shape[1]), np.zeros(self.hidden),
             rng.standard_normal((self.hidden, self.parts)) / np.sqrt(self.hidden), np.zeros(self.parts)]
        mom, var = [0.0] * 4, [0.0] * 4
        for t in range(1, steps + 1):
            pick = rng.integers(0, len(x), min(1024, len(x)))
            xb, yb = x[pick], want[pick]
            h = np.maximum(xb @ w[0] + w[1], 0)
            p = self._softmax(h @ w[2] + w[3])
            dz = (p - yb) / len(xb)
            dh = (dz @ w[2].T) * (h > 0)
            for i, g in enumerate((xb.T @ dh, dh.sum(axis=0), h.T @ dz, dz.sum(axis=0))):
                g = g + 1e-4 * w[i]
                mom[i], var[i] = 0.9 * mom[i] + 0.1 * g, 0.999 * var[i] + 0.001 * g ** 2
                w[i] = w[i] - 0.01 * (mom[i] / (1 - 0.9 ** t)) / (np.sqrt(var[i] / (1 - 0.999 ** t)) + 1e-8)
        self.w = w
        return self

    @staticmethod
    def _softmax(z):
        z = np.exp(z - z.max(axis=1, keepdims=True))
        return z / z.sum(axis=1, keepdims=True)

    def order(self, m: np.ndarray) -> np.ndarray:
        """Parts of each vector, the most probable first."""
        h = np.maximum((m - self.mean) / self.scale @ self.w[0] + self.w[1], 0)
        return np.argsort(-(h @ self.w[2] + self.w[3]), axis=1, kind="stable")


def learn_router(m: np.ndarray, parts: int = PARTS, k: int = GRAPH_K, target: float = TARGET) -> tuple[Router, int]:
    """The router and the number of parts that a query visits."""
    parts = max(1, 1 << min(parts.bit_length() - 1, max(0, (len(m) // 32).bit_length())))
    if len(m) < 64:
        return Router(1).fit(m, np.ones((len(m), 1)), 1), 1
    graph = neighbour_graph(m, k)
    part = balanced_parts(graph, parts)
    want = np.zeros((len(m), parts))
    np.add.at(want, (np.arange(len(m)), part), 1 + graph.shape[1] / 2)
    for j in range(graph.shape[1]):
        np.add.at(want, (np.arange(len(m)), part[graph[:, j]]), 1)
    router = Router(parts)
    half = np.arange(len(m)) % 4 > 0  # a quarter calibrates the visits
    router.fit(m[half], want[half] / want[half].sum(axis=1, keepdims=True))
    order = router.order(m)
    rank = np.argsort(order, axis=1)
    test = np.flatnonzero(~half)
    seen = np.sort(rank[test[:, None], order[graph[test], 0]].reshape(-1))
    visits = int(seen[min(len(seen) - 1, int(np.ceil(target * len(seen))))]) + 1
    return router, visits


def _route(shared, visits: int):
    def run(batches):
        state = shared.value
        router = Router(state["parts"])
        router.__dict__.update(state)
        for batch in batches:
            m = matrix(batch.column("v"))
            if not len(m):
                continue
            order = router.order(m)[:, :visits]
            at = np.repeat(np.arange(len(m)), order.shape[1])
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id").take(pa.array(at)), pa.array(order.reshape(-1).astype(np.int32)), lists(m[at])], ["vec_id", "part", "v"])
    return run


def distances(rows: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Distance of each row from ``b``; for very large or small differences by way of scaled ones."""
    with np.errstate(over="ignore", under="ignore", invalid="ignore"):
        diff = rows - b
        out = np.sqrt((diff ** 2).sum(axis=1))
        most = np.abs(diff).max(axis=1, initial=0.0)
        odd = (most > SAFE) | ((most < 1 / SAFE) & (most > 0))
        if odd.any():
            half = rows[odd] / 2 - b / 2  # a difference of two doubles may not be one
            m = np.abs(half).max(axis=1)
            tiny = m < 1e-300
            half[tiny] *= 2.0 ** 200
            m[tiny] *= 2.0 ** 200
            out[odd] = 2 * m * np.sqrt(((half / m[:, None]) ** 2).sum(axis=1)) * np.where(tiny, 2.0 ** -200, 1.0)
    return out


def _search(k: int, block: int = 256):
    def run(key, queries, rows):
        qi, q = np.asarray(queries.column("vec_id")), matrix(queries.column("v"))
        ri, r = np.asarray(rows.column("vec_id")), matrix(rows.column("v"))
        out = [[], [], []]
        if len(q) and len(r):
            by_id = np.argsort(ri, kind="stable")
            ri, r = ri[by_id], r[by_id]
            first = np.flatnonzero(np.concatenate([[True], ri[1:] != ri[:-1]]))
            most = max(np.abs(q).max(), np.abs(r).max())
            plain = 1 / SAFE < most < SAFE
            if plain:
                sq = (r ** 2).sum(axis=1)
                # the squared form only picks candidates; this much it may be off
                off = 1e-11 * (sq.max() + (q ** 2).sum(axis=1).max() + 1e-300)
            for s in range(0, len(q), block):
                b = q[s:s + block]
                if plain:
                    d = (b ** 2).sum(axis=1)[:, None] - 2 * b @ r.T + sq[None, :]
                else:  # squares are no doubles: the distances themselves
                    d, off = np.array([np.minimum(distances(r, x), np.finfo(float).max) for x in b]), 0.0
                d[qi[s:s + block][:, None] == ri[None, :]] = np.inf
                each = np.minimum.reduceat(d, first, axis=1)  # of every id, its nearest row
                last = min(k, len(first)) - 1
                reach = np.partition(each, last, axis=1)[:, last] + 2 * off
                for i in range(len(b)):
                    near = np.flatnonzero((d[i] <= reach[i]) & np.isfinite(d[i]))
                    score = distances(r[near], b[i])
                    order = np.lexsort((score, ri[near]))
                    order = order[np.diff(ri[near[order]], prepend=ri[near[order[:1]]] - 1) != 0]  # the nearest row of each id
                    best = order[np.lexsort((ri[near[order]], score[order]))[:k]]
                    out[0].append(np.full(len(best), qi[s + i]))
                    out[1].append(ri[near[best]])
                    out[2].append(score[best])
        join = lambda x, t: np.concatenate(x).astype(t) if x else np.empty(0, t)
        return pa.table({"query_id": join(out[0], np.int64), "vec_id": join(out[1], np.int64), "score": join(out[2], np.float64)})
    return run


def nearest(vectors: DataFrame, is_query, k: int = NEAREST, parts: int = PARTS, target: float = TARGET,
            id_col: str = "vec_id", column: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score) of the k nearest found of each usable row that ``is_query`` (a condition on vec_id) names.

    An empty table gives no rows; a query has fewer than k where there are fewer others.
    """
    spark = vectors.sparkSession
    rows = usable(vectors, id_col, column, every_length=True)
    found = spark.createDataFrame([], "query_id bigint, vec_id bigint, score double")
    asked = rows.filter(is_query).groupBy(F.size("v").alias("size")).count()
    sizes = rows.groupBy(F.size("v").alias("size")).count().join(asked.select("size"), "size").orderBy("size").collect()
    for s in sizes:  # a row for each length of a query; mostly one
        some = rows if len(sizes) == 1 and s["count"] == rows.count() else rows.filter(F.size("v") == s["size"])
        found = found.unionByName(_nearest(some, s["count"], is_query, k, parts, target))
    found = found.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))  # repeated rows of one id
    place = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    return found.withColumn("rank", place).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _nearest(rows: DataFrame, n: int, is_query, k: int, parts: int, target: float) -> DataFrame:
    """(query_id, vec_id, score): candidates for the k nearest among ``n`` vectors of one length."""
    spark = rows.sparkSession
    m = sample(rows, SAMPLE, 11)
    if len(m) < 64:
        m = matrix(rows.limit(64).toArrow().column("v"))
    router, visits = learn_router(m, parts, target=target)
    shared = spark.sparkContext.broadcast(vars(router))  # arrays only: tasks need no module to read it
    schema = "vec_id bigint, part int, v array<double>"
    index = saved(rows.mapInArrow(_route(shared, 1), schema), "index")
    sizes = index.groupBy("part").count().collect()  # at most ``parts`` rows
    # where the parts visited may hold no more than k ids, each id counted in one of its parts, all parts are visited
    ids = index.groupBy("vec_id").agg(F.min("part").alias("part")).groupBy("part").count().collect()  # at most ``parts`` rows
    least = sorted([0] * (router.parts - len(ids)) + [s["count"] for s in ids])[:visits]
    if sum(least) <= k:
        visits = router.parts
    # a query id in several rows: its least vector, so that runs agree
    queries = rows.filter(is_query).groupBy("vec_id").agg(F.min("v").alias("v"))
    queries = saved(queries.mapInArrow(_route(shared, visits), schema), "visits")
    asked = {s["part"]: s["count"] for s in queries.groupBy("part").count().collect()}  # at most ``parts`` rows
    number = lambda of: F.create_map(*[F.lit(x) for p in of for x in (p, -(-of[p] // CHUNK))])[F.col("part")]
    both = {s["part"]: s["count"] for s in sizes if s["part"] in asked}
    held, visiting = number(both), number({p: asked[p] for p in both})
    dealt = lambda of: F.pmod(F.xxhash64("vec_id", "v"), of).cast("int")
    every = lambda of: F.explode(F.sequence(F.lit(0), (of - 1).cast("int")))
    index = index.filter(held.isNotNull()).select("*", dealt(held).alias("chunk")).select("*", every(visiting).alias("visit"))
    queries = queries.filter(held.isNotNull()).select("*", dealt(visiting).alias("visit")).select("*", every(held).alias("chunk"))
    keys = ["part", "chunk", "visit"]
    return queries.groupBy(*keys).cogroup(index.groupBy(*keys)).applyInArrow(_search(k), "query_id bigint, vec_id bigint, score double")


def op2_learned_partitions(spark, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)
