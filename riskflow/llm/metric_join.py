"""Near-duplicate vectors by an exact metric range join.

Two vectors link when their cosine is at least ``COSINE``, that is when the
unit vectors are within r = sqrt(2 - 2 COSINE). Pivots (dense spots of a
bounded sample first, then spots far from those) partition the vectors: a
vector's home is its nearest pivot. A vector x of home p can only link with a
vector of home q if, by the triangle inequality, d(x, q) <= d(x, p) + 2r (and,
between the two homes' bisector, d(x, q)^2 - d(x, p)^2 <= 2 r d(p, q)); x is
sent to those q > p. Cells then join on their own.

Within r/2 of a pivot any two vectors link: such a core is counted, not
compared with itself, so that a spot which holds a large part of the table costs
no pairs. Other home vectors and visitors (the movers) are compared with the
cell's home vectors. Both sides are dealt over chunks of ``CHUNK``, and a task
joins one chunk of movers with one of home vectors. It adds each block of
movers to counts and to a spanning forest of the links found, and never holds
or returns the pairs of more than a block.

In many dimensions vectors without near neighbours are about equally far from
all pivots, and visitors then go to most cells: the join stays exact, and its
comparisons grow with the square of the distinct spots.

Vectors that are null, zero or hold null or non-finite components link with
nothing. Vectors of different lengths do not link: each length has pivots and
cells of its own. Rows that repeat a vec_id are vectors of their own.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskflow.llm._components import components
from riskflow.llm._tables import saved, table
from riskflow.llm._vectors import lists, matrix, sample, samples, usable

COSINE = 0.95
SAMPLE = 2048
CELL = 8192
MOST_PIVOTS = 256
CHUNK = 4096
SLACK = 1e-7


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(2 - 2 * (a @ b.T), 0))


def choose_pivots(units: np.ndarray, wanted: int, r: float) -> np.ndarray:
    """Dense spots of the sample, then spots far from those chosen."""
    if not len(units):
        return units
    d = _distances(units, units)
    dense = (d <= r / 4).sum(axis=1)
    free, chosen = np.ones(len(units), bool), []
    while len(chosen) < wanted // 2 and free.any():
        best = int(np.argmax(np.where(free, dense, -1)))
        if dense[best] < 3:
            break
        chosen.append(best)
        free &= d[best] > r
    if not chosen:
        chosen = [0]
    far = d[chosen].min(axis=0)
    while len(chosen) < min(wanted, len(units)) and far.max() > r:
        chosen.append(int(np.argmax(far)))
        far = np.minimum(far, d[chosen[-1]])
    return units[chosen]


def _units(m: np.ndarray) -> np.ndarray:
    u = m / np.abs(m).max(axis=1, keepdims=True)  # no overflow in the norm
    return u / np.linalg.norm(u, axis=1, keepdims=True)


def _pivots(rows: DataFrame, r: float) -> dict[int, tuple[int, np.ndarray]]:
    """By length of the vectors: the first pivot's cell, and the pivots."""
    counts = {x["size"]: x["n"] for x in rows.groupBy(F.size("v").alias("size")).agg(F.count("*").alias("n")).collect()}
    usual = min(counts, key=lambda size: (-counts[size], size))
    found = {usual: sample(rows.filter(F.size("v") == usual), SAMPLE, 3)}
    if len(counts) > 1:  # the other lengths share a sample
        found |= samples(rows.filter(F.size("v") != usual), sum(counts.values()) - counts[usual], SAMPLE, 3)
    out, first = {}, 0
    for size in sorted(counts):
        m = found.get(size, ())
        units = _units(m) if len(m) else np.eye(1, size)  # any unit vector may be a pivot
        out[size] = first, choose_pivots(units, min(MOST_PIVOTS, max(4, -(-counts[size] // CELL))), r)
        first += len(out[size][1])
    return out


def _assign(shared, r: float):
    def run(batches):
        for batch in batches:
            lengths = pc.list_value_length(batch.column("v"))
            for size in pc.unique(lengths).to_pylist():
                some = batch.filter(pc.equal(lengths, size))
                first, pivots = shared.value[size]
                between = _distances(pivots, pivots)
                u = _units(matrix(some.column("v")))
                d = _distances(u, pivots)
                home = np.argmin(d, axis=1)
                own = d[np.arange(len(u)), home]
                visit = (d <= own[:, None] + 2 * r + SLACK) & (d ** 2 - own[:, None] ** 2 <= 2 * r * between[home] + SLACK)
                visit &= np.arange(len(pivots))[None, :] > home[:, None]
                who, cell = np.nonzero(visit)
                rid = np.asarray(some.column("rid"))
                kind = np.where(own <= r / 2 - SLACK, 0, 1)  # core, other home vector, visitor
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate([rid, rid[who]])), pa.array((first + np.concatenate([home, cell])).astype(np.int32)),
                     pa.array(np.concatenate([kind, np.full(len(who), 2)]).astype(np.int32)), lists(np.concatenate([u, u[who]]))],
                    ["rid", "cell", "kind", "u"])
    return run


def _forest(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """Component label of each of n nodes under the links (a, b)."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[a], label[b])
        np.minimum.at(label, a, low)
        np.minimum.at(label, b, low)
        label = label[label]
        if (label[a] == label[b]).all():
            return label


def _is_link(x: np.ndarray, h: np.ndarray, i: np.ndarray, j: np.ndarray, cosine: float, most: int = 1 << 15) -> np.ndarray:
    """Whether the rows i of ``x`` and j of ``h`` link, pair by pair."""
    out = np.empty(len(i), bool)
    for s in range(0, len(i), most):
        out[s:s + most] = np.einsum("ij,ij->i", x[i[s:s + most]], h[j[s:s + most]]) >= cosine
    return out


def _join_cell(cosine: float, block: int = 512):
    def run(key, moving, home):
        hr, hk, h = np.asarray(home.column("rid")), np.asarray(home.column("kind")), matrix(home.column("u"))
        ar, ak, x = np.asarray(moving.column("rid")), np.asarray(moving.column("kind")), matrix(moving.column("u"))
        rid = np.concatenate([ar, hr])
        count, hit, label = np.zeros(len(rid), np.int64), np.zeros(len(rid), bool), np.arange(len(rid))
        for s in range(0, len(ar) if len(hr) else 0, block):
            dot = x[s:s + block] @ h.T
            i, j = np.nonzero(dot >= cosine - SLACK)
            link = dot[i, j] >= cosine + SLACK
            close = np.flatnonzero(~link)  # rounding may decide
            link[close] = _is_link(x, h, s + i[close], j[close], cosine)
            link &= ar[s + i] != hr[j]
            i, j = s + i[link], j[link]
            count += np.bincount(i, minlength=len(rid))
            both = (ak[i] == 2) | (hk[j] == 0)  # else the home vector moves to this one's chunk itself
            count += np.bincount(len(ar) + j[both], minlength=len(rid))
            j += len(ar)
            hit[i] = hit[j] = True
            label = _forest(label[i], label[j], len(rid))[label]
        return pa.table({"rid": pa.array(rid[hit], pa.int64()), "links": pa.array(count[hit]), "root": pa.array(rid[label[hit]], pa.int64())})
    return run


def near_vectors(vectors: DataFrame, cosine: float = COSINE, id_col: str = "vec_id", column: str = "embedding") -> DataFrame:
    """(vec_id, n_links, component_id, kept): one row per row of ``vectors``; other columns are ignored."""
    spark = vectors.sparkSession
    r = math.sqrt(2 - 2 * cosine)
    rows = usable(vectors, id_col, column, every_length=True)
    ids = vectors.select(F.col(id_col).cast("bigint").alias("vec_id"))
    alone = lambda t: t.select("vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component_id"),
                               F.col("vec_id").isNotNull().alias("kept"))
    if rows.isEmpty():
        return alone(ids)
    shared = spark.sparkContext.broadcast(_pivots(rows, r))

    dealt = saved(rows.mapInArrow(_assign(shared, r), "rid bigint, cell int, kind int, u array<double>"), "cells")
    amount = lambda kinds: F.sum(F.when(F.col("kind").isin(kinds), 1).otherwise(0))
    sizes = dealt.groupBy("cell").agg(amount([0]).alias("core"), F.ceil(amount([0, 1]) / CHUNK).cast("int").alias("chunks"),
                                      F.ceil(amount([1, 2]) / CHUNK).cast("int").alias("mover_chunks"))
    sizes = F.broadcast(saved(sizes, "sizes"))  # a row for each pivot
    joined = dealt.join(sizes, "cell").filter("chunks > 0 and mover_chunks > 0")
    dealt_to = lambda n: F.pmod(F.xxhash64("rid"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    columns = [F.col(c).alias(c) for c in ("rid", "cell", "kind", "u")]  # as new ones, so that the sides are told apart
    home = joined.filter("kind < 2").select(*columns, dealt_to("chunks").alias("chunk"), every("mover_chunks").alias("mover_chunk"))
    moving = joined.filter("kind > 0").select(*columns, dealt_to("mover_chunks").alias("mover_chunk"), every("chunks").alias("chunk"))
    keys = ["cell", "chunk", "mover_chunk"]
    found = moving.groupBy(*keys).cogroup(home.groupBy(*keys)).applyInArrow(_join_cell(cosine), "rid bigint, links bigint, root bigint")
    found = saved(found, "found")

    core = dealt.filter("kind = 0").join(sizes, "cell").select("rid", (F.col("core") - 1).alias("links"), (-1 - F.col("cell")).cast("bigint").alias("root"))
    core = core.filter("links > 0")
    everything = saved(found.unionByName(core), "found-all")
    links = everything.groupBy("rid").agg(F.sum("links").alias("links"))
    # a core is one node of its own, below all vectors
    comp = saved(components(everything.select(F.col("rid").alias("a"), F.col("root").alias("b"))), "components")
    known = rows.select("rid", "vec_id").join(links, "rid", "left").join(comp.withColumnRenamed("node", "rid"), "rid", "left")
    known = saved(known.select("vec_id", F.coalesce("links", F.lit(0)).cast("bigint").alias("n_links"), F.coalesce("root", "rid").alias("root")), "known")
    least = saved(known.groupBy("root").agg(F.min("vec_id").alias("component_id")), "least")
    known = known.join(least, "root").select("vec_id", "n_links", "component_id", (F.col("vec_id") == F.col("component_id")).alias("kept"))
    return known.unionByName(alone(_unusable(vectors, rows, id_col, column)))


def _unusable(vectors, rows, id_col, column):
    """The ids of rows that take no part, as often as they occur."""
    counted = vectors.select(F.col(id_col).cast("bigint").alias("vec_id")).groupBy("vec_id").agg(F.count("*").alias("there"))
    used = rows.groupBy("vec_id").agg(F.count("*").alias("used"))
    left = counted.alias("c").join(used.alias("u"), F.col("c.vec_id") == F.col("u.vec_id"), "left").select(
        "c.vec_id", (F.col("there") - F.coalesce("used", F.lit(0))).alias("times")).filter("times > 0")
    return left.select("vec_id", F.explode(F.sequence(F.lit(1), F.col("times").cast("int")))).select("vec_id")


def op9_metric_join(spark, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"))
