"""Exact top-k search by exhaustive term-at-a-time accumulation.

A vector is a sparse row of terms: component number -> integer weight
``floor(SCALE * x)``. A task takes a block of candidate rows as postings (for each
term the rows that hold it and their weights) and a block of queries. Term after
term it scatters query weight x posting weight into a dense score array, then
selects the ``k`` best of each query by partitioning and merges them with the best
of its earlier blocks. Spark merges the tasks' lists. Every candidate is scored,
so the result is exact.

Candidates stay where they are read: no row of them is shuffled. Queries are
broadcast in passes of at most ``QUERY_BYTES`` of weights, however many there
are; each pass writes its result before the next starts.

Defined cases: vectors that are null or hold a null or non-finite component, and
rows with a null id, take no part. Zero and empty vectors do (score 0).
Vectors of different lengths meet on the terms that both have. Rows with the
query's id are its own and no candidates; of candidate rows that share an id the
best counts; a query id in several rows stands for its least vector. Weights and
scores beyond the range of a long are its ends. An empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskflow.llm._tables import passing_tables, saved, table

SCALE = 1024
NEAREST = 10
QUERY_BYTES = 16 << 20  # of one broadcast
QUERY_BLOCK = 64
ROW_BLOCK = 4096
LONG = np.iinfo(np.int64)


class Terms:
    """Sparse rows by term: for each term the rows with a weight other than zero, ascending, and those weights."""

    def __init__(self, offsets: np.ndarray, weights: np.ndarray):
        self.rows = len(offsets) - 1
        size = np.diff(offsets)
        row = np.repeat(np.arange(self.rows), size)
        term = np.arange(len(weights)) - np.repeat(offsets[:-1], size)
        some = weights != 0
        row, term, weights = row[some], term[some], weights[some]
        order = np.argsort(term, kind="stable")
        term, self.row, self.weight = term[order], row[order], weights[order]
        cut = np.flatnonzero(np.diff(term, prepend=-1))
        self.at = {int(term[a]): slice(a, b) for a, b in zip(cut, np.append(cut[1:], len(term)))} if len(term) else {}

    def largest(self, term: int) -> float:
        return float(np.abs(self.weight[self.at[term]].astype(np.float64)).max())


def scores(queries: Terms, rows: Terms) -> np.ndarray:
    """Dense (query, row) scores, one term after the other."""
    common = sorted(queries.at.keys() & rows.at.keys())
    exact = sum(queries.largest(t) * rows.largest(t) for t in common) < 2.0 ** 62
    kind = np.int64 if exact else object  # beyond longs: Python's integers
    out = np.zeros((queries.rows, rows.rows), kind)
    for t in common:
        q, r = queries.at[t], rows.at[t]
        add = np.multiply.outer(queries.weight[q].astype(kind), rows.weight[r].astype(kind))
        if add.shape == out.shape:
            out += add
        else:
            out[np.ix_(queries.row[q], rows.row[r])] += add
    return out if exact else np.clip(out, LONG.min, LONG.max).astype(np.int64)


def best(score: np.ndarray, k: int):
    """(row, column) of the k highest of each row; ties to the smaller column."""
    n = score.shape[1]
    if n <= k:
        return np.indices(score.shape).reshape(2, -1)
    least = np.partition(score, n - k, axis=1)[:, n - k, None]
    take = score >= least
    over = np.flatnonzero(take.sum(axis=1) > k)
    if len(over):
        s, t = score[over], least[over]
        above, equal = s > t, s == t
        take[over] = above | (equal & (np.cumsum(equal, axis=1) <= k - above.sum(axis=1, keepdims=True)))
    return np.nonzero(take)


def leading(q: np.ndarray, ids: np.ndarray, s: np.ndarray, k: int):
    """The k best (score, smaller id) of each query number; of a repeated id its best row."""
    order = np.lexsort((ids, ~s, q))  # ~s falls as s rises, without overflow
    q, ids, s = q[order], ids[order], s[order]
    by_id = np.lexsort((np.arange(len(q)), ids, q))
    again = np.zeros(len(q), bool)
    again[by_id[1:]] = (q[by_id[1:]] == q[by_id[:-1]]) & (ids[by_id[1:]] == ids[by_id[:-1]])
    q, ids, s = q[~again], ids[~again], s[~again]
    place = np.arange(len(q)) - np.searchsorted(q, q)
    return q[place < k], ids[place < k], s[place < k]


def _lists(column):
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    offsets = np.asarray(column.offsets, np.int64)
    return offsets - offsets[0], np.asarray(column.flatten(), np.int64)


def _blocks(offsets, weights, size):
    for a in range(0, len(offsets) - 1, size):
        o = offsets[a:a + size + 1]
        yield a, Terms(o - o[0], weights[o[0]:o[-1]])


def _search(shared, k: int):
    def run(batches):
        ids, offsets, weights = (shared.value[x] for x in ("ids", "offsets", "weights"))
        parts = [(a, terms, [np.empty(0, np.int64)] * 3) for a, terms in _blocks(offsets, weights, QUERY_BLOCK)]
        for batch in batches:
            rid = np.asarray(batch.column("vec_id"), np.int64)
            for first, rows in _blocks(*_lists(batch.column("w")), ROW_BLOCK):
                mine = rid[first:first + rows.rows]
                order = np.argsort(mine, kind="stable")
                heads = np.flatnonzero(np.diff(mine[order], prepend=mine[order[0]] - 1))  # one place for each id
                for i, (a, terms, so_far) in enumerate(parts):
                    s = scores(terms, rows)[:, order]
                    if len(heads) < rows.rows:
                        s = np.maximum.reduceat(s, heads, axis=1)
                    q, c = best(s, k + 1)  # one more: the query's own id goes
                    found = q, mine[order][heads][c], s[q, c]
                    other = found[1] != ids[a + q]
                    merged = leading(*(np.concatenate((x, y[other])) for x, y in zip(so_far, found)), k)
                    parts[i] = a, terms, merged
        for a, _, (q, rid, s) in parts:
            yield pa.RecordBatch.from_arrays([pa.array(ids[a + q]), pa.array(rid), pa.array(s)], ["query_id", "vec_id", "score"])
    return run


def sparse_rows(vectors: DataFrame, id_col: str = "vec_id", column: str = "embedding", scale: int = SCALE) -> DataFrame:
    """(vec_id, w): the rows that take part, as integer weights."""
    v = F.col(column).cast("array<double>")
    fine = v.isNotNull() & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = vectors.filter(F.col(id_col).isNotNull() & F.coalesce(fine, F.lit(False)))
    return rows.select(F.col(id_col).cast("bigint").alias("vec_id"), F.transform(v, lambda x: F.floor(x * scale)).alias("w"))


def top_k(vectors: DataFrame, is_query, k: int = NEAREST, id_col: str = "vec_id", column: str = "embedding",
          query_bytes: int = QUERY_BYTES) -> DataFrame:
    """(query_id, rank, vec_id, score): the k highest inner products of each row that ``is_query`` (a condition on vec_id) names."""
    spark = vectors.sparkSession
    rows = sparse_rows(vectors, id_col, column)
    with passing_tables(spark):
        queries = rows.filter(is_query).groupBy("vec_id").agg(F.min("w").alias("w"))
        queries = saved(queries, "queries")
        size = queries.agg(F.sum(F.size("w") + 2)).first()[0] or 0
        passes = -(-int(size) * 8 // query_bytes)
        out = spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score bigint")
        place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
        for i in range(passes):
            part = queries.filter(F.pmod(F.xxhash64("vec_id"), F.lit(passes)) == i).sort("vec_id").toArrow()
            if not len(part):
                continue
            offsets, weights = _lists(part.column("w"))
            shared = spark.sparkContext.broadcast({"ids": np.asarray(part.column("vec_id"), np.int64), "offsets": offsets, "weights": weights})
            found = rows.mapInArrow(_search(shared, k), "query_id bigint, vec_id bigint, score bigint")
            found = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))  # an id's rows in several tasks
            found = found.withColumn("rank", place).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
            out = out.unionByName(saved(found, "top", keep=True))
            shared.destroy()
    return out


def op13_topk_search(spark, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)
