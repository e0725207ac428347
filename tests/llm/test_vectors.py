import math
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from helpers import Union
from riskflow.llm import learned_partitions as lp
from riskflow.llm import metric_join as mj
from riskflow.llm.learned_partitions import balanced_parts, nearest, neighbour_graph
from riskflow.llm._vectors import lists
from riskflow.llm.metric_join import near_vectors


def table(spark, m, ids=None):
    ids = range(len(m)) if ids is None else ids
    return spark.createDataFrame([(int(i), [float(x) for x in v], 1) for i, v in zip(ids, m)], "vec_id bigint, embedding array<float>, u int")


def clustered(seed, n=400, dim=16, noise=0.05, spots=20):
    rng = np.random.default_rng(seed)
    c = rng.standard_normal((spots, dim))
    m = c[rng.integers(0, spots, n)] + noise * rng.standard_normal((n, dim)) * rng.integers(0, 8, (n, 1))
    return np.vstack([m, rng.standard_normal((n // 2, dim)), np.repeat(m[:1], n // 3, axis=0) * 2]).astype(np.float32)


def brute(m, ids, cosine=0.95):
    x = m.astype(np.float64)
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    s = u @ u.T >= cosine
    np.fill_diagonal(s, False)
    rows = Union(range(len(m)))
    for i, j in zip(*np.nonzero(s)):
        if i < j:
            rows.join(int(i), int(j))
    least = {}
    for i in range(len(m)):
        least[rows.find(i)] = min(least.get(rows.find(i), 1 << 60), ids[i])
    return sorted((ids[i], int(s[i].sum()), least[rows.find(i)], ids[i] == least[rows.find(i)]) for i in range(len(m)))


@pytest.mark.parametrize("seed,chunk,cell", [(1, 4096, 8192), (2, 50, 60), (3, 50, 20)])
def test_links_and_components_equal_brute_force(spark, monkeypatch, seed, chunk, cell):
    monkeypatch.setattr(mj, "CHUNK", chunk)
    monkeypatch.setattr(mj, "CELL", cell)
    m = clustered(seed)
    ids = np.random.default_rng(9).permutation(len(m)) * 3
    out = sorted(tuple(r) for r in near_vectors(table(spark, m, ids)).collect())
    assert out == brute(m, [int(i) for i in ids])


def test_every_length_is_joined(spark, monkeypatch):
    monkeypatch.setattr(mj, "CHUNK", 40)
    monkeypatch.setattr(mj, "SAMPLE", 60)  # some lengths without a sampled vector
    ms = [clustered(seed, n=n, dim=dim) for seed, n, dim in ((1, 200, 16), (2, 90, 15), (3, 30, 3))]
    ms += [np.array([[2.0], [-1.0], [5.0]], np.float32), np.array([[1, 0], [1, 0.01]], np.float32), np.ones((1, 5), np.float32)]
    first, want, rows = 0, [], None
    for m in ms:
        ids = list(range(first, first + len(m)))
        want += brute(m, ids)
        rows = table(spark, m, ids) if rows is None else rows.unionByName(table(spark, m, ids))
        first += len(m)
    assert sorted(tuple(r) for r in near_vectors(rows).collect()) == sorted(want)


def test_both_sides_of_a_cell_are_dealt_over_chunks(spark, monkeypatch):
    join_cell, chunk = mj._join_cell, 50

    def watched(cosine):
        run = join_cell(cosine)

        def checked(key, moving, home):
            assert max(len(moving), len(home)) <= 2 * chunk, (len(moving), len(home))
            return run(key, moving, home)
        return checked

    monkeypatch.setattr(mj, "CHUNK", chunk)
    monkeypatch.setattr(mj, "_join_cell", watched)
    rng = np.random.default_rng(6)  # links within the cluster, most of it further than r/2 from every pivot
    m = np.vstack([rng.standard_normal(24) + 0.17 * rng.standard_normal((400, 24)), rng.standard_normal((200, 24))]).astype(np.float32)
    out = sorted(tuple(r) for r in near_vectors(table(spark, m)).collect())
    assert out == brute(m, list(range(len(m))))


def test_a_task_of_the_join_holds_no_more_than_a_block_of_pairs():
    rng = np.random.default_rng(7)
    u = 1 + 0.05 * rng.standard_normal((4000, 8))
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    side = lambda first, kind: pa.table({"rid": np.arange(first, first + len(u)), "kind": np.full(len(u), kind, np.int32), "u": lists(u)})
    tracemalloc.start()
    out = mj._join_cell(0.95)(None, side(10000, 2), side(0, 1))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert out.num_rows == 8000 and set(out.column("links").to_pylist()) == {4000} and len(set(out.column("root").to_pylist())) == 1
    assert peak < 250 << 20


def test_vectors_that_take_no_part(spark):
    rows = [(1, [1.0, 0.0]), (2, [2.0, 0.0]), (2, [1.0, 0.01]), (3, None), (4, [0.0, 0.0]), (5, [float("nan"), 1.0]), (6, [1.0, None]),
            (7, [float("inf"), 1.0]), (8, [1.0, 0.0, 0.0]), (9, []), (None, [1.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    out = sorted((tuple(r) for r in near_vectors(df).collect()), key=str)
    want = [(1, 2, 1, True), (2, 2, 1, False), (2, 2, 1, False)] + [(i, 0, i, True) for i in range(3, 10)] + [(None, 0, None, False)]
    assert out == sorted(want, key=str)
    assert near_vectors(df.limit(0)).count() == 0
    found = nearest(df, F.col("vec_id") > 0).collect()
    assert sorted((r["query_id"], r["rank"], r["vec_id"]) for r in found) == [(1, 1, 2), (2, 1, 1)]
    assert nearest(df.limit(0), F.lit(True)).count() == 0


def test_nearest_is_sorted_scored_and_found(spark, monkeypatch):
    monkeypatch.setattr(lp, "CHUNK", 300)
    m = clustered(5, n=1500, dim=12, noise=0.2, spots=12)
    df = table(spark, m)
    out = nearest(df, F.col("vec_id") % 20 == 0).collect()
    by = {}
    for r in out:
        by.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    assert set(by) == set(range(0, len(m), 20))
    x, hit, total = m.astype(np.float64), 0, 0
    for q, found in by.items():
        d = np.sqrt(((x - x[q]) ** 2).sum(axis=1))
        found.sort()
        assert [f[0] for f in found] == list(range(1, 11))
        assert all(math.isclose(s, d[v], rel_tol=1e-12, abs_tol=1e-12) for _, v, s in found)
        assert [(s, v) for _, v, s in found] == sorted((s, v) for _, v, s in found)
        d[q] = np.inf
        best = np.lexsort((np.arange(len(m)), d))[:10]
        hit, total = hit + len({v for _, v, _ in found} & set(best.tolist())), total + 10
    assert hit / total >= 0.9


@pytest.mark.parametrize("times", [2, 13])
def test_repeated_rows_take_no_places(spark, monkeypatch, times):
    rng = np.random.default_rng(8)
    m = rng.standard_normal((60, 6)).astype(np.float32)
    monkeypatch.setattr(lp, "CHUNK", 1000 * times)
    rows = table(spark, np.vstack([m] * times), list(range(len(m))) * times)
    odd = table(spark, np.vstack([m[:20] + 0.01, m[:20] + 5]), list(range(20)) * 2)  # ids with several vectors
    found = {}
    for r in nearest(rows.unionByName(odd), F.col("vec_id") >= 50).collect():
        found.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    x = m.astype(np.float64)
    near = (m[:20] + np.float32(0.01)).astype(np.float64)
    far = (m[:20] + np.float32(5)).astype(np.float64)
    assert set(found) == set(range(50, 60))
    for q, got in found.items():
        d = np.sqrt(((x - x[q]) ** 2).sum(axis=1))
        for other in (near, far):
            d[:20] = np.minimum(d[:20], np.sqrt(((other - x[q]) ** 2).sum(axis=1)))
        d[q] = np.inf
        want = np.lexsort((np.arange(60), d))[:10]
        assert [v for _, v, _ in sorted(got)] == want.tolist()
        assert np.allclose([s for _, _, s in sorted(got)], d[want], rtol=1e-12)


def test_repeated_rows_do_not_hide_that_a_part_holds_few_ids(spark, monkeypatch):
    class Halves:
        def __init__(self):
            self.parts = 2

        def order(self, m):
            return np.where(m[:, :1] < 0, [[0, 1]], [[1, 0]])

    monkeypatch.setattr(lp, "CHUNK", 160)
    monkeypatch.setattr(lp, "Router", lambda parts: Halves())
    monkeypatch.setattr(lp, "learn_router", lambda m, parts, target: (Halves(), 1))
    rng = np.random.default_rng(10)
    m = rng.standard_normal((60, 4)).astype(np.float32)
    m[:, 0] = np.where(np.arange(60) < 8, -1, 1)  # eight ids in a part, each many times
    out = nearest(table(spark, np.vstack([m] * 5), list(range(60)) * 5), F.col("vec_id") < 8).collect()
    assert len(out) == 8 * lp.NEAREST


def test_parts_are_balanced_and_cut_few_edges():
    rng = np.random.default_rng(4)
    m = rng.standard_normal((8, 6))[rng.integers(0, 8, 800)] * 4 + rng.standard_normal((800, 6)) * 0.3
    g = neighbour_graph(m, 10)
    part = balanced_parts(g, 8)
    assert np.bincount(part).max() - np.bincount(part).min() <= 1
    cut = (part[g] != part[:, None]).mean()
    assert cut < 0.5 * (1 - 1 / 8)


@pytest.mark.parametrize("lengths", [(8,), (8, 3, 20)])
def test_every_length_is_searched_and_extreme_vectors_have_distances(spark, monkeypatch, lengths):
    monkeypatch.setattr(lp, "CHUNK", 60)  # queries are dealt over chunks as well
    rng = np.random.default_rng(5)
    rows = []
    for i in range(900):
        size = lengths[i % 7 % len(lengths)]
        scale = [1.0, 1e160, 1e-170, 3e307][i % 4] if lengths != (8,) else 1.0
        rows.append((i, [float(x) for x in rng.uniform(-1, 1, size) * scale]))
    rows += [(100, [0.5] * lengths[0]), (100, [0.25] * lengths[0])]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").repartition(5)
    out = {}
    for r in nearest(df, F.col("vec_id") % 10 == 0).collect():
        out.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    again = sorted(tuple(r) for r in nearest(df.repartition(3), F.col("vec_id") % 10 == 0).collect())
    assert again == sorted((q, *x) for q, xs in out.items() for x in xs)
    queries = {i: min(v for j, v in rows if j == i) for i, _ in rows if i % 10 == 0}
    assert set(out) == set(queries)
    hits = 0
    for q, v in queries.items():
        best = {}
        for i, w in rows:
            if i != q and len(w) == len(v):
                d = math.dist(v, w) if max(map(abs, v + w)) < 1e300 else 2 * math.hypot(*(a / 2 - b / 2 for a, b in zip(v, w)))
                best[i] = min(d, best.get(i, math.inf))
        want = sorted((d, i) for i, d in best.items())[:10]
        got = sorted(out[q])
        assert [n for n, _, _ in got] == list(range(1, len(want) + 1))
        for _, i, score in got:
            assert score == pytest.approx(best[i], rel=1e-12)
        hits += len({i for _, i, _ in got} & {i for _, i in want})
    assert hits >= 0.9 * 10 * len(queries)
