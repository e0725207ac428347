import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskflow.llm import topk_search as ts
from riskflow.llm.topk_search import top_k

SCHEMA = "vec_id bigint, embedding array<double>, w int, score string"  # two columns with names that the search uses


def table(spark, rows):
    return spark.createDataFrame([(i, v, 1, "x") for i, v in rows], SCHEMA)


def brute(rows, every=100, k=10):
    clip = lambda x: int(max(-2**63, min(2**63 - 1, x)))
    fine = [(i, [clip(math.floor(max(-1e20, min(1e20, 1024 * x)))) for x in v]) for i, v in rows
            if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q in sorted({i for i, _ in fine if i % every == 0}):
        qv = min(v for i, v in fine if i == q)
        found = {}
        for i, v in fine:
            if i != q:
                s = clip(sum(a * b for a, b in zip(qv, v)))
                found[i] = max(s, found.get(i, s))
        best = sorted(found.items(), key=lambda x: (-x[1], x[0]))[:k]
        out += [(q, n + 1, i, s) for n, (i, s) in enumerate(best)]
    return out


def got(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize("query_bytes,rows_a_block,queries_a_block", [(1 << 20, 4096, 64), (600, 17, 2)])
def test_equals_brute_force(spark, monkeypatch, query_bytes, rows_a_block, queries_a_block):
    monkeypatch.setattr(ts, "ROW_BLOCK", rows_a_block)
    monkeypatch.setattr(ts, "QUERY_BLOCK", queries_a_block)
    rng = np.random.default_rng(3)
    m = rng.standard_normal((900, 12)) * (rng.random((900, 12)) < 0.4)
    m[700:] = np.round(m[700:])  # many ties
    rows = [(int(i), [float(x) for x in v]) for i, v in zip(rng.permutation(900), m)]
    rows += [(901, None), (1000, [1.0, None]), (902, [float("nan")] * 12), (903, [float("inf")]), (None, [1.0] * 12), (904, []),
             (1100, []), (1200, [0.0] * 12), (905, [2.0, 1.0]), (906, [1.0] * 30), (1300, [1.0] * 30)]
    df = table(spark, rows).repartition(5)
    assert got(top_k(df, F.col("vec_id") % 100 == 0, query_bytes=query_bytes)) == brute(rows)


def test_repeated_rows_and_ids(spark, monkeypatch):
    monkeypatch.setattr(ts, "ROW_BLOCK", 50)
    rng = np.random.default_rng(4)
    base = [(int(i), [float(x) for x in rng.standard_normal(6)]) for i in range(0, 400, 4)]
    rows = base * 13 + [(i, [float(x) for x in rng.standard_normal(6)]) for i in range(0, 400, 20)]
    assert got(top_k(table(spark, rows).repartition(7), F.col("vec_id") % 100 == 0)) == brute(rows)


def test_few_rows_and_empty_tables(spark):
    rows = [(0, [1.0, 2.0]), (1, [0.5, 0.25]), (7, [-1.0, 3.0])]
    assert got(top_k(table(spark, rows), F.col("vec_id") % 100 == 0)) == brute(rows) and len(brute(rows)) == 2
    assert got(top_k(table(spark, rows[:1]), F.col("vec_id") % 100 == 0)) == []
    empty = top_k(table(spark, []), F.col("vec_id") % 100 == 0)
    assert empty.count() == 0 and empty.dtypes == [("query_id", "bigint"), ("rank", "int"), ("vec_id", "bigint"), ("score", "bigint")]


def test_weights_beyond_longs(spark):
    rows = [(0, [1e160, 3.0]), (100, [2.0**45, -(2.0**50)]), (1, [1e10, 1.0]), (2, [-1e160, 2.0]), (3, [2.0**45, 2.0**50]), (4, [1e308, -1e308])]
    assert got(top_k(table(spark, rows), F.col("vec_id") % 100 == 0)) == brute(rows)


def test_no_candidate_row_is_shuffled(spark):
    rows = table(spark, [(i, [float(i)]) for i in range(300)])
    plan = top_k(rows, F.col("vec_id") % 100 == 0)._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
