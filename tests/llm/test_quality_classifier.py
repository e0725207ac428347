import random

import numpy as np

from helpers import documents, prose
from riskflow.llm import quality_classifier as qc


def rows(seed=1, n=600):
    rng = random.Random(seed)
    out, labels = [], []
    for i in range(n):
        good = rng.random() < 0.8
        t = prose(rng, rng.randint(10, 80))
        if not good:
            t = rng.choice([t.upper().replace(" ", "!! "), t.replace(" ", " | "), " ".join([t.split()[0]] * 40)])
        out.append((i, t))
        if i % 2:
            labels.append((i, int(good)))
    return out, labels


def test_held_out_rows(spark):
    docs, labels = rows()
    df = documents(spark, docs + [(9001, None), (9002, ""), (None, "ba do ki"), (9003, "x" * 100_000)])
    lab = spark.createDataFrame(labels + [(None, 1), (1, None), (3, 0), (3, 1)], "doc_id bigint, quality int")
    model = qc.learn(df, lab)
    assert 0.6 < model["prior"] < 0.95
    out = {r["doc_id"]: r for r in qc.scored(df, model).withColumn("held", qc.held_out()).collect()}
    assert len(out) == len(docs) + 4 and all(0 <= r["score"] <= 1 for r in out.values())
    right = [(out[i]["score"] >= qc.THRESHOLD) == bool(q) for i, q in labels if out[i]["held"]]
    assert len(right) > 40 and np.mean(right) > 0.95


def test_labels_of_held_out_rows_are_not_inputs(spark):
    docs, labels = rows(2, 300)
    df = documents(spark, docs)
    held = {r["doc_id"] for r in df.filter(qc.held_out()).collect()}
    a = spark.createDataFrame(labels, "doc_id bigint, quality int")
    b = spark.createDataFrame([(i, 1 - q if i in held else q) for i, q in labels], "doc_id bigint, quality int")
    assert sorted(qc.scored(df, qc.learn(df, a)).collect()) == sorted(qc.scored(df, qc.learn(df, b)).collect())


def test_risk_and_prior():
    rng = np.random.default_rng(1)
    pos, neg = rng.normal(1.5, 1, (3000, 2)), rng.normal(-1.5, 1, (1200, 2))
    one = lambda x: np.hstack([x, np.ones((len(x), 1))])
    p, u = one(pos[:1200]), one(np.vstack([pos[1200:], neg]))
    first = qc.fit_linear(p, u, None)
    prior = qc.class_prior(p @ first, u @ first)
    assert abs(prior - 0.6) < 0.1
    w = qc.fit_linear(p, u, prior)
    z = u @ w
    assert (z[:1800] > 0).mean() > 0.95 and (z[1800:] < 0).mean() > 0.9


def test_nothing_to_learn(spark):
    df = documents(spark, [(1, "a b"), (2, None)])
    none = spark.createDataFrame([], "doc_id bigint, quality int")
    assert qc.learn(df, none) is None
    assert [r["score"] for r in qc.scored(df, None).collect()] == [0.5, 0.5]
    assert qc.scored(df.limit(0), None).count() == 0
