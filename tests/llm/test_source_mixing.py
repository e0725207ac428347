import pytest
from pyspark.sql import functions as F

from helpers import documents, prose, words
from riskflow.llm.source_mixing import label_quality, mixed, source_targets, document_sizes


def fill(sizes: dict, weights, cap=3):
    """Capped shares by weight, by raising all sources together."""
    order = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    w = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    left, out, free = float(sum(sizes.values())), {}, set(order)
    while free:
        level = left / sum(w[s] for s in free)
        full = {s for s in free if level * w[s] >= cap * sizes[s]}
        if not full:
            return out | {s: level * w[s] for s in free}
        for s in full:
            out[s] = cap * sizes[s]
            left -= out[s]
        free -= full
    return out


@pytest.fixture
def rows():
    import random

    rng = random.Random(2)
    out = []
    for source, n in (("a", 400), ("b", 3), ("c", 60), ("Z", 1), ("é", 30), (None, 12), ("empty", 2)):
        for _ in range(n):
            out.append((len(out), None if source == "empty" else prose(rng, rng.randint(1, 200)), "en", source))
    return out


def test_targets_and_taken(spark, rows):
    df = documents(spark, rows)
    sizes = {}
    for i, t, _, s in rows:
        sizes[s] = sizes.get(s, 0) + len(words(t))
    want = fill(sizes, (1, 2, 3))
    out = mixed(df).collect()
    assert len(out) == len(rows)
    size = {i: len(words(t)) for i, t, _, _ in rows}
    taken = {}
    for r in out:
        assert r["size"] == size[r["doc_id"]] and r["source_size"] == sizes[r["source"]]
        assert r["target"] == pytest.approx(want[r["source"]])
        assert 0 <= r["taken"] <= 3 * r["size"]
        taken[r["source"]] = taken.get(r["source"], 0) + r["taken"]
    for s, t in taken.items():
        assert abs(t - want[s]) <= 1
    assert sum(want.values()) == pytest.approx(sum(sizes.values()))
    # complete epochs first; then the smallest keys
    for s in sizes:
        mine = sorted((r["key"], r["doc_id"], r["size"], r["taken"]) for r in out if r["source"] == s and r["size"])
        epochs = [t // n for _, _, n, t in mine]
        assert sorted(epochs, reverse=True) == epochs and (not epochs or epochs[0] - epochs[-1] <= 1)
    again = {(r["doc_id"], r["taken"]) for r in mixed(df.repartition(7)).collect()}
    assert again == {(r["doc_id"], r["taken"]) for r in out}


def test_whole_documents(spark, rows):
    out = mixed(documents(spark, rows), whole=True).collect()
    assert all(r["taken"] == 0 or r["taken"] % r["size"] == 0 for r in out)
    by = {}
    for r in out:
        by.setdefault(r["source"], []).append(r)
    for group in by.values():
        assert abs(sum(r["taken"] for r in group) - group[0]["target"]) <= max(r["size"] for r in group)


def test_quality_raises_the_chance(spark):
    df = spark.range(4000).select(F.col("id").alias("doc_id"), F.lit("one two").alias("text"),
                                  F.when(F.col("id") < 2000, "a").otherwise("b").alias("source"))
    labels = spark.range(4000).select(F.col("id").alias("doc_id"), (F.col("id") % 2).cast("int").alias("quality"))
    out = mixed(df, label_quality(labels)).filter("source = 'a'").groupBy(F.col("doc_id") % 2).agg(F.sum("taken")).collect()
    share = {r[0]: r[1] for r in out}
    assert share[1] > 1.6 * share[0]


def test_odd_rows(spark):
    df = spark.createDataFrame([(None, None, None, 1), (1, "a b", "x", 2), (1, "a b", "x", 3)], "doc_id bigint, text string, source string, size int")
    out = sorted((r["doc_id"] or 0, r["size"], r["taken"]) for r in mixed(df).collect())
    assert out == [(0, 0, 0), (1, 2, 2), (1, 2, 2)]
    assert mixed(df.limit(0)).count() == 0
    bad = spark.createDataFrame([(1, None), (2, float("nan")), (3, -1.0)], "doc_id bigint, weight double")
    assert mixed(df, bad).count() == 3
    assert source_targets(document_sizes(df)).count() == 2
