import random

import pytest

from helpers import corpus, documents, edited, jaccard_components, prose
from riskflow.llm import ngram_jaccard as nj
from riskflow.llm.ngram_jaccard import near_duplicates, one_of_each


def got(df):
    return {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in df.collect()}


@pytest.mark.parametrize("seed", [1, 2])
def test_components_equal_brute_force(spark, seed):
    rows = corpus(seed)
    assert got(near_duplicates(documents(spark, rows))) == jaccard_components(rows)


def test_short_sets_near_the_threshold(spark):
    rng = random.Random(3)
    rows = []
    for i in range(60):
        base = prose(rng, rng.randint(5, 30))
        rows += [(len(rows), base), (len(rows) + 1, base + " " + prose(rng, 1)), (len(rows) + 2, edited(rng, base, 1))]
    assert got(near_duplicates(documents(spark, rows))) == jaccard_components(rows)


def test_large_family_of_near_copies_with_outliers(spark, monkeypatch):
    """Blocks that many sets share take the hot path; its pairs are not expanded, its links are not lost."""
    monkeypatch.setattr(nj, "HOT", 3)
    rng = random.Random(4)
    base = prose(rng, 160)
    texts = [edited(rng, base, rng.choice([1, 2, 3, 5, 7])) for _ in range(150)]
    far = edited(rng, base, 14)
    texts += [edited(rng, far, 2) for _ in range(30)] + [prose(rng, 160) for _ in range(20)]
    rows = list(enumerate(texts))
    assert got(near_duplicates(documents(spark, rows))) == jaccard_components(rows)


def test_large_sets_use_the_wide_sketch(spark):
    rng = random.Random(5)
    base = prose(rng, 3000)
    rows = [(0, base), (1, edited(rng, base, 20)), (2, edited(rng, base, 150)), (3, prose(rng, 3000)), (4, base + " " + prose(rng, 500))]
    assert got(near_duplicates(documents(spark, rows))) == jaccard_components(rows)


def test_null_and_repeated_ids_empty_table_and_other_columns(spark):
    text = "one two three four five six seven"
    df = spark.createDataFrame([(None, text, "x"), (7, text, "y"), (7, text, "z"), (3, "other words", None), (None, None, None)],
                               "doc_id bigint, text string, node string")
    out = sorted((r["doc_id"] or -1, r["n_shingles"], r["component_id"]) for r in near_duplicates(df).collect())
    assert out == [(-1, 0, None), (-1, 3, 7), (3, 1, 3), (7, 3, 7), (7, 3, 7)]
    assert near_duplicates(df.limit(0)).count() == 0
    assert near_duplicates(df.filter("text IS NULL")).select("n_shingles").collect()[0][0] == 0


def test_one_of_each_keeps_one_row_and_all_columns(spark):
    rows = corpus(6, texts=20, family=10)
    want = jaccard_components(rows)
    df = documents(spark, rows)
    kept = one_of_each(df)
    assert kept.schema == df.schema
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(i for i, (n, c) in want.items() if i == c or not n)
    from pyspark.sql import functions as F
    clash = one_of_each(df.withColumn("_row", F.lit(7)).withColumn("row", F.lit(8)).withColumn("node", F.lit(9)))
    assert clash.select("_row", "row", "node").distinct().collect() == [(7, 8, 9)] and clash.count() == kept.count()
    twice = df.unionByName(df)
    assert one_of_each(twice).filter("n_chars > 20").count() == kept.filter("n_chars > 20").count()


def test_bit_sketch_distance_bounds_the_symmetric_difference():
    import numpy as np

    rng = np.random.default_rng(1)
    for _ in range(50):
        h = np.sort(rng.integers(0, 1 << 62, 300, dtype=np.uint64))
        other = np.sort(np.concatenate([h[rng.integers(0, 2, 300) > 0], rng.integers(0, 1 << 62, 40, dtype=np.uint64)]))
        d = np.concatenate([np.zeros(300, int), np.ones(len(other), int)])
        a, b = nj.bit_sketches(d, np.concatenate([h, other]), 2)
        assert sum(int(x).bit_count() for x in (a ^ b).astype(np.uint64)) <= len(np.setxor1d(h, other))
