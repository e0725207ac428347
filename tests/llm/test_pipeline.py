"""Each stage of the corpus pipeline on its predecessor's rows, against brute force."""

import random
import zlib

import corpus_pipeline
import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from helpers import documents, edited, jaccard_components, prose, words
from test_secret_scan import base


def fixture(spark, scratch):
    rng = random.Random(51)
    rows = []
    for i in range(200):
        rows.append((i, prose(rng, rng.randint(5, 120)), "aa", f"s{i % 3}"))
    for i in range(200, 240):
        t = rows[rng.randrange(60)][1]
        rows.append((i, edited(rng, t, 1) if len(t) > 300 else t, "aa", "s0"))
    rows += [(300, None, None, "s1"), (301, "", "aa", "s1"), (302, "12 34 !!", None, None), (303, "password=b7db7aa4a5fcc78305 " + prose(rng, 30), "aa", None),
             (304, "qxzw jvkq pygf bxqz " * 30, None, "s1")]
    documents(spark, rows).write.parquet(f"{scratch}/documents.parquet")
    spark.createDataFrame([(i, i % 2) for i in range(0, 100)], "doc_id bigint, quality int").write.parquet(f"{scratch}/labels.parquet")
    return rows


def test_stages(spark, scratch):
    rows = fixture(spark, scratch)
    docs = spark.read.parquet(f"{scratch}/documents.parquet")
    schema, state = docs.schema, docs
    after = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        state = stage(spark, state, scratch)
        assert state.schema == schema, name
        state = spark.createDataFrame(state.collect(), schema)
        after[name] = [(r["doc_id"], r["text"], r["source"], r["n_chars"]) for r in state.collect()]

    one = {i for i, *_ in after["language_id"]}
    assert one == {i for i, *_ in rows} - {300, 301, 302, 304}

    want = jaccard_components([(i, t) for i, t, *_ in after["language_id"]])
    assert sorted(i for i, *_ in after["ngram_jaccard"]) == sorted(i for i, (n, c) in want.items() if i == c or not n)

    assert [i for i, *_ in sorted(after["secret_scan"])] == [i for i, *_ in sorted(after["ngram_jaccard"])]
    assert any(base(t) for _, t, *_ in after["ngram_jaccard"]) and not any(base(t) for _, t, *_ in after["secret_scan"])
    assert all(n == len(t) for _, t, _, n in after["secret_scan"])

    sizes, taken, texts = {}, {}, {}
    for i, t, s, _ in after["secret_scan"]:
        sizes[s] = sizes.get(s, 0) + len(words(t))
        texts[i] = t
    for i, t, s, _ in after["source_mixing"]:
        assert texts[i] == t
        taken[s] = taken.get(s, 0) + len(words(t))
    from test_source_mixing import fill
    longest = max(len(words(t)) for t in texts.values())
    for s, target in fill(sizes, (1, 2, 3)).items():
        assert abs(taken.get(s, 0) - target) <= longest

    out = corpus_pipeline.STAGES[-1][1](spark, state, scratch).collect()
    t = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    ids = lambda x: t.encode(x, add_special_tokens=False).ids + [0]
    want = sorted((i, zlib.crc32(np.array(ids(x)[:2048], "<u4").tobytes())) for i, x, *_ in after["source_mixing"])
    assert sorted((r["doc_id"], r["ids_crc32"]) for r in out if r["piece"] == 0) == want
    assert len({(r["sequence_id"], r["offset"]) for r in out}) == len(out)


def test_run_and_empty_documents(spark, scratch):
    fixture(spark, scratch)
    assert corpus_pipeline.run(spark, scratch).count() > 150
    docs = spark.read.parquet(f"{scratch}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs2 = stage(spark, docs, scratch)
        assert docs2.count() == 0
