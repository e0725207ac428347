import hashlib
import random

import numpy as np
import pytest

from helpers import corpus, documents, prose
from riskflow.llm import suffix_dedup as sd
from riskflow.llm.suffix_dedup import merged, repeated_removed


def brute(rows, length=200):
    raw = [(i, (t or "").encode()) for i, t in rows]
    times = {}
    for _, b in raw:
        for p in range(len(b) - length + 1):
            times[b[p:p + length]] = times.get(b[p:p + length], 0) + 1
    out = []
    for i, b in raw:
        keep = np.ones(len(b), bool)
        for p in range(len(b) - length + 1):
            if times[b[p:p + length]] > 1:
                keep[p:p + length] = False
        left = np.frombuffer(b, np.uint8)[keep].tobytes()
        runs = int((np.diff(np.concatenate(([1], keep.astype(int)))) == -1).sum())
        out.append((i, len(b), len(b) - len(left), runs, hashlib.sha256(left).hexdigest()))
    return sorted(out, key=str)


def got(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()), key=str)


def passages(seed):
    rng = random.Random(seed)
    p = [prose(rng, n) for n in (25, 33, 40, 70, 200)]
    out = []
    for k in range(50):
        parts = [prose(rng, rng.randint(0, 50))]
        for _ in range(rng.randint(0, 3)):
            one = rng.choice(p)
            a = rng.randint(0, len(one) // 2)
            parts += [one[a:a + rng.randint(150, 400)], prose(rng, rng.randint(0, 9))]
        out.append("".join(parts))
    out += ["ab" * 300, "ab" * 150, "z" * 199, "z" * 199, "z" * 200, "y" * 201, "é" * 100 + "x", "é" * 100]
    return [*enumerate(out)]


@pytest.mark.parametrize("many", [4096, 2])
@pytest.mark.parametrize("rows", [corpus(21), passages(22), passages(23)], ids=["corpus", "passages", "more"])
def test_equal_to_brute_force(spark, monkeypatch, rows, many):
    monkeypatch.setattr(sd, "MANY", many)  # 2: nearly all anchors are dealt by whole strings
    df = documents(spark, rows).repartition(5)
    assert got(repeated_removed(df)) == brute(rows)


def test_a_passage_that_every_document_holds(spark):
    rng = random.Random(7)
    shared = prose(rng, 60)
    rows = [(i, prose(rng, rng.randint(20, 60)) + shared + prose(rng, 30)) for i in range(120)]
    assert got(repeated_removed(documents(spark, rows).repartition(4))) == brute(rows)


def test_odd_rows(spark):
    text = "word " * 60
    df = spark.createDataFrame([(None, None, 1), (4, text, 2), (4, text, 3), (None, "short", 4)], "doc_id bigint, text string, md5 int")
    assert got(repeated_removed(df)) == brute([(None, None), (4, text), (4, text), (None, "short")])
    assert repeated_removed(df.limit(0)).count() == 0


def test_kept_texts(spark):
    rows = passages(24) + [(None, "short"), (3, "same id")]
    for r in repeated_removed(documents(spark, rows), with_text=True).collect():
        assert "\ufffd" in r["kept"] or hashlib.sha256(r["kept"].encode()).hexdigest() == r["kept_sha256"]


def test_merged_spans():
    s, e = merged(np.array([5, 0, 3, 20]), np.array([9, 4, 6, 21]))
    assert s.tolist() == [0, 20] and e.tolist() == [9, 21]
    assert len(merged(np.empty(0, int), np.empty(0, int))[0]) == 0
