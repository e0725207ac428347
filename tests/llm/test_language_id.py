import math
import random
import zlib

import numpy as np
from pyspark.sql import functions as F

from helpers import documents
from riskflow.llm import language_id as li

ALPHABETS = {"aa": ["ba", "do", "ki", "lu"], "bb": ["str", "ich", "ung", "sche"], "cc": ["éau", "oi", "ça", "qui"]}


def text(rng, lang, n):
    return " ".join("".join(rng.choices(ALPHABETS[lang], k=rng.randint(1, 3))) for _ in range(n))


def labelled(seed=1, n=240):
    rng = random.Random(seed)
    return [(i, text(rng, lang := rng.choice(list(ALPHABETS)), rng.randint(5, 80)).capitalize(), lang) for i in range(n)]


def test_predictions_and_held_out(spark):
    rows = labelled() + [(1000, None, "aa"), (1001, "", "aa"), (1002, "123 !!", None), (1003, "Ba do ki!", None), (None, "str ich ung", "bb")]
    df = documents(spark, rows)
    model = li.learn(df)
    out = {r["doc_id"]: r for r in li.identified(df, model).withColumn("held", li.held_out()).collect()}
    assert len(out) == len(rows)
    for i, t, lang in rows:
        r = out[i]
        assert 0 <= r["score"] <= 1
        assert r["held"] == (i is not None and zlib.crc32(str(i).encode()) % 4 == 2)
        if i in (1000, 1001, 1002):
            assert r["lang_pred"] == "und" and r["score"] == 0
        elif lang:
            assert r["lang_pred"] == lang
    kept = li.accepted(df, model)
    assert kept.schema == df.schema
    ids = {r["doc_id"] for r in kept.collect()}
    assert not ids & {1000, 1001, 1002} and len(ids & set(range(240))) >= 238


def test_strange_text_is_rejected(spark):
    rng = random.Random(9)
    junk = "".join(rng.choices("qxzwjvkqpygfb ", k=600))
    df = documents(spark, labelled() + [(5000, junk, None)])
    model = li.learn(df)
    assert {r["doc_id"]: r["score"] for r in li.identified(df, model).collect()}[5000] < 0.5


def test_labels_of_held_out_rows_and_other_columns_are_not_inputs(spark):
    rows = labelled()
    flipped = [(i, t, "zz" if zlib.crc32(str(i).encode()) % 4 == 2 else g) for i, t, g in rows]
    a = li.identified(documents(spark, rows), li.learn(documents(spark, rows))).select("doc_id", "lang_pred", "score").collect()
    b = li.identified(documents(spark, flipped), li.learn(documents(spark, flipped))).select("doc_id", "lang_pred", "score").collect()
    assert sorted(a) == sorted(b)


def test_probabilities_sum_to_one_and_match_the_definition(spark):
    rng = random.Random(3)
    counts = {}
    for lang in ALPHABETS:
        s = "   " + text(rng, lang, 300)
        c = counts.setdefault(lang, {})
        for i in range(3, len(s)):
            c[s[i - 3:i + 1]] = c.get(s[i - 3:i + 1], 0) + 1
    model = li.kneser_ney(counts)
    ident = li.Identifier(model)
    letters = sorted({g[-1] for c in counts.values() for g in c})
    for context in ("   ", " ba", "ich", "çaq", "zzz", "do "):
        s = np.array([[ord(x) for x in context + c] for c in letters], np.uint64).reshape(-1)
        p = 2.0 ** ident._logp(s, np.arange(3, len(s), 4), 4).astype(float)
        unseen = 2.0 ** ident._logp(np.array([ord(x) for x in context + "中"], np.uint64), np.array([3]), 4).astype(float)[0]
        assert np.allclose(p.sum(axis=0) + unseen, 1, atol=1e-4)
    # one language, highest order, by hand
    c = counts["aa"]
    ones, twos = sum(v == 1 for v in c.values()), sum(v == 2 for v in c.values())
    d = min(max(ones / (ones + 2 * twos), 0.1), 0.9) if ones else 0.5
    g = max(c, key=c.get)
    total = sum(v for k, v in c.items() if k[:3] == g[:3])
    kinds = sum(k[:3] == g[:3] for k in c)
    s3 = np.array([ord(x) for x in g], np.uint64)
    low = 2.0 ** ident._logp(s3, np.array([3]), 3)[0][model["langs"].index("aa")]
    high = 2.0 ** ident._logp(s3, np.array([3]), 4)[0][model["langs"].index("aa")]
    assert math.isclose(high, max(c[g] - d, 0) / total + d * kinds / total * low, rel_tol=1e-4)


def test_every_language_is_learned(spark):
    rows, known = [], {}
    for i in range(300):
        a, b, c = (chr(0x4E00 + 3 * i + j) for j in range(3))
        ids = [j for j in range(20 * i, 20 * i + 20) if zlib.crc32(str(j).encode()) % 4 != 2][:2 + (i < 100)]
        rows += [(j, f"{a}{b}{c} {c}{b}", f"lang{i}") for j in ids]
        rows.append((10000 + i, f"{c}{b} {a}{b}{c}", None))
        known[10000 + i] = f"lang{i}"
    df = documents(spark, rows)
    out = {r["doc_id"]: r["lang_pred"] for r in li.identified(df, li.learn(df)).collect()}
    assert {i: out[i] for i in known} == known


def test_a_language_of_calibration_texts_only_is_learned(spark):
    check = spark.range(2000, 3000).selectExpr("id as doc_id").filter(F.pmod(F.xxhash64(F.lit(6), "doc_id"), F.lit(li.CALIBRATION_SHARE)) == 0)
    ids = sorted(r["doc_id"] for r in check.filter(~li.held_out()).collect())[:3]
    df = documents(spark, labelled() + [(i, "жук дом кот жук", "rare") for i in ids] + [(9000, "дом кот жук", None)])
    model = li.learn(df)
    assert model["langs"] == [*sorted(ALPHABETS), "rare"]
    out = {r["doc_id"]: r for r in li.identified(df, model).collect()}
    assert out[9000]["lang_pred"] == "rare" and out[9000]["score"] >= 0.5


def test_models_of_some_languages_each_agree_with_one_of_all(spark, monkeypatch):
    df = documents(spark, labelled())
    want = sorted(li.identified(df, li.learn(df)).collect())
    monkeypatch.setattr(li, "TOGETHER", 1)
    model = li.learn(df)
    out = sorted(li.identified(df, model).collect())
    assert len(model["models"]) == 3 and [r["lang_pred"] for r in out] == [r["lang_pred"] for r in want]
    assert np.allclose([(r["score"], r["bits"]) for r in out], [(r["score"], r["bits"]) for r in want], atol=1e-4)


def test_nothing_to_learn(spark):
    df = documents(spark, [(1, "abc", None), (2, None, "aa")])
    assert [r["lang_pred"] for r in li.identified(df, li.learn(df)).collect()] == ["und", "und"]
    empty = df.limit(0)
    assert li.identified(empty, li.learn(empty)).count() == 0 and li.accepted(df, None).count() == 2
