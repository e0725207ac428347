import random
import re
import zlib

import numpy as np
import pytest

from helpers import LOWER, documents, prose
from riskflow.llm import spelling_variants as sv
from riskflow.llm.spelling_variants import variants, vocabulary


def counted(rows):
    n = {}
    for doc, text, *_ in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'null' if doc is None else doc}:{run}".encode())
            w = run[:h % len(run)] + run[h % len(run) + 1:] if h % 199 == 0 else run
            n[w] = n.get(w, 0) + 1
    return {w: c for w, c in n.items() if len(w) >= 6 and c >= 5}


def near(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute(vocab):
    out, form = [], {}
    for w in vocab:
        of = [o for o in vocab if near(w, o)]
        best = min(of, key=lambda o: (-vocab[o], o), default=None)
        form[w] = best if best and vocab[best] >= 5 * vocab[w] else None
        out.append((w, vocab[w], len(of)))
    rows = []
    for w, n, k in out:
        root = w
        while form[root]:
            root = form[root]
        rows.append((w, form[w], root, n, k, vocab[form[w]] if form[w] else None))
    return sorted(rows)


def got(df):
    return sorted(tuple(r) for r in df.collect())


def corpus(seed=1, n=260):
    rng = random.Random(seed)
    bases = [prose(rng, 1) + prose(rng, 1) for _ in range(25)] + ["façadeé", "ÿÿÿÿÿÿ", "àéîõüß", "aaaaaaaa", "abcdef", "bcdefg"]
    def word():
        w = rng.choice(bases)
        while rng.random() < 0.35:
            i = rng.randrange(len(w))
            w = rng.choice([w[:i] + w[i + 1:], w[:i] + rng.choice("abzàÿé") + w[i:], w[:i] + rng.choice("abzàÿé") + w[i + 1:]])
        return w.upper() if w.isascii() and rng.random() < 0.1 else w
    rows = [(i, rng.choice([" ", ", ", "×", "1", "÷", "\n", "-"]).join(word() for _ in range(rng.randint(1, 60)))) for i in range(n)]
    return rows + [(n, None), (n + 1, ""), (None, "façadeé " * 30), (n + 2, "Ā ΩΩΩΩΩΩ жжжжжж 漢字"), (3, rows[3][1]), (3, rows[3][1])]


@pytest.mark.parametrize("filter_bytes,slice_bytes,held", [(32 << 20, 1 << 20, 200_000), (256, 128, 40)])
def test_equals_brute_force(spark, monkeypatch, filter_bytes, slice_bytes, held):
    monkeypatch.setattr(sv, "HELD_WORDS", held)
    rows = corpus()
    vocab = counted(rows)
    df = vocabulary(documents(spark, rows).selectExpr("*", "1 AS word", "2 AS n").repartition(3))
    assert {r["word"]: r["n"] for r in df.collect()} == vocab
    assert got(variants(df, filter_bytes=filter_bytes, slice_bytes=slice_bytes)) == brute(vocab)


def test_long_words_chains_ties_and_empty_tables(spark):
    x = "x" * 3000
    n = {"abcdef": 5, "abcdeg": 25, "abcdeh": 25, "abcdehi": 125, "abcdehij": 625, "abcdehijk": 3125, x: 40, x + "x": 8, x[:-1] + "y": 200,
         "a" * 64: 5, "a" * 65: 25, "a" * 63: 5, "a" * 63 + "b": 6, "lonely": 9, "zzzzzz": 5, "zzzzzÿ": 24}
    df = spark.createDataFrame(list(n.items()), "word string, n bigint")
    assert got(variants(df)) == brute(n)
    empty = variants(vocabulary(documents(spark, [])))
    assert empty.count() == 0 and empty.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert variants(vocabulary(documents(spark, [(1, "one two")]))).count() == 0


def test_no_word_of_a_filter_is_missed_and_few_others_pass():
    h = sv._text.mix(np.arange(1, 200_001, dtype=np.uint64))
    f = sv.Filter.of(h[:100_000], 100_000 * sv.BITS // 512)
    assert len(f.hits(h[:100_000])) == 100_000
    assert len(f.hits(h[100_000:])) < 1000


def test_edit_hashes_equal_the_edited_words_hashes():
    words = ["banana", "aabbcc", "façade"]
    alphabet = np.array(sorted({ord(c) for w in words for c in w}), np.int64)
    of = {}
    for size, at, codes in sv.by_length(words):
        for place, rows, letters, h in sv.neighbours(codes, alphabet, {5, 6}):
            for j, r in enumerate(rows):
                w = words[at[r]]
                edit = w[:place] + (chr(letters[j]) if letters is not None else "") + w[place + 1:]
                ((_, _, c),) = sv.by_length([edit])
                assert h[j] == sv.finished(np.bitwise_xor.reduce(sv.letter_hashes(c), axis=1), len(edit))[0]
                assert (w, edit) not in of
                of[w, edit] = True
    assert ("banana", "banna") in of or ("banana", "banaa") in of
