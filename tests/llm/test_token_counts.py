import random

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from helpers import corpus, documents
from riskflow.llm import _text
from riskflow.llm.token_counts import EDITS, CountTree, PreTokens, apply_edit, count_tokens, edited_counts, sample_edits

PATH, PATTERN = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN
ALPHABET = st.sampled_from(list(" \n\t'asrevmltd1.é\u0085\x1c中"))


@pytest.fixture(scope="module")
def pre():
    return PreTokens(PATH, PATTERN)


def full(pre, text):
    return len(pre.tokenizer.encode(text, add_special_tokens=False).ids)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet=ALPHABET, max_size=40), max_size=5))
def test_pretokens_equal_the_pattern(pre, texts):
    import pyarrow as pa

    for first, buf, offs in _text.text_chunks(pa.array(texts, pa.string())):
        lengths, counts, at = pre.chunk(buf, offs)
        for i in range(len(offs) - 1):
            text = texts[first + i]
            assert lengths[at[i]:at[i + 1]].tolist() == [len(w) for w in pre.pattern.findall(text)]
            assert counts[at[i]:at[i + 1]].sum() == full(pre, text)


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet=ALPHABET, max_size=300), st.lists(st.tuples(st.integers(0, 320), st.integers(0, 40), st.text(alphabet=ALPHABET, max_size=9)), max_size=6))
def test_edits_equal_a_full_count(pre, text, edits):
    words = pre.pattern.findall(text)
    tree = CountTree([len(w) for w in words], [pre.tokens(w) for w in words])
    for start, size, new in edits:
        start = min(start, len(text))
        want = text[:start] + new + text[min(start + size, len(text)):]
        text, _ = apply_edit(tree, text, start, start + size, new, pre)
        assert text == want
        lengths, counts = tree.leaves()
        assert lengths == [len(w) for w in pre.pattern.findall(text)]
        assert tree.tokens[1] == sum(counts) == full(pre, text) and tree.chars[1] == len(text)


def test_table_of_states(spark, pre):
    rows = corpus(41) + [(None, "null id"), (3, "same id again")]
    df = documents(spark, rows).withColumnRenamed("lang", "counts")
    states = count_tokens(df, PATH, PATTERN)
    assert sorted((r["doc_id"] or 0, r["n_tokens"]) for r in states.collect()) == sorted((i or 0, full(pre, t or "")) for i, t in rows)
    once = edited_counts(states.withColumn("edits", sample_edits()), PATH, PATTERN)
    twice = edited_counts(once.drop("n_encoded").withColumn("edits", F.lit(None).cast(EDITS)), PATH, PATTERN)
    for r in once.collect():
        assert r["n_tokens"] == full(pre, r["text"]) and r["n_pretokens"] == len(pre.pattern.findall(r["text"]))
        assert r["n_encoded"] <= 120 or "   " in r["text"]
    assert sorted(map(str, twice.select("text", "n_tokens", "lengths").collect())) == sorted(map(str, once.select("text", "n_tokens", "lengths").collect()))
    assert all(r["n_encoded"] == 0 for r in twice.collect())
    assert edited_counts(states.limit(0).withColumn("edits", sample_edits()), PATH, PATTERN).count() == 0


def test_an_edit_encodes_only_its_surroundings(pre):
    rng = random.Random(1)
    text = " ".join("".join(rng.choices("abcdefgh", k=5)) for _ in range(5000))
    words = pre.pattern.findall(text)
    tree = CountTree([len(w) for w in words], [pre.tokens(w) for w in words])
    for _ in range(50):
        a = rng.randrange(len(text))
        text, n = apply_edit(tree, text, a, a + rng.randint(0, 10), "new words here", pre)
        assert n <= 10
    assert tree.tokens[1] == full(pre, text)
