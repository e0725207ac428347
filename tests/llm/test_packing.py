import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from helpers import corpus, documents
from riskflow.llm import _text, packing
from riskflow.llm.packing import BestFit, WordTokens, pack_documents

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def words():
    return WordTokens(PATH)


def pieces_of(rows, length):
    t = Tokenizer.from_file(PATH)
    out = {}
    for i, text in rows:
        ids = t.encode(text or "", add_special_tokens=False).ids + [0]
        for k in range(0, len(ids), length):
            part = ids[k:k + length]
            out[i, k // length] = (k, len(part), zlib.crc32(np.array(part, "<u4").tobytes()))
    return out


@pytest.mark.parametrize("length,most,per_task", [(2048, 1024, 200_000), (64, 8, 40)])
def test_pieces_and_layout(spark, monkeypatch, length, most, per_task):
    monkeypatch.setattr(packing, "PIECES_PER_TASK", per_task)
    rows = corpus(11)
    out = pack_documents(documents(spark, rows), PATH, length, most).collect()
    assert {(r["doc_id"], r["piece"]): (r["start"], r["length"], r["ids_crc32"]) for r in out} == pieces_of(rows, length)
    assert len(out) == len({(r["doc_id"], r["piece"]) for r in out})
    bins = {}
    for r in out:
        bins.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for spans in bins.values():
        at = 0
        for offset, size in sorted(spans):
            assert offset == at
            at += size
        assert at <= length
    assert len(bins) <= 1.3 * sum(r["length"] for r in out) / length + 2


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from(list(" \n\t'sdt1.,!Aéßİ́ \u0085\x1c中<|endoftext|>")), max_size=60), max_size=6))
def test_word_lookup_equals_the_tokenizer(words, texts):
    import pyarrow as pa

    t = words.tokenizer
    for first, buf, offs in _text.text_chunks(pa.array(texts, pa.string())):
        ids, at = words.chunk(buf, offs)
        for i in range(len(offs) - 1):
            assert ids[at[i]:at[i + 1]].tolist() == t.encode(texts[first + i], add_special_tokens=False).ids


def test_best_fit_takes_the_fullest_and_closes_the_fullest():
    f = BestFit(10, 2)
    assert f.put(6) == (0, 0) and f.put(7) == (1, 0)
    assert f.put(3) == (1, 7)  # fits both: the fuller one, now full and no longer open
    assert f.put(5) == (2, 0)
    assert f.put(9) == (3, 0)  # two are open without room: the fuller (bin 0) closes
    assert f.put(4) == (2, 5)
    rng = random.Random(1)
    sizes = [rng.randint(1, 2048) for _ in range(20_000)]
    f = BestFit(2048, 1024)
    for s in sizes:
        f.put(s)
    assert f.next <= 1.02 * sum(sizes) / 2048


def test_null_ids_empty_table_and_other_columns(spark):
    df = spark.createDataFrame([(None, None, 1), (None, "a b", 2), (1, "a b", 3), (1, "a b", 4)], "doc_id bigint, text string, sequence_id int")
    out = pack_documents(df, PATH).collect()
    assert len(out) == 4 and len({(r["sequence_id"], r["offset"]) for r in out}) == 4
    assert pack_documents(df.limit(0), PATH).count() == 0
