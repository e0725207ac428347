"""Spelling variant grouping by Bloom-guided neighbourhoods.

Words are counted over all documents, first within a task, then by a shuffle of
(word, count). The vocabulary of words with at least ``LEAST`` occurrences is
hashed by position (XOR of a number for each place and letter), so that the hash of
an edited word follows from the word's own in one step. The hashes fill blocked
Bloom filters, sharded by word length; a block is 64 bytes, and a word sets one bit
in each of its eight longs.

Filters are broadcast in passes of at most ``FILTER_BYTES``, however large the
vocabulary is: a shard is cut into slices by hash, and each pass probes the edits
that fall into its slices. A task generates the edits of its words as hashes
only, never as strings: each replacement of a letter by a larger one of the
vocabulary's alphabet, and each deletion. (An insertion is a deletion seen from the
longer word, a replacement by a smaller letter one seen from the other word, so each
pair of words is met once.) Only probes that find all their bits become strings
and are shuffled, to an exact join with the vocabulary that removes false positives.

A word's form is the most frequent of its near words, if it is ``RATIO`` times as
frequent; roots follow forms by doubling paths, so their rounds grow with the
logarithm of the longest chain, which itself is at most the logarithm of the largest count.

Defined cases: null and empty texts give no words; a null doc_id reads ``null`` in the
hash; rows that repeat a doc_id are documents of their own; words may be as long as
their text. An empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskflow.llm import _text
from riskflow.llm._tables import parts_for, passing_tables, saved, table

LETTERS = 6  # code points of a word, at least
LEAST = 5  # occurrences of a word, at least
RATIO = 5  # of a form's count to its word's
SLIP = 199  # one in so many (document, run) pairs loses a letter
LONGEST_SHARD = 64  # longer words share the shard of this length
BITS = 16  # of a filter for each word
SLICE_BYTES = 1 << 20
FILTER_BYTES = 32 << 20  # of one broadcast
HELD_WORDS = 200_000
WORDS_PER_TASK = 10_000  # a task generates some hundred edits for each
PROBES = 1 << 19  # hashes at once
U64 = np.uint64
LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
#: A letter in UTF-8: ASCII, or U+00C0 to U+00FF (lead byte C3, which no other letter has).
RUN = re.compile(rb"(?:[a-z]|\xc3[\x80-\xbf])+")


# ---- words ------------------------------------------------------------------------

def without_letter(run: bytes, at: int) -> bytes:
    """The run without its code point ``at``."""
    text = run.decode()
    return (text[:at] + text[at + 1:]).encode()


def word_counts(letters: int = LETTERS, slip: int = SLIP):
    """Counts of the words of whole texts, a task's words together."""
    def counted(held):
        words = sorted(held)
        return pa.RecordBatch.from_arrays([pa.array([w.decode() for w in words], pa.string()), pa.array([held[w] for w in words], pa.int64())],
                                          ["word", "n"])

    def run(batches):
        held = {}
        for batch in batches:
            for doc, text in zip(batch.column("doc_id"), batch.column("text")):
                raw = text.as_buffer()
                if raw is None or not raw.size:
                    continue
                seed = zlib.crc32(("null" if not doc.is_valid else str(doc.as_py())).encode() + b":")
                of = {}
                for m in RUN.finditer(raw.to_pybytes().translate(LOWER)):
                    w = m.group()
                    of[w] = of.get(w, 0) + 1
                for w, n in of.items():
                    size = len(w) - w.count(b"\xc3")
                    if size < letters:
                        continue
                    h = zlib.crc32(w, seed)
                    if h % slip == 0:
                        if size == letters:
                            continue
                        w = without_letter(w, h % size)
                    held[w] = held.get(w, 0) + n
                if len(held) > HELD_WORDS:
                    yield counted(held)
                    held = {}
        if held:
            yield counted(held)
    return run


# ---- hashes and filters -------------------------------------------------------------

def place_hash(place, letter) -> np.ndarray:
    """A number for a letter (code point) at a place."""
    return _text.mix((np.asarray(place, U64) << U64(9)) + np.asarray(letter, U64) + U64(0x5E11))


def finished(h: np.ndarray, size: int) -> np.ndarray:
    return _text.mix(h ^ U64(0x9E3779B97F4A7C15 * (size + 1) & 0xFFFFFFFFFFFFFFFF))


def by_length(words: list[str]):
    """(length, row numbers, code points as a matrix) for each length."""
    size = np.array([len(w) for w in words], np.int64)
    for n in np.unique(size):
        at = np.flatnonzero(size == n)
        for i in range(0, len(at), max(1, PROBES // int(n))):
            some = at[i:i + max(1, PROBES // int(n))]
            yield int(n), some, np.frombuffer("".join(words[j] for j in some).encode("utf-32-le"), "<u4").reshape(-1, n).astype(np.int64)


def letter_hashes(codes: np.ndarray, first: int = 0) -> np.ndarray:
    return place_hash(np.arange(first, first + codes.shape[1])[None, :], codes)


def shard_of(size: int) -> int:
    return min(size, LONGEST_SHARD)


def _probe_bit(h: np.ndarray, j: int) -> np.ndarray:
    """The bit of each hash in long ``j`` of its block."""
    return U64(1) << ((h >> U64(6 * j)) & U64(63))


class Filter:
    """A blocked Bloom filter of one slice."""

    def __init__(self, longs: np.ndarray):
        self.longs = longs.reshape(-1, 8)

    @classmethod
    def of(cls, hashes: np.ndarray, blocks: int):
        out = cls(np.zeros(blocks * 8, U64))
        at = out._block(hashes)
        for j in range(8):
            np.bitwise_or.at(out.longs[:, j], at, _probe_bit(hashes, j))
        return out

    def _block(self, h):
        return ((_text.mix(h ^ U64(0xB10C)) >> U64(32)) * U64(len(self.longs))) >> U64(32)

    def hits(self, hashes: np.ndarray) -> np.ndarray:
        """Numbers of the hashes that have all their bits."""
        left = np.arange(len(hashes))
        at = self._block(hashes)
        for j in range(8):
            on = (self.longs[at, j] & _probe_bit(hashes[left], j)) != 0
            left, at = left[on], at[on]
        return left


def slice_of(h: np.ndarray, slices: int) -> np.ndarray:
    return (_text.mix(h ^ U64(0x51CE)) % U64(slices)).astype(np.int64)


def _hashed(slices: dict):
    """(shard, slice, hash) of each word."""
    def run(batches):
        for batch in batches:
            words = batch.column("word").to_pylist()
            for size, at, codes in by_length(words):
                h = finished(np.bitwise_xor.reduce(letter_hashes(codes), axis=1), size)
                shard = shard_of(size)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(at), shard, np.int32)), pa.array(slice_of(h, slices[shard]).astype(np.int32)), pa.array(h.view(np.int64))],
                    ["shard", "slice", "hash"])
    return run


def _built(bits: int):
    def run(key, tab):
        h = tab.column("hash").combine_chunks().to_numpy().view(U64)
        longs = Filter.of(h, max(1, -(-len(h) * bits // 512))).longs
        return pa.Table.from_arrays([pa.array([key[0].as_py()], pa.int32()), pa.array([key[1].as_py()], pa.int32()),
                                     pa.array([longs.tobytes()], pa.binary())], ["shard", "slice", "bits"])
    return run


def neighbours(codes: np.ndarray, alphabet: np.ndarray, shards: set):
    """Hashes of the edits of equally long words: (kind, place, rows, letters, hashes); letters None for deletions."""
    n, size = codes.shape
    t = letter_hashes(codes)
    whole = np.bitwise_xor.reduce(t, axis=1)
    if shard_of(size) in shards:
        rows = max(1, PROBES // max(1, len(alphabet)))
        for i in range(size):
            new = place_hash(np.full(len(alphabet), i), alphabet)
            for a in range(0, n, rows):
                r, c = np.nonzero(alphabet[None, :] > codes[a:a + rows, i, None])
                r += a
                yield i, r, alphabet[c], finished(whole[r] ^ t[r, i] ^ new[c], size)
    if size > 1 and shard_of(size - 1) in shards:
        moved = letter_hashes(codes[:, 1:])  # each letter one place to the left
        after = np.bitwise_xor.reduce(moved, axis=1) if size > 1 else np.zeros(n, U64)
        before = np.zeros(n, U64)
        for i in range(size):
            r = np.arange(n) if i == size - 1 else np.flatnonzero(codes[:, i] != codes[:, i + 1])  # once for equal letters in a row
            yield i, r, None, finished(before[r] ^ after[r], size - 1)
            before = before ^ t[:, i]
            if i < size - 1:
                after = after ^ moved[:, i]


def _probed(shared):
    """(word, n, edit) of the edits that a filter holds."""
    def run(batches):
        slices, alphabet = shared.value["slices"], shared.value["alphabet"]
        filters = {k: Filter(np.frombuffer(v, U64)) for k, v in shared.value["filters"].items()}
        shards = {s for s, _ in filters}
        for batch in batches:
            words, count = batch.column("word").to_pylist(), batch.column("n").to_pylist()
            out = []
            for size, at, codes in by_length(words):
                for place, rows, letters, h in neighbours(codes, alphabet, shards):
                    shard = shard_of(size - (letters is None))
                    part = slice_of(h, slices[shard]) if slices[shard] > 1 else np.zeros(len(h), np.int64)
                    for s in np.unique(part).tolist():
                        if (shard, s) in filters:
                            of = np.flatnonzero(part == s)
                            for j in of[filters[shard, s].hits(h[of])].tolist():
                                i = int(at[rows[j]])
                                w = words[i]
                                out.append((w, count[i], w[:place] + (chr(letters[j]) if letters is not None else "") + w[place + 1:]))
                    if len(out) > 50_000:
                        yield _positives(out)
                        out = []
            if out:
                yield _positives(out)
    return run


def _positives(rows):
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.string(), pa.int64(), pa.string()))], ["word", "n", "edit"])


# ---- DataFrames -------------------------------------------------------------------------

def vocabulary(docs: DataFrame, letters: int = LETTERS, least: int = LEAST, slip: int = SLIP) -> DataFrame:
    """(word, n): the words of ``docs`` (columns doc_id, text) with at least ``least`` occurrences."""
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    counts = docs.mapInArrow(word_counts(letters, slip), "word string, n bigint")
    return counts.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= least)


def near_words(vocab: DataFrame, filter_bytes: int = FILTER_BYTES, slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """(word, n, other, other_n): each pair of words that differ by one code point, both ways round.

    ``vocab`` (word, n) is a written table of distinct words.
    """
    spark = vocab.sparkSession
    shard = F.least(F.char_length("word"), F.lit(LONGEST_SHARD))
    sizes = {r["shard"]: r["count"] for r in vocab.groupBy(shard.alias("shard")).count().collect()}  # at most LONGEST_SHARD rows
    slices = {s: max(1, -(-n * BITS // (8 * slice_bytes))) for s, n in sizes.items()}
    slices |= {s: 1 for s in range(LONGEST_SHARD + 1) if s not in slices}
    # every code point of the vocabulary: at most 90 by the definition of a word
    letters = vocab.select(F.explode(F.array_distinct(F.split("word", ""))).alias("c")).distinct().filter("c <> ''").collect()
    alphabet = np.array(sorted(ord(r["c"]) for r in letters), np.int64)
    filters = vocab.select("word").mapInArrow(_hashed(slices), "shard int, slice int, hash bigint")
    filters = saved(filters.groupBy("shard", "slice").applyInArrow(_built(BITS), "shard int, slice int, bits binary"), "filters")

    of_pass, room, now = [], 0, []
    for s, i, size in sorted((r["shard"], r["slice"], r["size"]) for r in filters.select("shard", "slice", F.length("bits").alias("size")).collect()):
        if now and room + size > filter_bytes:
            of_pass.append(now)
            room, now = 0, []
        room += size
        now.append((s, i))
    of_pass += [now] if now else []

    positives = None
    for some in of_pass:
        (low, _), (high, _) = some[0], some[-1]
        held = filters.filter(F.col("shard").between(low, high)).select("shard", "slice", "bits")
        if (low, 0) != some[0] or (high, slices[high] - 1) != some[-1]:
            ends = F.struct("shard", "slice")
            held = held.filter(ends.between(*(F.struct(F.lit(a), F.lit(b)) for a, b in (some[0], some[-1]))))
        shared = spark.sparkContext.broadcast({
            "slices": slices, "alphabet": alphabet, "filters": {(r["shard"], r["slice"]): bytes(r["bits"]) for r in held.collect()}})
        # the words whose edits may have a length of this pass
        words = vocab.filter(F.char_length("word").between(low, high + 1 if high < LONGEST_SHARD else 1 << 30))
        words = words.repartition(parts_for(sum(sizes.values()), WORDS_PER_TASK))  # a word costs far more than its bytes
        found = saved(words.mapInArrow(_probed(shared), "word string, n bigint, edit string"), "positives")
        shared.destroy()
        positives = found if positives is None else positives.unionByName(found)
    if positives is None:
        return spark.createDataFrame([], "word string, n bigint, other string, other_n bigint")
    exact = positives.join(vocab.select(F.col("word").alias("edit"), F.col("n").alias("edit_n")), "edit")
    both = F.array(F.struct("word", "n", F.col("edit").alias("other"), F.col("edit_n").alias("other_n")),
                   F.struct(F.col("edit").alias("word"), F.col("edit_n").alias("n"), F.col("word").alias("other"), F.col("n").alias("other_n")))
    return exact.select(F.explode(both).alias("p")).select("p.*")


def roots(forms: DataFrame) -> DataFrame:
    """(word, root): from each word with a form along forms to the last, by doubled paths."""
    now = saved(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        ahead = now.select(F.col("word").alias("root"), F.col("root").alias("further"))
        then = saved(now.join(ahead, "root", "left").select("word", F.coalesce("further", "root").alias("root"),
                                                            F.col("further").isNotNull().alias("moved")), "roots")
        if then.filter("moved").isEmpty():
            return then.select("word", "root")
        now = then.select("word", "root")


def variants(vocab: DataFrame, ratio: int = RATIO, **limits) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of a vocabulary (word, n) of distinct words."""
    spark = vocab.sparkSession
    vocab = saved(vocab.select("word", F.col("n").cast("bigint").alias("n")), "vocabulary", keep=True)
    with passing_tables(spark):
        near = near_words(vocab, **limits)
        best = near.groupBy("word").agg(F.count("*").alias("n_near"), F.first("n").alias("n"),
                                        F.min(F.struct((-F.col("other_n")).alias("less"), "other")).alias("b"))
        fits = -F.col("b.less") >= ratio * F.col("n")
        best = saved(best.select("word", "n_near", F.when(fits, F.col("b.other")).alias("form"),
                                 F.when(fits, -F.col("b.less")).alias("form_n")), "forms")
        last = roots(best.filter("form IS NOT NULL"))
        out = vocab.join(best, "word", "left").join(last, "word", "left").select(
            "word", "form", F.coalesce("root", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"), "form_n")
        return saved(out, "variants", keep=True)


def op11_spelling_variants(spark, sf_dir: str) -> DataFrame:
    return variants(vocabulary(table(spark, sf_dir, "documents")))
