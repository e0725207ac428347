"""Best-fit packing of tokenized documents with a bounded number of open sequences.

A document's tokens are its ids and a closing id 0. Documents longer than a
sequence are cut into full pieces and a last, shorter one; others stay whole.
Packing needs only lengths: each task runs an online best fit over its share of
the pieces, with ``OPEN`` open sequences at most, found by free space in one
bitset. When all are in use and none has room, the fullest closes. Sequences
still open at the end of a task are packed again, as wholes, by fewer tasks, so
that the number of part-filled sequences does not grow with the tasks.

Tokenizing looks up each distinct word of a chunk once: the tokenizer drops
white space, never joins across it nor from an ASCII letter to an ASCII sign,
and lower-cases, so a text's ids are the ids of these parts in order. Chunks in
which a special token might stand are cut at blanks only, with their case.

Null and empty texts have the one token 0. Rows that repeat a doc_id are
documents of their own; null doc_ids pack like others.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskflow.llm import _text
from riskflow.llm._tables import saved, table

LENGTH = 2048
OPEN = 1024
PIECES_PER_TASK = 200_000


class WordTokens:
    """Token ids of whole texts by way of their words."""

    def __init__(self, path: str, keep: int = 1 << 20):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.hasher = _text.SpanHasher()
        # bytes that end a word: ASCII blanks, which the tokenizer drops too
        self.space = _text.space_table()
        self.lower = _text.lower_table()
        code = np.arange(256)
        self.letter = (code >= 97) & (code <= 122)
        self.sign = (code < 128) & ~self.space & ~self.letter & ~((code >= 48) & (code <= 57)) & ~((code >= 65) & (code <= 90))
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for w, i in vocabulary.items() if w.endswith("</w>")]] = True
        self.keep = keep
        self._forget()

    def _forget(self):
        self.known = np.empty(0, np.uint64)
        self.place = np.empty(0, np.int64)
        self.flat = np.empty(0, np.uint32)
        self.first = np.zeros(1, np.int64)

    def _encode(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all words, number of each)."""
        # a word of letters is one unit, whose last id is marked as an end: many words go in one text
        plain = [w.isalpha() for w in words]
        units = [w for w, p in zip(words, plain) if p]
        texts = [" ".join(units[i:i + 1000]) for i in range(0, len(units), 1000)]
        ids = [np.array(e.ids, np.uint32) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        ids = np.concatenate(ids) if ids else np.empty(0, np.uint32)
        ends = np.flatnonzero(self.ends[ids]) + 1
        if len(ends) != len(units):  # a letter that changes kind in lower case
            plain, ends, ids = [False] * len(words), ends[:0], ids[:0]
        rest = [e.ids for e in self.tokenizer.encode_batch_fast([w for w, p in zip(words, plain) if not p], add_special_tokens=False)]
        sizes = np.empty(len(words), np.int64)
        mark = np.array(plain, bool)
        sizes[mark], sizes[~mark] = np.diff(ends, prepend=0), [len(r) for r in rest]
        out = np.empty(int(sizes.sum()), np.uint32)
        of_plain = np.repeat(mark, sizes)
        out[of_plain], out[~of_plain] = ids, np.fromiter((i for r in rest for i in r), np.uint32)
        return out, sizes

    def _learn(self, keys, words):
        ids, sizes = self._encode(words)
        at = len(self.first) - 1
        self.flat = np.concatenate([self.flat, ids])
        self.first = np.concatenate([self.first, self.first[-1] + np.cumsum(sizes)])
        known = np.concatenate([self.known, keys])
        place = np.concatenate([self.place, at + np.arange(len(keys))])
        order = np.argsort(known, kind="stable")
        self.known, self.place = known[order], place[order]

    def _words(self, buf, offs):
        """The bytes to look up (as array and bytes), and start and end of each part."""
        raw = buf.tobytes()
        s, e, _ = _text.word_spans(buf, offs, self.space)
        if b"<|" in raw:
            return buf, raw, s, e
        low = self.lower[buf]
        cut = np.flatnonzero(self.letter[low[:-1]] & self.sign[low[1:]]) + 1
        edge = np.zeros(len(buf) + 1, bool)
        edge[offs] = True
        cut = cut[~edge[cut]]
        # each cut lies within a word: it ends one part and starts another
        return low, low.tobytes(), np.sort(np.concatenate([s, cut])), np.sort(np.concatenate([e, cut]))

    def chunk(self, buf, offs):
        """(ids, offsets) of the documents of a chunk."""
        n = len(offs) - 1
        if not len(buf):
            return np.empty(0, np.uint32), np.zeros(n + 1, np.int64)
        buf, raw, s, e = self._words(buf, offs)
        if not len(s):
            return np.empty(0, np.uint32), np.zeros(n + 1, np.int64)
        h = self.hasher.spans(self.hasher.prefix(buf), s, e)
        keys, one, which = np.unique(h, return_index=True, return_inverse=True)
        if len(self.known) > self.keep:
            self._forget()
        at = np.searchsorted(self.known, keys)
        new = np.ones(len(keys), bool)
        inside = at < len(self.known)
        new[inside] = self.known[at[inside]] != keys[inside]
        if new.any():
            one = one[new]
            self._learn(keys[new], [raw[a:b].decode("utf-8", "replace") for a, b in zip(s[one].tolist(), e[one].tolist())])
            at = np.searchsorted(self.known, keys)
        row = self.place[at][which]
        size = self.first[row + 1] - self.first[row]
        ends = np.cumsum(size)
        gather = np.repeat(self.first[row] - (ends - size), size) + np.arange(ends[-1])
        return self.flat[gather], np.concatenate(([0], ends))[np.searchsorted(s, offs)]


def _pieces(path: str, length: int):
    def run(batches):
        import os
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        words = WordTokens(path)
        for batch in batches:
            for first, buf, offs in _text.text_chunks(batch.column("text")):
                ids, at = words.chunk(buf, offs)
                n = len(offs) - 1
                size = np.diff(at) + 1
                count = -(-size // length)
                doc = np.repeat(np.arange(n), count)
                piece = np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count)
                start = piece * length
                long = np.minimum(size[doc] - start, length)
                crcs = np.empty(len(doc), np.int64)
                end = np.zeros(1, np.uint32).tobytes()
                for i, (k, a, z) in enumerate(zip(doc.tolist(), start.tolist(), long.tolist())):
                    last = a + z == size[k]
                    crc = zlib.crc32(ids[at[k] + a:at[k] + a + z - last].astype("<u4").tobytes())
                    crcs[i] = zlib.crc32(end, crc) if last else crc
                ids_of = batch.column("doc_id").slice(first, n).take(pa.array(doc))
                yield pa.RecordBatch.from_arrays([ids_of, pa.array(piece, pa.int32()), *map(pa.array, (start, long, crcs))],
                                                 ["doc_id", "piece", "start", "length", "ids_crc32"])
    return run


class BestFit:
    """Online best fit with a bounded number of open bins, keyed by free space in a bitset."""

    def __init__(self, length: int, most: int):
        self.length, self.most = length, most
        self.bits = 0  # bit f: some open bin has f free
        self.bins: list[list[int]] = [[] for _ in range(length + 1)]
        self.open = 0
        self.next = 0

    def _take(self, free: int) -> int:
        number = self.bins[free].pop()
        if not self.bins[free]:
            self.bits &= ~(1 << free)
        self.open -= 1
        return number

    def put(self, size: int) -> tuple[int, int]:
        """(bin, offset in it) for an item of ``size``."""
        room = self.bits >> size
        if room:
            free = size + (room & -room).bit_length() - 1
            number = self._take(free)
        else:
            if self.open >= self.most:
                self._take((self.bits & -self.bits).bit_length() - 1)  # the fullest closes
            number, free = self.next, self.length
            self.next += 1
        if free > size:
            self.bins[free - size].append(number)
            self.bits |= 1 << (free - size)
            self.open += 1
        return number, self.length - free


def _pack(length: int, most: int, turn: int):
    """Adds (bin, offset, open_fill): bin numbers of this round and task; open bins may be joined with others'."""
    def run(batches):
        from pyspark import TaskContext

        base = (turn << 56) + (TaskContext.get().partitionId() << 32)
        fit, held = BestFit(length, most), []
        for batch in batches:
            size = batch.column("length").to_pylist()
            put = [fit.put(s) for s in size]
            held.append((batch, put))
        still = {b for group in fit.bins for b in group}
        fill = {b: length - free for free, group in enumerate(fit.bins) for b in group}
        for batch, put in held:
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([base + b for b, _ in put], pa.int64()), pa.array([o for _, o in put], pa.int64()),
                 pa.array([fill[b] if b in still else None for b, _ in put], pa.int64())],
                [*batch.schema.names, "bin", "offset", "open_fill"])
    return run


def _packed_once(rows: DataFrame, key: list[str], length: int, most: int, tasks: int, turn: int) -> DataFrame:
    schema = ", ".join(f"`{c}` {t}" for c, t in rows.dtypes) + ", bin bigint, offset bigint, open_fill bigint"
    dealt = rows.repartition(tasks, F.xxhash64(F.lit(17), *key)).sortWithinPartitions(F.xxhash64(F.lit(3), *key), *key)
    return saved(dealt.mapInArrow(_pack(length, most, turn), schema), "packed")


def document_pieces(docs: DataFrame, tokenizer: str, length: int = LENGTH) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32) of every piece of every row of ``docs``."""
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return docs.mapInArrow(_pieces(tokenizer, length), "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint")


def packed(pieces: DataFrame, length: int = LENGTH, most: int = OPEN) -> DataFrame:
    """``pieces`` with sequence_id and offset; sequence ids are any numbers.

    Rounds of ever fewer tasks join what is left open, down to one task for the
    few thousand open sequences that a handful of tasks leaves.
    """
    key = ["doc_id", "piece", "start", "ids_crc32"]
    count = pieces.count()
    tasks = max(1, -(-count // PIECES_PER_TASK))
    turn = 0
    now = _packed_once(pieces, key, length, most, tasks, turn)
    now = now.select(*pieces.columns, F.col("bin").alias("sequence_id"), "offset", "open_fill")
    while tasks > 1:
        tasks = max(1, -(-tasks * most // PIECES_PER_TASK)) if tasks * most > PIECES_PER_TASK else 1
        again = now.filter("open_fill IS NOT NULL").select("sequence_id", F.col("open_fill").alias("length")).distinct()
        turn += 1
        again = _packed_once(again, ["sequence_id"], length, most, tasks, turn)
        moved = again.select(F.col("sequence_id").alias("was"), F.col("bin").alias("now_id"),
                             F.col("offset").alias("shift"), F.col("open_fill").alias("now_open"))
        left = now.filter("open_fill IS NOT NULL").join(moved, F.col("sequence_id") == F.col("was"))
        left = left.select(*pieces.columns, F.col("now_id").alias("sequence_id"), (F.col("offset") + F.col("shift")).alias("offset"),
                           F.col("now_open").alias("open_fill"))
        now = saved(now.filter("open_fill IS NULL").unionByName(left), "packed-again")
    return now.drop("open_fill")


def pack_documents(docs: DataFrame, tokenizer: str, length: int = LENGTH, most: int = OPEN) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset): one row per piece."""
    return packed(saved(document_pieces(docs, tokenizer, length), "pieces"), length, most)


def op3_best_fit_packing(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
