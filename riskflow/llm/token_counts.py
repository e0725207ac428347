"""Edit-aware token counts.

A document's state is its text and the length and token count of each of its
pre-tokens, the leaves of a segment tree of sums. An edit replaces a span of
code points: the tree finds the last pre-token boundary that the edit cannot
move (a pre-token's end depends on at most two code points after it), the text
is cut into pre-tokens again from there until a boundary meets an old one, and
only these pre-tokens are encoded again; the sums above them are updated.

States are rows (text, lengths, counts), so that a later batch of edits starts
from the table of the last one without encoding any text in full.

The first count looks up each distinct pre-token of a chunk once. Edits of a
document are applied in their order, each to the text that the last one left;
positions beyond the text are moved to its end, and an end before its start is
the start. Null text is empty, a null edit or replacement inserts nothing.
"""

from __future__ import annotations

import unicodedata

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskflow.llm import _text
from riskflow.llm._tables import table

LEAVES = 64
EDITS = "array<struct<start:bigint,end:bigint,text:string>>"
LETTER, NUMBER, BLANK, OTHER = 0, 1, 2, 3


class PreTokens:
    """Pre-tokens of a byte-level vocabulary, and their token counts."""

    LIMIT = 0x30000

    def __init__(self, path: str, pattern: str, keep: int = 1 << 20):
        import regex
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
        self.pattern = regex.compile(pattern)
        self.kinds = np.fromiter(map(self._kind, map(chr, range(self.LIMIT))), np.uint8, self.LIMIT)
        self.hasher = _text.SpanHasher()
        self.keep = keep
        self.seen: dict[str, int] = {}
        self.known, self.count = np.empty(0, np.uint64), np.empty(0, np.int64)

    @staticmethod
    def _kind(c: str) -> int:
        k = unicodedata.category(c)[0]
        return LETTER if k == "L" else NUMBER if k == "N" else BLANK if c.isspace() and c not in "\x1c\x1d\x1e\x1f" else OTHER

    def starts(self, cp: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Where pre-tokens start in code points ``cp``; documents start at ``first`` and never share one."""
        n = len(cp)
        kind = self.kinds[np.minimum(cp, self.LIMIT - 1)]
        edge = np.zeros(n + 1, bool)
        edge[first] = True
        edge[n] = True
        run = edge[:n].copy()
        run[1:] |= kind[1:] != kind[:-1]
        start = run.copy()
        at = np.flatnonzero(run)
        ends = np.append(at[1:], n)
        blank = kind[at] == BLANK
        # a run of blanks before more text gives up its last one, which joins the text if it is a space
        inner = blank & ~edge[ends]
        last = ends[inner] - 1
        start[last] = True
        spaces = last[cp[last] == 32]
        start[spaces + 1] = False
        # 's, 't, 're, 've, 'm, 'll, 'd after anything but a space
        lone = at[(ends - at == 1) & (cp[at] == 39)]
        lone = lone[start[lone]]
        for tail in ("s", "t", "re", "ve", "m", "ll", "d"):
            hit = lone[lone + len(tail) < n]
            for j, c in enumerate(tail, 1):
                hit = hit[(cp[hit + j] == ord(c)) & ~edge[hit + j]]
            start[hit + 1] = False
            rest = hit + len(tail) + 1
            rest = rest[rest < n]
            start[rest[~edge[rest] & (kind[rest] == LETTER)]] = True
            lone = np.setdiff1d(lone, hit)
        return np.flatnonzero(start)

    def chunk(self, buf: np.ndarray, offs: np.ndarray):
        """(lengths in code points, token counts, first pre-token of each document)."""
        lead = np.flatnonzero((buf & 0xC0) != 0x80)
        if not len(lead):
            return np.empty(0, np.int64), np.empty(0, np.int64), np.zeros(len(offs), np.int64)
        raw = buf.tobytes()
        cp = np.frombuffer(raw.decode("utf-8").encode("utf-32-le"), np.uint32)
        first = np.searchsorted(lead, offs[:-1])
        at = self.starts(cp, first[first < len(cp)])
        ends = np.append(at[1:], len(cp))
        bs, be = lead[at], np.append(lead, len(buf))[ends]
        h = self.hasher.spans(self.hasher.prefix(buf), bs, be)
        keys, one, which = np.unique(h, return_index=True, return_inverse=True)
        if len(self.known) > self.keep:
            self.known, self.count = self.known[:0], self.count[:0]
        slot = np.searchsorted(self.known, keys)
        new = np.ones(len(keys), bool)
        inside = slot < len(self.known)
        new[inside] = self.known[slot[inside]] != keys[inside]
        if new.any():
            words = [raw[bs[i]:be[i]].decode("utf-8") for i in one[new].tolist()]
            got = np.fromiter((len(e.ids) for e in self.tokenizer.encode_batch_fast(words, add_special_tokens=False)), np.int64, len(words))
            known, count = np.concatenate([self.known, keys[new]]), np.concatenate([self.count, got])
            order = np.argsort(known, kind="stable")
            self.known, self.count = known[order], count[order]
            slot = np.searchsorted(self.known, keys)
        return ends - at, self.count[slot][which], np.searchsorted(bs, offs)

    def tokens(self, word: str) -> int:
        n = self.seen.get(word)
        if n is None:
            if len(self.seen) > self.keep:
                self.seen.clear()
            n = self.seen[word] = len(self.tokenizer.encode(word, add_special_tokens=False).ids)
        return n


class CountTree:
    """Sums of code points and tokens over blocks of pre-tokens."""

    def __init__(self, lengths, counts):
        self.blocks = [(list(map(int, lengths[i:i + LEAVES])), list(map(int, counts[i:i + LEAVES])))
                       for i in range(0, max(len(lengths), 1), LEAVES)]
        self.size = 1 << (len(self.blocks) - 1).bit_length()
        self.chars, self.tokens = [0] * (2 * self.size), [0] * (2 * self.size)
        for i, (a, b) in enumerate(self.blocks):
            self.chars[self.size + i], self.tokens[self.size + i] = sum(a), sum(b)
        for i in range(self.size - 1, 0, -1):
            self._sum(i)

    def _sum(self, i):
        self.chars[i] = self.chars[2 * i] + self.chars[2 * i + 1]
        self.tokens[i] = self.tokens[2 * i] + self.tokens[2 * i + 1]

    def find(self, place: int) -> tuple[int, int, int]:
        """(block, pre-token in it, its start) of the pre-token that holds code point ``place``, or the place after the last one."""
        if place >= self.chars[1]:
            last = len(self.blocks) - 1
            return last, len(self.blocks[last][0]), self.chars[1]
        i, start = 1, 0
        while i < self.size:
            i *= 2
            if place >= start + self.chars[i]:
                start += self.chars[i]
                i += 1
        block, k = i - self.size, 0
        for n in self.blocks[block][0]:
            if place < start + n:
                break
            start, k = start + n, k + 1
        return block, k, start

    def before(self, block: int, k: int, start: int) -> tuple[int, int, int] | None:
        """The pre-token before a place of ``find``."""
        while k == 0:
            if block == 0:
                return None
            block, k = block - 1, len(self.blocks[block - 1][0])
        return block, k - 1, start - self.blocks[block][0][k - 1]

    def replace(self, first: tuple[int, int], last: tuple[int, int], lengths: list[int], counts: list[int]) -> None:
        """New leaves for those from ``first`` up to, not including, ``last``."""
        (b0, k0), (b1, k1) = first, last
        for b in range(b0, b1 + 1):
            for leaves, new in zip(self.blocks[b], (lengths, counts)):
                a, z = (k0 if b == b0 else 0), (k1 if b == b1 else len(leaves))
                leaves[a:z] = new if b == b0 else []
            i = self.size + b
            self.chars[i], self.tokens[i] = sum(self.blocks[b][0]), sum(self.blocks[b][1])
            while i > 1:
                i //= 2
                self._sum(i)

    def leaves(self):
        return [n for a, _ in self.blocks for n in a], [n for _, b in self.blocks for n in b]


def apply_edit(tree: CountTree, text: str, start: int, end: int, new: str, pre: PreTokens) -> tuple[str, int]:
    """The text after the edit, and how many pre-tokens were encoded for it; ``tree`` follows."""
    start = min(max(start, 0), len(text))
    end = min(max(end, start), len(text))
    after = text[:start] + new + text[end:]
    shift = len(after) - len(text)
    at = tree.find(max(start - 2, 0))
    while at[2] > 0 and at[2] + 2 > start:  # the boundary must lie two code points before the edit
        at = tree.before(*at)
    place, lengths, counts = at[2], [], []
    while place < len(after):
        if place >= start + len(new) and place - shift >= end:
            old = tree.find(place - shift)
            if old[2] == place - shift:
                break
        word = pre.pattern.match(after, place).group()
        lengths.append(len(word))
        counts.append(pre.tokens(word))
        place += len(word)
    tree.replace(at[:2], tree.find(place - shift)[:2] if place < len(after) else tree.find(len(text))[:2], lengths, counts)
    return after, len(lengths)


def _count(path: str, pattern: str):
    def run(batches):
        import os
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        pre = PreTokens(path, pattern)
        for batch in batches:
            for first, buf, offs in _text.text_chunks(batch.column("text")):
                n = len(offs) - 1
                lengths, counts, at = pre.chunk(buf, offs)
                total = np.concatenate(([0], np.cumsum(counts)))
                cut = list(zip(at[:-1].tolist(), at[1:].tolist()))
                pack = lambda x: pa.array([x[a:b].astype("<u4").tobytes() for a, b in cut], pa.binary())
                part = batch.slice(first, n)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(np.diff(at)), pa.array(total[at[1:]] - total[at[:-1]]), pack(lengths), pack(counts)],
                    [*part.schema.names, "n_pretokens", "n_tokens", "lengths", "counts"])
    return run


def _edit(path: str, pattern: str):
    def run(batches):
        import os
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        pre = PreTokens(path, pattern)
        for batch in batches:
            for s in range(0, batch.num_rows, 512):
                part = batch.slice(s, 512)
                out = [[] for _ in range(6)]
                for text, lengths, counts, edits in zip(*(part.column(c).to_pylist() for c in ("text", "lengths", "counts", "edits"))):
                    tree = CountTree(np.frombuffer(lengths or b"", "<u4"), np.frombuffer(counts or b"", "<u4"))
                    text, encoded = text or "", 0
                    for e in edits or []:
                        if e is not None:
                            text, n = apply_edit(tree, text, e["start"] or 0, e["end"] or 0, e["text"] or "", pre)
                            encoded += n
                    a, b = tree.leaves()
                    for x, v in zip(out, (text, len(a), tree.tokens[1], np.array(a, "<u4").tobytes(), np.array(b, "<u4").tobytes(), encoded)):
                        x.append(v)
                new = dict(zip(("text", "n_pretokens", "n_tokens", "lengths", "counts"), out))
                cols = [pa.array(new[c], part.schema.field(c).type) if c in new else part.column(c) for c in part.schema.names]
                yield pa.RecordBatch.from_arrays([*cols, pa.array(out[5], pa.int64())], [*part.schema.names, "n_encoded"])
    return run


def count_tokens(docs: DataFrame, tokenizer: str, pattern: str) -> DataFrame:
    """``docs`` (doc_id, text) with n_pretokens, n_tokens and the tree's leaves; other columns are dropped."""
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return rows.mapInArrow(_count(tokenizer, pattern), "doc_id bigint, text string, n_pretokens bigint, n_tokens bigint, lengths binary, counts binary")


def edited_counts(states: DataFrame, tokenizer: str, pattern: str) -> DataFrame:
    """States after their ``edits`` (``EDITS``), with ``n_encoded``: the pre-tokens that the edits made it encode."""
    schema = ", ".join(f"`{c}` {t}" for c, t in states.dtypes) + ", n_encoded bigint"
    return states.mapInArrow(_edit(tokenizer, pattern), schema)


def sample_edits(text: str = "text", doc_id: str = "doc_id"):
    """Three edits of each document, made from its id and text: a replacement, an insertion, a deletion."""
    h = F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(0))
    n = F.char_length(text)
    place = lambda k: F.pmod(F.floor(h / k), n + 1)
    piece = F.substring(F.col(text), (F.pmod(h, n + 1) + 1).cast("int"), (F.pmod(h, F.lit(13)) + 1).cast("int"))
    edit = lambda a, b, t: F.struct(a.cast("bigint").alias("start"), b.cast("bigint").alias("end"), t.alias("text"))
    return F.array(edit(place(1), place(1) + F.pmod(h, F.lit(9)), piece), edit(place(7), place(7), F.concat(F.lit(" "), piece)),
                   edit(place(11), place(11) + 1 + F.pmod(h, F.lit(5)), F.lit(""))).cast(EDITS)


def op8_token_counts(spark, sf_dir: str) -> DataFrame:
    """Token counts of all documents before and after three edits of each."""
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_50k.json")
    states = count_tokens(table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN)
    states = states.withColumn("edits", sample_edits()).withColumn("tokens_before", F.col("n_tokens"))
    return edited_counts(states, path, public_tokenizers.PATTERN).select(
        "doc_id", F.col("tokens_before").alias("n_tokens"), F.col("n_tokens").alias("n_tokens_edited"), "n_pretokens", "n_encoded")
