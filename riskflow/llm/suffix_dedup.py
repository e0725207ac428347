"""Removal of repeated byte strings by a depth-limited radix sort of suffixes.

A byte goes when it is covered by a string of ``LENGTH`` bytes that also starts
anywhere else, in the same document or another; overlaps count, and all strings
are judged on the input. Suffixes need ordering only to that depth: groups that
are still equal there are exactly the repeated strings, and a suffix that is
alone in its group is done. The passes, most significant first:

1. Strings are dealt by an anchor: of the ``LENGTH - GRAM + 1`` grams of
   ``GRAM`` bytes within a string the one with the least hash. Equal strings
   have equal anchors at equal places, and neighbouring strings share theirs, so
   only anchors are shuffled (about one in 46 bytes of prose).
2. Anchors are divided by the hash of their neighbourhood, the at most 300
   bytes that hold all strings with this anchor. A neighbourhood that occurs
   twice is repeated as a whole. An anchor with a single neighbourhood is done.
3. Where an anchor has different neighbourhoods, one of each kind is sorted: its
   up to 101 strings are divided by their first 50 bytes, the next 50, and so
   on to the full depth; strings alone in their group drop out at each pass.
   Anchors with more than ``MANY`` kinds are dealt by whole strings instead, so
   that no anchor's kinds meet in one task.

Groups of copies are combined before shuffles: within an input batch equal
texts are read once and equal neighbourhoods sent once. Texts that occur twice
are repeated as a whole, by their digest. Strings are compared by 64-bit hashes
(within one anchor group in passes 2 and 3), texts by MD5.

Null texts are empty. Texts shorter than ``LENGTH`` lose nothing. Rows are
documents of their own whatever their doc_id.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskflow.llm import _text
from riskflow.llm._tables import buckets, saved, table

LENGTH = 200
GRAM = 100
REACH = LENGTH - GRAM  # bytes of a string before or after its anchor
DIGIT = 50
MANY = 4096
U64 = np.uint64

OWNED = [("hi", "<u8"), ("lo", "<u8")]
SEEN = np.dtype([("key", "<u8"), ("near", "<u8"), *OWNED, ("pos", "<u4"), ("multi", "u1")])
FLAG = np.dtype([*OWNED, ("pos", "<u4"), ("kind", "u1")])
KIND = np.dtype([("key", "<u8"), *OWNED, ("pos", "<u4"), ("multi", "u1"), ("left", "u1"), ("right", "u1"), ("raw", "u1", (LENGTH + REACH,))])
STRING = np.dtype([("key", "<u8"), *OWNED, ("pos", "<u4"), ("multi", "u1")])
SPAN = np.dtype([*OWNED, ("start", "<u4"), ("end", "<u4")])
#: kinds of flags: the neighbourhood is repeated; its strings are to be sorted; by whole strings
WHOLE, SORT, SPREAD = 1, 2, 4


def _least(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum over each run of ``width`` neighbours."""
    span = 1
    while span * 2 <= width:
        x = np.minimum(x[:-span], x[span:])
        span *= 2
    return np.minimum(x[:len(x) - (width - span)], x[width - span:]) if span < width else x


def anchors(hasher, buf, offs):
    """Place, document, gram hash and neighbourhood hash of every anchor of a chunk."""
    n = len(buf)
    empty = np.empty(0, np.int64)
    if n < LENGTH:
        return empty, empty, empty.astype(U64), empty.astype(U64)
    acc = hasher.prefix(buf)
    p = np.arange(n - GRAM + 1)
    g = hasher.spans(acc, p, p + GRAM)
    bits = U64(int(n).bit_length())
    best = _least((g >> bits << bits) | p.astype(U64), REACH + 1)  # ties: the first
    end = np.repeat(offs[1:], np.diff(offs))[:len(best)]
    at = np.unique((best[p[:len(best)] + LENGTH <= end] & U64((1 << int(bits)) - 1)).astype(np.int64))
    doc = np.searchsorted(offs, at, "right") - 1
    low, high = np.maximum(at - REACH, offs[doc]), np.minimum(at + LENGTH, offs[doc + 1])
    near = hasher.spans(acc, low, high) ^ _text.mix((at - low).astype(U64) * U64(1009) + (high - at).astype(U64))
    return at, doc, g[at], near


def _digests(buf, offs):
    raw = [hashlib.md5(buf[a:b]).digest() for a, b in zip(offs[:-1].tolist(), offs[1:].tolist())]
    both = np.frombuffer(b"".join(raw), ">u8").reshape(-1, 2).astype(U64)
    return both[:, 0], both[:, 1]


def _rows(to, records, *names):
    """One row a bucket: (bucket, records in the first named column, null in the others)."""
    order = np.argsort(to, kind="stable")
    to, records = to[order], records[order]
    cut = _text.bounds(to)
    parts = list(zip(cut[:-1].tolist(), cut[1:].tolist())) if len(to) else []
    first = [pa.array([int(to[a]) for a, _ in parts], pa.int32()), pa.array([records[a:b].tobytes() for a, b in parts], pa.binary())]
    return pa.RecordBatch.from_arrays(first + [pa.nulls(len(parts), pa.binary()) for _ in names[1:]], ["bucket", *names])


def _joined(tab, name, dtype):
    return np.frombuffer(b"".join(x for x in tab.column(name).to_pylist() if x), dtype)


def _anchor_rows(n_buckets: int):
    def run(batches):
        hasher = _text.SpanHasher()
        for batch in batches:
            times: dict = {}
            held = []
            for _, buf, offs in _text.text_chunks(batch.column("text")):
                hi, lo = _digests(buf, offs)
                new = []
                for i, who in enumerate(zip(hi.tolist(), lo.tolist())):
                    times[who] = times.get(who, 0) + 1
                    if times[who] == 1:
                        new.append(i)
                at, doc, g, near = anchors(hasher, buf, offs)
                pick = np.isin(doc, new)
                at, doc = at[pick], doc[pick]
                r = np.zeros(len(at), SEEN)
                r["key"], r["near"], r["hi"], r["lo"], r["pos"] = g[pick], near[pick], hi[doc], lo[doc], at - offs[doc]
                held.append(r)
            if not held:
                continue
            r = np.concatenate(held)
            many = {who for who, k in times.items() if k > 1}
            if many:
                r["multi"] = np.fromiter(((a, b) in many for a, b in zip(r["hi"].tolist(), r["lo"].tolist())), bool, len(r))
            r = r[np.lexsort((r["near"], r["key"]))]
            new = np.ones(len(r), bool)
            new[1:] = (r["key"][1:] != r["key"][:-1]) | (r["near"][1:] != r["near"][:-1])
            first = np.flatnonzero(new)
            size = np.diff(np.append(first, len(r)))
            sent = r[first]
            sent["multi"] |= size > 1
            known = np.zeros(len(r) - len(first), FLAG)
            for f in ("hi", "lo", "pos"):
                known[f] = r[f][~new]
            known["kind"] = WHOLE
            yield _rows((sent["key"] >> U64(32)).astype(np.int64) % n_buckets, sent, "seen", "flags")
            yield _rows((known["hi"] % U64(n_buckets)).astype(np.int64), known, "flags", "seen").select(["bucket", "seen", "flags"])
    return run


def _divide(n_buckets: int):
    """Per bucket: flags of the anchors that are repeated as a whole or are to be sorted; dealt by document."""
    def run(key, tab):
        r = _joined(tab, "seen", SEEN)
        r = r[np.lexsort((r["near"], r["key"]))]
        flags = []
        if len(r):
            new_key = np.ones(len(r), bool)
            new_key[1:] = r["key"][1:] != r["key"][:-1]
            new = new_key.copy()
            new[1:] |= r["near"][1:] != r["near"][:-1]
            first, group = np.flatnonzero(new), np.cumsum(new) - 1
            size = np.diff(np.append(first, len(r)))
            repeated = (np.add.reduceat(r["multi"].astype(np.int64), first) + size) > 1
            at = np.flatnonzero(new_key)
            kinds = np.add.reduceat(new.astype(np.int64), at)
            kinds = np.repeat(kinds, np.diff(np.append(at, len(r))))
            kind = np.where(repeated[group], WHOLE, 0).astype(np.uint8)
            kind[new & (kinds > 1)] |= SORT
            kind[new & (kinds > MANY)] |= SPREAD
            pick = kind > 0
            out = np.zeros(int(pick.sum()), FLAG)
            for f in ("hi", "lo", "pos"):
                out[f] = r[f][pick]
            out["kind"] = kind[pick]
            flags.append(out)
        flags.append(_joined(tab, "flags", FLAG))
        out = np.concatenate(flags)
        return pa.Table.from_batches([_rows((out["hi"] % U64(n_buckets)).astype(np.int64), out, "flags")])
    return run


def _by_document(dtype, *fields):
    """(md5, one binary a field) per document of a bucket."""
    def run(key, tab):
        r = _joined(tab, "flags", dtype)
        r = r[np.lexsort((r[fields[0]], r["lo"], r["hi"]))]
        new = np.ones(len(r), bool)
        new[1:] = (r["hi"][1:] != r["hi"][:-1]) | (r["lo"][1:] != r["lo"][:-1])
        first = np.flatnonzero(new)
        ends = np.append(first, len(r))[1:]
        cols = [pa.array([r[f][a:b].tobytes() for a, b in zip(first.tolist(), ends.tolist())], pa.binary()) for f in fields]
        return pa.Table.from_arrays([_text.fixed_binary(r["hi"][first], r["lo"][first]), *cols], ["md5", *fields])
    return run


def _kind_rows(n_buckets: int):
    """The neighbourhoods (or, for anchors with very many kinds, the strings) to be sorted."""
    def run(batches):
        hasher, done = _text.SpanHasher(), set()
        for batch in batches:
            md5, pos_of, kind_of = (batch.column(c).to_pylist() for c in ("md5", "pos", "kind"))
            for first, buf, offs in _text.text_chunks(batch.column("text")):
                acc = hasher.prefix(buf)
                kinds, strings = [], []
                for i in range(len(offs) - 1):
                    who = md5[first + i]
                    if who in done:
                        continue
                    done.add(who)
                    kind = np.frombuffer(kind_of[first + i], np.uint8)
                    pos = np.frombuffer(pos_of[first + i], "<u4").astype(np.int64)
                    hi, lo = np.frombuffer(who, ">u8")
                    a, b = int(offs[i]), int(offs[i + 1])
                    pick = (kind & SORT > 0) & (kind & SPREAD == 0)
                    if pick.any():
                        at = pos[pick] + a
                        r = np.zeros(len(at), KIND)
                        r["key"], r["hi"], r["lo"], r["pos"] = hasher.spans(acc, at, at + GRAM), hi, lo, pos[pick]
                        r["multi"] = kind[pick] & WHOLE
                        r["left"], r["right"] = np.minimum(pos[pick], REACH), np.minimum(b - at, LENGTH)
                        raw = np.zeros(b - a + LENGTH + REACH, np.uint8)
                        raw[REACH:REACH + b - a] = buf[a:b]
                        r["raw"] = raw[(at - a)[:, None] + np.arange(LENGTH + REACH)]
                        kinds.append(r)
                    pick = kind & SPREAD > 0
                    if pick.any():
                        start = (pos[pick][:, None] + np.arange(-REACH, 1)).reshape(-1)
                        multi = np.repeat(kind[pick] & WHOLE, REACH + 1)
                        anchor = np.repeat(hasher.spans(acc, pos[pick] + a, pos[pick] + a + GRAM), REACH + 1)
                        place = np.tile(np.arange(REACH + 1), int(pick.sum())).astype(U64)
                        ok = (start >= 0) & (start + LENGTH <= b - a)
                        r = np.zeros(int(ok.sum()), STRING)
                        r["key"] = hasher.spans(acc, start[ok] + a, start[ok] + a + LENGTH) ^ _text.mix(anchor[ok] + place[ok])
                        r["hi"], r["lo"], r["pos"], r["multi"] = hi, lo, start[ok], multi[ok]
                        strings.append(r)
                if kinds:
                    r = np.concatenate(kinds)
                    yield _rows((_text.mix(r["key"]) % U64(n_buckets)).astype(np.int64), r, "kinds", "strings")
                if strings:
                    # equal strings of a chunk: the first stands for all, marked as repeated; the others are repeated
                    r = np.concatenate(strings)
                    r = r[np.argsort(r["key"], kind="stable")]
                    cut = _text.bounds(r["key"])
                    size = np.diff(cut)
                    lone = r[cut[:-1]]
                    lone["multi"] |= size > 1
                    sent = [lone]
                    if (size > 1).any():
                        rest = np.ones(len(r), bool)
                        rest[cut[:-1]] = False
                        own = r[rest & (r["multi"] == 0)]
                        own["multi"] = 2  # known to be repeated, and not to be counted
                        sent.append(own)
                        mine = lone[(size > 1) & (r["multi"][cut[:-1]] == 0)]
                        mine["multi"] = 2
                        sent.append(mine)
                    r = np.concatenate(sent)
                    yield _rows((r["key"] >> U64(20)).astype(np.int64) % n_buckets, r, "strings", "kinds").select(["bucket", "kinds", "strings"])
    return run


class Depth:
    """Most-significant-digit passes over the strings of neighbourhoods."""

    def __init__(self):
        width = LENGTH + REACH
        self.bytes = _text.seeds(256, 91)
        powers = np.full((2, width), [[_text.SpanHasher.BASE], [pow(_text.SpanHasher.BASE, -1, 1 << 64)]], U64)
        powers[:, 0] = 1
        self.pw, self.inv = np.cumprod(powers, axis=1, dtype=U64)

    def repeated(self, r: np.ndarray):
        """(row, first and last place of its repeated strings) for rows sorted by key."""
        acc = np.zeros((len(r), LENGTH + REACH + 1), U64)
        np.cumsum(self.bytes[r["raw"]] * self.pw, axis=1, out=acc[:, 1:], dtype=U64)
        digit = _text.mix((acc[:, DIGIT:] - acc[:, :-DIGIT]) * self.inv[:LENGTH + REACH - DIGIT + 1])
        place = np.arange(REACH + 1)
        valid = (place[None, :] >= REACH - r["left"][:, None].astype(int)) & (place[None, :] <= r["right"][:, None].astype(int) - GRAM)
        row, place = np.nonzero(valid)
        new = np.ones(len(r), np.int64)
        new[1:] = r["key"][1:] != r["key"][:-1]
        group = (np.cumsum(new)[row] * (REACH + 1) + place).astype(U64)
        weight = 1 + r["multi"].astype(np.int64)
        for depth in range(0, LENGTH, DIGIT):
            key = _text.mix(group * U64(0x9E3779B97F4A7C15) ^ digit[row, place + depth])
            order = np.argsort(key)
            row, place, key = row[order], place[order], key[order]
            cut = _text.bounds(key)
            if len(key) == 0:
                break
            size = np.diff(cut)
            stay = np.repeat(np.add.reduceat(weight[row], cut[:-1]) > 1, size)
            group = np.repeat(np.arange(len(size)), size).astype(U64)[stay]
            row, place = row[stay], place[stay]
        want = r["multi"][row] == 0
        row, place = row[want], place[want]
        first, last = np.full(len(r), REACH + 1), np.full(len(r), -1)
        np.minimum.at(first, row, place)
        np.maximum.at(last, row, place)
        hit = np.flatnonzero(last >= 0)
        return hit, first[hit], last[hit]


def _sort_strings(n_buckets: int, slice_rows: int = 2048):
    def run(key, tab):
        out, depth = [], Depth()
        r = _joined(tab, "kinds", KIND)
        if len(r):
            order = np.argsort(r["key"], kind="stable")
            keys = r["key"][order]
            cut = _text.bounds(keys)
            start = 0
            for a, b in zip(cut[:-1].tolist(), cut[1:].tolist()):
                if b - start >= slice_rows or b == len(keys):  # whole groups, so at most MANY more
                    part = r[order[start:b]]
                    hit, first, last = depth.repeated(part)
                    s = np.zeros(len(hit), SPAN)
                    s["hi"], s["lo"] = part["hi"][hit], part["lo"][hit]
                    base = part["pos"][hit].astype(np.int64) - REACH
                    s["start"], s["end"] = base + first, base + last + LENGTH  # these strings overlap: one span
                    out.append(s)
                    start = b
        r = _joined(tab, "strings", STRING)
        if len(r):
            r = r[np.argsort(r["key"], kind="stable")]
            cut = _text.bounds(r["key"])
            counted = np.where(r["multi"] == 2, 0, 1 + (r["multi"] == 1))
            repeated = np.repeat(np.add.reduceat(counted, cut[:-1]) > 1, np.diff(cut))
            r = r[(r["multi"] == 2) | (repeated & (r["multi"] == 0))]
            s = np.zeros(len(r), SPAN)
            s["hi"], s["lo"], s["start"], s["end"] = r["hi"], r["lo"], r["pos"], r["pos"] + LENGTH
            out.append(s)
        out = np.concatenate(out) if out else np.zeros(0, SPAN)
        return pa.Table.from_batches([_rows((out["hi"] % U64(n_buckets)).astype(np.int64), out, "flags")])
    return run


def merged(start: np.ndarray, end: np.ndarray):
    """Maximal runs of the union of spans."""
    order = np.argsort(start, kind="stable")
    start, end = start[order], np.maximum.accumulate(end[order]) if len(end) else end
    new = np.ones(len(start), bool)
    new[1:] = start[1:] > end[:-1]
    first = np.flatnonzero(new)
    return start[first], end[np.append(first[1:], len(end)) - 1] if len(end) else end


def _cut(with_text: bool):
    def run(batches):
        for batch in batches:
            cols = {c: batch.column(c).to_pylist() for c in ("pos", "kind", "start", "end")}
            removed, spans, digests, texts = [], [], [], []
            for first, buf, offs in _text.text_chunks(batch.column("text")):
                for i in range(len(offs) - 1):
                    raw = buf[offs[i]:offs[i + 1]]
                    pos = np.frombuffer(cols["pos"][first + i] or b"", "<u4").astype(np.int64)
                    kind = np.frombuffer(cols["kind"][first + i] or b"", np.uint8)
                    whole = pos[kind & WHOLE > 0]
                    a = np.maximum(whole - REACH, 0)
                    b = np.minimum(whole + LENGTH, len(raw))
                    s = np.concatenate([a, np.frombuffer(cols["start"][first + i] or b"", "<u4").astype(np.int64)])
                    e = np.concatenate([b, np.frombuffer(cols["end"][first + i] or b"", "<u4").astype(np.int64)])
                    s, e = merged(s, e)
                    keep = np.ones(len(raw), bool)
                    for x, y in zip(s.tolist(), e.tolist()):
                        keep[x:y] = False
                    left = raw[keep].tobytes()
                    removed.append(len(raw) - len(left))
                    spans.append(len(s))
                    digests.append(hashlib.sha256(left).hexdigest())
                    if with_text:
                        texts.append(left.decode("utf-8", "replace"))
            out = [batch.column("doc_id"), batch.column("n_bytes"), pa.array(removed, pa.int64()), pa.array(spans, pa.int64()), pa.array(digests, pa.string())]
            yield pa.RecordBatch.from_arrays(out + ([pa.array(texts, pa.string())] if with_text else []),
                                             ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"] + ["kept"] * with_text)
    return run


def repeated_removed(docs: DataFrame, with_text: bool = False) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256): one row per row of ``docs`` (doc_id, text; others are ignored).

    ``with_text`` adds ``kept``, the remaining bytes as text (a cut character becomes U+FFFD).
    """
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    raw = F.col("text").cast("binary")
    md5 = F.unhex(F.md5(raw))
    sig = saved(docs.select("doc_id", F.octet_length("text").cast("bigint").alias("n_bytes"), md5.alias("md5"), F.sha2(raw, 256).alias("sha")), "digests")
    total = sig.agg(F.sum("n_bytes")).first()[0] or 0
    n_buckets = buckets(spark, total // 46)

    read = docs.filter(F.octet_length("text") >= LENGTH)
    seen = read.select("text").mapInArrow(_anchor_rows(n_buckets), "bucket int, seen binary, flags binary")
    flags = seen.groupBy("bucket").applyInArrow(_divide(n_buckets), "bucket int, flags binary")
    flags = saved(flags.groupBy("bucket").applyInArrow(_by_document(FLAG, "pos", "kind"), "md5 binary, pos binary, kind binary"), "flags")

    keyed = read.select(md5.alias("of"), "text")
    kinds = keyed.join(flags, F.col("of") == F.col("md5")).select("md5", "pos", "kind", "text")
    kinds = kinds.mapInArrow(_kind_rows(n_buckets), "bucket int, kinds binary, strings binary")
    spans = kinds.groupBy("bucket").applyInArrow(_sort_strings(n_buckets), "bucket int, flags binary")
    spans = saved(spans.groupBy("bucket").applyInArrow(_by_document(SPAN, "start", "end"), "md5 binary, start binary, end binary"), "spans")

    copies = saved(sig.filter(F.col("n_bytes") >= LENGTH).groupBy("md5").agg(F.count("*").alias("n")).filter("n > 1").select("md5"), "copies")
    marks = flags.join(spans, "md5", "full").join(copies, "md5", "left_anti").select(F.col("md5").alias("of"), "pos", "kind", "start", "end")
    marks = saved(marks, "marks")
    nothing = F.sha2(F.lit(""), 256)
    same = sig.join(copies.withColumn("copied", F.lit(True)), "md5", "left").join(marks.select("of"), F.col("md5") == F.col("of"), "left_anti")
    all_of = F.coalesce("copied", F.lit(False))
    same = same.select("doc_id", "n_bytes", F.when(all_of, F.col("n_bytes")).otherwise(0).alias("n_removed"),
                       F.when(all_of, 1).otherwise(0).cast("bigint").alias("n_spans"),
                       F.when(all_of, nothing).otherwise(F.col("sha")).alias("kept_sha256"), "md5")
    if with_text:
        texts = docs.select(md5.alias("of_text"), F.col("text").alias("kept")).dropDuplicates(["of_text"])
        same = same.join(texts, F.col("md5") == F.col("of_text")).drop("of_text")
        same = same.withColumn("kept", F.when(F.col("n_removed") > 0, "").otherwise(F.col("kept")))
    cut = read.select("doc_id", F.octet_length("text").cast("bigint").alias("n_bytes"), "text", md5.alias("md5")).join(marks, F.col("md5") == F.col("of"))
    schema = "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string"
    cut = cut.select("doc_id", "n_bytes", "text", "pos", "kind", "start", "end").mapInArrow(_cut(with_text), schema + ", kept string" * with_text)
    return same.drop("md5").unionByName(cut)


def op6_suffix_dedup(spark, sf_dir: str) -> DataFrame:
    return repeated_removed(table(spark, sf_dir, "documents"))
