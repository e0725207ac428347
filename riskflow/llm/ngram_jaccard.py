"""N-gram Jaccard join by parity sketches.

A document's set is its distinct 5-word shingles. Two documents link when the
Jaccard similarity of their sets is at least ``PERCENT`` / 100, which bounds
their symmetric difference D by (|A| + |B|)(100 - p)/(100 + p).

Two parity sketches are built by XOR-ing hashed tokens:

* a bit sketch of 1024 bits, one bit flipped per token, and one of 8192 bits for
  sets of more than ``LARGE`` tokens. Their Hamming distances are at most D, so
  a larger distance rules a pair out without its sets;
* a word sketch per size band: tokens fall into blocks, and a block's word is
  the XOR of the 64-bit hashes of its tokens. One differing token changes one
  word, so two sets that link differ in at most k = max D words, and a set with
  more than k occupied blocks shares an occupied, unchanged block with every
  partner (pigeonhole). Blocks are joined on (band, block, word); sets near the
  top of a band are also sketched for the next band. A set with too few
  occupied blocks is joined on its single tokens as well.

Blocks that many different sets share ("hot") are not expanded into pairs:

1. A set with c guaranteed common blocks may leave out its c - q most frequent
   ones, and still has q in common with every partner that both keep: either
   one of them is hot, or the pair shows q blocks that are not (q = c / 2).
2. The sets of a hot block that is kept are compared with the block's first
   set and with their neighbour in the block, and the links found give components.
3. Then only sets outside the largest component of such a block are compared
   with the block's sets of other components, behind the bit sketches. Where
   more such pairs are left than there are sets, each set first meets a few of
   about its size, then, over the components that this leaves, ever more; in
   the end no such pair is left uncompared.

So components are exact, and no group is expanded into its pairs. Every pair
is verified on its whole sets. Shuffles carry each block as 5 bytes in columns
per (input batch, bucket); a batch sends a repeated set once.

Documents without words have an empty set and link with nothing. Null doc_id
rows are documents like others; a component's id is its least non-null doc_id.
Rows that repeat a doc_id are documents of their own.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskflow.llm import _text
from riskflow.llm._components import components
from riskflow.llm._tables import buckets, numbered, parts_for, passing_tables, saved

WIDTH = 5
PERCENT = 80
HOT = 8
SKETCH_LONGS, WIDE_LONGS, LARGE = 16, 128, 1500
BAND = 1.7
PER_BUCKET = 1 << 19  # blocks of a bucket, about: what one worker holds
U64 = np.uint64


def band_tops(largest: int) -> np.ndarray:
    """Largest set size of each band."""
    tops, low = [], 1
    while not tops or tops[-1] < largest * 2:
        tops.append(max(low, int(BAND * low)))
        low = tops[-1] + 1
    return np.array(tops, np.int64)


class Shingler:
    """Distinct shingle hashes of the documents of a text chunk."""

    def __init__(self, width: int = WIDTH):
        self.width = width
        self.hasher = _text.SpanHasher()
        self.space = _text.space_table()
        self.lower = _text.lower_table()
        self.place = _text.seeds(width, 5)
        self.short = _text.seeds(width + 1, 9)

    def sets(self, buf, offs):
        """(document index, hash) sorted by both, without repeats."""
        low = self.lower[buf]
        s, e, d = _text.word_spans(low, offs, self.space)
        w = self.hasher.spans(self.hasher.prefix(low), s, e)
        k, n_docs = self.width, len(offs) - 1
        count = np.bincount(d, minlength=n_docs)
        parts_h, parts_d = [], []
        if len(w) >= k:
            h = np.zeros(len(w) - k + 1, U64)
            for j in range(k):
                h += w[j:len(w) - k + 1 + j] * self.place[j]
            whole = d[:len(h)] == d[k - 1:]
            parts_h.append(_text.mix(h[whole]))
            parts_d.append(d[:len(h)][whole])
        few = np.flatnonzero((count > 0) & (count < k))
        if len(few):
            first = np.searchsorted(d, few)
            hs = self.short[count[few]].copy()
            for j in range(k - 1):
                has = count[few] > j
                hs[has] += w[first[has] + j] * self.place[j]
            parts_h.append(_text.mix(hs))
            parts_d.append(few)
        if not parts_h:
            return np.empty(0, np.int64), np.empty(0, U64)
        d = np.concatenate(parts_d)
        h = np.concatenate(parts_h)
        if len(few):
            order = np.argsort(d, kind="stable")
            d, h = d[order], h[order]
        cut = _text.bounds(d)
        for a, b in zip(cut[:-1].tolist(), cut[1:].tolist()):
            h[a:b].sort()
        if len(h):
            new = np.ones(len(h), bool)
            new[1:] = (h[1:] != h[:-1]) | (d[1:] != d[:-1])
            d, h = d[new], h[new]
        return d, h

    @staticmethod
    def nodes(d, h, n_docs):
        """Set size and the two halves of each document's 128-bit set hash."""
        n = np.bincount(d, minlength=n_docs).astype(np.int64)
        hi, lo = np.zeros(n_docs, U64), np.zeros(n_docs, U64)
        cut = _text.bounds(d)
        if len(d):
            at = d[cut[:-1]]
            hi[at] = np.add.reduceat(_text.mix(h ^ U64(0x51)), cut[:-1])
            lo[at] = np.add.reduceat(_text.mix(h ^ U64(0xA7)), cut[:-1])
        return n, _text.mix(hi ^ n.astype(U64)), _text.mix(lo + n.astype(U64))


def bit_sketches(d, h, n_docs, longs=SKETCH_LONGS) -> np.ndarray:
    """One flipped bit a token: ``longs`` longs a document."""
    bit = (_text.mix(h ^ U64(0x3C)) >> U64(32)).astype(np.int64) % (64 * longs)
    odd = np.bincount(d * (64 * longs) + bit, minlength=n_docs * 64 * longs) & 1
    return np.packbits(odd.astype(np.uint8).reshape(n_docs, -1), axis=1).view(">i8").astype(np.int64)


def wide_sketches(d, h, n) -> pa.Array:
    """The wide bit sketches of the large sets; null for others."""
    large = n > LARGE
    number = np.cumsum(large) - 1
    pick = large[d]
    sk = bit_sketches(number[d[pick]], h[pick], int(large.sum()), WIDE_LONGS) if large.any() else np.empty(0, np.int64)
    at = np.concatenate(([0], np.cumsum(large))) * WIDE_LONGS
    return pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(sk.reshape(-1)), mask=pa.array(~large))


def blocks(d, h, n, tops):
    """Word sketches: (document, key, band tag, guaranteed common blocks) of every occupied block."""
    band = np.searchsorted(tops, n)
    top_of = tops[band]
    reach = (n * 100) // PERCENT
    out = []
    for step in (0, 1):
        tag = band + step
        used = (n > 0) & ((step == 0) | (reach > top_of))
        top = tops[tag]
        worst = (2 * top * (100 - PERCENT)) // (100 + PERCENT)
        m = np.where(worst > 0, -(-top // 3), 1)
        pick = used[d]
        dd, hh = d[pick], h[pick]
        if not len(dd):
            continue
        # hashes are sorted within a document, so block numbers are too
        blk = ((hh >> U64(32)) * m[dd].astype(U64)) >> U64(32)
        place = dd.astype(U64) << U64(32) | blk
        cut = _text.bounds(place)[:-1]
        word = np.bitwise_xor.reduceat(_text.mix(hh ^ U64(0xB10C)), cut)
        kd = dd[cut]
        key = _text.mix(word ^ _text.mix(blk[cut] + (tag[kd].astype(U64) << U64(40))))
        full = np.bincount(kd, minlength=len(n))
        k = ((n + np.minimum(top, reach)) * (100 - PERCENT)) // (100 + PERCENT)
        sure = full - k
        out.append((kd, key, (tag[kd] * 2).astype(np.uint16), np.maximum(sure[kd], 0).astype(np.uint32)))
        weak = (sure < 1) & used
        pick = weak[dd]
        if pick.any():
            wd, wh = dd[pick], hh[pick]
            shared = -(-n * PERCENT // 100)
            out.append((wd, _text.mix(wh ^ _text.mix((tag[wd].astype(U64) << U64(41)) + U64(7))),
                        (tag[wd] * 2 + 1).astype(np.uint16), shared[wd].astype(np.uint32)))
    if not out:
        e = np.empty(0, np.int64)
        return e, e.astype(U64), e.astype(np.uint16), e.astype(np.uint32)
    return tuple(np.concatenate(x) for x in zip(*out))


def needed(sure: np.ndarray) -> np.ndarray:
    """How many common blocks of few sets a pair must show: half of the guaranteed ones (the other half may be left out as hot)."""
    return np.maximum(sure // 2, 1)


def _five_bytes(key: np.ndarray) -> bytes:
    return key.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :5].tobytes()


def _from_five(raw: bytes) -> np.ndarray:
    out = np.zeros((len(raw) // 5, 8), np.uint8)
    out[:, :5] = np.frombuffer(raw, np.uint8).reshape(-1, 5)
    return out.reshape(-1).view("<u8").astype(U64)


OWNER = np.dtype([("hi", "<u8"), ("lo", "<u8"), ("tag", "<u2"), ("sure", "<u4")])
HELD = np.dtype([("hi", "<u8"), ("lo", "<u8"), ("tag", "<u2"), ("sure", "<u4"), ("key", "<u8"), ("bucket", "<u4"), ("freq", "<u4")])
KEPT = np.dtype([("key", "<u8"), ("hi", "<u8"), ("lo", "<u8")])


def _dealt(records: np.ndarray, to: np.ndarray):
    """(bucket, records as bytes), one row a bucket."""
    order = np.argsort(to, kind="stable")
    to, records = to[order], records[order]
    cut = _text.bounds(to)
    pairs = [(int(to[a]), records[a:b].tobytes()) for a, b in zip(cut[:-1].tolist(), cut[1:].tolist())] if len(to) else []
    return pa.array([p[0] for p in pairs], pa.int32()), pa.array([p[1] for p in pairs], pa.binary())


def _signatures(width: int):
    def run(batches):
        sh = Shingler(width)
        for batch in batches:
            for first, buf, offs in _text.text_chunks(batch.column("text")):
                d, h = sh.sets(buf, offs)
                n, hi, lo = sh.nodes(d, h, len(offs) - 1)
                sk = bit_sketches(d, h, len(n))
                node = _text.fixed_binary(hi, lo)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(first, len(n)), batch.column("digest").slice(first, len(n)), pa.array(n), node,
                     pa.ListArray.from_arrays(np.arange(0, sk.size + 1, SKETCH_LONGS, dtype=np.int32), pa.array(sk.reshape(-1))),
                     wide_sketches(d, h, n)],
                    ["doc_id", "digest", "n", "node", "sketch", "wide"])
        _text.release()
    return run


def _dealt_blocks(held):
    """One row a bucket: block keys, and the sets that own them, each with its number of keys."""
    to, key, own = (np.concatenate(x) for x in zip(*held))
    order = np.argsort(to, kind="stable")
    to, key, own = to[order], key[order], own[order]
    cut = _text.bounds(to)
    rows = []
    for a, b in zip(cut[:-1].tolist(), cut[1:].tolist()):
        o = own[a:b]
        new = np.ones(b - a, bool)
        new[1:] = o[1:] != o[:-1]
        at = np.flatnonzero(new)
        rows.append((int(to[a]), _five_bytes(key[a:b]), o[at].tobytes(), np.diff(np.append(at, b - a)).astype("<u4").tobytes()))
    return pa.RecordBatch.from_arrays(
        [pa.array([r[0] for r in rows], pa.int32())] + [pa.array([r[i] for r in rows], pa.binary()) for i in (1, 2, 3)],
        ["bucket", "keys", "owners", "counts"])


def _block_rows(width: int, n_buckets: int, largest: int, hold: int = 400_000):
    def run(batches):
        sh, tops = Shingler(width), band_tops(largest)
        seen, held, size = set(), [], 0
        for batch in batches:
            for _, buf, offs in _text.text_chunks(batch.column("text")):
                d, h = sh.sets(buf, offs)
                n, hi, lo = sh.nodes(d, h, len(offs) - 1)
                new = np.zeros(len(n), bool)
                for i, who in enumerate(zip(hi.tolist(), lo.tolist())):
                    if n[i] and who not in seen:
                        seen.add(who)
                        new[i] = True
                pick = new[d]
                d, h = d[pick], h[pick]
                kd, key, tag, sure = blocks(d, h, np.where(new, n, 0), tops)
                if not len(kd):
                    continue
                own = np.zeros(len(kd), OWNER)
                own["hi"], own["lo"], own["tag"], own["sure"] = hi[kd], lo[kd], tag, sure
                held.append((((key >> U64(32)) % U64(n_buckets)).astype(np.int32), key, own))
                size += len(kd)
                if size > hold:  # a task's memory holds this many keys, however large the batch
                    yield _dealt_blocks(held)
                    held, size = [], 0
                if len(seen) > hold:
                    seen = set()
        if held:
            yield _dealt_blocks(held)
        _text.release()
    return run


def _meet(n_buckets: int):
    """Within a bucket: all pairs of blocks with few sets; the sets of hot blocks, dealt by set."""
    def run(key, tab):
        keys = _from_five(b"".join(tab.column("keys").to_pylist()))
        own = np.frombuffer(b"".join(tab.column("owners").to_pylist()), OWNER)
        counts = np.frombuffer(b"".join(tab.column("counts").to_pylist()), "<u4")
        who = np.repeat(np.arange(len(own)), counts)
        order = np.argsort(keys, kind="stable")
        keys, who = keys[order], who[order]
        cut = _text.bounds(keys)
        size = np.diff(cut)
        left, right, hot = [], [], []
        # a set that several batches sent counts once: runs of two or more are few, so sort those by set
        many = np.flatnonzero(size > 1)
        if len(many):
            at = np.concatenate([np.arange(cut[i], cut[i + 1]) for i in many.tolist()])
            k, o = keys[at], own[who[at]]
            order = np.lexsort((o["lo"], o["hi"], k))
            k, o = k[order], o[order]
            new = np.ones(len(k), bool)
            new[1:] = (k[1:] != k[:-1]) | (o["hi"][1:] != o["hi"][:-1]) | (o["lo"][1:] != o["lo"][:-1])
            k, o = k[new], o[new]
            cut = _text.bounds(k)
            size = np.diff(cut)
            for g in range(2, HOT + 1):
                first = cut[:-1][size == g]
                for i in range(g):
                    for j in range(i + 1, g):
                        left.append(first + i)
                        right.append(first + j)
            big = np.flatnonzero(size > HOT)
            if len(big):
                at = np.concatenate([np.arange(cut[i], cut[i + 1]) for i in big.tolist()])
                hot = np.zeros(len(at), HELD)
                for f in OWNER.names:
                    hot[f] = o[f][at]
                hot["key"], hot["bucket"] = k[at], key[0].as_py()
                hot["freq"] = np.repeat(size[big], size[big])
        empty = pa.array([], pa.binary())
        out = []
        if left:
            a, b = np.concatenate(left), np.concatenate(right)
            pair = np.zeros(len(a), [("ah", "<u8"), ("al", "<u8"), ("bh", "<u8"), ("bl", "<u8"), ("tag", "<u2"), ("need", "<u4")])
            pair["ah"], pair["al"], pair["bh"], pair["bl"] = o["hi"][a], o["lo"][a], o["hi"][b], o["lo"][b]
            pair["tag"], pair["need"] = o["tag"][a], needed(np.maximum(o["sure"][a], o["sure"][b]))
            pair, times = np.unique(pair, return_counts=True)
            out.append([pa.nulls(len(pair), pa.int32()), pa.nulls(len(pair), pa.binary()),
                        _text.fixed_binary(pair["ah"], pair["al"]), _text.fixed_binary(pair["bh"], pair["bl"]),
                        pa.array(pair["tag"].astype(np.int32)), pa.array(times.astype(np.int32)), pa.array(pair["need"].astype(np.int32))])
        if len(hot):
            to, raw = _dealt(hot, (hot["hi"] % U64(n_buckets)).astype(np.int32))
            out.append([to, raw] + [pa.nulls(len(to), t) for t in (pa.binary(), pa.binary(), pa.int32(), pa.int32(), pa.int32())])
        if not out:
            none = pa.array([], pa.int32())
            out.append([none, empty, empty, empty, none, none, none])
        names = ["bucket", "held", "a", "b", "tag", "times", "need"]
        tab = pa.concat_tables([pa.Table.from_arrays(x, names) for x in out])
        _text.release()
        return _text.in_slices(tab)
    return run


def _leave_out(n_buckets: int):
    """Per set and band: drop the most frequent hot blocks that it may leave out; deal the rest by block."""
    def run(key, tab):
        r = np.frombuffer(b"".join(tab.column("held").to_pylist()), HELD)
        rank = np.iinfo(np.uint32).max - r["freq"]
        order = np.lexsort((r["key"], r["bucket"], rank, r["tag"], r["lo"], r["hi"]))
        r = r[order]
        group = np.ones(len(r), bool)
        group[1:] = (r["hi"][1:] != r["hi"][:-1]) | (r["lo"][1:] != r["lo"][:-1]) | (r["tag"][1:] != r["tag"][:-1])
        first = np.flatnonzero(group)
        place = np.arange(len(r)) - np.repeat(first, np.diff(np.append(first, len(r))))
        r = r[place >= r["sure"] - np.minimum(r["sure"], needed(r["sure"]))]
        kept = np.zeros(len(r), KEPT)
        kept["key"] = (r["bucket"].astype(U64) << U64(40)) | r["key"]
        kept["hi"], kept["lo"] = r["hi"], r["lo"]
        to, raw = _dealt(kept, (_text.mix(kept["key"]) % U64(n_buckets)).astype(np.int32))
        _text.release()
        return pa.Table.from_arrays([to, raw], ["bucket", "kept"])
    return run


def _lead(key, tab):
    """(block, set, first set of the block, next smaller set of the block)."""
    r = np.frombuffer(b"".join(tab.column("kept").to_pylist()), KEPT)
    r = r[np.lexsort((r["lo"], r["hi"], r["key"]))]
    cut = _text.bounds(r["key"])
    first = np.repeat(cut[:-1], np.diff(cut))
    before = np.maximum(np.arange(len(r)) - 1, first)
    tab = pa.Table.from_arrays(
        [pa.array(r["key"].astype(np.int64))] + [_text.fixed_binary(r["hi"][i], r["lo"][i]) for i in (np.arange(len(r)), first, before)],
        ["block", "node", "lead", "prior"])
    _text.release()
    return _text.in_slices(tab)


def _sets_of(width: int):
    def run(batches):
        sh = Shingler(width)
        for batch in batches:
            for first, buf, offs in _text.text_chunks(batch.column("text")):
                d, h = sh.sets(buf, offs)
                n, hi, lo = sh.nodes(d, h, len(offs) - 1)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("node").slice(first, len(n)), _text.fixed_binary(hi, lo),
                     pa.ListArray.from_arrays(np.concatenate(([0], np.cumsum(n))).astype(np.int32), pa.array(h.view(np.int64)))],
                    ["node", "found", "shingles"])
        _text.release()
    return run


def _apart(x: str, y: str):
    """Hamming distance of the bit sketches of two aliases."""
    return sum((F.bit_count(F.col(f"{x}.sketch")[i].bitwiseXOR(F.col(f"{y}.sketch")[i])) for i in range(SKETCH_LONGS)), F.lit(0))


def _near(x: str, y: str):
    """Sizes and bit sketches allow the pair."""
    nx, ny = F.col(f"{x}.n"), F.col(f"{y}.n")
    return ((F.least(nx, ny) * 100 >= F.greatest(nx, ny) * PERCENT)
            & (_apart(x, y) * (100 + PERCENT) <= (nx + ny) * (100 - PERCENT)))


def _near_wide(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """The pairs (a, b, n_a, n_b, ...) whose wide sketches, where both have one, allow them."""
    large = pairs.filter((F.col("n_a") > LARGE) & (F.col("n_b") > LARGE))
    wide = nodes.filter("wide IS NOT NULL").select("node", "wide")
    apart = F.aggregate(F.zip_with("x.wide", "y.wide", lambda u, v: F.bit_count(u.bitwiseXOR(v))), F.lit(0), lambda s, v: s + v)
    large = large.alias("p").join(wide.alias("x"), F.col("p.a") == F.col("x.node")).join(wide.alias("y"), F.col("p.b") == F.col("y.node"))
    large = large.filter(apart * (100 + PERCENT) <= (F.col("n_a") + F.col("n_b")) * (100 - PERCENT)).select("p.*")
    return pairs.filter((F.col("n_a") <= LARGE) | (F.col("n_b") <= LARGE)).unionByName(large)


class Verifier:
    """Links of candidate pairs (a, b) of sets, by whole shingle sets of one document each."""

    def __init__(self, docs: DataFrame, nodes: DataFrame, width: int, parts: int):
        self.docs, self.nodes, self.width, self.parts = docs, nodes, width, parts

    def near(self, pairs: DataFrame) -> DataFrame:
        """The pairs that sizes and sketches allow, with n and a document of each set."""
        small = self.nodes.select("node", "n", "rep", "sketch")
        near = pairs.alias("p").join(small.alias("x"), F.col("p.a") == F.col("x.node")).join(
            small.alias("y"), F.col("p.b") == F.col("y.node")).filter(_near("x", "y"))
        near = near.select("p.a", "p.b", F.col("x.n").alias("n_a"), F.col("y.n").alias("n_b"),
                           F.col("x.rep").alias("rep_a"), F.col("y.rep").alias("rep_b"))
        return saved(_near_wide(saved(near, "near-narrow", self.parts), self.nodes), "near-pairs", self.parts)

    def links(self, near: DataFrame) -> DataFrame:
        """The pairs of ``near`` that link."""
        need = near.select(F.col("a").alias("node"), F.col("rep_a").alias("rep")).unionByName(
            near.select(F.col("b").alias("node"), F.col("rep_b").alias("rep"))).distinct()
        # the same plan at every size: texts are dealt once, and no id list is broadcast; the digest tells rows of one id apart
        same = F.col("doc_id").eqNullSafe(F.col("rep.doc_id")) & (F.col("digest") == F.col("rep.digest"))
        texts = self.docs.join(need.hint("merge"), same).select("node", "text")
        sets = texts.mapInArrow(_sets_of(self.width), "node binary, found binary, shingles array<bigint>")
        sets = saved(sets.filter("node = found").select("node", "shingles").dropDuplicates(["node"]), "near-sets", self.parts)
        both = near.select("a", "b").join(sets.select(F.col("node").alias("a"), F.col("shingles").alias("sa")), "a").join(
            sets.select(F.col("node").alias("b"), F.col("shingles").alias("sb")), "b")
        both = both.select("a", "b", F.size(F.array_intersect("sa", "sb")).alias("same"), (F.size("sa") + F.size("sb")).alias("total"))
        return saved(both.filter(F.col("same") * 100 >= (F.col("total") - F.col("same")) * PERCENT).select("a", "b"), "near-links", self.parts)


def _across(hot: DataFrame, comp: DataFrame, nodes: DataFrame, tested: DataFrame, verify: Verifier) -> DataFrame:
    """Untested pairs of one hot block and different components that sizes and sketches allow."""
    held = saved(hot.join(comp, "node", "left").select("block", "node", F.coalesce("root", "node").alias("root")), "held", verify.parts)
    sizes = held.groupBy("block", "root").agg(F.count("*").alias("size"))
    main = saved(sizes.groupBy("block").agg(F.max(F.struct("size", "root")).alias("m"), F.count("*").alias("parts"))
                 .filter("parts > 1").select("block", F.col("m.root").alias("main")), "main-parts", verify.parts)
    longs = range(SKETCH_LONGS)
    mixed = held.join(main, "block").join(nodes.select("node", "n", *[F.col("sketch")[i].alias(f"s{i}") for i in longs]), "node")
    mixed = saved(mixed.withColumn("minor", F.col("root") != F.col("main")), "mixed-blocks", verify.parts)
    x, y = mixed.filter("minor").alias("x"), mixed.alias("y")
    apart = sum((F.bit_count(F.col(f"x.s{i}").bitwiseXOR(F.col(f"y.s{i}"))) for i in longs), F.lit(0))
    may = ((F.least("x.n", "y.n") * 100 >= F.greatest("x.n", "y.n") * PERCENT)
           & (apart * (100 + PERCENT) <= (F.col("x.n") + F.col("y.n")) * (100 - PERCENT)))
    rest = x.join(y, (F.col("x.block") == F.col("y.block")) & (F.col("x.root") != F.col("y.root"))
                  & (~F.col("y.minor") | (F.col("x.node") < F.col("y.node"))) & may)
    rest = saved(rest.select(F.col("x.node").alias("a"), F.col("y.node").alias("b")).distinct(), "rest", verify.parts)
    return verify.near(rest.join(tested, ["a", "b"], "left_anti"))


def near_duplicates(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """(doc_id, n_shingles, component_id, node): one row per row of ``docs`` (columns doc_id, text; others are ignored).

    ``node`` identifies the document's set (null for an empty one).
    """
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    docs = docs.withColumn("digest", F.xxhash64("text"))
    sig = saved(docs.mapInArrow(_signatures(width), "doc_id bigint, digest bigint, n bigint, node binary, sketch array<bigint>, wide array<bigint>"), "signatures")
    total, largest, rows = sig.agg(F.sum("n"), F.max("n"), F.count("*")).first()
    parts = parts_for(rows)
    if not total:
        return sig.select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"),
                          F.lit(None).cast("binary").alias("node"))
    n_buckets = buckets(spark, total * 2 // 3, PER_BUCKET)
    sent = docs.select("text").mapInArrow(_block_rows(width, n_buckets, int(largest)), "bucket int, keys binary, owners binary, counts binary")
    met = saved(sent.groupBy("bucket").applyInArrow(_meet(n_buckets), "bucket int, held binary, a binary, b binary, tag int, times int, need int"), "met")
    kept = met.filter("held IS NOT NULL").select("bucket", "held").groupBy("bucket").applyInArrow(
        _leave_out(n_buckets), "bucket int, kept binary")
    hot = saved(kept.groupBy("bucket").applyInArrow(_lead, "block bigint, node binary, lead binary, prior binary"), "hot-blocks", parts)

    nodes = saved(sig.filter("n > 0").groupBy("node").agg(
        F.min(F.struct("doc_id", "digest")).alias("rep"), F.first("n").alias("n"), F.first("sketch").alias("sketch"), F.first("wide").alias("wide")), "nodes", parts)
    pairs = met.filter("a IS NOT NULL").groupBy("a", "b", "tag").agg(F.sum("times").alias("times"), F.max("need").alias("need"))
    pairs = pairs.filter("times >= need").select("a", "b")
    for other in ("lead", "prior"):
        pairs = pairs.unionByName(hot.filter(f"{other} < node").select(F.col(other).alias("a"), F.col("node").alias("b")))
    verify = Verifier(docs, nodes, width, parts)
    now = verify.near(pairs.distinct())
    links = verify.links(now)
    comp = saved(components(links), "components", parts)

    both_ways = lambda t: t.select("a", "b").unionByName(t.select(F.col("b").alias("a"), F.col("a").alias("b")))
    tested, nearest, few = both_ways(now), 2, rows
    while True:
        now = _across(hot, comp, nodes, tested, verify)
        left = now.count()
        if not left:
            break
        if left > few:  # some first: the components that they join leave fewer pairs
            place = F.row_number().over(Window.partitionBy("a").orderBy(F.abs(F.col("n_a") - F.col("n_b")), "b"))
            now = saved(now.withColumn("place", place).filter(F.col("place") <= nearest).drop("place"), "now-pairs", parts)
            nearest *= 8
        more = verify.links(now)
        # the components so far stand for the links so far
        links = comp.select(F.col("root").alias("a"), F.col("node").alias("b")).unionByName(more)
        comp = saved(components(links), "components", parts)
        if left <= few:
            break
        tested = saved(tested.unionByName(both_ways(now)), "tested", parts)

    of = sig.select("doc_id", "n", F.when(F.col("n") > 0, F.col("node")).alias("node"))
    of = of.join(comp, "node", "left").select("doc_id", "n", "node", F.coalesce("root", "node").alias("root"))
    least = saved(of.filter("root IS NOT NULL").groupBy("root").agg(F.min("doc_id").alias("least")), "least", parts)
    return of.join(least, "root", "left").select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(F.col("root").isNull(), F.col("doc_id")).otherwise(F.col("least")).alias("component_id"), "node")


def one_of_each(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """``docs`` with one row of each group: the one with the least doc_id (nulls last); all columns stay.

    Rows with empty sets stay.
    """
    rows, number = numbered(docs, "numbered")
    with passing_tables(docs.sparkSession):
        near = near_duplicates(rows.select(F.col(number).alias("doc_id"), "text"), width)
        named = rows.select(F.col(number).alias("row"), "doc_id").join(near.select(F.col("doc_id").alias("row"), "component_id"), "row")
        best = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")).alias("best")
        stay = named.groupBy("component_id").agg(best).select(F.col("best.row").alias(number))
        stay = saved(stay, "stay", keep=True)
    return rows.join(stay.hint("merge"), number, "left_semi").drop(number)  # one plan at every size


def op1_ngram_jaccard(spark, sf_dir: str) -> DataFrame:
    from riskflow.llm._tables import table
    return near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")
