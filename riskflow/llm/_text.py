"""Whole texts as byte arrays inside tasks: word spans, span hashes, small helpers.

Arrow batches are walked in chunks of about ``max_bytes`` that end at document
boundaries, so a task's memory is bounded by one chunk or its longest document.
A null text is an empty one.
"""

from __future__ import annotations

import contextlib
import ctypes

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U64 = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (splitmix64)."""
    x = np.asarray(x, dtype=U64)
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def seeds(n: int, salt: int) -> np.ndarray:
    """``n`` fixed pseudo-random odd 64-bit numbers."""
    return mix(np.arange(1, n + 1, dtype=U64) * U64(0x9E3779B97F4A7C15) + U64(salt)) | U64(1)


def text_chunks(col, max_bytes: int = 1 << 20):
    """(first row, bytes, offsets) for runs of rows; null texts become empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if col.null_count:
        col = pc.fill_null(col, "")
    n = len(col)
    if n == 0:
        return
    wide = pa.types.is_large_string(col.type)
    offs = np.frombuffer(col.buffers()[1], np.int64 if wide else np.int32)[col.offset:col.offset + n + 1].astype(np.int64)
    raw = col.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None else np.empty(0, np.uint8)
    i = 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(offs, offs[i] + max_bytes, "right")) - 1)
        yield i, data[offs[i]:offs[j]], offs[i:j + 1] - offs[i]
        i = j


def release() -> None:
    """Give a worker's free memory back: a reused worker would keep its largest group's."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # other C libraries have no malloc_trim
        ctypes.CDLL(None).malloc_trim(0)


def in_slices(tab: pa.Table, rows: int = 20_000) -> pa.Table:
    """The same table in batches of at most ``rows``, so that the JVM never holds a whole group's result as one."""
    return pa.Table.from_batches(tab.to_batches(max_chunksize=rows), tab.schema)


def space_table() -> np.ndarray:
    """True at the bytes that separate words: 0x20 and 0x09 to 0x0D."""
    t = np.zeros(256, bool)
    t[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
    return t


def lower_table() -> np.ndarray:
    """Bytes with A-Z mapped to a-z."""
    t = np.arange(256, dtype=np.uint8)
    t[65:91] += 32
    return t


def word_spans(buf: np.ndarray, offs: np.ndarray, space: np.ndarray):
    """Start, end and document index of each word; words end at document ends."""
    n = len(buf)
    if n == 0:
        e = np.empty(0, np.int64)
        return e, e, e
    sp = space[buf]
    edge = np.zeros(n + 1, bool)
    edge[offs] = True
    before = edge[:n].copy()
    before[1:] |= sp[:-1]
    after = edge[1:].copy()
    after[:-1] |= sp[1:]
    word = ~sp
    starts = np.flatnonzero(word & before)
    ends = np.flatnonzero(word & after) + 1
    return starts, ends, np.searchsorted(offs, starts, "right") - 1


class SpanHasher:
    """64-bit hashes of byte spans from one running sum (multilinear in odd powers)."""

    BASE = 0x9E3779B97F4A7C15 | 1

    def __init__(self):
        self.bytes = seeds(256, 77)
        self.pw = np.empty(0, U64)
        self.inv = np.empty(0, U64)

    def _grow(self, n: int) -> None:
        if n > len(self.pw):
            size = 1 << max(16, int(n).bit_length())
            for name, base in (("pw", self.BASE), ("inv", pow(self.BASE, -1, 1 << 64))):
                p = np.full(size, base, U64)
                p[0] = 1
                setattr(self, name, np.cumprod(p, dtype=U64))

    def prefix(self, buf: np.ndarray) -> np.ndarray:
        self._grow(len(buf) + 1)
        acc = np.zeros(len(buf) + 1, U64)
        np.cumsum(self.bytes[buf] * self.pw[:len(buf)], out=acc[1:], dtype=U64)
        return acc

    def spans(self, acc: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mix((acc[ends] - acc[starts]) * self.inv[starts])


def bounds(keys: np.ndarray) -> np.ndarray:
    """Start of each run of equal neighbours, and the length at the end."""
    if len(keys) == 0:
        return np.zeros(1, np.int64)
    return np.concatenate(([0], np.flatnonzero(keys[1:] != keys[:-1]) + 1, [len(keys)]))


def fixed_binary(*cols: np.ndarray) -> pa.Array:
    """Big-endian 64-bit columns side by side as one binary value a row (ordered as the numbers are)."""
    raw = np.stack(cols, axis=1).astype(">u8").tobytes() if len(cols[0]) else b""
    width = 8 * len(cols)
    return pa.FixedSizeBinaryArray.from_buffers(pa.binary(width), len(cols[0]), [None, pa.py_buffer(raw)]).cast(pa.binary())
