"""Secret scan: fixed patterns, and guess-cost scoring of credential-context values.

Base kinds, leftmost and non-overlapping within a kind, judged on whole texts:

* ``assign``: a credential word, a separator and a value of 8 or more characters;
* ``access``: ``AKIA`` and capitals or digits, 16 or more characters in all;
* ``hex``: 32 or more lower-case hex digits.

A match that is too short is dropped after matching. ``guess`` spans are added
to them and never replace one: values that stand in a wider credential context
and would cost a password guesser at least ``MIN_BITS`` bits. The cost is the
least over all segmentations of the value into common words (by rank, with
case and look-alike characters), dates, repeats, keyboard walks or character
sequences, and brute-force spans; it is found by dynamic programming over the
value's characters in time linear in its length.

Spans count code points, end exclusive, and cover the whole match (``guess``:
the value). Null and empty texts have none. Each row of the input gives one row.
"""

from __future__ import annotations

import hashlib
import math
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskflow.llm import _text

MIN_BITS = 36.0
LENGTH_BITS = 4.0  # for the length of a repeat or sequence
MASK = "[SECRET]"
KINDS = ("assign", "access", "hex", "guess")

ASSIGN = rb"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
CONTEXT = (rb"""(?i:pass(?:word|wd|phrase|code)?|pwd|secret|token|api[_-]?key|private[_-]?key|access[_-]?key|credentials?"""
           rb"""|authorization)["']?\x20*(?:=>|:=|[:=])\x20*(?:(?i:bearer|basic)\x20+)?["']?([^\x00-\x20"'`<>,;]{6,})""")

# Common password words, most common first.
COMMON = """password qwerty dragon monkey letmein football baseball master welcome login admin princess sunshine shadow
superman michael jordan hunter ranger batman trustno killer soccer hockey charlie jennifer thomas summer winter spring
autumn secret access mustang jessica pepper daniel george computer internet love hello freedom whatever cookie flower
silver golden purple orange banana cheese coffee test guest root user pass default change changeme example sample demo
public private server database system service client token value string null none true false your here insert placeholder
the and for you not with this that from have will home work time year people first last name city house water world
green black white blue red money power music magic happy lucky tiger eagle lion horse star moon fire ice""".split()
KEY_ROWS = ("`1234567890-=", "qwertyuiop[]\\", "asdfghjkl;'", "zxcvbnm,./")
LOOKS = str.maketrans({"4": "a", "@": "a", "3": "e", "1": "l", "0": "o", "$": "s", "5": "s", "7": "t", "!": "i"})


class GuessCost:
    """Bits to guess a value: the cheapest segmentation."""

    def __init__(self):
        self.rank = {w: i + 2 for i, w in enumerate(COMMON)}
        self.longest = max(map(len, COMMON))
        self.near = {}
        for r, row in enumerate(KEY_ROWS):
            for i, c in enumerate(row):
                self.near[c] = {row[j] for j in (i - 1, i + 1) if 0 <= j < len(row)}
                for other in (r - 1, r + 1):
                    if 0 <= other < len(KEY_ROWS):
                        self.near[c] |= set(KEY_ROWS[other][max(0, i - 1):i + 2])

    @staticmethod
    def _class_bits(value: str) -> float:
        size = (26 * any("a" <= c <= "z" for c in value) + 26 * any("A" <= c <= "Z" for c in value)
                + 10 * any("0" <= c <= "9" for c in value) + 33 * any(c.isascii() and not c.isalnum() for c in value)
                + 100 * any(not c.isascii() for c in value))
        if value and all(c in "0123456789abcdef" for c in value):
            size = 16
        return math.log2(max(size, 2))

    @staticmethod
    def _date_bits(s: str) -> float | None:
        parts = re.fullmatch(r"(\d{4})[-/._]?(\d{1,2})[-/._]?(\d{1,2})|(\d{1,2})[-/._]?(\d{1,2})[-/._]?(\d{4}|\d{2})", s)
        if not parts:
            return None
        y, m, d, d2, m2, y2 = parts.groups()
        y, m, d = int(y or y2), int(m or m2), int(d or d2)
        if m > 12:
            m, d = d, m
        if not (1 <= m <= 12 and 1 <= d <= 31) or (y >= 100 and not 1900 <= y <= 2099):
            return None
        return math.log2(365 * 120) + (2 if re.search(r"\D", s) else 0)

    def bits(self, value: str) -> float:
        n, each = len(value), self._class_bits(value)
        low = value.lower()
        plain = low.translate(LOOKS) if len(low) == n else low
        if len(low) != n:  # a letter whose lower case is longer
            low = plain = value
        best = [0.0] * (n + 1)
        # runs by (cost of the first character, of each further one): repeat, keyboard walk, up, down
        start = (1 + each + LENGTH_BITS, 1 + math.log2(47), 2 + each + LENGTH_BITS, 2 + each + LENGTH_BITS)
        step = (0.0, 1.5, 0.0, 0.0)
        runs = [[math.inf] * 3 for _ in start]  # the least cost with a run of 1, 2, 3 or more characters that ends here
        for j in range(1, n + 1):
            i = j - 1
            if i:
                diff = ord(low[i]) - ord(low[i - 1])
                goes_on = (value[i] == value[i - 1], low[i] in self.near.get(low[i - 1], ()), diff == 1, diff == -1)
            else:
                goes_on = (False,) * 4
            cost = best[i] + each
            for run, on, s, t in zip(runs, goes_on, start, step):
                run[:] = [best[i] + s, run[0] + t, min(run[1:]) + t] if on else [best[i] + s, math.inf, math.inf]
                cost = min(cost, run[2])
            for k in range(3, min(self.longest, j) + 1):
                bits = self._word_bits(value[j - k:j], low[j - k:j], plain[j - k:j])
                if bits is not None:
                    cost = min(cost, best[j - k] + bits)
            if "0" <= value[i] <= "9":
                for k in (6, 8, 10):
                    if j >= k and (date := self._date_bits(value[j - k:j])) is not None:
                        cost = min(cost, best[j - k] + 1 + date)
            best[j] = cost
        return best[n]

    def _word_bits(self, seen: str, low: str, plain: str) -> float | None:
        if (r := self.rank.get(low)) is not None:
            extra = 0.0
        elif (r := self.rank.get(plain)) is not None:
            extra = 2.0
        else:
            return None
        if seen != low:
            extra += 1.0 if seen[0].isupper() and seen[1:] == low[1:] or seen.isupper() else len(seen) / 2
        return 1 + math.log2(r) + extra


class Scanner:
    """Spans of one document's bytes."""

    def __init__(self, min_bits: float = MIN_BITS):
        self.min_bits = min_bits
        self.assign, self.context = re.compile(ASSIGN), re.compile(CONTEXT)
        self.access, self.hex = re.compile(rb"AKIA[A-Z0-9]+"), re.compile(rb"[0-9a-f]{32,}")
        self.cost = GuessCost()

    def candidates(self, buf: np.ndarray, offs: np.ndarray) -> np.ndarray:
        """Documents of a chunk that can hold a span."""
        raw = buf.tobytes()
        hits = [np.flatnonzero((buf == 0x3A) | (buf == 0x3D))]
        # matches may overlap: one that runs over a border must not hide the next document's
        hits.append(np.array([m.start() for m in re.finditer(rb"(?=AKIA)", raw)], np.int64))
        docs = [np.searchsorted(offs, np.concatenate(hits), "right") - 1]
        for m in self.hex.finditer(raw):  # may run over a border: all documents that it touches
            docs.append(np.arange(np.searchsorted(offs, m.start(), "right") - 1, np.searchsorted(offs, m.end() - 1, "right")))
        return np.unique(np.concatenate(docs))

    def spans(self, raw: bytes) -> list[tuple[int, int, int]]:
        """(start, kind index, end) in code points, sorted."""
        found = [(m.start(), 0, m.end()) for m in self.assign.finditer(raw) if len(m[2]) >= 8]
        found += [(m.start(), 1, m.end()) for m in self.access.finditer(raw) if m.end() - m.start() >= 16]
        found += [(m.start(), 2, m.end()) for m in self.hex.finditer(raw)]
        for m in self.context.finditer(raw):
            value = m[1].rstrip(b".:!?)]}")
            if len(value) >= 6 and self.cost.bits(value.decode("utf-8", "replace")) >= self.min_bits:
                found.append((m.start(1), 3, m.start(1) + len(value)))
        if found:
            lead = np.concatenate(([0], np.cumsum((np.frombuffer(raw, np.uint8) & 0xC0) != 0x80)))
            found = sorted((int(lead[a]), k, int(lead[b])) for a, k, b in found)
        return found


def _line(spans) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


def _scan(min_bits: float):
    def run(batches):
        scanner = Scanner(min_bits)
        for batch in batches:
            for first, buf, offs in _text.text_chunks(batch.column("text")):
                n = len(offs) - 1
                lines, base, counts = [""] * n, [hashlib.sha256(b"").hexdigest()] * n, np.zeros((4, n), np.int64)
                for i in scanner.candidates(buf, offs).tolist():
                    if spans := scanner.spans(buf[offs[i]:offs[i + 1]].tobytes()):
                        lines[i] = _line(spans)
                        base[i] = hashlib.sha256(_line([s for s in spans if s[1] < 3]).encode()).hexdigest()
                        for _, k, _ in spans:
                            counts[k, i] += 1
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(first, n), *map(pa.array, counts), pa.array(base, pa.string()), pa.array(lines, pa.string())],
                    ["doc_id", "n_assign", "n_access", "n_hex", "n_guess", "base_sha256", "spans"])
    return run


def _mask(name: str, size: str | None, min_bits: float):
    def run(batches):
        scanner = Scanner(min_bits)
        for batch in batches:
            for first, buf, offs in _text.text_chunks(batch.column(name)):
                n = len(offs) - 1
                part = batch.slice(first, n)
                changed = {}
                for i in scanner.candidates(buf, offs).tolist():
                    raw = buf[offs[i]:offs[i + 1]].tobytes()
                    if spans := scanner.spans(raw):
                        text, out, at = raw.decode("utf-8"), [], 0
                        for a, _, b in spans:
                            if a >= at:
                                out += [text[at:a], MASK]
                            at = max(at, b)
                        changed[i] = "".join(out) + text[at:]
                if changed:
                    texts = part.column(name).to_pylist()
                    for i, text in changed.items():
                        texts[i] = text
                    cols = {c: part.column(c) for c in part.schema.names}
                    cols[name] = pa.array(texts, part.schema.field(name).type)
                    if size:
                        lengths = part.column(size).to_pylist()
                        for i, text in changed.items():
                            lengths[i] = len(text)
                        cols[size] = pa.array(lengths, part.schema.field(size).type)
                    part = pa.RecordBatch.from_arrays(list(cols.values()), list(cols))
                yield part
    return run


def secret_spans(docs: DataFrame, min_bits: float = MIN_BITS) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text; other columns are ignored): counts by kind, base digest, spans."""
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return docs.mapInArrow(_scan(min_bits), "doc_id bigint, n_assign bigint, n_access bigint, n_hex bigint, "
                                            "n_guess bigint, base_sha256 string, spans string")


def masked(docs: DataFrame, text: str = "text", size: str | None = "n_chars", min_bits: float = MIN_BITS) -> DataFrame:
    """``docs`` with every span replaced by ``MASK`` (overlapping spans by one); ``size``, if there, follows. All columns stay."""
    size = size if size in docs.columns else None
    return docs.mapInArrow(_mask(text, size, min_bits), docs.schema)


def op10_secret_scan(spark, sf_dir: str) -> DataFrame:
    from riskflow.llm._tables import table
    return secret_spans(table(spark, sf_dir, "documents"))
