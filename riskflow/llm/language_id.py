"""Language identification by interpolated Kneser-Ney character models.

Texts are lower-cased; runs of anything but letters become one blank. For each
language a model of order ``ORDER`` gives P(c | h) = max(n(hc) - D, 0) / n(h.)
+ lambda(h) P(c | h'), with raw counts at the highest order and continuation
counts below (Kneser and Ney, 1995). The n-grams of all languages stand in one
sorted array of hashes per order, with a row of log-probabilities (a value for
each language) beside it; n-grams that no language has back off through the
sorted contexts. A text's language is the one with the lowest cross-entropy per
symbol.

A prediction is accepted while its cross-entropy stays below the language's
limit, calibrated on texts that the counts did not see: their 99th percentile,
plus a margin that shrinks with the root of the text's length. ``score`` (0 to
1) is at least 0.5 for accepted texts.

Learning takes about ``DOCS_PER_LANG`` whole labelled documents of each
language, chosen by a hash of doc_id; every document is scored in full. Models
hold ``TOGETHER`` languages each, so that their size grows in proportion to the
languages. A language that would have no documents left for counting gives none
to calibration. Null or letterless texts, and all texts where
nothing was learned, give ``und`` with score 0. Null doc_ids are not learned
from and not held out. Repeated rows give repeated rows.
"""

from __future__ import annotations

import unicodedata
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskflow.llm import _text
from riskflow.llm._tables import table

ORDER = 4
DOCS_PER_LANG = 800
TOGETHER = 256
CALIBRATION_SHARE = 5  # one in so many sampled documents
MARGIN_BITS = 1.0
SHORT_BITS = 12.0
U64 = np.uint64


def held_out(doc_id="doc_id"):
    """True for the documents that are never learned from: crc32 of the id as text is 2 modulo 4."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


class Symbols:
    """Letters and blanks of texts, each document after ORDER - 1 blanks."""

    LIMIT = 0x30000

    def __init__(self):
        self.letter = np.fromiter((unicodedata.category(chr(i))[0] == "L" for i in range(self.LIMIT)), bool, self.LIMIT)
        self.factor = _text.seeds(ORDER, 31)
        self.plus = _text.seeds(2 * ORDER + 2, 37)

    def read(self, texts: list[str]):
        """(symbols, places of the scored ones, their documents, letters of each document)."""
        low = [t.lower() for t in texts]
        size = np.fromiter(map(len, low), np.int64, len(low))
        cp = np.frombuffer("".join(low).encode("utf-32-le", "surrogatepass"), np.uint32)
        doc = np.repeat(np.arange(len(low)), size)
        letter = self.letter[np.minimum(cp, self.LIMIT - 1)]
        keep = letter.copy()
        keep[1:] |= letter[:-1] & (doc[1:] == doc[:-1])
        doc = doc[keep]
        place = np.arange(len(doc)) + (ORDER - 1) * (doc + 1)
        out = np.full(len(doc) + (ORDER - 1) * len(low), 32, U64)
        out[place] = np.where(letter[keep], cp[keep], 32)
        return out, place, doc, np.bincount(doc, weights=letter[keep], minlength=len(low)).astype(np.int64)

    def grams(self, s, place, n):
        """Hash of the n symbols that end at each place."""
        return sum((s[place - j] * self.factor[j] for j in range(n)), self.plus[n])

    def contexts(self, s, place, n):
        """Hash of the n - 1 symbols before each place."""
        return sum((s[place - j] * self.factor[j] for j in range(1, n)), self.plus[ORDER + 1 + n])


def _counts(batches):
    symbols = Symbols()
    for batch in batches:
        langs, texts = batch.column("lang").to_pylist(), batch.column("text").to_pylist()
        for lang in set(langs):
            s, place, _, _ = symbols.read([t for t, g in zip(texts, langs) if g == lang])
            if len(place):
                _, first, n = np.unique(symbols.grams(s, place, ORDER), return_index=True, return_counts=True)
                cols = [s[place[first] - j].tolist() for j in range(ORDER - 1, -1, -1)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(first), pa.string()), pa.array(["".join(map(chr, g)) for g in zip(*cols)], pa.string()), pa.array(n)],
                    ["lang", "gram", "n"])


def kneser_ney(counts: dict[str, dict[str, int]], vocabulary: int | None = None) -> dict:
    """Model arrays from the ORDER-gram counts of each language (general in the languages' number).

    ``vocabulary`` is the number of symbols and one more, by default those of these languages.
    """
    langs = sorted(counts)
    by_order = []  # by order: per language {gram: count}
    for lang in langs:
        top = counts[lang]
        orders = {ORDER: top}
        for n in range(ORDER - 1, 0, -1):
            orders[n] = Counter(g[1:] for g in orders[n + 1])  # distinct left neighbours
        by_order.append(orders)
    vocabulary = vocabulary or len({g for o in by_order for g in o[1]}) + 1
    weights = []  # by language, order: (discount, {context: (total, lambda)})
    for o in by_order:
        of = {}
        for n in range(1, ORDER + 1):
            ones, twos = sum(c == 1 for c in o[n].values()), sum(c == 2 for c in o[n].values())
            d = min(max(ones / (ones + 2 * twos), 0.1), 0.9) if ones else 0.5
            total, kinds = defaultdict(int), defaultdict(int)
            for g, c in o[n].items():
                total[g[:-1]] += c
                kinds[g[:-1]] += 1
            of[n] = d, {h: (t, d * kinds[h] / t) for h, t in total.items()}
        weights.append(of)

    symbols = Symbols.__new__(Symbols)
    symbols.factor, symbols.plus = _text.seeds(ORDER, 31), _text.seeds(2 * ORDER + 2, 37)

    def hashes(grams, n, plus):
        h = np.full(len(grams), plus, U64)
        for j in range(n):
            h += np.fromiter((ord(g[-1 - j]) for g in grams), U64, len(grams)) * symbols.factor[j]
        return h

    unseen = [w[1][1].get("", (0, 1.0))[1] / vocabulary for w in weights]
    model = {"langs": langs, "unseen": np.log2(np.array(unseen, np.float64)), "grams": {}, "logp": {}, "contexts": {}, "logl": {}}
    lower = [defaultdict(lambda u=u: u) for u in unseen]  # P of the order below, by gram
    for n in range(1, ORDER + 1):
        grams = sorted({g for o in by_order for g in o[n]})
        now, p = [], np.empty((len(grams), len(langs)))
        for i, (o, w) in enumerate(zip(by_order, weights)):
            d, of = w[n]
            mine = {}
            for r, g in enumerate(grams):
                below = lower[i][g[1:]] if n > 1 else 1.0 / vocabulary
                if (tl := of.get(g[:-1])) is not None:
                    below = max(o[n].get(g, 0) - d, 0.0) / tl[0] + tl[1] * below
                mine[g] = p[r, i] = below
            now.append(mine)
        lower = now
        contexts = sorted({h for w in weights for h in w[n][1]})
        back = np.array([[w[n][1].get(h, (0, 1.0))[1] for w in weights] for h in contexts]).reshape(len(contexts), len(langs))
        gh = hashes(grams, n, symbols.plus[n])
        # a context is the gram's symbols before its last: shift by one place
        ch = np.full(len(contexts), symbols.plus[ORDER + 1 + n], U64)
        for j in range(1, n):
            ch += np.fromiter((ord(h[-j]) for h in contexts), U64, len(contexts)) * symbols.factor[j]
        go, co = np.argsort(gh), np.argsort(ch)
        model["grams"][n], model["logp"][n] = gh[go], np.log2(p[go]).astype(np.float32)
        model["contexts"][n], model["logl"][n] = ch[co], np.log2(np.maximum(back[co], 1e-12)).astype(np.float32)
    return model


class Identifier:
    def __init__(self, model: dict):
        self.m = model
        self.symbols = Symbols()

    @staticmethod
    def _find(keys, table):
        at = np.minimum(np.searchsorted(table, keys), max(len(table) - 1, 0))
        return at, table[at] == keys if len(table) else np.zeros(len(keys), bool)

    def _logp(self, s, place, n):
        """log2 P of each place's symbol, by language."""
        if n == 0:
            return np.broadcast_to(self.m["unseen"].astype(np.float32), (len(place), len(self.m["langs"])))
        at, hit = self._find(self.symbols.grams(s, place, n), self.m["grams"][n])
        out = self.m["logp"][n][at]
        miss = np.flatnonzero(~hit)
        if len(miss):
            rest = place[miss]
            low = self._logp(s, rest, n - 1)
            if n > 1:  # the vocabulary's share is within "unseen"
                at, hit = self._find(self.symbols.contexts(s, rest, n), self.m["contexts"][n])
                low = low + np.where(hit[:, None], self.m["logl"][n][at], np.float32(0))
            out[miss] = low
        return out

    def entropies(self, texts: list[str]):
        """(bits per symbol by language, symbols, letters) of each text."""
        s, place, doc, letters = self.symbols.read(texts)
        n = np.bincount(doc, minlength=len(texts))
        h = np.zeros((len(texts), len(self.m["langs"])))
        if len(place):
            logp = self._logp(s, place, ORDER)
            cut = _text.bounds(doc)[:-1]
            h[doc[cut]] = -np.add.reduceat(logp.astype(np.float64), cut, axis=0)
        return h / np.maximum(n, 1)[:, None], n, letters


def _groups(texts, most=1 << 18):
    """Runs of texts of about ``most`` characters."""
    start = size = 0
    for i, t in enumerate(texts):
        if size and size + len(t) > most:
            yield start, i
            start, size = i, 0
        size += len(t)
    if len(texts):
        yield start, len(texts)


def _predict(shared):
    def run(batches):
        model = shared.value
        idents, limits = [Identifier(m) for m in model["models"]], model.get("limits")
        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            for a, b in _groups(texts):
                h, n, letters = zip(*(ident.entropies(texts[a:b]) for ident in idents))
                h, n, letters = np.concatenate(h, axis=1), n[0], letters[0]
                best = np.argmin(h, axis=1)
                bits = h[np.arange(b - a), best]
                root = np.sqrt(np.maximum(n, 1))
                apart = (h - bits[:, None]) * root[:, None]
                sure = 1 / np.sum(2.0 ** -np.minimum(apart, 60), axis=1)
                over = bits - limits[best] - SHORT_BITS / root if limits is not None else np.zeros(b - a)
                fits = 1 / (1 + 2.0 ** np.clip(4 * over, -60, 60))
                score = np.where(over <= 0, 0.5 + 0.5 * np.minimum(sure, 2 * fits - 1), np.minimum(fits, 0.4999))
                known = letters > 0
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(a, b - a),
                     pa.array([model["langs"][i] if k else "und" for i, k in zip(best.tolist(), known.tolist())], pa.string()),
                     pa.array(np.where(known, score, 0.0)), pa.array(np.where(known, bits, 0.0)), pa.array(n.astype(np.int64))],
                    ["doc_id", "lang_pred", "score", "bits", "symbols"])
        _text.release()
    return run


OUT = "doc_id bigint, lang_pred string, score double, bits double, symbols bigint"


def learn(docs: DataFrame, docs_per_lang: int = DOCS_PER_LANG) -> dict | None:
    """Model of the labelled, not held-out rows of ``docs`` (doc_id, text, lang); None if there are none."""
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"),
                       F.col("lang").cast("string").alias("lang"))
    rows = rows.filter(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & ~held_out())
    sizes = rows.groupBy("lang").count().collect()  # a row for each language
    if not sizes:
        return None
    share = spark.createDataFrame([(r["lang"], min(1.0, docs_per_lang / r["count"])) for r in sizes], "lang string, share double")
    draw = F.shiftrightunsigned(F.xxhash64(F.lit(5), "doc_id"), 11) / float(1 << 53)
    sample = rows.join(F.broadcast(share), "lang").filter((draw < F.col("share")) & F.col("text").isNotNull())
    check = F.pmod(F.xxhash64(F.lit(6), "doc_id"), F.lit(CALIBRATION_SHARE)) == 0
    counts: dict[str, dict[str, int]] = {}

    def count(some: DataFrame):
        grams = some.select("lang", "text").mapInArrow(_counts, "lang string, gram string, n bigint")
        got = grams.groupBy("lang", "gram").agg(F.sum("n").alias("n")).toArrow()
        for lang, gram, n in zip(*(got.column(c).to_pylist() for c in ("lang", "gram", "n"))):
            counts.setdefault(lang, {})[gram] = n

    count(sample.filter(~check))
    # languages with nothing outside the calibration texts are counted from all their texts
    if left := sorted({r["lang"] for r in sizes} - counts.keys()):
        count(sample.filter(F.col("lang").isin(left)))
        check &= ~F.col("lang").isin(left)
    if not counts:
        return None
    langs, vocabulary = sorted(counts), len({g[-1] for of in counts.values() for g in of}) + 1
    model = {"langs": langs, "models": [kneser_ney({g: counts[g] for g in langs[i:i + TOGETHER]}, vocabulary) for i in range(0, len(langs), TOGETHER)]}
    shared = spark.sparkContext.broadcast(model)
    seen = sample.filter(check).select("doc_id", "text").mapInArrow(_predict(shared), OUT).filter("symbols > 0")
    seen = seen.groupBy("lang_pred").agg(F.percentile_approx(F.col("bits") - SHORT_BITS / F.sqrt("symbols"), 0.99, 10000).alias("high")).collect()
    high = {r["lang_pred"]: r["high"] for r in seen}
    # without calibration texts: the entropy of a uniform choice, which accepts any text of known letters
    model["limits"] = np.array([high.get(g, np.log2(30)) + MARGIN_BITS for g in model["langs"]])
    return model


def identified(docs: DataFrame, model: dict | None) -> DataFrame:
    """(doc_id, lang_pred, score, bits, symbols): one row per row of ``docs``."""
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    if model is None:
        return rows.select("doc_id", F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"), F.lit(0.0).alias("bits"), F.lit(0).cast("bigint").alias("symbols"))
    return rows.mapInArrow(_predict(docs.sparkSession.sparkContext.broadcast(model)), OUT)


def _accept(shared, name):
    def run(batches):
        predict = _predict(shared)
        for batch in batches:
            pair = pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64()), batch.column(name)], ["doc_id", "text"])
            score = pa.concat_arrays([p.column("score") for p in predict([pair])]) if batch.num_rows else pa.array([], pa.float64())
            yield batch.filter(pa.array(score.to_numpy() >= 0.5))
    return run


def accepted(docs: DataFrame, model: dict | None) -> DataFrame:
    """The rows of ``docs`` whose language is accepted, with all their columns; all rows where nothing was learned."""
    if model is None:
        return docs
    return docs.mapInArrow(_accept(docs.sparkSession.sparkContext.broadcast(model), "text"), docs.schema)


def op5_language_id(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return identified(docs, learn(docs)).select("doc_id", held_out().alias("held_out"), "lang_pred", "score", "bits", "symbols")
