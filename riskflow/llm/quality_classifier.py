"""Quality scores by positive-unlabelled learning.

A linear model over byte-class pairs and repetition figures of the whole text
minimises the non-negative unbiased risk (Kiryo et al., 2017)

    pi R_p(+1) + max(0, R_u(-1) - pi R_p(-1))

on trusted positives and unlabelled documents. The class prior pi is estimated
as the least ratio of unlabelled to positive tail shares over the scores of a
first model (best-bin estimation), on rows that this model was not fitted to.

Learning takes about ``POSITIVES`` labelled and ``UNLABELLED`` other documents
by a hash of doc_id; every document is scored in full. Null and empty texts
have the features of a text without bytes and get a score like others. Without
positives every score is 0.5. Null doc_ids are not learned from and not held
out; conflicting labels of one doc_id are not trusted.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskflow.llm import _text
from riskflow.llm._tables import table
from riskflow.llm.language_id import held_out

POSITIVES = 2000
UNLABELLED = 4000
THRESHOLD = 0.7
STEPS = 250
SINGLE = b".,;:!?|#$%&*@_-+=/\\\"'()[]{}<>~^`"


class Features:
    """A dense row a document: shares of byte-class pairs, and figures of length and repetition."""

    EXTRA = 7

    def __init__(self):
        classes = np.zeros(256, np.int64)
        for k, (a, b) in enumerate(((97, 123), (65, 91), (48, 58), (32, 33), (10, 11), (128, 256)), start=1):
            classes[a:b] = k
        for k, c in enumerate(SINGLE, start=7):
            classes[c] = k
        self.classes, self.kinds = classes, 7 + len(SINGLE)
        self.width = self.kinds ** 2 + self.EXTRA
        self.space = _text.space_table()
        self.hasher = _text.SpanHasher()

    def rows(self, buf, offs) -> np.ndarray:
        n, k = len(offs) - 1, self.kinds
        out = np.zeros((n, self.width), np.float32)
        size = np.diff(offs).astype(np.float64)
        if len(buf):
            c = self.classes[buf]
            doc = np.repeat(np.arange(n), np.diff(offs))
            same = doc[1:] == doc[:-1]
            code = doc[1:] * k * k + c[:-1] * k + c[1:]
            # in blocks of documents: the counts of one block at a time are wide
            pairs = np.bincount(code[same], minlength=n * k * k).reshape(n, k * k)
            out[:, :k * k] = np.sqrt(pairs / np.maximum(size - 1, 1)[:, None])
        s, e, d = _text.word_spans(buf, offs, self.space)
        words = np.bincount(d, minlength=n).astype(np.float64)
        many = np.maximum(words, 1)
        h = self.hasher.spans(self.hasher.prefix(buf), s, e) if len(s) else np.empty(0, np.uint64)
        order = np.lexsort((h, d))
        new = np.ones(len(h), bool)
        new[1:] = (h[order][1:] != h[order][:-1]) | (d[order][1:] != d[order][:-1])
        distinct = np.bincount(d[order][new], minlength=n)
        again = np.bincount(d[1:][(h[1:] == h[:-1]) & (d[1:] == d[:-1])], minlength=n) if len(h) else np.zeros(n)
        out[:, k * k + 0] = np.log1p(size) / 10
        out[:, k * k + 1] = np.log1p(words) / 10
        out[:, k * k + 2] = distinct / many
        out[:, k * k + 3] = again / many
        out[:, k * k + 4] = np.log1p(np.bincount(d, weights=(e - s).astype(np.float64), minlength=n) / many) / 3
        out[:, k * k + 5] = np.log1p(distinct) / 10
        out[:, k * k + 6] = words > 0
        return out


def _features(batches):
    features = Features()
    for batch in batches:
        for first, buf, offs in _text.text_chunks(batch.column("text"), 1 << 19):
            x = features.rows(buf, offs)
            at = np.arange(0, x.size + 1, x.shape[1], dtype=np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").slice(first, len(x)), pa.ListArray.from_arrays(at, pa.array(x.reshape(-1)))], ["doc_id", "x"])


def _sigmoid(z):
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def fit_linear(p: np.ndarray, u: np.ndarray, prior: float | None, steps: int = STEPS, decay: float = 1e-4) -> np.ndarray:
    """Weights (the last is the intercept): non-negative PU risk, or plain P against U where ``prior`` is None."""
    w, m, v = np.zeros(p.shape[1]), 0.0, 0.0
    for t in range(1, steps + 1):
        gp, gu = _sigmoid(p @ w), _sigmoid(u @ w)
        # logistic loss: d/dz of loss(z, +1) is g - 1, of loss(z, -1) is g
        up, un, uu = p.T @ (gp - 1) / len(p), p.T @ gp / len(p), u.T @ gu / len(u)
        if prior is None:
            grad = up + uu
        else:
            negative = -np.log1p(-np.minimum(gu, 1 - 1e-12)).mean() + prior * np.log1p(-np.minimum(gp, 1 - 1e-12)).mean()
            grad = prior * up + (uu - prior * un) if negative >= 0 else prior * un - uu
        grad = grad + decay * w
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad ** 2
        w = w - 0.05 * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
    return w


def class_prior(p: np.ndarray, u: np.ndarray) -> float:
    """Share of positives in ``u``: least ratio of the shares above a score, with a margin for small samples."""
    cuts = np.unique(p)
    fp = 1 - np.searchsorted(np.sort(p), cuts, "left") / len(p)
    fu = 1 - np.searchsorted(np.sort(u), cuts, "left") / len(u)
    margin = np.sqrt(np.log(40) / (2 * len(u))) + np.sqrt(np.log(40) / (2 * len(p)))
    wide = fp > max(0.2, 2 * margin)
    best = np.argmin(((fu + margin) / fp)[wide]) if wide.any() else None
    return float(np.clip((fu / fp)[wide][best], 0.05, 0.98)) if best is not None else 0.5


def learn(docs: DataFrame, labels: DataFrame, positives: int = POSITIVES, unlabelled: int = UNLABELLED) -> dict | None:
    """Model from trusted positives of ``labels`` (doc_id, quality) and other rows of ``docs`` (doc_id, text); None without positives."""
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = rows.filter(F.col("doc_id").isNotNull() & ~held_out())
    good = labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), "quality").filter("quality IS NOT NULL AND doc_id IS NOT NULL")
    good = good.filter(~held_out()).groupBy("doc_id").agg(F.min("quality").alias("q")).filter("q = 1").select("doc_id")
    draw = F.shiftrightunsigned(F.xxhash64(F.lit(8), "doc_id"), 11) / float(1 << 53)
    n_good, n_rows = good.count(), rows.count()
    if not n_good:
        return None
    # at most about ``positives`` ids: a bound by parameter
    chosen = F.broadcast(good.filter(draw < positives / n_good))
    schema = "doc_id bigint, x array<float>"
    stack = lambda t: np.array(t.column("x").combine_chunks().flatten()).reshape(t.num_rows, -1).astype(np.float64)
    fold = lambda t: np.array(t.column("doc_id")).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(63)
    pt = rows.join(chosen, "doc_id", "left_semi").mapInArrow(_features, schema).orderBy("doc_id", "x").toArrow()
    ut = rows.filter((F.lit(1.0) - draw) < unlabelled / max(n_rows, 1)).mapInArrow(_features, schema).orderBy("doc_id", "x").toArrow()
    if not pt.num_rows or not ut.num_rows:
        return None
    p, u = stack(pt), stack(ut)
    used = (u.std(axis=0) > 0) | (p.std(axis=0) > 0)
    p, u = p[:, used], u[:, used]
    mean, scale = u.mean(axis=0), u.std(axis=0) + 0.01
    one = lambda x: np.hstack([(x - mean) / scale, np.ones((len(x), 1))]).astype(np.float32)
    p, u = one(p), one(u)
    fp, fu = fold(pt) == 0, fold(ut) == 0
    prior = 0.5
    if fp.any() and fu.any() and not fp.all() and not fu.all():
        first = fit_linear(p[fp], u[fu], None)
        prior = class_prior(p[~fp] @ first, u[~fu] @ first)
    w = fit_linear(p, u, prior)
    weights = np.zeros(len(used))
    weights[used] = w[:-1] / scale
    return {"weights": weights, "intercept": float(w[-1] - np.sum(w[:-1] * mean / scale)), "prior": prior}


def _score(shared):
    def run(batches):
        features, model = Features(), shared.value
        for batch in batches:
            for first, buf, offs in _text.text_chunks(batch.column("text"), 1 << 19):
                # a document's sum must not depend on its chunk: one product a row
                x = features.rows(buf, offs)
                z = np.einsum("ij,j->i", x.astype(np.float64), model["weights"]) + model["intercept"]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(first, len(x)), pa.array(_sigmoid(z))], ["doc_id", "score"])
    return run


def scored(docs: DataFrame, model: dict | None) -> DataFrame:
    """(doc_id, score): one row per row of ``docs``."""
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    if model is None:
        return rows.select("doc_id", F.lit(0.5).alias("score"))
    return rows.mapInArrow(_score(docs.sparkSession.sparkContext.broadcast(model)), "doc_id bigint, score double")


def op7_quality_classifier(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    rows = scored(docs, learn(docs, table(spark, sf_dir, "labels")))
    return rows.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
