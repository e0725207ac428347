"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

A document's size is its number of words. Sources share a budget by weight; a
target stops at ``MAX_EPOCHS`` times its source's size, and what it leaves is
shared again by weight until no target is above. Each source then gives
complete epochs of all its documents, and the rest of its target by weighted
sampling without replacement: a document's exponential key is -ln(u) / quality,
with u a hash of the document, and the smallest keys are taken until the sizes
reach the budget (Efraimidis and Spirakis, 2006).

The prefix sum over a source's keys never meets in one task: keys are cut into
slices of equal probability, slice sums (aggregated before their shuffle) give
each slice's start, slices before the budget's end are taken whole, and only
the slice in which the budget ends is sorted. Runs agree, since keys depend on
the documents alone.

Null text: size 0. Null source: a source of its own, last. No or a null quality: 1;
negative, zero and non-finite quality: the least weight. Repeated rows are
documents of their own. Empty tables give empty results.
"""

from __future__ import annotations

from fractions import Fraction

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskflow.llm._tables import saved, table

MAX_EPOCHS = 3
WEIGHTS = (1, 2, 3)
SLICE_ROWS = 1000
MAX_SLICES = 1 << 16
SEED = 20240229
WORD = r"[^\x20\x09-\x0D]+"


def document_sizes(docs: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, source, size, u) and ``keep``: one row per row of ``docs``; u in (0, 1) is a hash of the row."""
    u = (F.shiftrightunsigned(F.xxhash64(F.lit(SEED), "doc_id", "source", "text"), 11) + 0.5) / float(1 << 53)
    return docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.col("source").cast("string").alias("source"),
        F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("bigint").alias("size"), u.alias("u"), *keep)


def with_keys(sizes: DataFrame, quality: DataFrame | None) -> DataFrame:
    """``sizes`` with the exponential key; ``quality`` has (doc_id, weight), at most one row a doc_id."""
    if quality is None:
        return sizes.withColumn("key", -F.log("u")).drop("u")
    of = sizes.join(quality.select(F.col("doc_id").alias("rated"), "weight"), F.col("doc_id") == F.col("rated"), "left")
    weight = F.coalesce(F.col("weight").cast("double"), F.lit(1.0))
    weight = F.when((weight > 0) & (weight < float("inf")), weight).otherwise(1e-9)
    return of.withColumn("key", -F.log("u") / weight).drop("u", "rated", "weight")


def source_targets(sizes: DataFrame, weights=WEIGHTS, share: Fraction = Fraction(1), max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """(source, source_size, docs, target): capped shares of ``share`` times the total size.

    Sources in code point order, null last, weigh ``weights`` in turn.
    """
    spark = sizes.sparkSession
    of = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("docs"))
    ranked = of.orderBy(F.col("source").asc_nulls_last()).rdd.zipWithIndex().map(lambda x: (*x[0], x[1]))
    of = saved(spark.createDataFrame(ranked, "source string, source_size bigint, docs bigint, place bigint"), "sources")
    of = of.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (F.col("place") % len(weights) + 1).cast("int")))
    cap = F.col("source_size") * max_epochs
    budget = Fraction(int(of.agg(F.sum("source_size")).first()[0] or 0)) * share
    level = Fraction(0)  # words a unit of weight
    while True:
        stopped = (cap <= float(level) * F.col("weight")) | (cap == 0)
        held, open_weight = of.agg(F.sum(F.when(stopped, cap)), F.sum(F.when(~stopped, F.col("weight")))).first()
        if not open_weight:
            break
        new = max(Fraction(0), budget - int(held or 0)) / int(open_weight)
        if new <= level:
            break
        level = new
    return of.select("source", "source_size", "docs", F.least(cap.cast("double"), float(level) * F.col("weight")).alias("target"))


def mixed(docs: DataFrame, quality: DataFrame | None = None, weights=WEIGHTS, share: Fraction = Fraction(1),
          max_epochs: int = MAX_EPOCHS, whole: bool = False, keep: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, source, size, key, source_size, target, taken) and the columns ``keep``: one row per row of ``docs``.

    ``taken`` counts words over all repeats. The document in which a source's
    budget ends gives the words that are left; with ``whole`` it is taken if at
    least half of it fits, and else left out.
    """
    sizes = saved(with_keys(document_sizes(docs, keep), quality), "sizes")
    targets = source_targets(sizes, weights, share, max_epochs)
    size = F.col("source_size")
    epochs = F.when(size > 0, F.least(F.floor(F.col("target") / size), F.lit(max_epochs))).otherwise(0).cast("bigint")
    targets = targets.withColumn("epochs", epochs).withColumn(
        "extra", F.floor(F.col("target") - F.col("epochs") * size + 0.5).cast("bigint"))
    targets = saved(targets.withColumn(
        "slices", F.least(F.ceil(F.col("docs") / SLICE_ROWS), F.lit(MAX_SLICES)).cast("bigint")), "targets")

    t = targets.withColumnRenamed("source", "of")
    rows = sizes.join(t, F.col("source").eqNullSafe(F.col("of"))).drop("of", "docs")
    chance = F.lit(1.0) - F.exp(-F.col("key"))  # uniform for weight 1, monotone in the key
    rows = saved(rows.withColumn("slice", F.least(F.floor(chance * F.col("slices")), F.col("slices") - 1)), "sliced")

    sums = rows.groupBy("source", "slice").agg(F.sum("size").alias("slice_size"), F.max("extra").alias("extra"))
    so_far = F.sum("slice_size").over(Window.partitionBy("source").orderBy("slice"))
    ends = sums.withColumn("end", so_far).withColumn("start", F.col("end") - F.col("slice_size"))
    ends = ends.filter("start < extra AND extra <= end").select(F.col("source").alias("of"), F.col("slice").alias("end_slice"), "start")
    ends = saved(ends, "ends")

    rows = saved(rows.join(ends, F.col("source").eqNullSafe(F.col("of")), "left").drop("of"), "rows")
    inside = F.col("slice") == F.col("end_slice")
    full = rows.filter(~F.coalesce(inside, F.lit(False))).withColumn(
        "more", F.when(F.col("slice") < F.col("end_slice"), F.col("size")).otherwise(0))
    order = Window.partitionBy("source").orderBy("key", F.col("doc_id").asc_nulls_last(), "size")
    before = F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, -1))
    last = rows.filter(inside).withColumn("left", F.col("extra") - F.col("start") - F.coalesce(before, F.lit(0)))
    fits = F.when(F.col("left") * 2 >= F.col("size"), F.col("size")).otherwise(0) if whole else F.least("left", "size")
    last = last.withColumn("more", F.when(F.col("left") > 0, fits).otherwise(0)).drop("left")
    return full.unionByName(last).select(
        "doc_id", "source", "size", "key", "source_size", "target", *keep,
        (F.col("epochs") * F.col("size") + F.col("more")).cast("bigint").alias("taken"))


def label_quality(labels: DataFrame) -> DataFrame:
    """(doc_id, weight): 2 where labelled good, 0.5 where bad, 1 where the label is null."""
    q = labels.filter("doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("bigint").alias("doc_id")).agg(F.max("quality").alias("q"))
    return q.select("doc_id", F.when(F.col("q") == 1, 2.0).when(F.col("q") == 0, 0.5).otherwise(1.0).alias("weight"))


def op4_source_mixing(spark, sf_dir: str) -> DataFrame:
    rows = mixed(table(spark, sf_dir, "documents"), label_quality(table(spark, sf_dir, "labels")))
    return rows.select("doc_id", "size", "source_size", "target", "taken")
