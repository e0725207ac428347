"""Hot keys found by mergeable sketches, and joins that salt only these.

A frequent-items sketch (``approx_top_k``) is built per map task and merged, so
finding the keys that hold a large share of all rows costs one pass over the key
column and no shuffle of rows. Sketches are rows of a table: keep one per hour or
day and combine those that matter. A stream, which has no look ahead, takes its
hot keys from the sketches of earlier data.

A key is hot when it holds more than ``HOT_FACTOR`` times the rows of an average
shuffle partition. It gets ``PIECES`` salts for each partition that it would fill (small
pieces, since a hash may put several of them together); all other keys keep one, so
only the few rows of hot keys on the other side are copied.
Which keys are salted never changes a join's result, only its balance.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SKETCH_ITEMS = 8192  # counters of a sketch
MOST_HOT = 1000  # keys salted at most: the hottest; also the proven size of the broadcast list
HOT_FACTOR = 2
PIECES = 8


def key_sketches(rows: DataFrame, key: str, *by: str) -> DataFrame:
    """``(*by, sketch, rows)``: a frequent-items sketch of ``key`` and the rows it has seen, for each group."""
    keyed = rows.where(F.col(key).isNotNull()).select(*by, F.col(key).alias("_key"))
    sketch = F.expr(f"approx_top_k_accumulate(_key, {SKETCH_ITEMS})").alias("sketch")
    return keyed.groupBy(F.lit("all").alias("_all"), *by).agg(sketch, F.count("*").alias("rows")).drop("_all")


def hot_salts(sketches: DataFrame, partitions: int) -> DataFrame | None:
    """``(key, salts)`` of the hot keys of all sketches together; None if there are none. At most ``MOST_HOT`` rows."""
    # one group: a combination of no sketches is an error, and tasks without any would make one
    whole = sketches.groupBy(F.lit("all").alias("_all")).agg(F.expr("approx_top_k_combine(sketch)").alias("sketch"), F.sum("rows").alias("rows"))
    found = whole.select(F.explode(F.expr(f"approx_top_k_estimate(sketch, {MOST_HOT})")).alias("f"), "rows")
    share = F.col("f.count") / F.col("rows")
    hot = found.where(share * partitions > HOT_FACTOR).select(
        F.col("f.item").alias("key"), F.ceil(share * partitions * PIECES).cast("int").alias("salts"))
    schema, rows = hot.schema, hot.collect()  # at most MOST_HOT rows
    return sketches.sparkSession.createDataFrame(rows, schema) if rows else None


def salted_left_join(rows: DataFrame, side: DataFrame, key: str, hot: DataFrame | None, salt_by: list[str]) -> DataFrame:
    """``rows`` left-joined with ``side`` on ``key``; rows of a hot key are spread by a hash of ``salt_by``.

    The hash makes a retried task repeat its salts.
    """
    if hot is None:
        return rows.join(side, on=key, how="left")
    hot = F.broadcast(hot.select(F.col("key").alias("_hot"), F.col("salts").alias("_salts")))
    salts = F.coalesce("_salts", F.lit(1))
    left = rows.join(hot, F.col(key) == F.col("_hot"), "left").withColumn("_salt", F.pmod(F.xxhash64(*salt_by), salts).cast("int"))
    right = side.join(hot, F.col(key) == F.col("_hot"), "left").withColumn("_salt", F.explode(F.sequence(F.lit(0), salts - 1)))
    return left.drop("_hot", "_salts").join(right.drop("_hot", "_salts"), on=[key, "_salt"], how="left").drop("_salt")
