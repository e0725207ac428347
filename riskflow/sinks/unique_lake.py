"""A lake that takes every transaction id once, however late a duplicate comes.

``dropDuplicatesWithinWatermark`` forgets an id when the watermark passes. Here the lake
itself is the memory, and Bloom filters of the ids of each event date keep the look-up
cheap: a batch's ids meet the filters' pages first (about ``BITS`` / ids bits each),
and only the dates that a filter names for some id are read, ids only, for an exact
anti join. So a filter's false positives cost reading and never reject a row.

A filter is a bit table of ``BITS`` places with two hashes, kept as pages of 4 KB
(``bitmap_construct_agg``); a batch adds its own pages, and readers OR them. Rows and
pages of batch N lie in folders of their own and count once commit N is made
(``sinks.commits``): a replayed batch writes the same folders again, and readers see
whole batches. Of several rows of one id in a batch the earliest stays (nulls last).
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from riskflow.functions.columns import utc_wall_clock_of
from riskflow.operators.validate import dedup_transactions
from riskflow.sinks.commits import CommitLog

BITS = 1 << 27  # places of a date's filter: 16 MB where all pages are used
NO_DATE = "none"  # the date of rows without a time


def _places(key: str, bits: int) -> list:
    """Two places of an id, from 1 on as the bitmap functions count."""
    return [F.pmod(F.xxhash64(F.lit(salt), key), F.lit(bits)) + 1 for salt in (11, 23)]


def _pages(rows: DataFrame, key: str, bits: int) -> DataFrame:
    """``(day, page, bits)`` of the ids of ``rows``."""
    places = rows.select("day", F.explode(F.array(*_places(key, bits))).alias("place"))
    return places.groupBy("day", F.bitmap_bucket_number("place").alias("page")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("place")).alias("bits"))


def _possible(ids: DataFrame, pages: DataFrame, key: str, bits: int) -> DataFrame:
    """``(key, day)`` of the dates whose filter may hold the id."""
    asked = ids.select(key, F.posexplode(F.array(*_places(key, bits))).alias("hash", "place"))
    asked = asked.select(key, "hash", F.bitmap_bucket_number("place").alias("page"), F.bitmap_bit_position("place").cast("int").alias("bit"))
    byte = "cast(conv(hex(substring(bits, cast(bit div 8 AS int) + 1, 1)), 16, 10) AS int)"
    found = asked.join(pages, "page").where(f"{byte} & shiftleft(1, bit % 8) <> 0")
    return found.groupBy(key, "day").agg(F.count_distinct("hash").alias("hashes")).where("hashes = 2").select(key, "day")


def _committed(log: CommitLog, before: int | None = None) -> list[int]:
    return [n for n in log.numbers() if before is None or n < before]


def _take_batch(batch: DataFrame, batch_id: int, path: str, key: str, bits: int) -> None:
    spark = batch.sparkSession
    log = CommitLog(spark, f"{path}/_commits")
    done = _committed(log)
    if batch_id in done:  # replayed after its commit
        return
    if done and json.loads(log.read(done[-1]))["bits"] != bits:
        raise ValueError(f"the filters of {path} have another size than {bits}")
    day = F.coalesce(F.to_date(utc_wall_clock_of(batch, "timestamp")).cast("string"), F.lit(NO_DATE))
    rows = dedup_transactions(batch, key).withColumn("day", day)
    rows.write.mode("overwrite").parquet(f"{path}/_arrived/batch={batch_id}")  # read several times below
    rows = spark.read.schema(rows.schema).parquet(f"{path}/_arrived/batch={batch_id}")
    if done:
        pages = spark.read.schema("day string, page bigint, bits binary").parquet(*(f"{path}/filters/batch={n}" for n in done))
        pages = pages.join(rows.select(F.explode(F.array(*(F.bitmap_bucket_number(p) for p in _places(key, bits)))).alias("page")).distinct(),
                           "page", "left_semi")
        pages = pages.groupBy("day", "page").agg(F.bitmap_or_agg("bits").alias("bits"))
        possible = _possible(rows.select(key), pages, key, bits)
        possible.write.mode("overwrite").parquet(f"{path}/_possible/batch={batch_id}")
        possible = spark.read.schema(possible.schema).parquet(f"{path}/_possible/batch={batch_id}")
        days = [r["day"] for r in possible.select("day").distinct().collect()]  # at most a row for each date
        held = _lake(spark, path, done, [f.simpleString() for f in rows.schema.fields])
        seen = held.where(F.col("day").isin(days)).select(key, "day").join(possible, [key, "day"], "left_semi")
        rows = rows.join(seen.select(key).distinct(), key, "left_anti")
    rows.write.mode("overwrite").partitionBy("day").parquet(f"{path}/rows/batch={batch_id}")
    kept = spark.read.schema(rows.schema).parquet(f"{path}/rows/batch={batch_id}")
    _pages(kept, key, bits).write.mode("overwrite").parquet(f"{path}/filters/batch={batch_id}")
    log.commit(batch_id, json.dumps({"bits": bits}))


def _lake(spark, path: str, batches: list[int], fields=None) -> DataFrame:
    reader = spark.read.option("basePath", f"{path}/rows")
    if fields is not None:
        reader = reader.schema(", ".join(f.replace(":", " ", 1) for f in fields) + ", batch int")
    return reader.parquet(*(f"{path}/rows/batch={n}" for n in batches)).drop("batch")


def start_unique_lake(tx: DataFrame, path: str, checkpoint_path: str, key: str = "transaction_id",
                      bits: int = BITS, available_now: bool = False) -> StreamingQuery:
    """Write a stream of transactions to a lake that holds each ``key`` once. Rows without a key are kept out."""
    if bits % 8:
        raise ValueError("bits must be a multiple of 8")

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        _take_batch(batch.where(F.col(key).isNotNull()), batch_id, path, key, bits)

    writer = tx.writeStream.option("checkpointLocation", checkpoint_path).foreachBatch(on_batch)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def read_unique_lake(spark, path: str) -> DataFrame:
    """The rows of all committed batches; ``day`` is the partition column."""
    return _lake(spark, path, _committed(CommitLog(spark, f"{path}/_commits")))
