"""Replay connector rows as a file stream (stands in for a broker).

``write_replay`` lays the rows down once under a shared scratch path: the
records as one parquet directory, then a sentinel record far ahead in event
time. A stream over the replay sees the records, then the sentinel: the
sentinel moves the watermark past every real window so that an append-mode
aggregation emits all of them, after which the stream equals the batch answer.
``write_ordered_replay`` writes event-time slices one after another, so a
stream with ``maxFilesPerTrigger`` gets them in time order (late-data tests).
"""

from __future__ import annotations

import datetime as dt
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskflow.functions.columns import as_utc_instant, utc_wall_clock_of
from riskflow.schemas import KAFKA_RECORD_SCHEMA
from riskflow.sources.kafka import open_kafka_layout_files

SENTINEL_ID = "sentinel"
SENTINEL_AFTER = dt.timedelta(days=30)  # longer than any window and watermark delay


def sentinel_records(spark: SparkSession, when: dt.datetime,
                     topic: str = SENTINEL_ID) -> DataFrame:
    """One valid connector row at ``when`` (UTC) that closes all windows that end before it."""
    ts_text = when.strftime("%Y-%m-%dT%H:%M:%S.%f") + "Z"  # the wire format
    value = json.dumps({"transaction_id": SENTINEL_ID, "user_id": SENTINEL_ID,
                        "amount": 0, "timestamp": ts_text}, separators=(",", ":"))
    row = [(SENTINEL_ID.encode(), value.encode(), topic, 0, 0, None, 0)]
    return spark.createDataFrame(row, KAFKA_RECORD_SCHEMA)


def write_sentinel(records: DataFrame, path: str, time_col: str = "timestamp") -> None:
    """A sentinel ``SENTINEL_AFTER`` the latest of ``records`` (none without a time)."""
    last = records.agg(F.max(utc_wall_clock_of(records, time_col))).first()[0]
    if last is not None:
        sentinel_records(records.sparkSession, last + SENTINEL_AFTER).write.mode("overwrite").parquet(f"{path}/zz_sentinel")


def write_replay(records: DataFrame, path: str, sentinel: bool = True) -> str:
    """Write ``records`` then a sentinel; returns the glob to stream from."""
    records.write.mode("overwrite").parquet(f"{path}/data")
    if sentinel:
        write_sentinel(records.sparkSession.read.schema(records.schema).parquet(f"{path}/data"), path)
    return f"{path}/*"


def write_ordered_replay(records: DataFrame, path: str, bounds: list[str],
                         time_col: str = "timestamp") -> str:
    """Write one directory per event-time slice ``[bounds[i], bounds[i+1])``
    (UTC), one after another, so a stream with ``maxFilesPerTrigger=1`` reads
    them in event-time order (tests of multi-batch replays and late data).

    The first and last slices are open-ended, so every row is replayed; rows
    without a time go to the first slice. Each slice is one file, written by one
    task, so this is for small replays: large ones write a slice with
    ``write_slice`` and run the stream before the next. Returns the glob to stream from.
    """
    for i in range(len(bounds) - 1):
        write_slice(records, path, bounds, i, time_col, files=1)
    return f"{path}/*"


def write_slice(records: DataFrame, path: str, bounds: list[str], i: int, time_col: str = "timestamp",
                files: int | None = None) -> None:
    """Write slice ``i`` of ``write_ordered_replay``, in as many files as there are partitions or in ``files``."""
    t, last = F.col(time_col), len(bounds) - 2
    cond = F.lit(True)
    if i > 0:
        cond = cond & (t >= as_utc_instant(F.lit(bounds[i]).cast("timestamp_ntz")))
    if i < last:
        cond = cond & (t < as_utc_instant(F.lit(bounds[i + 1]).cast("timestamp_ntz")))
    if i == 0:
        cond = cond | t.isNull()
    rows = records.where(cond)
    (rows if files is None else rows.coalesce(files)).write.mode("overwrite").parquet(f"{path}/slice_{i:05d}")


def replay_stream(spark: SparkSession, glob: str,
                  max_files_per_trigger: int | None = None) -> DataFrame:
    return open_kafka_layout_files(spark, glob, streaming=True,
                                   max_files_per_trigger=max_files_per_trigger)
