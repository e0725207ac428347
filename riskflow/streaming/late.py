"""Late rows as a side output.

A windowed aggregation drops a row when its window had closed before the row's
micro-batch: the window's end is not after the watermark of the batch before.
``late_rows`` returns these rows, and only these, as a stream of their own with the same
watermark: run on the same batches, it and the aggregation's input rows
make up all rows with a time.

Which watermark held a batch ago is kept by a stateful processor. Its state is one
number for each of ``slots`` slots, to which rows are dealt by a hash of the whole row, so
that no user's rows meet in one task. Every slot is there from the first batch on
(initial state) and has an event-time timer one millisecond past the watermark it knows:
in each batch that moves the watermark all timers fire, after the batch's rows,
and note the new one.
"""

from __future__ import annotations

import contextlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskflow.config import RiskParams

SLOTS = 64
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@contextlib.contextmanager
def rocksdb_state(spark: SparkSession):
    """Start queries with the RocksDB state store, which processors with timers need; the session's setting returns after the block."""
    key = "spark.sql.streaming.stateStore.providerClass"
    old = spark.conf.get(key)
    spark.conf.set(key, ROCKSDB)
    try:
        yield
    finally:
        spark.conf.set(key, old)


def _processor():
    # within a function: pickled by value, so executors need no copy of this package
    from pyspark.sql.streaming.stateful_processor import StatefulProcessor

    class WatermarkOfTheBatchBefore(StatefulProcessor):
        def init(self, handle):
            self.handle = handle
            self.mark = handle.getValueState("mark", "ms bigint")

        def _note(self, timer_values):
            ms = timer_values.getCurrentWatermarkInMs()
            self.mark.update((ms,))
            self.handle.registerTimer(ms + 1)

        def handleInitialState(self, key, initialState, timerValues):
            self._note(timerValues)

        def handleInputRows(self, key, rows, timerValues):
            (mark,) = self.mark.get()
            for some in rows:
                if not mark or some.empty:  # a slot's first frame may have no columns
                    continue
                late = some[some["late_end"] <= mark * 1000]
                if len(late):
                    late = late.drop(columns=["late_end", "late_slot"])
                    late["late_mark"] = mark
                    yield late

        def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
            self._note(timerValues)
            yield from ()

        def close(self):
            pass

    return WatermarkOfTheBatchBefore()


def late_rows(tx: DataFrame, params: RiskParams = RiskParams(), slots: int = SLOTS) -> DataFrame:
    """The rows of a watermarked stream ``tx`` that the windowed aggregation over it drops as late.

    All columns of ``tx``, and ``watermark``, the instant that the row missed. ``slots`` is
    the query's for life. Start the query within ``rocksdb_state``.
    """
    columns = [c for c in tx.columns if c != "timestamp"]
    end = F.unix_micros(F.window("timestamp", params.window_duration)["end"])
    # micros: no column of the input carries the watermark, or Spark would drop late rows before the processor
    rows = tx.where(F.col("timestamp").isNotNull()).select(*columns, F.unix_micros("timestamp").alias("late_ts"), end.alias("late_end"))
    rows = rows.withColumn("late_slot", F.pmod(F.xxhash64(*columns, "late_ts"), F.lit(slots)).cast("int"))
    every = tx.sparkSession.range(slots).select(F.col("id").cast("int").alias("late_slot"), F.lit(0).alias("late_none"))
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields if f.name in columns]
    late = rows.groupBy("late_slot").transformWithStateInPandas(
        _processor(), ", ".join([*fields, "late_ts bigint", "late_mark bigint"]), "append", "eventTime", initialState=every.groupBy("late_slot"))
    return late.select(*(F.timestamp_micros("late_ts").alias(c) if c == "timestamp" else F.col(c) for c in tx.columns),
                       F.timestamp_millis("late_mark").alias("watermark"))
