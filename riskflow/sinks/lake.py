"""Parquet data-lake sinks (streaming and batch)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from riskflow.config import DEFAULT_CHECKPOINT_LAKE, DEFAULT_DATA_LAKE_PATH, DEFAULT_LAKE_TRIGGER
from riskflow.functions.columns import utc_wall_clock_of


def with_event_date(df: DataFrame, time_col: str = "timestamp", name: str = "event_date") -> DataFrame:
    """UTC calendar date of the event time: the lake's partition column, so
    date-bounded reads prune whole directories."""
    return df.withColumn(name, F.to_date(utc_wall_clock_of(df, time_col)))


def persist_transactions_to_data_lake(df: DataFrame,
                                      output_path: str = DEFAULT_DATA_LAKE_PATH,
                                      checkpoint_path: str = DEFAULT_CHECKPOINT_LAKE,
                                      output_mode: str = "append",
                                      trigger_interval: str | None = DEFAULT_LAKE_TRIGGER,
                                      partition_by: list[str] | None = None,
                                      available_now: bool = False) -> StreamingQuery:
    """Streaming parquet sink with a checkpoint: exactly-once file output
    (the sink's ``_spark_metadata`` log lists committed files only).

    Parquet accepts ``append`` only. ``available_now`` drains what is there and
    stops (backfills, tests); otherwise ``trigger_interval`` paces batches.
    """
    if output_mode != "append":
        raise ValueError("the parquet sink supports output_mode='append' only")
    writer = (df.writeStream.outputMode(output_mode).format("parquet")
              .option("path", output_path)
              .option("checkpointLocation", checkpoint_path))
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif trigger_interval:
        writer = writer.trigger(processingTime=trigger_interval)
    return writer.start()


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite",
                  partition_by: list[str] | None = None) -> None:
    """Batch parquet write."""
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
