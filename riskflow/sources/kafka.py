"""Kafka sources: option maps, envelope decode, typed decode, bronze ingest.

The connector is not needed to build or test the transforms: a source is the
pair (options -> reader) and (connector rows -> decoded rows). The decode step
works on any DataFrame with the connector's column layout, batch or stream, so
tests and replays feed it from parquet files of that layout.
"""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from riskflow.config import DEFAULT_BOOTSTRAP_SERVERS, DEFAULT_INPUT_TOPIC
from riskflow.functions.columns import utc_wall_clock_of
from riskflow.operators.validate import flatten_parsed
from riskflow.schemas import KAFKA_RECORD_SCHEMA


def kafka_source_options(bootstrap_servers: str = DEFAULT_BOOTSTRAP_SERVERS,
                         topic: str = DEFAULT_INPUT_TOPIC,
                         starting_offsets: str = "latest",
                         max_offsets_per_trigger: int | None = None,
                         **extra: str) -> dict[str, str]:
    """Reader options for ``format("kafka")``.

    ``max_offsets_per_trigger`` bounds a micro-batch, so a backlog after an
    outage is worked off in slices instead of one unbounded batch.
    """
    opts = {
        "kafka.bootstrap.servers": bootstrap_servers,
        "subscribe": topic,
        "startingOffsets": starting_offsets,
    }
    if max_offsets_per_trigger is not None:
        opts["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    opts.update({k: str(v) for k, v in extra.items()})
    return opts


def kafka_history_options(bootstrap_servers: str = DEFAULT_BOOTSTRAP_SERVERS, topic: str = DEFAULT_INPUT_TOPIC,
                          hours: float = 24, now: float | None = None) -> dict[str, str]:
    """Batch reader options for a topic's last ``hours`` (before ``now``, epoch seconds); a
    partition without newer records gives none."""
    start = int(((time.time() if now is None else now) - hours * 3600) * 1000)
    return {"kafka.bootstrap.servers": bootstrap_servers, "subscribe": topic, "startingTimestamp": str(start),
            "startingOffsetsByTimestampStrategy": "latest", "endingOffsets": "latest"}


KAFKA_PACKAGE_HINT = ("the Kafka source needs the Spark Kafka connector on the classpath, e.g. "
                      "--packages org.apache.spark:spark-sql-kafka-0-10_2.13:<spark version>")


class KafkaConnectorMissing(RuntimeError):
    """The Kafka data source is not available in this Spark installation."""


def open_kafka_stream(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    """Raw connector rows of a Kafka subscription (needs the Kafka connector)."""
    return _open_kafka(spark.readStream, options)


def open_kafka_batch(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    """The same as a batch, from starting to ending offsets or times."""
    return _open_kafka(spark.read, options)


def _open_kafka(reader, options: dict[str, str]) -> DataFrame:
    try:
        return reader.format("kafka").options(**options).load()
    except Exception as err:  # AnalysisException: DATA_SOURCE_NOT_FOUND
        text = str(err).lower()
        if "kafka" in text and ("failed to find data source" in text or "data_source_not_found" in text):
            raise KafkaConnectorMissing(KAFKA_PACKAGE_HINT) from err
        raise


def open_kafka_layout_files(spark: SparkSession, path: str, streaming: bool = True,
                            max_files_per_trigger: int | None = None) -> DataFrame:
    """Parquet files with the connector's row layout, as a batch or a stream.

    Stands in for a broker in tests and replays; the declared schema avoids
    inference on every micro-batch.
    """
    if not streaming:
        return spark.read.schema(KAFKA_RECORD_SCHEMA).parquet(path)
    reader = spark.readStream.schema(KAFKA_RECORD_SCHEMA)
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.parquet(path)


def decode_envelope(records: DataFrame, value_schema: StructType | None = None,
                    keep: tuple[str, ...] = ()) -> DataFrame:
    """``CAST(key/value AS STRING)``; with ``value_schema`` the JSON value is
    parsed and its fields are flattened next to ``key``.

    ``keep`` passes connector columns (``topic``, ``partition``, ``offset``)
    through for auditing.
    """
    decoded = records.select(
        F.col("key").cast("string").alias("key"),
        F.col("value").cast("string").alias("value"),
        *keep,
    )
    if value_schema is None:
        return decoded
    return decoded.select("key", *keep, flatten_parsed(F.from_json(F.col("value"), value_schema)))


def read_raw_transactions(spark: SparkSession,
                          bootstrap_servers: str = DEFAULT_BOOTSTRAP_SERVERS,
                          input_topic: str = DEFAULT_INPUT_TOPIC,
                          starting_offsets: str = "latest",
                          value_schema: StructType | None = None,
                          records: DataFrame | None = None) -> DataFrame:
    """Kafka transactions as ``key, value`` strings, or typed when a value
    schema is given. ``records`` replaces the broker (tests, replays)."""
    if records is None:
        records = open_kafka_stream(
            spark, kafka_source_options(bootstrap_servers, input_topic, starting_offsets))
    return decode_envelope(records, value_schema)


def read_bronze(spark: SparkSession,
                bootstrap_servers: str = DEFAULT_BOOTSTRAP_SERVERS,
                topic: str = "bronze",
                starting_offsets: str = "earliest",
                records: DataFrame | None = None) -> DataFrame:
    """Bronze ingest: connector rows unprojected (binary key/value, metadata)
    plus the UTC ingest date for partition pruning downstream."""
    if records is None:
        records = open_kafka_stream(
            spark, kafka_source_options(bootstrap_servers, topic, starting_offsets))
    return records.withColumn("ingest_date", F.to_date(utc_wall_clock_of(records, "timestamp")))
