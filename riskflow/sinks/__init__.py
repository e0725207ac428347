"""Sinks: Kafka topics, parquet lake, per-batch alert table."""
