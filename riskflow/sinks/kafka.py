"""Kafka sinks for risk rows (alerts topic) and enriched transactions (lake topic).

A sink is (message frame) + (writer options). The message frame is built by
``operators.messages.to_kafka_messages``; ``fmt`` lets tests point the same
writer at a file or memory sink, since the Kafka connector needs a broker.
Kafka output is at-least-once: consumers key on the message key and
``window``/``transaction_id`` to drop replays.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from riskflow.config import (
    DEFAULT_BOOTSTRAP_SERVERS,
    DEFAULT_CHECKPOINT_RISK,
    DEFAULT_OUTPUT_TOPIC,
)
from riskflow.operators.messages import to_kafka_messages

OUTPUT_MODES = ("append", "update", "complete")


def kafka_sink_options(bootstrap_servers: str = DEFAULT_BOOTSTRAP_SERVERS,
                       topic: str = DEFAULT_OUTPUT_TOPIC,
                       checkpoint_path: str = DEFAULT_CHECKPOINT_RISK) -> dict[str, str]:
    return {
        "kafka.bootstrap.servers": bootstrap_servers,
        "topic": topic,
        "checkpointLocation": checkpoint_path,
    }


def write_to_kafka(df: DataFrame, key_col: str | None = "user_id",
                   bootstrap_servers: str = DEFAULT_BOOTSTRAP_SERVERS,
                   output_topic: str = DEFAULT_OUTPUT_TOPIC,
                   checkpoint_path: str = DEFAULT_CHECKPOINT_RISK,
                   output_mode: str = "append",
                   fmt: str = "kafka", path: str | None = None,
                   query_name: str | None = None,
                   available_now: bool = False,
                   trigger_interval: str | None = None) -> StreamingQuery:
    """Start a streaming write of ``df`` as JSON messages keyed by ``key_col``.

    ``output_mode``: ``append`` emits a window once the watermark closes it;
    ``update`` emits every change of a window (more messages, no delay);
    ``complete`` re-emits the whole result table each trigger (only for small
    aggregates: its state and output grow with all keys ever seen).
    """
    if output_mode not in OUTPUT_MODES:
        raise ValueError(f"output_mode must be one of {OUTPUT_MODES}, got {output_mode!r}")
    msgs = to_kafka_messages(df, key_col=key_col)
    opts = kafka_sink_options(bootstrap_servers, output_topic, checkpoint_path)
    writer = msgs.writeStream.outputMode(output_mode).format(fmt)
    if fmt != "kafka":
        opts = {"checkpointLocation": checkpoint_path}
        if path is not None:
            opts["path"] = path
    writer = writer.options(**opts)
    if query_name:
        writer = writer.queryName(query_name)
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif trigger_interval:
        writer = writer.trigger(processingTime=trigger_interval)
    return writer.start()


def write_high_risk_transactions(risk_df: DataFrame, **kw) -> StreamingQuery:
    """Risk rows -> alerts topic, keyed by user."""
    kw.setdefault("key_col", "user_id")
    return write_to_kafka(risk_df, **kw)


def write_lake_transactions_to_kafka(tx_df: DataFrame, output_topic: str = "transactions_lake",
                                     **kw) -> StreamingQuery:
    """Validated, enriched transactions -> lake topic, keyed by user so one
    user's records stay ordered within a partition."""
    kw.setdefault("key_col", "user_id")
    return write_to_kafka(tx_df, output_topic=output_topic, **kw)
