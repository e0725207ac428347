"""Change-data-capture source: connector topics and change-event envelopes.

A CDC connector publishes one topic per captured table, named
``<topic.prefix>.<database>.<table>``, with the row key as the message key
and a JSON envelope as the value::

    {"before": {...} | null, "after": {...} | null, "op": "c|u|d|r",
     "ts_ms": <epoch millis>, "source": {...}}

``decode_change_events`` turns connector rows of such topics into the change
log layout folded by ``operators.cdc``: ``(key, op, ts, seq, before, after)``
with ``seq`` = the Kafka offset, which orders events of one key (a key always
lands in one partition). Deletes carry ``after = NULL``; tombstone messages
(NULL value, sent after a delete for log compaction) are dropped.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from riskflow.functions.columns import utc_wall_clock
from riskflow.operators.validate import flatten_parsed


def cdc_topics(connector_config: dict[str, str]) -> list[str]:
    """Topics of the tables a connector captures (``table.include.list``)."""
    prefix = connector_config["topic.prefix"]
    tables = [t.strip() for t in connector_config.get("table.include.list", "").split(",") if t.strip()]
    return [f"{prefix}.{t}" for t in tables]


def change_event_schema(row_schema: StructType) -> StructType:
    """Envelope schema for rows of ``row_schema``."""
    return StructType.fromJson({
        "type": "struct",
        "fields": [
            {"name": "before", "type": row_schema.jsonValue(), "nullable": True, "metadata": {}},
            {"name": "after", "type": row_schema.jsonValue(), "nullable": True, "metadata": {}},
            {"name": "op", "type": "string", "nullable": True, "metadata": {}},
            {"name": "ts_ms", "type": "long", "nullable": True, "metadata": {}},
        ],
    })


def decode_change_events(records: DataFrame, row_schema: StructType, key_schema: StructType,
                         key_field: str | None = None) -> DataFrame:
    """Connector rows -> ``(key, op, ts, seq, before, after)``.

    ``key`` is the parsed message key (its single field when ``key_field``
    names it), ``ts`` the event time from ``ts_ms`` (UTC wall clock).
    """
    key: Column = F.from_json(F.col("key").cast("string"), key_schema)
    if key_field:
        key = key.getField(key_field)
    events = (records.where(F.col("value").isNotNull())
              .select(key.alias("key"), F.col("offset").alias("seq"),
                      flatten_parsed(F.from_json(F.col("value").cast("string"),
                                                 change_event_schema(row_schema)))))
    return events.select("key", "op", utc_wall_clock(F.timestamp_millis(F.col("ts_ms"))).alias("ts"),
                         "seq", "before", "after")
