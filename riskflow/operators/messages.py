"""Outgoing message frames: Kafka key/value rows and alert text.

Messages are built as columns on the executors; nothing is collected to the
driver. The value is the whole row as JSON (``to_json(struct(*))``), written
with microsecond timestamps.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskflow.functions.columns import JSON_WRITE_OPTIONS, alert_text


def to_kafka_messages(df: DataFrame, key_col: str | None = "user_id",
                      value_cols: list[str] | None = None) -> DataFrame:
    """``key STRING, value STRING`` rows for the Kafka sink.

    The value holds every column of the frame (or ``value_cols``), the key is
    taken from ``key_col`` (NULL key when None), as a Kafka producer would.
    """
    cols = value_cols or df.columns
    key = F.col(key_col).cast("string") if key_col else F.lit(None).cast("string")
    value = F.to_json(F.struct(*[F.col(c) for c in cols]), JSON_WRITE_OPTIONS)
    return df.select(key.alias("key"), value.alias("value"))


def alert_messages(risk: DataFrame) -> DataFrame:
    """One alert line per risk row, next to the row's identifying columns."""
    keep = [c for c in ("window", "window_start", "window_end", "user_id") if c in risk.columns]
    return risk.select(*keep, alert_text().alias("alert_text"))
