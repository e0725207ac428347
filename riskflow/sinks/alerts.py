"""Per-micro-batch alert sink.

Alert lines are computed on the executors (``operators.messages``) and written
as a table partitioned by ``batch_id``. The write overwrites only its own
batch's partition, so a batch replayed after a failure replaces its earlier
output instead of duplicating it (idempotent, effectively exactly-once). The
write is the only action on the batch's plan and always runs every partition,
so stateful plans commit all their state. For the log, at most ``log_limit``
lines are read back from the written partition; the table has them all.
"""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from riskflow.operators.messages import alert_messages

log = logging.getLogger(__name__)


def alert_batch_writer(alerts_path: str, log_limit: int = 20):
    """``foreachBatch`` callback writing all alert lines of each batch."""

    def on_batch(batch_df: DataFrame, batch_id: int) -> None:
        alerts = alert_messages(batch_df).withColumn("batch_id", F.lit(batch_id).cast("long"))
        (alerts.write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic")
         .partitionBy("batch_id").parquet(alerts_path))
        if log_limit > 0:
            written = (batch_df.sparkSession.read.schema(alerts.schema).parquet(alerts_path)
                       .where(F.col("batch_id") == batch_id))
            for row in written.select("alert_text").take(log_limit):
                log.warning(row["alert_text"])

    return on_batch


def start_high_risk_alert_stream(risk_df: DataFrame, checkpoint_path: str,
                                 alerts_path: str | None = None,
                                 output_mode: str = "append",
                                 log_limit: int = 20,
                                 available_now: bool = False,
                                 trigger_interval: str | None = None) -> StreamingQuery:
    """Start the alert stream. ``checkpoint_path`` is required: without it a
    restart would re-read from the source's start or lose open windows. Alerts
    go to ``alerts_path``, by default the folder ``<checkpoint_path>-alerts``."""
    alerts_path = alerts_path or f"{checkpoint_path.rstrip('/')}-alerts"
    writer = (risk_df.writeStream.outputMode(output_mode)
              .option("checkpointLocation", checkpoint_path)
              .foreachBatch(alert_batch_writer(alerts_path, log_limit)))
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif trigger_interval:
        writer = writer.trigger(processingTime=trigger_interval)
    return writer.start()
