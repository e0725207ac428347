"""The end-to-end risk flow: source -> parse/validate -> enrich -> lake + risk -> alerts.

``prepare_transactions`` and ``risk_from_transactions`` are pure DataFrame
transforms used unchanged for batch and streaming input. ``start_risk_flow``
wires them to sinks as several streaming queries over one source definition
(each query has its own checkpoint and its own read of the source).
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from riskflow.config import RiskParams
from riskflow.operators.enrich import DEFAULT_MAX_BROADCAST_BYTES, augment_with_profile, augment_with_self_profile
from riskflow.operators.risk import detect_high_risk
from riskflow.operators.validate import (
    dedup_transactions,
    parse_transactions,
    validate_transactions,
    with_event_time_watermark,
)
from riskflow.sources.kafka import decode_envelope


def prepare_transactions(records: DataFrame, params: RiskParams = RiskParams(),
                         profile: DataFrame | None = None,
                         self_profile: bool = False,
                         default_category: str | None = None,
                         dedup: bool = False,
                         require_timestamp: bool = False,
                         salt_buckets: int = 1,
                         max_broadcast_bytes: int = DEFAULT_MAX_BROADCAST_BYTES,
                         history: Callable[[], DataFrame] | None = None) -> DataFrame:
    """Connector rows -> parsed, watermarked, validated (and enriched) rows.

    Where the profile is too large to broadcast, hot users are spread over several
    reducers: those of the batch itself, and for a stream those of ``history()``,
    connector rows of earlier data as a batch. ``salt_buckets`` spreads all users.
    """
    decoded = decode_envelope(records)
    parsed = parse_transactions(decoded)
    if require_timestamp:
        # Before the watermark: a filter on the event-time column itself is
        # not moved below it by the optimizer.
        parsed = parsed.where(parsed["timestamp"].isNotNull())
    tx = validate_transactions(with_event_time_watermark(parsed, params))
    if dedup:
        tx = dedup_transactions(tx)
    if profile is not None:
        earlier = None
        if history is not None:
            def earlier():
                return validate_transactions(parse_transactions(decode_envelope(history())))
        tx = augment_with_profile(tx, profile, default_category=default_category, salt_buckets=salt_buckets,
                                  max_broadcast_bytes=max_broadcast_bytes, history=earlier)
    elif self_profile:
        tx = augment_with_self_profile(tx)
    return tx


def risk_from_transactions(tx: DataFrame, params: RiskParams = RiskParams()) -> DataFrame:
    """High-risk (window, user) rows. The profile columns are not grouping keys."""
    return detect_high_risk(tx.select("user_id", "amount", "timestamp"), params)


def risk_from_records(records: DataFrame, params: RiskParams = RiskParams(),
                      **prepare_kw) -> DataFrame:
    return risk_from_transactions(prepare_transactions(records, params, **prepare_kw), params)


@dataclass
class RiskFlowHandles:
    """The streaming queries started by ``start_risk_flow``."""

    queries: dict[str, StreamingQuery] = field(default_factory=dict)

    def await_any(self, timeout: float | None = None):
        from riskflow.streaming.runner import await_any_termination
        return await_any_termination(list(self.queries.values()), timeout)

    def stop(self):
        for q in self.queries.values():
            if q.isActive:
                q.stop()


def start_risk_flow(open_records, params: RiskParams = RiskParams(), *,
                    profile: DataFrame | None = None,
                    lake_sink=None, risk_sink=None, alert_sink=None,
                    **prepare_kw) -> RiskFlowHandles:
    """Start the fan-out: validated rows to the lake, risk rows to Kafka and/or
    the alert sink. ``open_records()`` returns a fresh streaming source frame
    for each query; each ``*_sink(df) -> StreamingQuery`` carries its own
    checkpoint.

    The risk branches skip the profile join: with a unique profile a left join
    keeps every transaction exactly once and adds only columns the aggregate
    does not read, so the answer is the same without the join's cost.
    """
    handles = RiskFlowHandles()
    if lake_sink is not None:
        tx = prepare_transactions(open_records(), params, profile=profile, **prepare_kw)
        handles.queries["lake"] = lake_sink(tx)
    if risk_sink is not None:
        handles.queries["risk"] = risk_sink(
            risk_from_records(open_records(), params, **prepare_kw))
    if alert_sink is not None:
        handles.queries["alerts"] = alert_sink(
            risk_from_records(open_records(), params, **prepare_kw))
    return handles


def start_default_flow(spark, checkpoint_dir: str, params: RiskParams = RiskParams(), *,
                       profile: DataFrame | None = None,
                       bootstrap_servers: str | None = None, input_topic: str | None = None,
                       starting_offsets: str = "latest",
                       max_offsets_per_trigger: int | None = None,
                       lake_topic: str = "transactions_lake", risk_topic: str | None = None,
                       alerts_path: str | None = None,
                       open_records=None, open_history: Callable[[], DataFrame] | None = None,
                       history_hours: float = 24,
                       sink_format: str = "kafka", sink_dir: str | None = None,
                       available_now: bool = False,
                       trigger_interval: str | None = None, **prepare_kw) -> RiskFlowHandles:
    """The complete job with the default settings: Kafka transactions ->
    validated, enriched rows to the lake topic; high-risk windows to the alert
    sink (and to ``risk_topic`` when given). Each query checkpoints under
    ``checkpoint_dir``; ``open_records``/``sink_format``/``sink_dir`` replace the
    broker (tests, replays). Await with ``handles.await_any()``.

    The users that the profile join salts are the hot ones of the topic's last
    ``history_hours`` (or of ``open_history()``, connector rows as a batch), taken when
    the flow starts; they are looked up only if the profile is too large to broadcast.
    """
    from riskflow.config import DEFAULT_BOOTSTRAP_SERVERS, DEFAULT_INPUT_TOPIC
    from riskflow.sinks.alerts import start_high_risk_alert_stream
    from riskflow.sinks.kafka import write_high_risk_transactions, write_lake_transactions_to_kafka
    from riskflow.sources.kafka import kafka_history_options, kafka_source_options, open_kafka_batch, open_kafka_stream

    servers = bootstrap_servers or DEFAULT_BOOTSTRAP_SERVERS
    if open_records is None:
        opts = kafka_source_options(servers, input_topic or DEFAULT_INPUT_TOPIC, starting_offsets,
                                    max_offsets_per_trigger)

        def open_records():
            return open_kafka_stream(spark, opts)

        if open_history is None:
            def open_history():
                return open_kafka_batch(spark, kafka_history_options(servers, input_topic or DEFAULT_INPUT_TOPIC, history_hours))

    def sink_kw(name):
        kw = {"bootstrap_servers": servers, "checkpoint_path": f"{checkpoint_dir}/{name}",
              "fmt": sink_format, "available_now": available_now,
              "trigger_interval": trigger_interval}
        if sink_format != "kafka":
            kw["path"] = f"{sink_dir}/{name}"
        return kw

    risk_sink = None
    if risk_topic is not None:
        def risk_sink(df):
            return write_high_risk_transactions(df, output_topic=risk_topic, **sink_kw("risk"))

    return start_risk_flow(
        open_records, params, profile=profile, history=open_history, **prepare_kw,
        lake_sink=lambda df: write_lake_transactions_to_kafka(df, output_topic=lake_topic, **sink_kw("lake")),
        risk_sink=risk_sink,
        alert_sink=lambda df: start_high_risk_alert_stream(
            df, f"{checkpoint_dir}/alerts", alerts_path=alerts_path, available_now=available_now,
            trigger_interval=trigger_interval),
    )
