"""Named queries over the driver tables: ``name -> fn(spark, sf_dir) -> DataFrame``.

Each query reads whole tables (events, customer, lineitem, orders) through the
fixture rules and runs one operator of the library, so its work grows with the
tables. Timestamps of results are UTC wall clocks (TIMESTAMP_NTZ) and windows
are flattened to ``window_start``/``window_end`` so that the SQL oracle in
``riskflow.plans.oracle`` can be compared value for value.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, LongType, StringType, StructField, StructType, TimestampType

from riskflow.config import FIXTURE_PARAMS
from riskflow.functions.columns import as_utc_instant, flatten_window, utc_wall_clock
from riskflow.operators import cdc, contracts, lineage
from riskflow.operators.registry import SchemaRegistry
from riskflow.operators.storage_estimate import estimate_storage, parquet_data_bytes
from riskflow.operators.enrich import augment_with_profile, augment_with_self_profile
from riskflow.operators.messages import alert_messages, to_kafka_messages
from riskflow.operators.risk import detect_high_risk, window_totals
from riskflow.operators.validate import (
    dedup_transactions,
    distinct_users,
    parse_transactions,
    rejected_transactions,
)
from riskflow.plans.risk_flow import prepare_transactions, risk_from_records, risk_from_transactions, start_default_flow
from riskflow.schemas import TRANSACTION_SCHEMA
from riskflow.session import scratch_path, sf_table, state_partitions
from riskflow.sinks.alerts import start_high_risk_alert_stream
from riskflow.sinks.clustered_lake import ClusteredLake
from riskflow.sinks.kafka import write_high_risk_transactions, write_lake_transactions_to_kafka
from riskflow.sinks.lake import persist_transactions_to_data_lake, with_event_date
from riskflow.sinks.unique_lake import read_unique_lake, start_unique_lake
from riskflow.sources import fixtures
from riskflow.sources.cdc import decode_change_events
from riskflow.sources.kafka import decode_envelope, read_bronze
from riskflow.streaming.late import late_rows, rocksdb_state
from riskflow.streaming.monitor import QueryMonitor
from riskflow.streaming.replay import SENTINEL_ID, replay_stream, write_replay, write_sentinel, write_slice
from riskflow.streaming.runner import drain

QueryFn = Callable[[SparkSession, str], DataFrame]
PARAMS = FIXTURE_PARAMS
UNKNOWN_CATEGORY = "UNKNOWN"

RISK_MESSAGE_SCHEMA = StructType([
    StructField("window", StructType([
        StructField("start", TimestampType()),
        StructField("end", TimestampType()),
    ])),
    StructField("user_id", StringType()),
    StructField("tx_count", LongType()),
    StructField("total_amount", DecimalType(20, 2)),
])

ALERT_TABLE_SCHEMA = StructType([
    StructField("window", RISK_MESSAGE_SCHEMA["window"].dataType),
    StructField("user_id", StringType()),
    StructField("alert_text", StringType()),
    StructField("batch_id", LongType()),
])


def _events(spark, sf_dir):
    return sf_table(spark, sf_dir, "events")


def _records(spark, sf_dir, dirty=True):
    return fixtures.kafka_records(_events(spark, sf_dir), dirty=dirty)


def _utc_ts(df: DataFrame, col: str = "timestamp") -> DataFrame:
    return df.withColumn(col, utc_wall_clock(F.col(col)))


def _valid_tx(spark, sf_dir, **kw) -> DataFrame:
    return prepare_transactions(_records(spark, sf_dir), PARAMS, **kw)


# --- A1-A3, W2, P10: windowed risk on clean transactions -------------------

def q_high_risk_transactions(spark, sf_dir):
    tx = fixtures.transactions(_events(spark, sf_dir))
    return flatten_window(detect_high_risk(tx, PARAMS))


def q_user_window_totals(spark, sf_dir):
    tx = fixtures.transactions(_events(spark, sf_dir))
    return flatten_window(window_totals(tx, PARAMS))


# --- S1, S2, P1-P3: envelope and JSON decode on dirty records ---------------

def q_kafka_envelope_decode(spark, sf_dir):
    return decode_envelope(_records(spark, sf_dir), keep=("topic", "partition", "offset"))


def q_kafka_typed_decode(spark, sf_dir):
    return _utc_ts(decode_envelope(_records(spark, sf_dir), TRANSACTION_SCHEMA))


def q_parse_transactions(spark, sf_dir):
    return _utc_ts(parse_transactions(_records(spark, sf_dir)))


# --- P7-P9, W11, A4: validation, audit, de-duplication ----------------------

def q_validate_transactions(spark, sf_dir):
    return _utc_ts(_valid_tx(spark, sf_dir))


def q_rejected_transactions(spark, sf_dir):
    return _utc_ts(rejected_transactions(parse_transactions(_records(spark, sf_dir))))


def q_dedup_transactions(spark, sf_dir):
    return _utc_ts(dedup_transactions(_valid_tx(spark, sf_dir)))


def q_distinct_users(spark, sf_dir):
    return distinct_users(_valid_tx(spark, sf_dir))


# --- S4, J1, J2, P6: enrichment --------------------------------------------

def q_augment_user_profile(spark, sf_dir):
    profile = fixtures.user_profiles(sf_table(spark, sf_dir, "customer"))
    tx = augment_with_profile(_valid_tx(spark, sf_dir), profile,
                              default_category=UNKNOWN_CATEGORY)
    return _utc_ts(tx)


def q_augment_self_profile(spark, sf_dir):
    return _utc_ts(augment_with_self_profile(parse_transactions(_records(spark, sf_dir))))


def q_augment_hot_user(spark, sf_dir):
    """A third of all rows on one user, and a profile that may not be broadcast: hot users only are salted."""
    records = fixtures.kafka_records(fixtures.hot_user_events(_events(spark, sf_dir)))
    profile = fixtures.user_profiles(sf_table(spark, sf_dir, "customer"))
    return _utc_ts(prepare_transactions(records, PARAMS, profile=profile, default_category=UNKNOWN_CATEGORY, max_broadcast_bytes=0))


# --- K1, K2, K4, P4, P11: outgoing messages --------------------------------

def _risk_rows(spark, sf_dir):
    return risk_from_transactions(_valid_tx(spark, sf_dir), PARAMS)


def q_risk_alert_messages(spark, sf_dir):
    msgs = to_kafka_messages(_risk_rows(spark, sf_dir), key_col="user_id")
    parsed = msgs.select("key", F.from_json("value", RISK_MESSAGE_SCHEMA).alias("v")).select("key", "v.*")
    return flatten_window(parsed, utc=True)


def q_lake_messages(spark, sf_dir):
    profile = fixtures.user_profiles(sf_table(spark, sf_dir, "customer"))
    tx = augment_with_profile(_valid_tx(spark, sf_dir), profile,
                              default_category=UNKNOWN_CATEGORY)
    msgs = to_kafka_messages(tx, key_col="user_id")
    schema = StructType(TRANSACTION_SCHEMA.fields + [StructField("risk_category", StringType())])
    parsed = msgs.select("key", F.from_json("value", schema).alias("v")).select("key", "v.*")
    return _utc_ts(parsed)


def q_alert_text(spark, sf_dir):
    return flatten_window(alert_messages(_risk_rows(spark, sf_dir)), utc=True)


QUERIES: dict[str, QueryFn] = {
    "high_risk_transactions": q_high_risk_transactions,
    "user_window_totals": q_user_window_totals,
    "kafka_envelope_decode": q_kafka_envelope_decode,
    "kafka_typed_decode": q_kafka_typed_decode,
    "parse_transactions": q_parse_transactions,
    "validate_transactions": q_validate_transactions,
    "rejected_transactions": q_rejected_transactions,
    "dedup_transactions": q_dedup_transactions,
    "distinct_users": q_distinct_users,
    "augment_user_profile": q_augment_user_profile,
    "augment_self_profile": q_augment_self_profile,
    "augment_hot_user": q_augment_hot_user,
    "risk_alert_messages": q_risk_alert_messages,
    "lake_messages": q_lake_messages,
    "alert_text": q_alert_text,
}


# --- W1-W10, K1, K3, K4, S3, C1: the same plans as streams -----------------
# Each stream query replays the dirty records as files under the shared
# checkpoint directory, drains the stream with an availableNow trigger and
# returns the sink's committed output read back as a table.

def _replay(spark, sf_dir, name, sentinel=True):
    base = scratch_path(spark, name)
    glob = write_replay(_records(spark, sf_dir), f"{base}/replay", sentinel=sentinel)
    return base, replay_stream(spark, glob)


def _sized(spark, base):
    """State partitions for the volume of the files under ``base``."""
    return state_partitions(spark, parquet_data_bytes(spark, base))


def q_high_risk_stream(spark, sf_dir):
    base, stream = _replay(spark, sf_dir, "high-risk-stream")
    risk = risk_from_records(stream, PARAMS)
    with _sized(spark, base):
        drain(persist_transactions_to_data_lake(
            risk, output_path=f"{base}/out", checkpoint_path=f"{base}/ckpt", available_now=True))
    return flatten_window(spark.read.parquet(f"{base}/out"), utc=True)


def _slices(spark, sf_dir, n=3):
    """Bounds of ``n`` event-time slices of equal length, as text."""
    lo, hi = _events(spark, sf_dir).agg(F.min("ts"), F.max("ts")).first()
    if lo is None:
        return []
    return [str(lo + (hi - lo) * i / n) for i in range(n + 1)]


def q_high_risk_incremental(spark, sf_dir):
    """Incremental runs: event-time slices arrive one after another as new files
    and the same stream is re-run with ``availableNow`` on one checkpoint, so
    open windows, their state and the watermark carry over the restarts. The
    number of slices is fixed; rows without a time come with the first."""
    base = scratch_path(spark, "high-risk-incremental")
    bounds = _slices(spark, sf_dir)
    records = fixtures.kafka_records(_events(spark, sf_dir))
    with state_partitions(spark, parquet_data_bytes(spark, f"{sf_dir}/events.parquet")):
        for i in range(len(bounds) - 1):
            write_slice(records, f"{base}/arrivals", bounds, i)
            _risk_run(spark, base)
        write_sentinel(records, f"{base}/arrivals")
        _risk_run(spark, base)
    return flatten_window(spark.read.parquet(f"{base}/out"), utc=True)


def _risk_run(spark, base):
    """One run of the risk stream over the arrivals that its checkpoint has not seen."""
    risk = risk_from_records(replay_stream(spark, f"{base}/arrivals/*"), PARAMS)
    drain(persist_transactions_to_data_lake(
        risk, output_path=f"{base}/out", checkpoint_path=f"{base}/ckpt", available_now=True))


LATE_EVERY = 37  # every 37th event arrives after all others


def _late_arrivals(spark, sf_dir, base, run):
    """Three runs over arriving files: every 37th event comes after the watermark has reached the end of the others, then a sentinel."""
    events = _events(spark, sf_dir)
    late = F.col("event_id") % LATE_EVERY == 0
    on_time = fixtures.kafka_records(events.where(~late), dirty=True)
    on_time.write.parquet(f"{base}/arrivals/a_on_time")
    with _sized(spark, f"{base}/arrivals"):
        run(spark, base)
        fixtures.kafka_records(events.where(late), dirty=True).write.parquet(f"{base}/arrivals/b_late")
        run(spark, base)
        write_sentinel(on_time, f"{base}/arrivals")
        run(spark, base)


def q_late_rows_stream(spark, sf_dir):
    """Late data: every 37th event arrives in a second run, after the watermark
    has reached the end of the others; rows whose window has closed are dropped."""
    base = scratch_path(spark, "late-rows")
    _late_arrivals(spark, sf_dir, base, _risk_run)
    return flatten_window(spark.read.parquet(f"{base}/out"), utc=True)


def _late_run(spark, base):
    tx = prepare_transactions(replay_stream(spark, f"{base}/arrivals/*"), PARAMS)
    with rocksdb_state(spark):
        drain(persist_transactions_to_data_lake(
            late_rows(tx, PARAMS), output_path=f"{base}/out", checkpoint_path=f"{base}/ckpt", available_now=True))


def q_late_rows_side_stream(spark, sf_dir):
    """The rows that ``late_rows_stream`` drops, from the same arrivals."""
    base = scratch_path(spark, "late-side")
    _late_arrivals(spark, sf_dir, base, _late_run)
    return _utc_ts(_utc_ts(spark.read.parquet(f"{base}/out")), "watermark")


def _by_slices(spark, sf_dir, path, run):
    """``run()`` after each of three event-time slices has arrived under ``path``; a slice is a micro-batch."""
    records, bounds = _records(spark, sf_dir), _slices(spark, sf_dir)
    with state_partitions(spark, parquet_data_bytes(spark, f"{sf_dir}/events.parquet")):
        for i in range(len(bounds) - 1):
            write_slice(records, path, bounds, i)
            run()


def q_risk_update_stream(spark, sf_dir):
    """Update mode over several micro-batches: a group is sent whenever it
    changes; the last message of each (window, user) is the batch answer."""
    base = scratch_path(spark, "risk-update")

    def run():
        drain(start_high_risk_alert_stream(
            risk_from_records(replay_stream(spark, f"{base}/replay/*"), PARAMS), checkpoint_path=f"{base}/ckpt",
            alerts_path=f"{base}/alerts", output_mode="update", log_limit=0, available_now=True))

    _by_slices(spark, sf_dir, f"{base}/replay", run)
    alerts = spark.read.schema(ALERT_TABLE_SCHEMA).parquet(f"{base}/alerts")
    last = alerts.groupBy("window", "user_id").agg(F.max_by("alert_text", "batch_id").alias("alert_text"))
    return flatten_window(last, utc=True)


def q_risk_flow_fanout(spark, sf_dir):
    """Lake, risk messages and alerts from one flow, with a restart of all three
    before the last windows close."""
    base = scratch_path(spark, "fanout")
    records = _records(spark, sf_dir)
    write_replay(records, f"{base}/replay", sentinel=False)

    def run():
        flow = start_default_flow(
            spark, f"{base}/ckpt", PARAMS, risk_topic="risk", sink_format="parquet", sink_dir=f"{base}/sinks",
            alerts_path=f"{base}/alerts", available_now=True,
            open_records=lambda: replay_stream(spark, f"{base}/replay/*"))
        for query in flow.queries.values():
            drain(query)

    with _sized(spark, f"{base}/replay"):
        run()
        write_sentinel(records, f"{base}/replay")
        run()

    tx = spark.read.parquet(f"{base}/sinks/lake").select(F.from_json("value", TRANSACTION_SCHEMA).alias("v")).select("v.*")
    lake = tx.where(F.col("transaction_id") != SENTINEL_ID).groupBy("user_id").agg(
        F.count(F.lit(1)).alias("tx_count"), F.sum("amount").alias("total_amount"))
    risk = spark.read.parquet(f"{base}/sinks/risk").select(F.from_json("value", RISK_MESSAGE_SCHEMA).alias("v")).select("v.*")
    alerts = spark.read.schema(ALERT_TABLE_SCHEMA).parquet(f"{base}/alerts").drop("batch_id")
    parts = {"lake": lake, "risk": flatten_window(risk, utc=True), "alerts": flatten_window(alerts, utc=True)}
    types = {"window_start": "timestamp_ntz", "window_end": "timestamp_ntz", "user_id": "string", "tx_count": "bigint",
             "total_amount": "decimal(20,2)", "alert_text": "string"}
    out = None
    for branch, rows in parts.items():
        cols = [(F.col(c) if c in rows.columns else F.lit(None)).cast(t).alias(c) for c, t in types.items()]
        rows = rows.select(F.lit(branch).alias("branch"), *cols)
        out = rows if out is None else out.unionByName(rows)
    return out


def q_query_progress(spark, sf_dir):
    """What the monitor's table says of the lake stream over three arrivals, a run each: batches and rows."""
    base = scratch_path(spark, "query-progress")
    ids = []

    def run():
        lake = prepare_transactions(replay_stream(spark, f"{base}/replay/*"), PARAMS)
        query = persist_transactions_to_data_lake(lake, output_path=f"{base}/lake", checkpoint_path=f"{base}/ckpt", available_now=True)
        ids.append(str(query.id))
        drain(query)

    with QueryMonitor(spark, f"{base}/monitor") as monitor:
        _by_slices(spark, sf_dir, f"{base}/replay", run)
    rows = monitor.table().where(F.col("id").isin(ids))
    return rows.agg(F.sum("input_rows").alias("input_rows"),
                    F.count_if(F.col("event") == "started").alias("starts"), F.count_if(F.col("event") == "ended").alias("ends"),
                    F.count_if(F.col("error").isNotNull()).alias("failures"),
                    F.count_distinct(F.when(F.col("input_rows") > 0, F.col("batch_id"))).alias("batches"))


def q_risk_messages_stream(spark, sf_dir):
    base, stream = _replay(spark, sf_dir, "risk-messages-stream")
    risk = risk_from_records(stream, PARAMS)
    with _sized(spark, base):
        drain(write_high_risk_transactions(
            risk, fmt="parquet", path=f"{base}/out", checkpoint_path=f"{base}/ckpt",
            available_now=True))
    msgs = spark.read.parquet(f"{base}/out")
    parsed = msgs.select("key", F.from_json("value", RISK_MESSAGE_SCHEMA).alias("v")).select("key", "v.*")
    return flatten_window(parsed, utc=True)


def q_alert_stream(spark, sf_dir):
    base, stream = _replay(spark, sf_dir, "alert-stream")
    risk = risk_from_records(stream, PARAMS)
    with _sized(spark, base):
        drain(start_high_risk_alert_stream(
            risk, checkpoint_path=f"{base}/ckpt", alerts_path=f"{base}/alerts",
            log_limit=0, available_now=True))
    alerts = spark.read.schema(ALERT_TABLE_SCHEMA).parquet(f"{base}/alerts")
    return flatten_window(alerts.drop("batch_id"), utc=True)


def q_lake_roundtrip(spark, sf_dir):
    base, stream = _replay(spark, sf_dir, "lake-roundtrip", sentinel=False)
    lake = with_event_date(prepare_transactions(stream, PARAMS))
    with _sized(spark, base):
        drain(persist_transactions_to_data_lake(
            lake, output_path=f"{base}/lake", checkpoint_path=f"{base}/ckpt",
            partition_by=["event_date"], available_now=True))
    return _utc_ts(spark.read.parquet(f"{base}/lake"))


def q_lake_clustered(spark, sf_dir):
    """The validated stream in a lake of small files, compacted along a curve, and a
    range of users and times read from the files that may hold it."""
    base, stream = _replay(spark, sf_dir, "lake-clustered", sentinel=False)
    lake = ClusteredLake(spark, f"{base}/lake", ["timestamp", "user_id"])
    query = (prepare_transactions(stream, PARAMS).writeStream.option("checkpointLocation", f"{base}/ckpt")
             .foreachBatch(lambda batch, n: lake.append(batch.repartition(16)) if n >= len(lake.log.numbers()) else None)
             .trigger(availableNow=True).start())
    drain(query)
    lake.compact(target_rows=100_000)
    day = lambda d: as_utc_instant(F.lit(f"2024-01-{d} 00:00:00").cast("timestamp_ntz"))
    return _utc_ts(lake.read(timestamp=(day("08"), day("15")), user_id=("1", "3")))


def q_lake_messages_stream(spark, sf_dir):
    """Validated stream joined with the static profile, sent to the lake topic."""
    base, stream = _replay(spark, sf_dir, "lake-messages-stream", sentinel=False)
    profile = fixtures.user_profiles(sf_table(spark, sf_dir, "customer"))
    tx = prepare_transactions(stream, PARAMS, profile=profile, default_category=UNKNOWN_CATEGORY)
    with _sized(spark, base):
        drain(write_lake_transactions_to_kafka(
            tx, fmt="parquet", path=f"{base}/out", checkpoint_path=f"{base}/ckpt", available_now=True))
    schema = StructType(TRANSACTION_SCHEMA.fields + [StructField("risk_category", StringType())])
    msgs = spark.read.parquet(f"{base}/out")
    return _utc_ts(msgs.select("key", F.from_json("value", schema).alias("v")).select("key", "v.*"))


def q_hot_user_flow(spark, sf_dir):
    """The default flow on such rows: it finds the hot users in earlier records and salts them."""
    base = scratch_path(spark, "hot-user-flow")
    records = fixtures.kafka_records(fixtures.hot_user_events(_events(spark, sf_dir)))
    glob = write_replay(records, f"{base}/replay", sentinel=False)
    profile = fixtures.user_profiles(sf_table(spark, sf_dir, "customer"))
    with _sized(spark, f"{base}/replay"):
        flow = start_default_flow(
            spark, f"{base}/ckpt", PARAMS, profile=profile, sink_format="parquet", sink_dir=f"{base}/sinks",
            alerts_path=f"{base}/alerts", available_now=True, open_records=lambda: replay_stream(spark, glob),
            open_history=lambda: spark.read.schema(records.schema).parquet(glob),
            default_category=UNKNOWN_CATEGORY, max_broadcast_bytes=0)
        for query in flow.queries.values():
            drain(query)
    schema = StructType(TRANSACTION_SCHEMA.fields + [StructField("risk_category", StringType())])
    msgs = spark.read.parquet(f"{base}/sinks/lake")
    return _utc_ts(msgs.select(F.from_json("value", schema).alias("v")).select("v.*"))


def q_dedup_stream(spark, sf_dir):
    base, stream = _replay(spark, sf_dir, "dedup-stream", sentinel=False)
    tx = prepare_transactions(stream, PARAMS, dedup=True)
    with _sized(spark, base):
        drain(persist_transactions_to_data_lake(
            tx, output_path=f"{base}/out", checkpoint_path=f"{base}/ckpt", available_now=True))
    return _utc_ts(spark.read.parquet(f"{base}/out"))


REDELIVERED_EVERY = 11  # every 11th event comes again at the end


def q_unique_lake_stream(spark, sf_dir):
    """Redelivery long after the watermark: the lake takes every transaction once."""
    base = scratch_path(spark, "unique-lake")
    events = _events(spark, sf_dir)
    fixtures.kafka_records(events).write.parquet(f"{base}/arrivals/a_first")

    def run():
        tx = prepare_transactions(replay_stream(spark, f"{base}/arrivals/*"), PARAMS)
        drain(start_unique_lake(tx, f"{base}/lake", f"{base}/ckpt", available_now=True))

    run()
    fixtures.kafka_records(events.where(F.col("event_id") % REDELIVERED_EVERY == 0)).write.parquet(f"{base}/arrivals/b_again")
    run()
    return _utc_ts(read_unique_lake(spark, f"{base}/lake").drop("day"))


def q_bronze_ingest(spark, sf_dir):
    base, stream = _replay(spark, sf_dir, "bronze-ingest", sentinel=False)
    with _sized(spark, base):
        drain(persist_transactions_to_data_lake(
            read_bronze(spark, records=stream), output_path=f"{base}/bronze",
            checkpoint_path=f"{base}/ckpt", partition_by=["ingest_date"], available_now=True))
    bronze = spark.read.parquet(f"{base}/bronze")
    return bronze.groupBy("topic", "partition").agg(
        F.count(F.lit(1)).alias("n_records"),
        F.min("offset").alias("min_offset"),
        F.max("offset").alias("max_offset"),
        F.sum(F.length("value")).cast("long").alias("value_bytes"),
    )


QUERIES.update({
    "high_risk_stream": q_high_risk_stream,
    "high_risk_incremental": q_high_risk_incremental,
    "late_rows_stream": q_late_rows_stream,
    "late_rows_side_stream": q_late_rows_side_stream,
    "risk_update_stream": q_risk_update_stream,
    "risk_flow_fanout": q_risk_flow_fanout,
    "query_progress": q_query_progress,
    "risk_messages_stream": q_risk_messages_stream,
    "alert_stream": q_alert_stream,
    "lake_roundtrip": q_lake_roundtrip,
    "lake_clustered": q_lake_clustered,
    "lake_messages_stream": q_lake_messages_stream,
    "hot_user_flow": q_hot_user_flow,
    "dedup_stream": q_dedup_stream,
    "unique_lake_stream": q_unique_lake_stream,
    "bronze_ingest": q_bronze_ingest,
})


# --- R2-R6, P12, X1, X2: schema contracts over observed payloads -----------
# The catalog is derived from the data: payload rows of ``events`` -> observed
# fields (R5) -> definitions in the registry format -> flattened again (R2).

def _observed(spark, sf_dir):
    return contracts.observed_schema(fixtures.schema_payloads(_events(spark, sf_dir)))


def _catalog(spark, sf_dir):
    """Definitions of the observed schemas; even versions write string leaves in the short form."""
    catalog = contracts.definitions_from_fields(_observed(spark, sf_dir))
    short = F.replace("definition", F.lit('{"type":"STRING"}'), F.lit('"STRING"'))
    return catalog.withColumn("definition", F.when(F.col("version") % 2 == 0, short).otherwise(F.col("definition")))


def q_observed_schema(spark, sf_dir):
    return _observed(spark, sf_dir)


def q_observed_schema_keyed(spark, sf_dir):
    """Payloads with objects keyed by user and event ids: such keys are one path step."""
    return contracts.observed_schema(fixtures.keyed_payloads(_events(spark, sf_dir)))


def q_schema_fields(spark, sf_dir):
    return contracts.flatten_definitions(_catalog(spark, sf_dir)).drop("field_definition")


def q_schema_fingerprint(spark, sf_dir):
    catalog = _catalog(spark, sf_dir)
    return contracts.schema_fingerprints(contracts.flatten_definitions(catalog), catalog)


def q_schema_register(spark, sf_dir):
    """The first two versions of each topic as they are, the later ones registered
    without a number; the registry's record of each."""
    catalog = _catalog(spark, sf_dir)
    new = catalog.where("version > 2").select("topic", F.lit(None).cast("int").alias("version"), "definition",
                                              F.col("version").alias("place"))
    out = contracts.register_versions(catalog.where("version <= 2"), new, order_col="place")
    return contracts.registration_records(out).select(
        "topic", "version", "fingerprint", "n_fields", F.array_join("breaking", "\n").alias("breaking"))


def q_schema_registry(spark, sf_dir):
    """The same versions registered in a shared registry by two commits; its records."""
    catalog = _catalog(spark, sf_dir).checkpoint()
    registry = SchemaRegistry(spark, scratch_path(spark, "schema-registry"))
    registry.register(catalog.where("version <= 2"))
    registry.register(catalog.where("version > 2").select("topic", F.lit(None).cast("int").alias("version"), "definition",
                                                          F.col("version").alias("place")), order_col="place")
    return contracts.registration_records(registry.catalog()).select(
        "topic", "version", "fingerprint", "n_fields", F.array_join("breaking", "\n").alias("breaking"))


def q_schema_latest(spark, sf_dir):
    return contracts.latest_versions(_catalog(spark, sf_dir))


def q_schema_breaking_changes(spark, sf_dir):
    catalog = _catalog(spark, sf_dir)
    return contracts.breaking_changes(contracts.flatten_definitions(catalog), versions=catalog)


QUERIES.update({
    "observed_schema": q_observed_schema,
    "observed_schema_keyed": q_observed_schema_keyed,
    "schema_fields": q_schema_fields,
    "schema_fingerprint": q_schema_fingerprint,
    "schema_register": q_schema_register,
    "schema_registry": q_schema_registry,
    "schema_latest": q_schema_latest,
    "schema_breaking_changes": q_schema_breaking_changes,
})


# --- R7-R9: lineage over the star-schema edge log --------------------------

def _edges(spark, sf_dir):
    log = fixtures.lineage_edge_log(sf_table(spark, sf_dir, "lineitem"),
                                    sf_table(spark, sf_dir, "orders"),
                                    sf_table(spark, sf_dir, "part"))
    return lineage.latest_edges(log)


def q_lineage_edges_latest(spark, sf_dir):
    return _edges(spark, sf_dir)


def q_lineage_upstream(spark, sf_dir):
    """Upstream lineage of one customer of each nation, over all edges."""
    first = sf_table(spark, sf_dir, "customer").groupBy("c_nationkey").agg(F.min("c_custkey").alias("k"))
    targets = first.select(F.concat(F.lit("customer:"), F.col("k").cast("string")).alias("node"))
    return lineage.upstream_lineage(_edges(spark, sf_dir), targets)


def q_lineage_downstream(spark, sf_dir):
    """Impact of one part of each size, over all edges."""
    first = sf_table(spark, sf_dir, "part").groupBy("p_size").agg(F.min("p_partkey").alias("k"))
    origins = first.select(F.concat(F.lit("part:"), F.col("k").cast("string")).alias("node"))
    return lineage.downstream_lineage(_edges(spark, sf_dir), origins)


def q_lineage_deep(spark, sf_dir):
    """Upstream lineage of the middle event of each of fifty long rings: as deep as the table is long."""
    events = _events(spark, sf_dir)
    edges = lineage.latest_edges(fixtures.deep_edge_log(events))
    top = events.agg(F.max("event_id").alias("top"))
    middle = (F.floor(F.col("top") / (2 * fixtures.DEEP_CHAINS)) * fixtures.DEEP_CHAINS + F.col("chain")).cast("string")
    targets = top.select("top", F.explode(F.sequence(F.lit(0), F.lit(fixtures.DEEP_CHAINS - 1))).alias("chain"))
    targets = targets.where("top IS NOT NULL").select(F.concat(F.lit("event:"), middle).alias("node"))
    return lineage.upstream_lineage(edges, targets)


# --- S5: CDC fold; R1: storage estimate -------------------------------------

def q_cdc_current_state(spark, sf_dir):
    return cdc.current_state(fixtures.change_log(_events(spark, sf_dir)))


def q_cdc_change_events(spark, sf_dir):
    """Change events of the captured table's topic decoded and folded."""
    records = fixtures.change_event_records(_events(spark, sf_dir))
    row = StructType.fromDDL("event_type string, value double, props string")
    changes = decode_change_events(records, row, StructType.fromDDL("user_id bigint"), key_field="user_id")
    return cdc.current_state(changes.drop("before"))


def q_cdc_snapshot_stream(spark, sf_dir):
    """The change log in several micro-batches, folded into a bucketed snapshot."""
    base = scratch_path(spark, "cdc-snapshot")
    fixtures.change_log(_events(spark, sf_dir)).repartition(4, "seq").write.parquet(f"{base}/log")
    schema = spark.read.parquet(f"{base}/log").schema
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 2).parquet(f"{base}/log")
    with _sized(spark, base):
        drain(cdc.start_snapshot_stream(stream, f"{base}/snapshot", f"{base}/ckpt", available_now=True))
    return cdc.read_snapshot(spark, f"{base}/snapshot")


def q_estimate_storage(spark, sf_dir):
    """Row counts of the estimator, the first-rows form, and whether the estimate
    from the default sample is within 1.5 times, either way, of the table's files
    (of another writer)."""
    lineitem = sf_table(spark, sf_dir, "lineitem")
    estimate = estimate_storage(lineitem)
    first = estimate_storage(lineitem, sample_size_rows=100, method="limit").select(F.col("sample_rows").alias("first_rows"))
    real = parquet_data_bytes(spark, f"{sf_dir.rstrip('/')}/lineitem.parquet")
    return estimate.crossJoin(first).select(
        "row_count", "first_rows", F.col("estimated_bytes").between(real / 1.5, real * 1.5).alias("within_bounds"))


QUERIES.update({
    "lineage_edges_latest": q_lineage_edges_latest,
    "lineage_upstream": q_lineage_upstream,
    "lineage_downstream": q_lineage_downstream,
    "lineage_deep": q_lineage_deep,
    "cdc_current_state": q_cdc_current_state,
    "cdc_change_events": q_cdc_change_events,
    "cdc_snapshot_stream": q_cdc_snapshot_stream,
    "estimate_storage": q_estimate_storage,
})
