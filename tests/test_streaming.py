"""Streaming: stream == batch, late data, recovery, output modes, fan-out, sinks."""

import datetime as dt
import json
import time
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from riskflow.config import FIXTURE_PARAMS, RiskParams
from riskflow.functions.columns import flatten_window
from riskflow.operators import cdc
from riskflow.plans.risk_flow import prepare_transactions, risk_from_records, start_risk_flow
from riskflow.schemas import KAFKA_RECORD_SCHEMA
from riskflow.sinks.alerts import alert_batch_writer, start_high_risk_alert_stream
from riskflow.sinks.kafka import write_to_kafka
from riskflow.sinks.lake import persist_transactions_to_data_lake
from riskflow.sources import fixtures
from riskflow.streaming.replay import replay_stream, write_ordered_replay, write_sentinel
from riskflow.streaming.late import late_rows, rocksdb_state
from riskflow.streaming.runner import await_any_termination, drain, dropped_by_watermark

from conftest import SF_SMALL


def records(spark, rows):
    """Connector rows from (transaction_id, user_id, amount, 'HH:MM:SS' on 2024-01-01)."""
    out = []
    for i, (tid, uid, amount, hms) in enumerate(rows):
        value = json.dumps({"transaction_id": tid, "user_id": uid, "amount": amount,
                            "timestamp": f"2024-01-01T{hms}Z"})
        out.append((uid.encode() if uid else None, value.encode(), "t", 0, i, None, 0))
    return spark.createDataFrame(out, KAFKA_RECORD_SCHEMA)


def write_batches(spark, base, batches):
    for i, rows in enumerate(batches):
        records(spark, rows).coalesce(1).write.parquet(f"{base}/src/b{i:03d}")
        time.sleep(0.05)
    return f"{base}/src/*"


def test_stream_equals_batch_on_ordered_replay(spark, scratch):
    """Dirty records replayed one day per micro-batch, in event-time order,
    then a sentinel far ahead: the append-mode stream equals the batch answer."""
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    recs = fixtures.kafka_records(ev)
    days = [f"2024-01-{d:02d}" for d in range(1, 32)]
    write_ordered_replay(recs, f"{scratch}/replay", days)
    time.sleep(0.05)
    write_sentinel(recs, f"{scratch}/replay")
    stream = replay_stream(spark, f"{scratch}/replay/*", max_files_per_trigger=1)
    risk = risk_from_records(stream, FIXTURE_PARAMS)
    q = persist_transactions_to_data_lake(risk, f"{scratch}/out", f"{scratch}/ckpt", available_now=True)
    drain(q)
    got = spark.read.parquet(f"{scratch}/out")
    want = risk_from_records(recs, FIXTURE_PARAMS)
    assert len(q.recentProgress) > 10  # really many micro-batches
    assert spark.read.parquet(f"{scratch}/replay/slice_*").count() == recs.count()  # nothing left out
    assert got.count() == want.count() > 0
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    assert dropped_by_watermark(q) == 0


def _update_counts(spark, scratch, batches):
    glob = write_batches(spark, scratch, batches)
    stream = replay_stream(spark, glob, max_files_per_trigger=1)
    params = RiskParams(window_duration="1 minute", watermark_duration="5 minutes")
    totals = risk_from_records(stream, params.with_(tx_count_threshold=0))
    q = (totals.writeStream.outputMode("update").format("memory")
         .queryName(f"late_{abs(hash(scratch))}").option("checkpointLocation", f"{scratch}/ckpt")
         .trigger(availableNow=True).start())
    drain(q)
    rows = spark.table(f"late_{abs(hash(scratch))}").where(
        F.col("window.start") == F.lit("2024-01-01 00:00:00").cast("timestamp")).collect()
    return max((r["tx_count"] for r in rows), default=0), dropped_by_watermark(q)


def test_late_row_behind_watermark_is_dropped(spark, scratch):
    batches = [[("a", "u", 1, "00:00:50")], [("b", "u", 1, "00:10:00")],
               [("c", "u", 1, "00:10:05")], [("d", "u", 1, "00:00:55")]]
    count, dropped = _update_counts(spark, scratch, batches)
    assert count == 1 and dropped == 1


def _side_rows(spark, scratch, batches, restart=False):
    """Transaction ids of the late rows, and the number that the aggregation drops from the same batches."""
    params = RiskParams(window_duration="1 minute", watermark_duration="5 minutes", tx_count_threshold=0)
    glob = write_batches(spark, scratch, [] if restart else batches)
    for i in range(len(batches) if restart else 1):
        if restart:
            records(spark, batches[i]).write.parquet(f"{glob[:-2]}/r{i}")
        with rocksdb_state(spark):
            tx = prepare_transactions(replay_stream(spark, glob, max_files_per_trigger=1), params)
            drain(persist_transactions_to_data_lake(late_rows(tx, params, slots=3), f"{scratch}/late", f"{scratch}/late-ck", available_now=True))
    late = [r["transaction_id"] for r in spark.read.parquet(f"{scratch}/late").collect()]
    q = (risk_from_records(replay_stream(spark, glob, max_files_per_trigger=1), params).writeStream.outputMode("update")
         .format("noop").option("checkpointLocation", f"{scratch}/agg-ck").trigger(availableNow=True).start())
    return sorted(late), dropped_by_watermark(drain(q))


def test_late_rows_are_the_dropped_ones(spark, scratch):
    # a batch's rows meet the watermark of the batch before, so e and f, j and l are not late
    batches = [[("a", "u", 1, "00:00:50")], [("b", "u", 1, "00:10:00"), ("e", "v", 1, "00:00:10")],
               [("c", "u", 1, "00:10:05"), ("f", "w", 1, "00:04:59"), ("n", "u", 1, None)],
               [("d", "u", 1, "00:00:55"), ("g", "new", 1, "00:04:59.999"), ("h", "u", 1, "00:05:00"), ("x", None, 1, "00:00:01")],
               [("i", "u", 1, "00:20:00")], [("j", "u", 1, "00:14:59"), ("l", "u", 1, "00:13:00")],
               [("m", "u", 1, "00:14:59"), ("o", "u", 1, "00:15:00"), ("p", "u", 1, "00:13:00")]]
    late, dropped = _side_rows(spark, scratch, batches)
    assert late == ["d", "g", "m", "p"]
    assert dropped == len(late)


def test_late_rows_over_restarts(spark, scratch):
    batches = [[("a", "u", 1, "00:00:50")], [("b", "u", 1, "00:10:00")], [("d", "u", 1, "00:00:55"), ("e", "v", 1, "00:09:00")]]
    late, _ = _side_rows(spark, scratch, batches, restart=True)
    assert late == ["d"]


def test_row_before_watermark_moves_is_counted(spark, scratch):
    batches = [[("a", "u", 1, "00:00:50")], [("d", "u", 1, "00:00:55")], [("b", "u", 1, "00:10:00")]]
    count, dropped = _update_counts(spark, scratch, batches)
    assert count == 2 and dropped == 0


def test_rejected_row_does_not_move_watermark(spark, scratch):
    # a negative amount far in the future is filtered below the watermark
    batches = [[("a", "u", 1, "00:00:50")], [("x", "u", -5, "23:00:00")], [("d", "u", 1, "00:00:55")]]
    count, dropped = _update_counts(spark, scratch, batches)
    assert count == 2 and dropped == 0


def test_checkpoint_recovery_continues_open_window(spark, scratch):
    params = RiskParams(window_duration="1 minute", tx_count_threshold=0)
    src = f"{scratch}/src"
    records(spark, [("a", "u", 1, "00:00:10")]).write.parquet(f"{src}/b0")

    def run():
        stream = replay_stream(spark, f"{src}/*")
        risk = risk_from_records(stream, params)
        drain(persist_transactions_to_data_lake(risk, f"{scratch}/out", f"{scratch}/ckpt",
                                                available_now=True))

    run()
    assert spark.read.parquet(f"{scratch}/out").count() == 0  # window still open
    time.sleep(0.05)
    records(spark, [("b", "u", 2, "00:00:20")]).write.parquet(f"{src}/b1")
    time.sleep(0.05)
    records(spark, [("s", "s", 0, "01:00:00")]).write.parquet(f"{src}/b2")
    run()
    out = spark.read.parquet(f"{scratch}/out").collect()
    assert [(r["user_id"], r["tx_count"], r["total_amount"]) for r in out] == [("u", 2, Decimal("3.00"))]


def test_output_modes(spark, scratch):
    glob = write_batches(spark, scratch, [[("a", "u", 1, "00:00:10"), ("b", "v", 2, "00:00:20")]])
    totals = risk_from_records(replay_stream(spark, glob), RiskParams(tx_count_threshold=0))
    q = (totals.writeStream.outputMode("complete").format("memory").queryName("complete_out")
         .trigger(availableNow=True).option("checkpointLocation", f"{scratch}/c1").start())
    drain(q)
    assert spark.table("complete_out").count() == 2
    with pytest.raises(ValueError):
        persist_transactions_to_data_lake(totals, f"{scratch}/o", f"{scratch}/c2", output_mode="update")
    with pytest.raises(ValueError):
        write_to_kafka(totals, output_mode="sometimes")


def test_fan_out_and_alert_sink(spark, scratch):
    glob = write_batches(spark, scratch, [
        [("a", "u", 200, "00:00:10"), ("b", "u", 200, "00:00:20")],
        [("s", "s", 0, "02:00:00")]])
    params = RiskParams(window_duration="1 minute", amount_threshold=Decimal("300"))

    def open_records():
        return replay_stream(spark, glob, max_files_per_trigger=1)

    handles = start_risk_flow(
        open_records, params,
        lake_sink=lambda df: persist_transactions_to_data_lake(
            df, f"{scratch}/lake", f"{scratch}/ck_lake", available_now=True),
        alert_sink=lambda df: start_high_risk_alert_stream(
            df, f"{scratch}/ck_alert", alerts_path=f"{scratch}/alerts", available_now=True))
    for q in handles.queries.values():
        drain(q)
    assert spark.read.parquet(f"{scratch}/lake").count() == 3
    alerts = spark.read.parquet(f"{scratch}/alerts").collect()
    assert [a["alert_text"] for a in alerts] == [
        "[ALERT] High-risk transaction detected: User=u | Count=2 | Amount=400.00"]


def test_alert_writer_is_idempotent_per_batch(spark, scratch):
    risk = spark.createDataFrame([("u", 5, Decimal("1.00"))], "user_id string, tx_count long, total_amount decimal(20,2)")
    writer = alert_batch_writer(f"{scratch}/alerts", log_limit=0)
    writer(risk, 7)
    writer(risk, 7)   # replayed batch
    writer(risk, 8)
    assert spark.read.parquet(f"{scratch}/alerts").groupBy("batch_id").count().orderBy("batch_id").collect() == [
        (7, 1), (8, 1)]


def boom(df, batch_id):
    raise RuntimeError("sink failed")


def test_await_any_reraises_the_sinks_own_failure(spark, scratch):
    glob = write_batches(spark, scratch, [[("a", "u", 1, "00:00:10")]])
    idle = replay_stream(spark, glob).writeStream.format("noop").option("checkpointLocation", f"{scratch}/ck0").start()
    failing = (replay_stream(spark, glob).writeStream.foreachBatch(boom)
               .option("checkpointLocation", f"{scratch}/ck").start())
    with pytest.raises(Exception, match="sink failed"):
        await_any_termination([idle, failing], timeout=120)
    assert not idle.isActive  # the others are stopped


def _idle_and_failing(spark, base):
    glob = write_batches(spark, f"{base}/pair", [[("a", "u", 1, "00:00:10")]])
    idle = replay_stream(spark, glob).writeStream.format("noop").option("checkpointLocation", f"{base}/ck-idle").start()
    failing = replay_stream(spark, glob).writeStream.foreachBatch(boom).option("checkpointLocation", f"{base}/ck-failing").start()
    return idle, failing


def test_a_failure_wakes_the_waiter_without_polling(spark, scratch, monkeypatch):
    from riskflow.streaming import monitor as mon

    idle, failing = _idle_and_failing(spark, scratch)
    checks = []
    real = type(idle).isActive
    monkeypatch.setattr(type(idle), "isActive", property(lambda self: checks.append(1) or real.fget(self)))
    with pytest.raises(Exception, match="sink failed"):
        await_any_termination([idle, failing], timeout=120)
    assert len(checks) <= 8  # two a waking, and the stopping
    assert mon.RECHECK_SECONDS >= 60


def test_monitor_keeps_progress_and_failures(spark, scratch):
    from riskflow.streaming.monitor import QueryMonitor

    with QueryMonitor(spark, f"{scratch}/monitor") as monitor:
        glob = write_batches(spark, scratch, [[("a", "u", 1, "00:00:10")], [("b", "u", 2, "00:10:20"), ("c", "v", 2, "00:20:00")],
                                           [("e", "v", 2, "00:20:01")], [("d", "u", 1, "00:00:01")]])
        stream = replay_stream(spark, glob, max_files_per_trigger=1)
        good = persist_transactions_to_data_lake(risk_from_records(stream, RiskParams(tx_count_threshold=0)), f"{scratch}/o", f"{scratch}/c", available_now=True)
        drain(good)
        idle, failing = _idle_and_failing(spark, f"{scratch}/x")
        with pytest.raises(Exception, match="sink failed"):
            await_any_termination([idle, failing], timeout=120)
    rows = monitor.table().collect()
    mine = [r for r in rows if r["run_id"] == str(good.runId)]
    assert sum(r["input_rows"] or 0 for r in mine) == 5 and [r["event"] for r in mine].count("ended") == 1
    assert {r["batch_id"] for r in mine if r["input_rows"]} == {0, 1, 2, 3} and all(r["error"] is None for r in mine)
    assert any(r["watermark"] for r in mine) and sum(r["dropped_rows"] or 0 for r in mine) == 1
    assert ["sink failed" in r["error"] for r in rows if r["run_id"] == str(failing.runId) and r["event"] == "ended"] == [True]
    assert [r["error"] for r in rows if r["run_id"] == str(idle.runId) and r["event"] == "ended"] == [None]


def test_await_any_ignores_other_queries_of_the_session(spark, scratch):
    glob = write_batches(spark, scratch, [[("a", "u", 1, "00:00:10")]])
    ended = replay_stream(spark, glob).writeStream.foreachBatch(boom).option("checkpointLocation", f"{scratch}/ck0").start()
    with pytest.raises(Exception):
        ended.awaitTermination(120)
    mine = (replay_stream(spark, glob).writeStream.format("noop").trigger(processingTime="1 second")
            .option("checkpointLocation", f"{scratch}/ck").start())
    try:
        started = time.monotonic()
        assert await_any_termination([mine], timeout=0.7) is None
        assert time.monotonic() - started >= 0.6 and mine.isActive
    finally:
        mine.stop()
    assert await_any_termination([mine], timeout=60) is mine
    spark.streams.resetTerminated()


def test_default_alert_sink_keeps_all_alerts_over_a_restart(spark, scratch):
    """More alerts than the log shows, several state partitions, no alerts path."""
    users = [f"u{i}" for i in range(60)]
    write_batches(spark, scratch, [[(f"a{u}", u, 400, "00:00:10") for u in users]])
    params = RiskParams(window_duration="1 minute", amount_threshold=Decimal("300"))

    def run():
        risk = risk_from_records(replay_stream(spark, f"{scratch}/src/*"), params)
        drain(start_high_risk_alert_stream(risk, f"{scratch}/ck_alert", available_now=True))

    run()
    time.sleep(0.05)
    records(spark, [(f"b{u}", u, 500, "00:30:10") for u in users] + [("s", "s", 0, "02:00:00")]).write.parquet(f"{scratch}/src/later")
    run()
    alerts = spark.read.parquet(f"{scratch}/ck_alert-alerts")
    assert alerts.count() == 120 and alerts.select("alert_text").distinct().count() == 120


def test_lake_sink_with_a_processing_time_trigger(spark, scratch):
    glob = write_batches(spark, scratch, [[("a", "u", 1, "00:00:10")]])
    query = persist_transactions_to_data_lake(prepare_transactions(replay_stream(spark, glob), RiskParams()), f"{scratch}/lake",
                                              f"{scratch}/ck", trigger_interval="1 second")
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    assert spark.read.parquet(f"{scratch}/lake").count() == 1


def test_cdc_snapshot_stream_keeps_tombstones(spark, scratch):
    schema = "key long, op string, ts timestamp_ntz, seq long, after struct<v:string>"
    t = lambda h: dt.datetime(2024, 1, 1, h)
    batches = [
        [(1, "c", t(1), 1, ("a",)), (2, "c", t(1), 1, ("b",))],
        [(1, "d", t(3), 3, None), (2, "u", t(3), 4, ("b2",))],
        [(1, "u", t(4), 2, ("late",))],          # before the delete in the log's order: ignored
    ]
    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{scratch}/log/b{i}")
        time.sleep(0.05)
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{scratch}/log/*")
    drain(cdc.start_snapshot_stream(stream, f"{scratch}/snap", f"{scratch}/ck", available_now=True))
    live = cdc.read_snapshot(spark, f"{scratch}/snap").collect()
    assert [(r["key"], r["v"]) for r in live] == [(2, "b2")]
    batch = cdc.current_state(spark.createDataFrame([r for b in batches for r in b], schema))
    assert [(r["key"], r["v"]) for r in batch.collect()] == [(2, "b2")]


def test_stream_static_profile_join(spark, scratch):
    glob = write_batches(spark, scratch, [[("a", "u1", 1, "00:00:10"), ("b", "u9", 2, "00:00:20")]])
    profile = spark.createDataFrame([("u1", "RETAIL")], "user_id string, risk_category string")
    tx = prepare_transactions(replay_stream(spark, glob), RiskParams(), profile=profile,
                              default_category="UNKNOWN")
    q = (tx.writeStream.format("memory").queryName("enriched_stream")
         .option("checkpointLocation", f"{scratch}/ck").trigger(availableNow=True).start())
    drain(q)
    got = {r["transaction_id"]: r["risk_category"] for r in spark.table("enriched_stream").collect()}
    assert got == {"a": "RETAIL", "b": "UNKNOWN"}


def test_default_flow_wiring(spark, scratch):
    from riskflow.plans.risk_flow import start_default_flow
    glob = write_batches(spark, scratch, [
        [("a", "u", 200, "00:00:10"), ("b", "u", 200, "00:00:20"), ("x", None, 5, "00:00:30")],
        [("s", "s", 0, "02:00:00")]])
    params = RiskParams(window_duration="1 minute", amount_threshold=Decimal("300"))
    handles = start_default_flow(
        spark, f"{scratch}/ck", params, risk_topic="risk",
        open_records=lambda: replay_stream(spark, glob, max_files_per_trigger=1),
        sink_format="parquet", sink_dir=f"{scratch}/sinks", alerts_path=f"{scratch}/alerts",
        available_now=True)
    assert set(handles.queries) == {"lake", "risk", "alerts"}
    for q in handles.queries.values():
        drain(q)
    assert spark.read.parquet(f"{scratch}/sinks/lake").count() == 3      # the NULL user is rejected
    risk = spark.read.parquet(f"{scratch}/sinks/risk").collect()
    assert [r["key"] for r in risk] == ["u"]
    assert spark.read.parquet(f"{scratch}/alerts").count() == 1


def test_cluster_conf_sizes_partitions():
    from riskflow.session import cluster_conf
    conf = cluster_conf(100 << 40)   # 100 TiB of shuffle
    assert int(conf["spark.sql.shuffle.partitions"]) == 409600
    assert cluster_conf(1 << 20)["spark.sql.shuffle.partitions"] == "200"
