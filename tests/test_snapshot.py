"""The commit log and the snapshot table that is merged when it is read."""

import datetime as dt
import os
import random

import pytest

from riskflow.operators import cdc
from riskflow.sinks.commits import CommitConflictError, CommitLog

SCHEMA = "key long, op string, ts timestamp_ntz, seq long, after struct<v:string>"
T = dt.datetime(2024, 1, 1)


def changes(rng, n, keys, seq):
    out = []
    for i in range(n):
        op = rng.choice("cuuud")
        s = seq + i if rng.random() < 0.9 else rng.randrange(seq + 1)  # some arrive late
        out.append((rng.randrange(keys), op, T + dt.timedelta(seconds=s), s * 1000 + i, None if op == "d" else (f"v{s}",)))
    return out


def live(df):
    return sorted((r["key"], r["op"], r["seq"], r["v"]) for r in df.collect())


def bytes_under(path):
    return sum(os.path.getsize(os.path.join(d, f)) for d, _, files in os.walk(path) for f in files if f.endswith(".parquet"))


def test_commit_numbers_are_given_once(spark, scratch):
    one, two = CommitLog(spark, f"{scratch}/log"), CommitLog(spark, f"{scratch}/log")
    assert one.latest() == (None, None)
    one.commit(0, "a")
    with pytest.raises(CommitConflictError):
        two.commit(0, "b")
    two.commit(3, "ü")
    assert one.numbers() == [0, 3] and one.latest() == (3, "ü") and one.read(0) == "a"
    assert [f for f in os.listdir(f"{scratch}/log") if f.endswith(".json")] and len(os.listdir(f"{scratch}/log")) <= 6  # no drafts stay


def test_batches_splits_and_merges_equal_the_batch_fold(spark, scratch, monkeypatch):
    monkeypatch.setattr(cdc, "LEAST_PENDING", 20)
    monkeypatch.setattr(cdc, "FAN", 3)
    rng, seen, path = random.Random(4), [], f"{scratch}/snap"
    counts = []
    for b in range(10):
        rows = changes(rng, [3, 400, 5, 2, 90, 1, 300, 0, 4, 40][b], [10, 300, 300, 300, 900, 900, 2000, 1, 2000, 5][b], b * 1000)
        seen += rows
        cdc._apply_batch(spark.createDataFrame(rows, SCHEMA), b, path, "key", 100)
        state = cdc.read_state(spark, path)
        counts.append((len(state.buckets), len(state.deltas)))
        assert sum(1 / (1 << bits) for bits, _ in state.buckets) == 1 and len(state.buckets) == (1 << state.bits) + state.split
        if b in (1, 4, 9):
            assert live(cdc.read_snapshot(spark, path)) == live(cdc.current_state(spark.createDataFrame(seen, SCHEMA)))
    assert counts[0][0] == 1 and counts[-1][0] > 3 and max(d for _, d in counts) <= 8
    gone = cdc.vacuum_snapshot(spark, path)
    assert gone and live(cdc.read_snapshot(spark, path)) == live(cdc.current_state(spark.createDataFrame(seen, SCHEMA)))


def test_a_small_batch_writes_few_bytes(spark, scratch):
    path, n = f"{scratch}/snap", 60_000
    big = spark.range(n).selectExpr("id AS key", "'c' AS op", "timestamp_ntz'2024-01-01' AS ts", "id AS seq",
                                    "named_struct('v', sha2(string(id), 256)) AS after")
    cdc._apply_batch(big, 0, path, "key", 11_000)
    state, size = cdc.read_state(spark, path), bytes_under(path)
    assert len(state.buckets) == 6 and size > 3_000_000
    rows = [(k, "u", T, n + k, (f"new{k}",)) for k in range(0, n, n // 50)]  # fifty keys all over the table
    cdc._apply_batch(spark.createDataFrame(rows, SCHEMA), 1, path, "key", 11_000)
    assert bytes_under(path) - size < 40_000
    got = {r["key"]: r["v"] for r in cdc.read_snapshot(spark, path).where("v LIKE 'new%'").collect()}
    assert got == {k: f"new{k}" for k, *_ in rows}


def test_replays_and_second_writers(spark, scratch, monkeypatch):
    monkeypatch.setattr(cdc, "LEAST_PENDING", 5)
    path, rng = f"{scratch}/snap", random.Random(6)
    first, second = changes(rng, 60, 30, 0), changes(rng, 60, 30, 1000)
    cdc._apply_batch(spark.createDataFrame(first, SCHEMA), 0, path, "key", 10)
    before = live(cdc.read_snapshot(spark, path))
    cdc._apply_batch(spark.createDataFrame(second, SCHEMA), 0, path, "key", 10)  # number 0 is committed: nothing happens
    assert live(cdc.read_snapshot(spark, path)) == before

    def lost(self, number, text):
        raise OSError("the driver goes away before the commit")

    with monkeypatch.context() as m:
        m.setattr(CommitLog, "commit", lost)
        with pytest.raises(OSError):
            cdc._apply_batch(spark.createDataFrame(second, SCHEMA), 1, path, "key", 10)
    assert live(cdc.read_snapshot(spark, path)) == before  # its files are there, but no reader sees them
    cdc._apply_batch(spark.createDataFrame(second, SCHEMA), 1, path, "key", 10)
    assert live(cdc.read_snapshot(spark, path)) == live(cdc.current_state(spark.createDataFrame(first + second, SCHEMA)))

    real = CommitLog.latest
    with monkeypatch.context() as m:  # a writer that has not seen batch 1
        m.setattr(CommitLog, "latest", lambda self: (0, self.read(0)) if self.numbers() else real(self))
        with pytest.raises(CommitConflictError):
            cdc._apply_batch(spark.createDataFrame(first, SCHEMA), 1, path, "key", 10)


def test_a_fresh_checkpoint_is_refused(spark, scratch):
    rows = spark.createDataFrame([(1, "c", T, 1, ("a",))], SCHEMA)
    rows.write.parquet(f"{scratch}/log")
    stream = lambda: spark.readStream.schema(rows.schema).parquet(f"{scratch}/log")
    cdc.start_snapshot_stream(stream(), f"{scratch}/snap", f"{scratch}/ck", available_now=True).awaitTermination()
    cdc.start_snapshot_stream(stream(), f"{scratch}/snap", f"{scratch}/ck", available_now=True).awaitTermination()
    with pytest.raises(ValueError, match="another checkpoint"):
        cdc.start_snapshot_stream(stream(), f"{scratch}/snap", f"{scratch}/other", available_now=True)
    with pytest.raises(FileNotFoundError):
        cdc.read_snapshot(spark, f"{scratch}/none")
