"""A lake that takes every id once, whatever the delay of a duplicate."""

import datetime as dt
import os
import random

import pytest
from pyspark.sql import functions as F

from riskflow.sinks import unique_lake as ul
from riskflow.sinks.commits import CommitLog

SCHEMA = "transaction_id string, user_id string, amount decimal(10,2), timestamp timestamp"
T = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)


def rows(ids, day):
    return [(f"t{i}", "u", None, None if i % 50 == 49 else T + dt.timedelta(days=day, seconds=i)) for i in ids]


def take(spark, path, n, data, bits):
    ul._take_batch(spark.createDataFrame(data, SCHEMA), n, path, "transaction_id", bits)


def ids(spark, path):
    return sorted(r["transaction_id"] for r in ul.read_unique_lake(spark, path).collect())


@pytest.mark.parametrize("bits", [1 << 20, 64])  # 64 places: the filters hold everything, the join decides
def test_late_duplicates_are_refused_and_nothing_else(spark, scratch, bits):
    path, rng, known = f"{scratch}/lake", random.Random(2), set()
    for n in range(4):
        new = list(range(n * 200, n * 200 + 200))
        again = rng.sample(sorted(known), min(60, len(known)))
        data = rows(new, 7 * n) + rows(again, 0) + rows(new[:20], 7 * n) + rows(again[:5], 90)  # also with another time
        rng.shuffle(data)
        take(spark, path, n, data, bits)
        known |= set(new)
        assert ids(spark, path) == sorted(f"t{i}" for i in known)


def test_only_dates_that_a_filter_names_are_read(spark, scratch):
    path = f"{scratch}/lake"
    for n in range(3):
        take(spark, path, n, rows(range(n * 300, n * 300 + 300), n), 1 << 22)
    take(spark, path, 3, rows([5, 310], 0) + rows(range(5000, 5400), 9), 1 << 22)
    named = {(r["transaction_id"], r["day"]) for r in spark.read.parquet(f"{path}/_possible/batch=3").collect()}
    assert {("t5", "2024-01-01"), ("t310", "2024-01-02")} <= named and len(named) <= 4
    assert len(ids(spark, path)) == 1300


def test_replayed_and_lost_batches(spark, scratch, monkeypatch):
    path = f"{scratch}/lake"
    take(spark, path, 0, rows(range(100), 0), 1 << 20)
    take(spark, path, 0, rows(range(500), 0), 1 << 20)  # committed already
    assert len(ids(spark, path)) == 100

    def lost(self, number, text):
        raise OSError("gone before the commit")

    with monkeypatch.context() as m:
        m.setattr(CommitLog, "commit", lost)
        with pytest.raises(OSError):
            take(spark, path, 1, rows(range(50, 150), 0), 1 << 20)
    assert os.path.exists(f"{path}/rows/batch=1") and len(ids(spark, path)) == 100
    take(spark, path, 1, rows(range(50, 150), 0), 1 << 20)
    assert ids(spark, path) == sorted(f"t{i}" for i in range(150))
    with pytest.raises(ValueError, match="another size"):
        take(spark, path, 2, rows([1], 0), 1 << 21)
    take(spark, path, 2, [], 1 << 20)
    assert len(ids(spark, path)) == 150


def test_a_filter_has_no_false_negative(spark):
    held = spark.range(3000).select(F.concat(F.lit("k"), "id").alias("k"), (F.col("id") % 3).cast("string").alias("day"))
    pages = ul._pages(held, "k", 1 << 18)
    asked = spark.range(6000).select(F.concat(F.lit("k"), "id").alias("k"))
    got = ul._possible(asked, pages, "k", 1 << 18)
    assert held.join(got, ["k", "day"], "left_anti").isEmpty()
    assert got.count() < 3000 * 1.02
