"""Lake files: statistics, clustering, atomic replacement."""

import pytest
from pyspark.sql import functions as F

from riskflow.sinks.clustered_lake import ClusteredLake
from riskflow.sinks.commits import CommitLog


def rows(spark, n=6000):
    return spark.range(n).selectExpr("concat('u', lpad(string(xxhash64(id) & 1023), 4, '0')) AS user_id", "id * 37 % 6000 AS at",
                                     "CASE WHEN id % 97 = 0 THEN NULL ELSE id END AS amount")


@pytest.fixture
def lake(spark, scratch):
    lake = ClusteredLake(spark, f"{scratch}/lake", ["user_id", "at"])
    for i in range(3):
        lake.append(rows(spark).where(f"at % 3 = {i}").repartition(10))
    return lake


def key(df):
    return sorted(tuple(r) for r in df.select("user_id", "at", "amount").collect())


def test_compaction_keeps_the_rows_and_prunes(spark, lake):
    want = dict(user_id=("u0100", "u0180"), at=(1000, 1500))
    held = key(rows(spark).where("user_id BETWEEN 'u0100' AND 'u0180' AND at BETWEEN 1000 AND 1500"))
    assert lake.manifest().count() == 30 and lake.files_for(**want).count() == 30  # no file of the arrival order can be left out
    assert key(lake.read(**want)) == held
    assert lake.compact(target_rows=500) == 30
    after = lake.manifest()
    assert after.agg(F.sum("rows")).first()[0] == 6000 and 10 <= after.count() <= 12
    assert lake.files_for(**want).count() <= 4  # of 12: the others' boxes lie elsewhere
    assert key(lake.read(**want)) == held and key(lake.read()) == key(rows(spark))
    assert lake.read(at=(90_000, 99_000)).count() == 0
    assert lake.compact(target_rows=100) == 0  # nothing small is left
    assert lake.vacuum(keep=1) == 3 and key(lake.read()) == key(rows(spark))


def test_a_reader_sees_old_or_new_files(spark, lake, monkeypatch):
    seen, commit = [], CommitLog.commit

    def watched(self, number, text):
        seen.append(key(lake.read()))  # the new files are written, the commit is not made
        commit(self, number, text)
        seen.append(key(lake.read()))

    open_reader = lake.read()  # planned on the old files
    monkeypatch.setattr(CommitLog, "commit", watched)
    lake.compact(target_rows=1000)
    assert seen == [key(rows(spark))] * 2 and key(open_reader) == seen[0]


def test_compaction_and_append_race(spark, lake, monkeypatch):
    commit, first = CommitLog.commit, []

    def after_an_append(self, number, text):
        if not first:
            first.append(1)
            ClusteredLake(spark, lake.path, lake.columns).append(spark.createDataFrame([("late", 7, 7)], "user_id string, at long, amount long"))
        commit(self, number, text)

    with monkeypatch.context() as m:
        m.setattr(CommitLog, "commit", after_an_append)
        assert lake.compact(target_rows=1000) == 30
    assert lake.read().count() == 6001 and lake.read(user_id=("late", "late")).count() == 1

    first.clear()

    def after_another_compaction(self, number, text):
        if not first:
            first.append(1)
            assert ClusteredLake(spark, lake.path, lake.columns).compact(target_rows=100_000) > 0
        commit(self, number, text)

    with monkeypatch.context() as m:
        m.setattr(CommitLog, "commit", after_another_compaction)
        assert lake.compact(target_rows=50_000) == 0  # gives up
    assert lake.read().count() == 6001 and lake.manifest().count() == 1
