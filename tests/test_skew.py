"""Hot keys: one key holds a third of all rows. Results must stay whole and
exact, and each plan must combine map-side before the shuffle."""

import pytest
from pyspark.sql import functions as F

from riskflow.config import FIXTURE_PARAMS
from riskflow.operators import cdc, hot_keys, lineage
from riskflow.operators.enrich import augment_with_profile
from riskflow.operators.risk import window_totals
from riskflow.operators.validate import dedup_transactions
from riskflow.sources import fixtures

from conftest import SF_SMALL


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def hot_tx(spark):
    """Clean transactions where every third event belongs to user 0."""
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet").withColumn(
        "user_id", F.when(F.col("event_id") % 3 == 0, F.lit(0)).otherwise(F.col("user_id")))
    return fixtures.transactions(ev)


def test_hot_user_window_totals_exact_and_partial(spark, hot_tx):
    got = window_totals(hot_tx, FIXTURE_PARAMS)
    plan = _plan(got)
    assert "partial_count" in plan and "partial_sum" in plan
    hot_tx.createOrReplaceTempView("hot_tx")
    want = spark.sql("""
        SELECT window(timestamp, '1 day') AS window, user_id, count(*) AS tx_count,
               CAST(sum(amount) AS DECIMAL(20,2)) AS total_amount
        FROM hot_tx WHERE timestamp IS NOT NULL GROUP BY 1, 2""")
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    assert got.where("user_id = '0'").agg(F.sum("tx_count")).first()[0] == hot_tx.where("user_id = '0'").count()


def test_hot_duplicate_group_dedup(spark, hot_tx):
    copies = hot_tx.where("user_id = '0'").withColumn("transaction_id", F.lit("same"))
    df = hot_tx.where("user_id <> '0'").unionByName(copies)
    out = dedup_transactions(df)
    assert "partial_min" in _plan(out)
    assert out.count() == hot_tx.where("user_id <> '0'").count() + 1


def test_hot_key_cdc_fold(spark):
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet").withColumn(
        "user_id", F.when(F.col("event_id") % 3 == 0, F.lit(0)).otherwise(F.col("user_id")))
    log = fixtures.change_log(ev)
    live = cdc.fold_latest(log)
    assert "partial_max_by" in _plan(live)
    last = ev.where("user_id = 0").orderBy(F.col("event_id").desc()).first()
    row = live.where("key = 0").first()
    assert row["seq"] == last["event_id"]


def test_hot_edge_pair_latest(spark):
    li = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet").withColumn(
        "l_suppkey", F.when(F.col("l_orderkey") % 3 == 0, F.lit(1)).otherwise(F.col("l_suppkey")))
    edges = lineage.latest_edges(fixtures.lineage_edge_log(
        li, spark.read.parquet(f"{SF_SMALL}/orders.parquet"), spark.read.parquet(f"{SF_SMALL}/part.parquet")))
    assert "partial_max_by" in _plan(edges)
    assert edges.groupBy("source_id", "target_id").count().where("count > 1").count() == 0


def test_hot_user_salted_join_keeps_every_row(spark, hot_tx):
    profile = fixtures.user_profiles(spark.read.parquet(f"{SF_SMALL}/customer.parquet"))
    base = augment_with_profile(hot_tx, profile)
    salted = augment_with_profile(hot_tx, profile, max_broadcast_bytes=0, salt_buckets=8)
    assert salted.count() == hot_tx.count()
    assert salted.select(*base.columns).exceptAll(base).count() == 0


@pytest.fixture
def shuffled_joins(spark):
    """Sixteen shuffle partitions, no broadcast by size and no adaptive splitting: the plan alone must balance."""
    conf = {"spark.sql.shuffle.partitions": "16", "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    old = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield 16
    for k, v in old.items():
        spark.conf.set(k, v)


def _balance(rows, column="part"):
    sizes = sorted(r["count"] for r in rows.groupBy(column).count().collect())
    return sizes[-1] / sizes[len(sizes) // 2]


def test_only_hot_users_are_salted_and_tasks_are_even(spark, shuffled_joins):
    tx = spark.range(90_000).selectExpr("string(id) AS transaction_id", "CASE WHEN id % 3 = 0 THEN 'hot' WHEN id % 89 = 0 THEN NULL "
                                        "ELSE concat('u', id % 5000) END AS user_id")
    profile = spark.range(5000).selectExpr("concat('u', id) AS user_id", "'R' AS risk_category").union(
        spark.createDataFrame([("hot", "H")], "user_id string, risk_category string"))
    out = augment_with_profile(tx, profile, max_broadcast_bytes=0)
    assert out.count() == 90_000 and out.where("user_id = 'hot' AND risk_category = 'H'").count() == 30_000
    assert out.where("user_id IS NOT NULL AND risk_category IS NULL").count() == 0
    assert _balance(out.withColumn("part", F.spark_partition_id())) < 2
    plain = tx.join(profile, "user_id", "left")
    assert _balance(plain.withColumn("part", F.spark_partition_id())) > 4  # what the salts mend
    hot = hot_keys.hot_salts(hot_keys.key_sketches(tx, "user_id"), 16)
    assert [tuple(r) for r in hot.collect()] == [("hot", 43)]  # eight for each partition of 89,326 / 16 rows
    assert hot_keys.hot_salts(hot_keys.key_sketches(tx.where("user_id <> 'hot'"), "user_id"), 16) is None
    assert hot_keys.hot_salts(hot_keys.key_sketches(tx.where("1 = 0"), "user_id"), 16) is None


def test_sketches_of_parts_are_merged(spark):
    tx = spark.range(60_000).selectExpr("CASE WHEN id % 4 = 0 THEN 'a' ELSE concat('u', id) END AS user_id", "id % 7 AS day")
    parts = hot_keys.key_sketches(tx, "user_id", "day")
    assert parts.count() == 7 and {r["key"]: r["salts"] for r in hot_keys.hot_salts(parts, 100).collect()} == {"a": 200}


def test_the_default_flow_spreads_a_hot_user_of_its_history(spark, scratch, shuffled_joins, monkeypatch):
    from riskflow.plans import risk_flow

    ev = fixtures.hot_user_events(spark.range(30_000).selectExpr(
        "id AS event_id", "id % 4000 + 2 AS user_id", "timestamp_ntz'2024-01-01' + make_dt_interval(0, 0, 0, id) AS ts",
        "'click' AS event_type", "1.0D AS value", "'{}' AS props"))
    records = fixtures.kafka_records(ev, dirty=False)
    records.write.parquet(f"{scratch}/records")
    profile = spark.range(4002).selectExpr("string(id) AS user_id", "'R' AS risk_category")
    plain = risk_flow.augment_with_profile
    monkeypatch.setattr(risk_flow, "augment_with_profile", lambda *a, **kw: plain(*a, **kw).withColumn("part", F.spark_partition_id()))

    def balance(name, **kw):
        flow = risk_flow.start_default_flow(
            spark, f"{scratch}/{name}", FIXTURE_PARAMS, profile=profile, sink_format="parquet", sink_dir=f"{scratch}/{name}-out",
            alerts_path=f"{scratch}/{name}-alerts", available_now=True, max_broadcast_bytes=0,
            open_records=lambda: spark.readStream.schema(records.schema).parquet(f"{scratch}/records"), **kw)
        for q in flow.queries.values():
            q.awaitTermination()
            assert q.exception() is None
        sent = spark.read.parquet(f"{scratch}/{name}-out/lake").selectExpr("from_json(value, 'user_id string, part int, risk_category string') AS v").select("v.*")
        assert sent.count() == 30_000 and sent.where("risk_category IS NULL").count() == 0
        return _balance(sent)

    assert balance("salted", open_history=lambda: spark.read.parquet(f"{scratch}/records")) < 2
    assert balance("plain") > 4
