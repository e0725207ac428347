"""Windowed risk, profile enrichment and message frames."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from riskflow.config import FIXTURE_PARAMS, RiskParams
from riskflow.operators.enrich import (
    ProfileNotUniqueError,
    augment_with_profile,
    augment_with_self_profile,
)
from riskflow.operators.messages import alert_messages, to_kafka_messages
from riskflow.operators.risk import detect_high_risk, window_totals
from riskflow.schemas import TRANSACTION_SCHEMA

T0 = dt.datetime(2024, 1, 1, 0, 0, 0)


def tx(spark, rows):
    return spark.createDataFrame(
        [(tid, uid, Decimal(a) if a is not None else None, ts) for tid, uid, a, ts in rows],
        TRANSACTION_SCHEMA)


def test_reference_defaults():
    p = RiskParams()
    assert (p.tx_count_threshold, p.amount_threshold, p.window_duration, p.watermark_duration) == (
        10, Decimal("10000.0"), "1 minute", "5 minutes")


def test_window_border_and_null_time(spark):
    df = tx(spark, [("a", "u", "1", T0 + dt.timedelta(seconds=59)),
                    ("b", "u", "1", T0 + dt.timedelta(minutes=1)),  # exactly on the border
                    ("c", "u", "1", None)])
    out = window_totals(df, RiskParams()).orderBy("window").collect()
    assert [(r["window"]["start"], r["tx_count"]) for r in out] == [
        (T0, 1), (T0 + dt.timedelta(minutes=1), 1)]
    assert str(window_totals(df).schema["total_amount"].dataType) == "DecimalType(20,2)"


def test_thresholds_are_strict(spark):
    p = RiskParams(tx_count_threshold=2, amount_threshold=Decimal("10.00"))
    rows = [("a", "at_count", "1", T0), ("b", "at_count", "1", T0),        # count == 2: no
            ("c", "over_count", "1", T0), ("d", "over_count", "1", T0), ("e", "over_count", "1", T0),
            ("f", "at_amount", "10.00", T0),                                 # amount == 10: no
            ("g", "over_amount", "10.01", T0)]
    flagged = {r["user_id"] for r in detect_high_risk(tx(spark, rows), p).collect()}
    assert flagged == {"over_count", "over_amount"}


def test_partial_aggregation_before_shuffle(spark):
    df = tx(spark, [("a", "u", "1", T0)])
    plan = detect_high_risk(df, FIXTURE_PARAMS)._jdf.queryExecution().executedPlan().toString()
    assert "partial_count" in plan and "partial_sum" in plan


@pytest.fixture
def profile(spark):
    return spark.createDataFrame([("u1", "RETAIL"), ("u2", "CORP")], "user_id string, risk_category string")


def test_profile_left_join_broadcast_and_default(spark, profile):
    df = tx(spark, [("a", "u1", "1", T0), ("b", "u3", "2", T0), ("c", None, "3", T0)])
    out = augment_with_profile(df, profile, default_category="UNKNOWN")
    got = {r["transaction_id"]: r["risk_category"] for r in out.collect()}
    assert got == {"a": "RETAIL", "b": "UNKNOWN", "c": "UNKNOWN"}
    assert "BroadcastHashJoin" in out._jdf.queryExecution().executedPlan().toString()


def test_profile_large_path_and_salting_agree(spark, profile):
    df = tx(spark, [(str(i), "u1" if i % 3 else "u2", "1", T0) for i in range(60)])
    base = sorted(augment_with_profile(df, profile).collect())
    shuffled = augment_with_profile(df, profile, max_broadcast_bytes=0)
    salted = augment_with_profile(df, profile, max_broadcast_bytes=0, salt_buckets=4)
    assert sorted(shuffled.collect()) == base
    assert sorted(salted.select(*base[0].__fields__).collect()) == base


def test_profile_uniqueness_check(spark):
    dup = spark.createDataFrame([("u1", "A"), ("u1", "B")], "user_id string, risk_category string")
    df = tx(spark, [("a", "u1", "1", T0)])
    with pytest.raises(ProfileNotUniqueError):
        augment_with_profile(df, dup, check_unique=True)


def test_self_profile_equals_join_with_own_distinct_users(spark):
    df = tx(spark, [("a", "u1", "1", T0), ("b", "u1", "2", T0), ("c", None, "3", T0), ("d", "u2", "4", T0)])
    ref = df.join(df.select("user_id").distinct().withColumn("risk_category", F.lit("HIGH")),
                  on="user_id", how="left")
    mine = augment_with_self_profile(df).select(*ref.columns)
    assert sorted(map(tuple, mine.collect()), key=str) == sorted(map(tuple, ref.collect()), key=str)


def test_kafka_messages_and_alert_text(spark):
    risk = window_totals(tx(spark, [("a", "u1", "300.50", T0), ("b", "u1", "0.50", T0)]), RiskParams())
    msg = to_kafka_messages(risk).collect()[0]
    assert msg["key"] == "u1"
    assert '"window":{"start":"2024-01-01T00:00:00.000000Z"' in msg["value"]
    assert '"total_amount":301.00' in msg["value"] and '"tx_count":2' in msg["value"]
    text = alert_messages(risk).collect()[0]["alert_text"]
    assert text == "[ALERT] High-risk transaction detected: User=u1 | Count=2 | Amount=301.00"
    nulls = spark.createDataFrame([(None, None, None)], "user_id string, tx_count long, total_amount decimal(20,2)")
    assert alert_messages(nulls).collect()[0]["alert_text"].endswith("User=None | Count=None | Amount=None")


def test_event_date_for_instants_and_wall_clocks(spark):
    from riskflow.sinks.lake import with_event_date
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        ntz = spark.createDataFrame([(dt.datetime(2024, 1, 1, 23, 30),)], "t timestamp_ntz")
        ltz = ntz.select(F.to_utc_timestamp(F.col("t").cast("timestamp"), "Asia/Tokyo").alias("t"))
        for df in (ntz, ltz):
            assert with_event_date(df, "t").first()["event_date"] == dt.date(2024, 1, 1)
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
