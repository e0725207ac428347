"""Parse / validate / audit / de-duplicate: the edge rows of FIXTURES.md."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from riskflow.operators.validate import (
    dedup_transactions,
    distinct_users,
    parse_transactions,
    rejected_transactions,
    validate_transactions,
)
from riskflow.sources.kafka import decode_envelope, kafka_source_options
from riskflow.schemas import TRANSACTION_SCHEMA

ROWS = [
    ("ok0", '{"transaction_id":"t0","user_id":"u","amount":0,"timestamp":"2024-01-01T00:00:00Z"}'),
    ("neg", '{"transaction_id":"t1","user_id":"u","amount":-0.01,"timestamp":"2024-01-01T00:00:00Z"}'),
    ("round", '{"transaction_id":"t2","user_id":"u","amount":12.345,"timestamp":"2024-01-01T00:00:00Z"}'),
    ("quoted", '{"transaction_id":"t3","user_id":"u","amount":"7.10","timestamp":"2024-01-01T00:00:00Z"}'),
    ("overflow", '{"transaction_id":"t4","user_id":"u","amount":123456789.99}'),
    ("empty_ids", '{"transaction_id":"","user_id":"","amount":1}'),
    ("empty_obj", "{}"),
    ("junk", "not json"),
    ("array", "[1,2]"),
    ("null", None),
    ("epoch", '{"transaction_id":"t5","user_id":"u","amount":1,"timestamp":1700000000}'),
    ("no_user", '{"transaction_id":"t6","amount":5}'),
]


@pytest.fixture
def parsed(spark):
    raw = spark.createDataFrame(ROWS, "tag string, value string")
    return parse_transactions(raw, keep=("tag",))


def _by_tag(df):
    return {r["tag"]: r for r in df.collect()}


def test_parse_edge_rows(parsed):
    rows = _by_tag(parsed)
    assert len(rows) == len(ROWS)  # one output row per input row, NULL value included
    assert rows["round"]["amount"] == Decimal("12.35")
    assert rows["quoted"]["amount"] == Decimal("7.10")
    assert rows["overflow"]["amount"] is None
    assert rows["empty_ids"]["transaction_id"] == ""
    for tag in ("empty_obj", "junk", "array", "null"):
        r = rows[tag]
        assert r["transaction_id"] is None and r["amount"] is None and r["timestamp"] is None
    assert rows["epoch"]["timestamp"] == dt.datetime(2023, 11, 14, 22, 13, 20)


def test_validate_keeps_zero_and_empty_ids(parsed):
    kept = {r["tag"] for r in validate_transactions(parsed).collect()}
    assert kept == {"ok0", "round", "quoted", "empty_ids", "epoch"}


def test_rejected_is_complement_with_reasons(parsed):
    rej = _by_tag(rejected_transactions(parsed))
    assert {t: r["reason"] for t, r in rej.items()} == {
        "neg": "negative_amount",
        "overflow": "missing_amount",
        "empty_obj": "unparsable",
        "junk": "unparsable",
        "array": "unparsable",
        "null": "unparsable",
        "no_user": "missing_user_id",
    }
    assert validate_transactions(parsed).count() + len(rej) == len(ROWS)


def test_require_timestamp(parsed):
    kept = {r["tag"] for r in validate_transactions(parsed, require_timestamp=True).collect()}
    assert "empty_ids" not in kept and "ok0" in kept
    rej = _by_tag(rejected_transactions(parsed, require_timestamp=True))
    assert rej["empty_ids"]["reason"] == "missing_timestamp"


def test_single_json_parse_in_plan(spark, parsed):
    plan = validate_transactions(parsed)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_json") == 1


def test_dedup_and_distinct_users(spark):
    df = spark.createDataFrame(
        [("a", "u1", Decimal("1.00"), None), ("a", "u1", Decimal("1.00"), None),
         ("b", "u2", Decimal("2.00"), None)], TRANSACTION_SCHEMA)
    assert dedup_transactions(df).count() == 2
    assert sorted(r[0] for r in distinct_users(df).collect()) == ["u1", "u2"]


def test_envelope_decode_and_options(spark):
    rec = spark.createDataFrame([(b"k", b'{"transaction_id":"x","amount":1}', "t", 0, 5)],
                                "key binary, value binary, topic string, partition int, offset long")
    plain = decode_envelope(rec).collect()[0]
    assert plain["key"] == "k" and plain["value"].startswith("{")
    typed = decode_envelope(rec, TRANSACTION_SCHEMA, keep=("offset",)).collect()[0]
    assert typed["transaction_id"] == "x" and typed["offset"] == 5 and typed["amount"] == Decimal("1.00")
    opts = kafka_source_options("b:1", "topic", "earliest", max_offsets_per_trigger=10)
    assert opts == {"kafka.bootstrap.servers": "b:1", "subscribe": "topic",
                    "startingOffsets": "earliest", "maxOffsetsPerTrigger": "10"}
    assert kafka_source_options()["startingOffsets"] == "latest"


def test_missing_kafka_connector_is_explained(spark):
    from riskflow.sources.kafka import KafkaConnectorMissing, open_kafka_stream
    try:
        open_kafka_stream(spark, kafka_source_options())
    except KafkaConnectorMissing as err:
        assert "spark-sql-kafka" in str(err)
    # with the connector installed load() is lazy and succeeds: nothing to check
