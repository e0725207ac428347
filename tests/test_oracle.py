"""Every named query against its DuckDB oracle at sf0.001 (the driver runs the
same check at sf0.01), and the entry point's smoke contract."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from conftest import SF_SMALL
from oracle_compare import compare, duck

QUERIES = queries()
ORACLE = oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_entry(spark):
    df = entry(spark)
    assert df.columns == ["window_start", "window_end", "user_id", "tx_count", "total_amount"]
    assert df.count() == 41


def test_every_oracle_has_a_query():
    assert set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    if name not in ORACLE:
        assert QUERIES[name](spark, SF_SMALL).count() >= 1
        return
    info = compare(spark, SF_SMALL, name, QUERIES[name], ORACLE[name], con)
    assert info["ok"], info


@pytest.mark.parametrize("name", ["kafka_typed_decode", "risk_alert_messages", "high_risk_stream", "lake_roundtrip"])
def test_results_do_not_depend_on_session_time_zone(spark, con, name):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        info = compare(spark, SF_SMALL, name, QUERIES[name], ORACLE[name], con)
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert info["ok"], info
