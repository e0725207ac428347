"""Test-input views derived from the driver tables by fixed rules.

Every fixture is a narrow projection (or a bounded explode) of a driver table,
so it scales with the table and adds no shuffle. The rules are documented in
FIXTURES.md part C; the SQL oracle rebuilds the same rows independently.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskflow.functions.columns import as_utc_instant, wire_timestamp_text

# --- fixed values: dirt rules on event_id (FIXTURES.md C) -------------------
NEGATIVE_AMOUNT_EVERY = 17
NULL_USER_EVERY = 19
MALFORMED_JSON_EVERY = 23
NULL_TIMESTAMP_EVERY = 29
DOUBLED_ROW_EVERY = 31
MALFORMED_PREFIX = "not json "
KAFKA_PARTITIONS = 4
# ---------------------------------------------------------------------------


def transactions(events: DataFrame) -> DataFrame:
    """Clean transactions: ``timestamp`` stays the table's TIMESTAMP_NTZ."""
    return events.select(
        F.col("event_id").cast("string").alias("transaction_id"),
        F.col("user_id").cast("string").alias("user_id"),
        F.col("value").cast("decimal(10,2)").alias("amount"),
        F.col("ts").alias("timestamp"),
    )


def _dirty_fields(events: DataFrame) -> DataFrame:
    eid = F.col("event_id")
    amount = F.col("value").cast("decimal(10,2)")
    doubled = F.sequence(F.lit(1), F.when(eid % DOUBLED_ROW_EVERY == 0, 2).otherwise(1))
    return events.select(
        eid,
        F.col("event_type"),
        F.col("user_id").alias("src_user_id"),
        F.col("ts").alias("src_ts"),
        F.col("event_id").cast("string").alias("transaction_id"),
        F.when(eid % NULL_USER_EVERY != 0, F.col("user_id").cast("string")).alias("user_id"),
        F.when(eid % NEGATIVE_AMOUNT_EVERY == 0, -amount).otherwise(amount).alias("amount"),
        F.when(eid % NULL_TIMESTAMP_EVERY != 0, F.col("ts")).alias("ts_utc"),
        (eid % MALFORMED_JSON_EVERY == 0).alias("malformed"),
        F.explode(doubled).alias("copy"),
    )


def kafka_records(events: DataFrame, dirty: bool = True) -> DataFrame:
    """Kafka connector rows (BINARY key/value) carrying JSON transactions.

    ``key`` = user id, ``topic`` = event type, ``partition`` = user id mod 4,
    ``offset`` = event id, ``timestamp`` = event time as an instant. With
    ``dirty`` the FIXTURES.md rules put in bad rows (they add up; malformed
    JSON wins over the field rules).
    """
    if dirty:
        base = _dirty_fields(events)
    else:
        base = events.select(
            F.col("event_id"),
            F.col("event_type"),
            F.col("user_id").alias("src_user_id"),
            F.col("ts").alias("src_ts"),
            F.col("event_id").cast("string").alias("transaction_id"),
            F.col("user_id").cast("string").alias("user_id"),
            F.col("value").cast("decimal(10,2)").alias("amount"),
            F.col("ts").alias("ts_utc"),
            F.lit(False).alias("malformed"),
        )
    payload = F.to_json(F.struct(
        F.col("transaction_id"),
        F.col("user_id"),
        F.col("amount"),
        wire_timestamp_text(F.col("ts_utc")).alias("timestamp"),
    ))
    value = F.when(F.col("malformed"),
                   F.concat(F.lit(MALFORMED_PREFIX), F.col("transaction_id"))).otherwise(payload)
    return base.select(
        F.col("user_id").cast("binary").alias("key"),
        value.cast("binary").alias("value"),
        F.col("event_type").alias("topic"),
        (F.col("src_user_id") % KAFKA_PARTITIONS).cast("int").alias("partition"),
        F.col("event_id").alias("offset"),
        as_utc_instant(F.col("src_ts")).alias("timestamp"),
        F.lit(0).alias("timestampType"),
    )


# --- fixed values: a hot user (FIXTURES.md C) --------------------------------
HOT_USER, HOT_EVERY = 1, 3
# ---------------------------------------------------------------------------


def hot_user_events(events: DataFrame) -> DataFrame:
    """``events`` in which every third row belongs to one user."""
    return events.withColumn("user_id", F.when(F.col("event_id") % HOT_EVERY == 0, F.lit(HOT_USER)).otherwise(F.col("user_id")).cast("bigint"))


def user_profiles(customer: DataFrame) -> DataFrame:
    """Profile dimension from ``customer``: one row per customer in good
    standing (non-negative balance); the others have no profile, so their
    transactions stay unmatched in the left join."""
    return customer.where(F.col("c_acctbal") >= 0).select(
        F.col("c_custkey").cast("string").alias("user_id"),
        F.col("c_mktsegment").alias("risk_category"),
    )


# --- fixed values: schema drift of events.props by week (FIXTURES.md C) ----
DRIFT_EPOCH = "2024-01-01"
# v1 {"k": n}; v2 adds w (a number) and src {app, rev}, NULL for every 5th event;
# v3 makes k a string, w NULL, adds ctx {geo {cc}}, a group named type {name} and
# a field named a.b; v4 drops all but k and w, a string now; v5+ as v4
NULL_GROUP_EVERY = 5
# ---------------------------------------------------------------------------


def schema_version(ts_col="ts"):
    """1 + whole weeks since the drift epoch."""
    days = F.datediff(F.col(ts_col).cast("date"), F.lit(DRIFT_EPOCH).cast("date"))
    return (F.floor(days / 7) + 1).cast("int")


def schema_payloads(events: DataFrame) -> DataFrame:
    """``(topic, version, payload)``: ``props`` rewritten per version so the
    observed schema drifts; every 23rd event carries an unparsable payload."""
    version = schema_version()
    k = F.get_json_object(F.col("props"), "$.k").cast("bigint")
    text = k.cast("string")
    src = F.struct(F.col("event_type").alias("app"), (k % 3).alias("rev"))
    some_src = F.when(F.col("event_id") % NULL_GROUP_EVERY != 0, src).alias("src")
    ctx = F.struct(F.struct(F.col("event_type").alias("cc")).alias("geo")).alias("ctx")
    named = F.struct(F.col("event_type").alias("name")).alias("type")
    nulls = {"ignoreNullFields": "false"}
    payload = (
        F.when(F.col("event_id") % MALFORMED_JSON_EVERY == 0,
               F.concat(F.lit('{"k": '), text))
        .when(version <= 1, F.col("props"))
        .when(version == 2, F.to_json(F.struct(k.alias("k"), k.alias("w"), some_src), nulls))
        .when(version == 3, F.to_json(F.struct(text.alias("k"), F.lit(None).cast("string").alias("w"), src.alias("src"),
                                               ctx, named, k.alias("a.b")), nulls))
        .otherwise(F.to_json(F.struct(text.alias("k"), text.alias("w"))))
    )
    return events.select(F.col("event_type").alias("topic"), version.alias("version"),
                         payload.alias("payload"))


def keyed_payloads(events: DataFrame) -> DataFrame:
    """``(topic, version, payload)``: payloads with objects keyed by data (user and event ids),
    unparsable every 23rd event."""
    k = F.get_json_object(F.col("props"), "$.k").cast("bigint")
    payload = F.to_json(F.struct(
        k.alias("k"), F.struct(F.col("event_type").alias("app"), (k % 3).alias("rev")).alias("src"),
        F.create_map(F.concat(F.lit("u"), F.col("user_id")), F.struct(k.alias("n"), F.col("event_type").alias("kind"))).alias("by_user"),
        F.create_map(F.concat(F.lit("e"), F.col("event_id")), k).alias("by_event")))
    broken = F.concat(F.lit('{"k": '), k.cast("string"))
    return events.select(F.col("event_type").alias("topic"), schema_version().alias("version"),
                         F.when(F.col("event_id") % MALFORMED_JSON_EVERY == 0, broken).otherwise(payload).alias("payload"))


# --- fixed values: lineage graph over the star schema (FIXTURES.md C) -------
SELF_EDGE_TIME = "2000-01-01 00:00:00"
# supplier:k -> part:k (supply), part:k -> order:k (line), order:k -> customer:k
# (purchase), back edge customer:k -> order:k (reorder), self edge part:k -> part:k
# ---------------------------------------------------------------------------


def _node(kind: str, col: str):
    return F.concat(F.lit(kind + ":"), F.col(col).cast("string"))


def lineage_edge_log(lineitem: DataFrame, orders: DataFrame, part: DataFrame) -> DataFrame:
    """Edge log ``(source_id, target_id, transformation_type, details, ts, seq)``.

    One record per line item for supplier -> part and part -> order (a pair
    recorded again supersedes the earlier record), one per order for order ->
    customer and its back edge (cycles), one self edge per part.
    """
    line_seq = F.col("l_orderkey") * 100 + F.col("l_linenumber")
    supply = lineitem.select(
        _node("supplier", "l_suppkey").alias("source_id"), _node("part", "l_partkey").alias("target_id"),
        F.lit("supply").alias("transformation_type"),
        F.to_json(F.struct("l_orderkey", "l_linenumber", "l_quantity")).alias("details"),
        F.col("l_shipdate").alias("ts"), line_seq.alias("seq"))
    line = lineitem.select(
        _node("part", "l_partkey").alias("source_id"), _node("order", "l_orderkey").alias("target_id"),
        F.lit("line").alias("transformation_type"),
        F.to_json(F.struct("l_linenumber", "l_extendedprice", "l_discount")).alias("details"),
        F.col("l_shipdate").alias("ts"), line_seq.alias("seq"))
    purchase = orders.select(
        _node("order", "o_orderkey").alias("source_id"), _node("customer", "o_custkey").alias("target_id"),
        F.lit("purchase").alias("transformation_type"),
        F.to_json(F.struct("o_orderstatus", "o_totalprice")).alias("details"),
        F.col("o_orderdate").alias("ts"), F.col("o_orderkey").alias("seq"))
    reorder = orders.select(
        _node("customer", "o_custkey").alias("source_id"), _node("order", "o_orderkey").alias("target_id"),
        F.lit("reorder").alias("transformation_type"),
        F.to_json(F.struct("o_orderpriority")).alias("details"),
        F.col("o_orderdate").alias("ts"), F.col("o_orderkey").alias("seq"))
    revision = part.select(
        _node("part", "p_partkey").alias("source_id"), _node("part", "p_partkey").alias("target_id"),
        F.lit("revision").alias("transformation_type"),
        F.to_json(F.struct("p_size", "p_retailprice")).alias("details"),
        F.lit(SELF_EDGE_TIME).cast("timestamp_ntz").alias("ts"), F.col("p_partkey").alias("seq"))
    return supply.unionByName(line).unionByName(purchase).unionByName(reorder).unionByName(revision)


# --- fixed values: deep lineage over event ids (FIXTURES.md C) --------------
DEEP_CHAINS = 50  # event:k -> event:k+50 (next)
DEEP_SKIP_EVERY, DEEP_SKIP = 997, 7  # event:k-350 -> event:k (skip) for every 997th event
# the last event of a chain -> its first one (loop); raw:k -> event:k (load), a dead end upstream
# ---------------------------------------------------------------------------


def deep_edge_log(events: DataFrame) -> DataFrame:
    """Edges of ``DEEP_CHAINS`` rings over the events, as long as the table has events for each."""
    e = F.col("event_id")
    ids = events.select(e, F.col("ts"))
    ends = ids.groupBy((e % DEEP_CHAINS).alias("chain")).agg(F.min(e).alias("first"), F.max(e).alias("last"), F.max("ts").alias("ts"))

    def edges(rows, source, target, kind, where=F.lit(True)):
        return rows.where(where).select(
            F.concat(F.lit("event:"), source.cast("string")).alias("source_id"), F.concat(F.lit("event:"), target.cast("string")).alias("target_id"),
            F.lit(kind).alias("transformation_type"), F.lit(None).cast("string").alias("details"), F.col("ts"), F.lit(0).alias("seq"))

    step = DEEP_CHAINS * DEEP_SKIP
    load = edges(ids, e, e, "load").withColumn("source_id", F.concat(F.lit("raw:"), F.substring("source_id", 7, 20)))
    return (edges(ids, e - DEEP_CHAINS, e, "next", e >= DEEP_CHAINS)
            .unionByName(edges(ids, e - step, e, "skip", (e % DEEP_SKIP_EVERY == 0) & (e >= step)))
            .unionByName(edges(ends, F.col("last"), F.col("first"), "loop")).unionByName(load))


# --- fixed values: CDC operation per event type (FIXTURES.md C) -------------
CDC_CREATE_TYPE = "signup"
CDC_DELETE_TYPE = "error"
# every other event type is an update
# ---------------------------------------------------------------------------


def change_log(events: DataFrame) -> DataFrame:
    """Change log keyed by user: ``(key, op, ts, seq, after)``."""
    op = (F.when(F.col("event_type") == CDC_CREATE_TYPE, F.lit("c"))
          .when(F.col("event_type") == CDC_DELETE_TYPE, F.lit("d"))
          .otherwise(F.lit("u")))
    after = F.when(op != "d", F.struct("event_type", "value", "props"))
    return events.select(F.col("user_id").alias("key"), op.alias("op"), F.col("ts"),
                         F.col("event_id").alias("seq"), after.alias("after"))


# --- fixed values: CDC connector naming (topic prefix, captured table) -------
CDC_CONNECTOR = {"topic.prefix": "myapp", "table.include.list": "inventory.customers"}
# ---------------------------------------------------------------------------


def change_event_records(events: DataFrame) -> DataFrame:
    """The change log as connector rows of the captured table's topic: JSON key
    ``{"user_id": n}``, envelope value with ``after`` (NULL for deletes),
    ``op``, ``ts_ms``; every delete is followed by a tombstone (NULL value)."""
    from riskflow.sources.cdc import cdc_topics

    topic = cdc_topics(CDC_CONNECTOR)[0]
    log = change_log(events)
    ts_ms = F.unix_millis(as_utc_instant(F.col("ts")))
    envelope = F.to_json(F.struct(
        F.col("after"), F.col("op"), ts_ms.alias("ts_ms"),
        F.struct(F.lit(CDC_CONNECTOR["table.include.list"]).alias("table")).alias("source")))
    copies = F.explode(F.when(F.col("op") == "d", F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    rows = log.select("*", copies.alias("copy"))
    return rows.select(
        F.to_json(F.struct(F.col("key").alias("user_id"))).cast("binary").alias("key"),
        F.when(F.col("copy") == 0, envelope).cast("binary").alias("value"),
        F.lit(topic).alias("topic"),
        (F.col("key") % KAFKA_PARTITIONS).cast("int").alias("partition"),
        (F.col("seq") * 2 + F.col("copy")).alias("offset"),
        as_utc_instant(F.col("ts")).alias("timestamp"),
        F.lit(0).alias("timestampType"),
    )
