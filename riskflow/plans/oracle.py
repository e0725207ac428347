"""Independent SQL (DuckDB dialect) for every named query with an oracle.

The oracle never parses the JSON the Spark side produces: it rebuilds the
expected rows from ``events``/``customer``/``lineitem``/``orders`` with the
fixture rules, so a wrong encoder or parser shows up as a mismatch. Sums are
cast to DECIMAL(20,2) (DuckDB widens to 38 digits), windows of one day are
``date_trunc('day', ts)`` (both engines align tumbling windows to the epoch).
"""

from __future__ import annotations

# Dirty records, one row per delivered copy (FIXTURES.md C rules): every
# event is delivered once, every 31st twice.
DIRTY = """dirty AS (
  SELECT event_id, event_type, user_id AS src_user_id, ts AS src_ts,
         CAST(event_id AS VARCHAR) AS transaction_id,
         CASE WHEN event_id % 19 <> 0 THEN CAST(user_id AS VARCHAR) END AS user_id,
         CASE WHEN event_id % 17 = 0 THEN -CAST(value AS DECIMAL(10,2))
              ELSE CAST(value AS DECIMAL(10,2)) END AS amount,
         CASE WHEN event_id % 29 <> 0 THEN ts END AS ts_utc,
         event_id % 23 = 0 AS malformed
  FROM events, unnest(range(CASE WHEN event_id % 31 = 0 THEN 2 ELSE 1 END)) AS copies(copy)
)"""

# Parsed view of the dirty records: malformed rows parse to all NULLs.
PARSED = """parsed AS (
  SELECT user_id AS key,
         CASE WHEN NOT malformed THEN transaction_id END AS transaction_id,
         CASE WHEN NOT malformed THEN user_id END AS user_id,
         CASE WHEN NOT malformed THEN amount END AS amount,
         CASE WHEN NOT malformed THEN ts_utc END AS "timestamp"
  FROM dirty
)"""

VALID = """valid AS (
  SELECT transaction_id, user_id, amount, "timestamp" FROM parsed
  WHERE amount >= 0 AND transaction_id IS NOT NULL AND user_id IS NOT NULL
)"""

PROFILE = """profile AS (
  SELECT CAST(c_custkey AS VARCHAR) AS user_id, c_mktsegment AS risk_category
  FROM customer WHERE c_acctbal >= 0
)"""

RISK_VALID = """risk AS (
  SELECT date_trunc('day', "timestamp") AS window_start,
         date_trunc('day', "timestamp") + INTERVAL 1 DAY AS window_end,
         user_id, COUNT(*) AS tx_count,
         CAST(SUM(amount) AS DECIMAL(20,2)) AS total_amount
  FROM valid WHERE "timestamp" IS NOT NULL
  GROUP BY 1, 2, 3
  HAVING COUNT(*) > 4 OR SUM(amount) > 300
)"""

CLEAN_TOTALS = """
  SELECT date_trunc('day', ts) AS window_start,
         date_trunc('day', ts) + INTERVAL 1 DAY AS window_end,
         CAST(user_id AS VARCHAR) AS user_id,
         COUNT(*) AS tx_count,
         CAST(SUM(CAST(value AS DECIMAL(10,2))) AS DECIMAL(20,2)) AS total_amount
  FROM events WHERE ts IS NOT NULL
  GROUP BY 1, 2, 3"""

WIRE_JSON = """CASE WHEN malformed THEN 'not json ' || transaction_id
  ELSE '{' || concat_ws(',',
      '"transaction_id":"' || transaction_id || '"',
      CASE WHEN user_id IS NOT NULL THEN '"user_id":"' || user_id || '"' END,
      '"amount":' || CAST(amount AS VARCHAR),
      CASE WHEN ts_utc IS NOT NULL
           THEN '"timestamp":"' || strftime(ts_utc, '%Y-%m-%dT%H:%M:%S.%fZ') || '"' END)
    || '}' END"""


ORACLE: dict[str, str] = {
    "high_risk_transactions": f"""
SELECT * FROM ({CLEAN_TOTALS}) t WHERE tx_count > 4 OR total_amount > 300""",

    "user_window_totals": CLEAN_TOTALS,

    "kafka_envelope_decode": f"""
WITH {DIRTY}
SELECT user_id AS key, {WIRE_JSON} AS value, event_type AS topic,
       CAST(src_user_id % 4 AS INTEGER) AS "partition", event_id AS "offset"
FROM dirty""",

    "kafka_typed_decode": f"""
WITH {DIRTY}, {PARSED}
SELECT key, transaction_id, user_id, amount, "timestamp" FROM parsed""",

    "parse_transactions": f"""
WITH {DIRTY}, {PARSED}
SELECT transaction_id, user_id, amount, "timestamp" FROM parsed""",

    "validate_transactions": f"""
WITH {DIRTY}, {PARSED}, {VALID}
SELECT * FROM valid""",

    "rejected_transactions": f"""
WITH {DIRTY}, {PARSED}
SELECT * FROM (
  SELECT transaction_id, user_id, amount, "timestamp",
         CASE WHEN transaction_id IS NULL AND user_id IS NULL AND amount IS NULL
                   AND "timestamp" IS NULL THEN 'unparsable'
              WHEN amount IS NULL THEN 'missing_amount'
              WHEN amount < 0 THEN 'negative_amount'
              WHEN transaction_id IS NULL THEN 'missing_transaction_id'
              WHEN user_id IS NULL THEN 'missing_user_id' END AS reason
  FROM parsed) r
WHERE reason IS NOT NULL""",

    "dedup_transactions": f"""
WITH {DIRTY}, {PARSED}, {VALID}
SELECT DISTINCT * FROM valid""",

    "distinct_users": f"""
WITH {DIRTY}, {PARSED}, {VALID}
SELECT DISTINCT user_id FROM valid""",

    "augment_user_profile": f"""
WITH {DIRTY}, {PARSED}, {VALID}, {PROFILE}
SELECT v.user_id, v.transaction_id, v.amount, v."timestamp",
       COALESCE(p.risk_category, 'UNKNOWN') AS risk_category
FROM valid v LEFT JOIN profile p ON v.user_id = p.user_id""",

    # the same on events of which every third belongs to user 1
    "augment_hot_user": f"""
WITH {DIRTY.replace("FROM events,", "FROM (SELECT * REPLACE (CASE WHEN event_id % 3 = 0 THEN 1 ELSE user_id END AS user_id) FROM events),")},
{PARSED}, {VALID}, {PROFILE}
SELECT v.user_id, v.transaction_id, v.amount, v."timestamp",
       COALESCE(p.risk_category, 'UNKNOWN') AS risk_category
FROM valid v LEFT JOIN profile p ON v.user_id = p.user_id""",

    "augment_self_profile": f"""
WITH {DIRTY}, {PARSED}
SELECT t.transaction_id, t.user_id, t.amount, t."timestamp", p.risk_category
FROM parsed t LEFT JOIN (SELECT DISTINCT user_id, 'HIGH' AS risk_category FROM parsed) p
  ON t.user_id = p.user_id""",

    "risk_alert_messages": f"""
WITH {DIRTY}, {PARSED}, {VALID}, {RISK_VALID}
SELECT user_id AS key, window_start, window_end, user_id, tx_count, total_amount
FROM risk""",

    "lake_messages": f"""
WITH {DIRTY}, {PARSED}, {VALID}, {PROFILE}
SELECT v.user_id AS key, v.transaction_id, v.user_id, v.amount, v."timestamp",
       COALESCE(p.risk_category, 'UNKNOWN') AS risk_category
FROM valid v LEFT JOIN profile p ON v.user_id = p.user_id""",

    "alert_text": f"""
WITH {DIRTY}, {PARSED}, {VALID}, {RISK_VALID}
SELECT window_start, window_end, user_id,
       '[ALERT] High-risk transaction detected: User=' || user_id
       || ' | Count=' || CAST(tx_count AS VARCHAR)
       || ' | Amount=' || CAST(total_amount AS VARCHAR) AS alert_text
FROM risk""",
}

ORACLE.update({
    "high_risk_stream": f"""
WITH {DIRTY}, {PARSED}, {VALID}, {RISK_VALID}
SELECT * FROM risk""",

    "high_risk_incremental": f"""
WITH {DIRTY}, {PARSED}, {VALID}, {RISK_VALID}
SELECT * FROM risk""",

    "late_rows_stream": f"""
WITH {DIRTY}, late_parsed AS (
  SELECT event_id % 37 = 0 AS late, p.* FROM (
    SELECT event_id, CASE WHEN NOT malformed THEN transaction_id END AS transaction_id,
           CASE WHEN NOT malformed THEN user_id END AS user_id, CASE WHEN NOT malformed THEN amount END AS amount,
           CASE WHEN NOT malformed THEN ts_utc END AS "timestamp" FROM dirty) p
), mark AS (
  SELECT MAX("timestamp") - INTERVAL 5 MINUTE AS watermark FROM late_parsed WHERE NOT late
), valid AS (
  SELECT transaction_id, user_id, amount, "timestamp" FROM late_parsed, mark
  WHERE amount >= 0 AND transaction_id IS NOT NULL AND user_id IS NOT NULL
    AND (NOT late OR date_trunc('day', "timestamp") + INTERVAL 1 DAY > watermark)
), {RISK_VALID}
SELECT * FROM risk""",

    "late_rows_side_stream": f"""
WITH {DIRTY}, late_parsed AS (
  SELECT event_id % 37 = 0 AS late, p.* FROM (
    SELECT event_id, CASE WHEN NOT malformed THEN transaction_id END AS transaction_id,
           CASE WHEN NOT malformed THEN user_id END AS user_id, CASE WHEN NOT malformed THEN amount END AS amount,
           CASE WHEN NOT malformed THEN ts_utc END AS "timestamp" FROM dirty) p
), mark AS (
  SELECT MAX("timestamp") - INTERVAL 5 MINUTE AS watermark FROM late_parsed WHERE NOT late
)
SELECT transaction_id, user_id, amount, "timestamp", date_trunc('millisecond', watermark) AS watermark FROM late_parsed, mark
WHERE amount >= 0 AND transaction_id IS NOT NULL AND user_id IS NOT NULL
  AND late AND date_trunc('day', "timestamp") + INTERVAL 1 DAY <= watermark""",

    # three event-time slices of equal length, each a run of one batch
    "query_progress": f"""
WITH {DIRTY}
SELECT COUNT(*) AS input_rows, 3 AS starts, 3 AS ends, 0 AS failures, 3 AS batches FROM dirty""",

    "risk_update_stream": ORACLE["alert_text"],

    "risk_flow_fanout": f"""
WITH {DIRTY}, {PARSED}, {VALID}, {RISK_VALID}
SELECT 'lake' AS branch, CAST(NULL AS TIMESTAMP) AS window_start, CAST(NULL AS TIMESTAMP) AS window_end,
       user_id, COUNT(*) AS tx_count, CAST(SUM(amount) AS DECIMAL(20,2)) AS total_amount, CAST(NULL AS VARCHAR) AS alert_text
FROM valid GROUP BY user_id
UNION ALL
SELECT 'risk', window_start, window_end, user_id, tx_count, total_amount, NULL FROM risk
UNION ALL
SELECT 'alerts', window_start, window_end, user_id, NULL, NULL, alert_text
FROM ({ORACLE["alert_text"].split("FROM risk")[0][ORACLE["alert_text"].index("SELECT window_start"):]} FROM risk) a""",

    "risk_messages_stream": ORACLE["risk_alert_messages"],

    "alert_stream": ORACLE["alert_text"],

    "lake_roundtrip": f"""
WITH {DIRTY}, {PARSED}, {VALID}
SELECT *, CAST("timestamp" AS DATE) AS event_date FROM valid""",

    "lake_messages_stream": ORACLE["lake_messages"],

    "hot_user_flow": ORACLE["augment_hot_user"],

    "dedup_stream": ORACLE["dedup_transactions"],

    "unique_lake_stream": ORACLE["dedup_transactions"],

    "lake_clustered": f"""
WITH {DIRTY}, {PARSED}, {VALID}
SELECT * FROM valid WHERE "timestamp" BETWEEN TIMESTAMP '2024-01-08' AND TIMESTAMP '2024-01-15' AND user_id BETWEEN '1' AND '3'""",

    "bronze_ingest": f"""
WITH {DIRTY}
SELECT event_type AS topic, CAST(src_user_id % 4 AS INTEGER) AS "partition",
       COUNT(*) AS n_records, MIN(event_id) AS min_offset, MAX(event_id) AS max_offset,
       CAST(SUM(strlen({WIRE_JSON})) AS BIGINT) AS value_bytes
FROM dirty GROUP BY 1, 2""",
})

# Payloads by version (same drift rule), then a recursive walk over the JSON.
PAYLOADS = """payloads AS (
  SELECT event_type AS topic,
         CAST(floor(datediff('day', DATE '2024-01-01', CAST(ts AS DATE)) / 7) + 1 AS INTEGER) AS version,
         event_id, props, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, event_type
  FROM events
), shaped AS (
  SELECT topic, version, event_id, k,
         CASE WHEN version <= 1 THEN props
              WHEN version = 2 THEN json_object('k', k, 'w', k, 'src',
                CASE WHEN event_id % 5 <> 0 THEN json_object('app', event_type, 'rev', k % 3) END)
              WHEN version = 3 THEN json_object('k', CAST(k AS VARCHAR), 'w', NULL,
                'src', json_object('app', event_type, 'rev', k % 3),
                'ctx', json_object('geo', json_object('cc', event_type)),
                'type', json_object('name', event_type), 'a.b', k)
              ELSE json_object('k', CAST(k AS VARCHAR), 'w', CAST(k AS VARCHAR)) END AS payload
  FROM payloads
), parsed_payloads AS (
  SELECT topic, version,
         CASE WHEN event_id % 23 = 0 THEN '{"k": ' || k ELSE CAST(payload AS VARCHAR) END AS payload
  FROM shaped
), valid_payloads AS (
  SELECT topic, version, CASE WHEN json_valid(payload) THEN payload END AS payload
  FROM parsed_payloads
)"""

OBSERVED = """nodes(topic, version, field_path, j) AS (
  SELECT topic, version, replace(replace(key, '%', '%25'), '.', '%2E'), json_extract(payload, '$."' || key || '"')
  FROM valid_payloads, unnest(json_keys(payload)) AS t(key)
  UNION ALL
  SELECT topic, version, field_path || '.' || replace(replace(key, '%', '%25'), '.', '%2E'), json_extract(j, '$."' || key || '"')
  FROM nodes, unnest(json_keys(j)) AS t(key)
  WHERE json_type(j) = 'OBJECT'
), observed AS (
  SELECT topic, version, field_path,
         CASE WHEN bool_and(json_type(j) = 'NULL') THEN 'VOID'
              WHEN bool_and(json_type(j) IN ('UBIGINT', 'BIGINT', 'NULL')) THEN 'BIGINT'
              WHEN bool_and(json_type(j) IN ('VARCHAR', 'NULL')) THEN 'STRING'
              WHEN bool_and(json_type(j) IN ('BOOLEAN', 'NULL')) THEN 'BOOLEAN'
              ELSE 'VARIANT' END AS field_type,
         COUNT(*) AS n_rows
  FROM nodes WHERE json_type(j) <> 'OBJECT'
  GROUP BY 1, 2, 3
)"""

ORACLE.update({
    "observed_schema": f"""
WITH RECURSIVE {PAYLOADS}, {OBSERVED}
SELECT * FROM observed""",

    # an object holds one key: keys are data where they are more than 64
    "observed_schema_keyed": f"""
WITH {PAYLOADS.split(", shaped AS")[0].replace("event_id, props", "event_id, user_id, props")}, valid AS (
  SELECT p.*, CASE WHEN users > 64 THEN '*' ELSE 'u' || user_id END AS u, CASE WHEN events > 64 THEN '*' ELSE 'e' || event_id END AS e
  FROM payloads p
  JOIN (SELECT topic, version, count(DISTINCT user_id) AS users, count(DISTINCT event_id) AS events
        FROM payloads WHERE event_id % 23 <> 0 GROUP BY 1, 2) USING (topic, version)
  WHERE event_id % 23 <> 0
)
SELECT topic, version, field_path, field_type, count(*) AS n_rows FROM (
  SELECT topic, version, unnest(['k', 'src.app', 'src.rev', 'by_user.' || u || '.n', 'by_user.' || u || '.kind', 'by_event.' || e]) AS field_path,
         unnest(['BIGINT', 'STRING', 'BIGINT', 'BIGINT', 'STRING', 'BIGINT']) AS field_type
  FROM valid)
GROUP BY 1, 2, 3, 4""",

    "schema_fields": f"""
WITH RECURSIVE {PAYLOADS}, {OBSERVED}
SELECT topic, version, field_path, field_type FROM observed""",

    "schema_latest": f"""
WITH RECURSIVE {PAYLOADS}, {OBSERVED}
SELECT topic, MAX(version) AS latest_version, COUNT(DISTINCT version) AS n_versions,
       MAX(version) + 1 AS next_version
FROM observed GROUP BY 1""",
})

PRINTS = """prints AS (
  SELECT topic, version, sha256(string_agg(pair, chr(10) ORDER BY pair)) AS fingerprint, COUNT(*) AS n_fields
  FROM (SELECT *, CAST(to_json([field_path, '{"type":"' || field_type || '"}']) AS VARCHAR) AS pair FROM observed)
  GROUP BY 1, 2
)"""
ORACLE["schema_fingerprint"] = f"WITH RECURSIVE {PAYLOADS}, {OBSERVED}, {PRINTS} SELECT * FROM prints"

# Types of the old version: the last one other than VOID over versions without a gap.
CHANGES = """versions AS (
  SELECT topic, version, ROW_NUMBER() OVER (PARTITION BY topic ORDER BY version) AS place,
         LAG(version) OVER (PARTITION BY topic ORDER BY version) AS old_version
  FROM (SELECT DISTINCT topic, version FROM observed)
), runs AS (
  SELECT o.*, place - ROW_NUMBER() OVER (PARTITION BY topic, field_path ORDER BY version) AS run
  FROM observed o JOIN versions USING (topic, version)
), typed AS (
  SELECT *, COALESCE(LAST_VALUE(NULLIF(field_type, 'VOID') IGNORE NULLS) OVER (
    PARTITION BY topic, field_path, run ORDER BY version ROWS UNBOUNDED PRECEDING), field_type) AS last_type
  FROM runs
), changes AS (
  SELECT v.topic, v.old_version, v.version AS new_version,
         CASE WHEN n.field_path IS NULL THEN 'removed' ELSE 'type_changed' END AS change,
         o.field_path, o.last_type AS old_type, n.field_type AS new_type
  FROM versions v JOIN typed o ON o.topic = v.topic AND o.version = v.old_version
  LEFT JOIN typed n ON n.topic = v.topic AND n.version = v.version AND n.field_path = o.field_path
  WHERE n.field_path IS NULL
     OR (o.last_type <> n.field_type AND o.last_type <> 'VOID' AND n.field_type <> 'VOID')
)"""

ORACLE.update({
    "schema_breaking_changes": f"""
WITH RECURSIVE {PAYLOADS}, {OBSERVED}, {CHANGES}
SELECT * FROM changes""",

    "schema_register": f"""
WITH RECURSIVE {PAYLOADS}, {OBSERVED}, {CHANGES},
broken AS (
  SELECT topic, new_version AS version, string_agg(line, chr(10) ORDER BY line) AS breaking
  FROM (SELECT *, CASE WHEN change = 'removed' THEN 'removed ' || field_path
                       ELSE 'type_changed ' || field_path || ': ' || old_type || ' -> ' || new_type END AS line
        FROM changes) GROUP BY 1, 2
), {PRINTS}
SELECT topic, version, fingerprint, n_fields, COALESCE(breaking, '') AS breaking
FROM prints LEFT JOIN broken USING (topic, version)""",
})

ORACLE["schema_registry"] = ORACLE["schema_register"]

EDGES = """edge_log AS (
  SELECT 'supplier:' || l_suppkey AS source_id, 'part:' || l_partkey AS target_id,
         'supply' AS transformation_type,
         '{"l_orderkey":' || l_orderkey || ',"l_linenumber":' || l_linenumber
           || ',"l_quantity":' || l_quantity || '}' AS details,
         l_shipdate AS ts, l_orderkey * 100 + l_linenumber AS seq
  FROM lineitem
  UNION ALL
  SELECT 'part:' || l_partkey, 'order:' || l_orderkey, 'line',
         '{"l_linenumber":' || l_linenumber || ',"l_extendedprice":' || l_extendedprice
           || ',"l_discount":' || l_discount || '}',
         l_shipdate, l_orderkey * 100 + l_linenumber
  FROM lineitem
  UNION ALL
  SELECT 'order:' || o_orderkey, 'customer:' || o_custkey, 'purchase',
         '{"o_orderstatus":"' || o_orderstatus || '","o_totalprice":' || o_totalprice || '}',
         o_orderdate, o_orderkey
  FROM orders
  UNION ALL
  SELECT 'customer:' || o_custkey, 'order:' || o_orderkey, 'reorder',
         '{"o_orderpriority":"' || o_orderpriority || '"}', o_orderdate, o_orderkey
  FROM orders
  UNION ALL
  SELECT 'part:' || p_partkey, 'part:' || p_partkey, 'revision',
         '{"p_size":' || p_size || ',"p_retailprice":' || p_retailprice || '}',
         TIMESTAMP '2000-01-01 00:00:00', p_partkey
  FROM part
), edges AS (
  SELECT source_id, target_id, transformation_type, details, ts FROM (
    SELECT *, ROW_NUMBER() OVER (PARTITION BY source_id, target_id ORDER BY ts DESC, seq DESC) AS rn
    FROM edge_log) x
  WHERE rn = 1
)"""

# The oracle walks with UNION over (root, node, depth) and keeps the minimum
# depth; the depth bound of 12 only stops the cycles from repeating forever (the
# longest shortest path of this graph has 4 edges; the Spark walk has no bound).
_REACH = """reach(root, node, depth) AS (
  SELECT root, root, 0 FROM roots
  UNION
  SELECT r.root, e.{far}, r.depth + 1 FROM reach r JOIN edges e ON e.{near} = r.node
  WHERE r.depth < 12
), reach_min AS (SELECT root, node, MIN(depth) AS depth FROM reach GROUP BY 1, 2)"""

ORACLE.update({
    "lineage_edges_latest": f"WITH {EDGES} SELECT * FROM edges",

    "lineage_upstream": f"""
WITH RECURSIVE {EDGES},
roots AS (SELECT 'customer:' || MIN(c_custkey) AS root FROM customer GROUP BY c_nationkey),
{_REACH.format(far="source_id", near="target_id")}
SELECT r.root AS target, e.source_id, e.target_id, r.depth, e.transformation_type, e.details, e.ts
FROM reach_min r JOIN edges e ON e.target_id = r.node""",

    "lineage_downstream": f"""
WITH RECURSIVE {EDGES},
roots AS (SELECT 'part:' || MIN(p_partkey) AS root FROM part GROUP BY p_size),
{_REACH.format(far="target_id", near="source_id")}
SELECT r.root AS origin, e.source_id, e.target_id, r.depth, e.transformation_type, e.details, e.ts
FROM reach_min r JOIN edges e ON e.source_id = r.node""",

    # every shortest path is shorter than its ring; UNION drops repeated (node, depth) pairs
    "lineage_deep": """
WITH RECURSIVE edges AS (
  SELECT 'event:' || (event_id - 50) AS source_id, 'event:' || event_id AS target_id, 'next' AS transformation_type, ts
  FROM events WHERE event_id >= 50
  UNION ALL
  SELECT 'event:' || (event_id - 350), 'event:' || event_id, 'skip', ts FROM events WHERE event_id % 997 = 0 AND event_id >= 350
  UNION ALL
  SELECT 'event:' || MAX(event_id), 'event:' || MIN(event_id), 'loop', MAX(ts) FROM events GROUP BY event_id % 50
  UNION ALL
  SELECT 'raw:' || event_id, 'event:' || event_id, 'load', ts FROM events
), size AS (
  SELECT MAX(event_id) AS top, COUNT(*) // 50 + 1 AS longest FROM events
), reach(root, node, depth) AS (
  SELECT 'event:' || (top // 100 * 50 + chain), 'event:' || (top // 100 * 50 + chain), 0
  FROM size, (SELECT unnest(range(50)) AS chain)
  UNION
  SELECT r.root, e.source_id, r.depth + 1 FROM reach r JOIN edges e ON e.target_id = r.node, size
  WHERE r.depth < size.longest AND e.transformation_type <> 'load'
), reach_min AS (SELECT root, node, MIN(depth) AS depth FROM reach GROUP BY 1, 2)
SELECT r.root AS target, e.source_id, e.target_id, r.depth, e.transformation_type, CAST(NULL AS VARCHAR) AS details, e.ts
FROM reach_min r JOIN edges e ON e.target_id = r.node""",

    "cdc_current_state": """
SELECT key, op, ts, seq, event_type, value, props FROM (
  SELECT user_id AS key,
         CASE event_type WHEN 'signup' THEN 'c' WHEN 'error' THEN 'd' ELSE 'u' END AS op,
         ts, event_id AS seq, event_type, value, props,
         ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS rn
  FROM events) x
WHERE rn = 1 AND op <> 'd'""",
})
ORACLE["cdc_snapshot_stream"] = ORACLE["cdc_current_state"]

# Change events carry epoch milliseconds; the fold orders by offset
# = 2 * event_id (+1 for tombstones), so the same rows win.
ORACLE["cdc_change_events"] = """
SELECT key, op, date_trunc('millisecond', ts) AS ts, 2 * seq AS seq, event_type, value, props FROM (
  SELECT user_id AS key,
         CASE event_type WHEN 'signup' THEN 'c' WHEN 'error' THEN 'd' ELSE 'u' END AS op,
         ts, event_id AS seq, event_type, value, props,
         ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS rn
  FROM events) x
WHERE rn = 1 AND op <> 'd'"""

ORACLE["estimate_storage"] = """
SELECT COUNT(*) AS row_count, LEAST(COUNT(*), 100) AS first_rows, TRUE AS within_bounds FROM lineitem"""
