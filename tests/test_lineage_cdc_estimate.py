"""Lineage closure vs brute force, CDC fold, storage estimate."""

import datetime as dt
import json
import random
from collections import deque

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from riskflow.operators import cdc, lineage
from riskflow.operators.storage_estimate import estimate_storage, parquet_data_bytes
from riskflow.sinks.lake import write_parquet

from conftest import SF_SMALL

EDGE_SCHEMA = "source_id string, target_id string, transformation_type string, details string, ts timestamp_ntz, seq long"
T = dt.datetime(2024, 1, 1)


def edge_log(spark, edges):
    rows = [(s, t, typ, json.dumps(det), T + dt.timedelta(seconds=i), i)
            for i, (s, t, typ, det) in enumerate(edges)]
    return spark.createDataFrame(rows, EDGE_SCHEMA)


def test_chain_and_overwrite(spark):
    log = edge_log(spark, [
        ("web_log", "sessions", "sessionize", {"gap_minutes": 30}),
        ("sessions", "daily_visits", "rollup", {"by": ["day", "page"]}),
        ("sessions", "daily_visits", "rollup", {"by": ["day"]}),
    ])
    edges = lineage.latest_edges(log)
    assert edges.count() == 2
    targets = spark.createDataFrame([("daily_visits",), ("unknown",)], "node string")
    up = {(r["source_id"], r["target_id"], r["depth"], r["transformation_type"], r["details"], r["ts"])
          for r in lineage.upstream_lineage(edges, targets).collect()}
    assert up == {
        ("sessions", "daily_visits", 0, "rollup", '{"by": ["day"]}', T + dt.timedelta(seconds=2)),
        ("web_log", "sessions", 1, "sessionize", '{"gap_minutes": 30}', T),
    }
    down = lineage.downstream_lineage(edges, spark.createDataFrame([("web_log",)], "node string"))
    assert {(r["source_id"], r["depth"]) for r in down.collect()} == {("web_log", 0), ("sessions", 1)}


def test_hot_node_is_walked_once(spark):
    """A node with thousands of neighbours: every edge once, least depths."""
    pairs = {("hub", f"leaf{i}") for i in range(3000)} | {(f"src{i}", "hub") for i in range(3000)} | {("leaf0", "src0")}
    edges = spark.createDataFrame([(s, t, "x", "{}", T) for s, t in sorted(pairs)],
                                  "source_id string, target_id string, transformation_type string, details string, ts timestamp_ntz")
    got = {(r["source_id"], r["target_id"], r["depth"])
           for r in lineage.upstream_lineage(edges, spark.createDataFrame([("leaf7",)], "node string")).collect()}
    assert got == brute_upstream(pairs, "leaf7")


def brute_upstream(edges, target):
    """First-visit walk: every in-edge of every node reachable upstream, min depth."""
    ins = {}
    for s, t in edges:
        ins.setdefault(t, set()).add(s)
    depth = {target: 0}
    todo = deque([target])
    while todo:
        n = todo.popleft()
        for s in ins.get(n, ()):
            if s not in depth:
                depth[s] = depth[n] + 1
                todo.append(s)
    return {(s, t, depth[t]) for t in depth for s in ins.get(t, ())}


@settings(max_examples=3, deadline=None)
@given(seed=st.integers(0, 100_000))
def test_upstream_matches_brute_force_on_cyclic_graphs(spark, seed):
    rnd = random.Random(seed)
    nodes = [f"n{i}" for i in range(25)]
    pairs = {(rnd.choice(nodes), rnd.choice(nodes)) for _ in range(45)}
    pairs.add(("n0", "n0"))  # a self edge
    edges = lineage.latest_edges(edge_log(spark, [(s, t, "x", {}) for s, t in sorted(pairs)]))
    targets = ["n1", "n2", "n3", "missing"]
    got = {(r["target"], r["source_id"], r["target_id"], r["depth"])
           for r in lineage.upstream_lineage(
               edges, spark.createDataFrame([(t,) for t in targets], "node string")).collect()}
    want = {(t, s, x, d) for t in targets for s, x, d in brute_upstream(pairs, t)}
    assert got == want


@pytest.mark.parametrize("jumps,plain", [(4_000_000, 4), (40, 1)])
@pytest.mark.parametrize("seed", [1, 2])
def test_doubling_matches_brute_force(spark, monkeypatch, seed, jumps, plain):
    """Random cyclic graphs with chains; 40 rows of jumps: most are thinned away and single steps must mend it."""
    monkeypatch.setattr(lineage, "JUMP_ROWS", jumps)
    monkeypatch.setattr(lineage, "LEAST_JUMPS", 1)
    monkeypatch.setattr(lineage, "PLAIN_ROUNDS", plain)
    monkeypatch.setattr(lineage, "PLAIN_ROUNDS_LARGE", plain)
    rnd = random.Random(seed)
    pairs = {(f"n{i + 1}", f"n{i}") for i in range(60)} | {(f"n{rnd.randrange(61)}", f"n{rnd.randrange(61)}") for _ in range(12)}
    pairs |= {(f"n{i}", f"m{i}") for i in range(5)} | {("n60", "n30")}
    edges = lineage.latest_edges(edge_log(spark, [(s, t, "x", {}) for s, t in sorted(pairs)]))
    got = {(r["target"], r["source_id"], r["target_id"], r["depth"])
           for r in lineage.upstream_lineage(edges, spark.createDataFrame([("n0",), ("m4",), ("n30",)], "node string")).collect()}
    assert got == {(t, s, x, d) for t in ("n0", "m4", "n30") for s, x, d in brute_upstream(pairs, t)}


@pytest.mark.parametrize("ring", [False, True])
def test_rounds_grow_with_the_logarithm_of_the_depth(spark, ring):
    n = 10_000
    chain = spark.range(n).selectExpr("concat('n', id + 1) AS source_id", "concat('n', id) AS target_id")
    if ring:
        chain = chain.union(spark.createDataFrame([("n0", f"n{n}")], chain.schema))
    rounds = []
    reach = lineage._closure(chain, spark.createDataFrame([("n0",)], "root string"), True, lambda: rounds.append(1))
    assert len(rounds) < 20
    assert reach.count() == n + ring and reach.where("substr(node, 2) <> depth").isEmpty()


@pytest.mark.parametrize("seed", [1, 2])
def test_contraction_matches_brute_force(spark, monkeypatch, seed):
    """Chains, rings, shortcuts, hubs and dead ends with two roots that are no nodes: contracted to nothing, then put back."""
    monkeypatch.setattr(lineage, "CORE_ROWS", 0)
    monkeypatch.setattr(lineage, "PLAIN_ROUNDS", 1)
    rnd = random.Random(seed)
    pairs = {(f"n{i + 1}", f"n{i}") for i in range(60)} | {(f"n{rnd.randrange(61)}", f"n{rnd.randrange(61)}") for _ in range(12)}
    pairs |= {(f"n{i}", f"m{i}") for i in range(5)} | {("n60", "n30")} | {(f"r{(i + 1) % 40}", f"r{i}") for i in range(40)}
    pairs |= {(f"r{i}", f"r{i - 7}") for i in (9, 20, 31)} | {(f"raw{i}", f"r{i}") for i in range(40)} | {(f"raw{i}", "n20") for i in range(30)}
    pairs |= {("n5", "n5"), ("raw1", "raw1")}
    edges = lineage.latest_edges(edge_log(spark, [(s, t, "x", {}) for s, t in sorted(pairs)]))
    targets = ["n0", "m4", "n30", "r11", "raw1", "raw2", "missing"]
    got = [(r["target"], r["source_id"], r["target_id"], r["depth"])
           for r in lineage.upstream_lineage(edges, spark.createDataFrame([(t,) for t in targets], "node string")).collect()]
    assert len(got) == len(set(got))
    assert set(got) == {(t, s, x, d) for t in targets for s, x, d in brute_upstream(pairs, t)}


def test_large_deep_graphs_are_contracted_before_doubling(spark, monkeypatch):
    """Rings with skips: no table of jumps is as large as the graph, and every depth is right."""
    monkeypatch.setattr(lineage, "CORE_ROWS", 500)
    doubled, doubling = [], lineage._doubled
    monkeypatch.setattr(lineage, "_doubled", lambda reach, hops, rows, *more: doubled.append(rows) or doubling(reach, hops, rows, *more))
    n = 6000
    pairs = {(f"a{(i + 1) % n}", f"a{i}") for i in range(n)} | {(f"a{i + 7}", f"a{i}") for i in range(0, n - 7, 97)}
    chain = spark.createDataFrame(sorted(pairs), "source_id string, target_id string")
    reach = lineage._closure(chain, spark.createDataFrame([("a40",)], "root string"), True)
    assert {(r["node"], r["depth"]) for r in reach.collect()} == {(t, d) for _, t, d in brute_upstream(pairs, "a40")}
    assert len(doubled) == 1 and doubled[0] <= 500


def test_ids_of_nodes_never_clash(spark, monkeypatch):
    """The hash of the first seed gives every name the same id: another seed is taken."""
    real, calls = F.xxhash64, []
    monkeypatch.setattr(lineage.F, "xxhash64", lambda *columns: F.lit(7) if calls.append(columns) or len(calls) == 1 else real(*columns))
    assert lineage._hash_seed(spark.createDataFrame([("a",), ("b",)], "name string")) == 1


@pytest.mark.parametrize("upstream", [True, False])
def test_only_edges_of_reached_nodes_are_shuffled_whole(spark, upstream):
    """The log's payload is aggregated for edges of reached nodes alone: the others are left out below the shuffle."""
    log = edge_log(spark, [(f"s{i}", f"t{i % 50}", "x", {"i": i}) for i in range(200)])
    walk = lineage.upstream_lineage if upstream else lineage.downstream_lineage
    rows = walk(lineage.latest_edges(log), spark.createDataFrame([("t7" if upstream else "s7",)], "node string"))
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert plan.rindex("max_by") < plan.rindex("LeftSemi")  # printed top down: the condition is below the aggregation
    assert {r["source_id"] for r in rows.collect()} == ({"s7", "s57", "s107", "s157"} if upstream else {"s7"})


def test_cdc_fold_batch(spark):
    schema = "key long, op string, ts timestamp_ntz, seq long, after struct<v:string>"
    rows = [(1, "c", T, 1, ("a",)), (1, "u", T - dt.timedelta(1), 2, ("b",)),  # the clock stepped back: seq decides
            (2, "c", T, 3, ("x",)), (2, "d", T + dt.timedelta(1), 4, None),
            (3, "u", T, 5, ("only",))]
    live = cdc.current_state(spark.createDataFrame(rows, schema))
    assert sorted((r["key"], r["op"], r["v"]) for r in live.collect()) == [(1, "u", "b"), (3, "u", "only")]


def test_estimate_storage(spark, scratch):
    li = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet")
    est = estimate_storage(li, sample_size_rows=2000).collect()[0]
    assert est["row_count"] == li.count() and 0 < est["sample_rows"] <= li.count()
    write_parquet(li, f"{scratch}/full")
    actual = parquet_data_bytes(spark, f"{scratch}/full")
    assert 0.7 * actual < est["estimated_bytes"] < 1.4 * actual
    spread = [estimate_storage(li.repartition(n), sample_size_rows=2000).first()["estimated_bytes"] for n in (1, 8, 200)]
    assert max(spread) < 1.2 * min(spread)
    (one,) = estimate_storage(li.limit(1), sample_size_rows=1).collect()
    assert one["estimated_bytes"] > 0
    lim = estimate_storage(li, sample_size_rows=100, method="limit").collect()[0]
    assert lim["sample_rows"] == 100
    empty = estimate_storage(li.where(F.lit(False))).collect()[0]
    assert empty["estimated_bytes"] == 0
    bad = estimate_storage(li, method="nope", on_error="minus_one").collect()[0]
    assert bad["estimated_bytes"] == -1


TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.mark.parametrize("name", TABLES)
def test_a_thousand_rows_estimate_every_table(spark, scratch, name):
    table = spark.read.parquet(f"/root/testdata/sf0.01/{name}.parquet")
    table.coalesce(1).write.parquet(f"{scratch}/full")
    real = parquet_data_bytes(spark, f"{scratch}/full")
    assert real / 1.3 <= estimate_storage(table).first()["estimated_bytes"] <= real * 1.3


def test_dictionaries_of_row_groups_and_odd_types(spark, scratch, monkeypatch):
    df = spark.range(200_000).selectExpr("string(id % 50) AS code", "id % 3 = 0 AS flag", "cast(id % 7 AS decimal(9,2)) AS d", "NULL AS nothing",
                                         "array(id, id + 1) AS a", "map('k', id % 5) AS m", "named_struct('x', id) AS s", "sha2(string(id), 256) AS `odd.name`")
    df = df.withColumn("nothing", F.col("nothing").cast("int"))
    write_parquet(df.coalesce(1), f"{scratch}/full")
    real = parquet_data_bytes(spark, f"{scratch}/full")
    assert real / 1.3 <= estimate_storage(df).first()["estimated_bytes"] <= real * 1.3
    from riskflow.operators import storage_estimate as se
    monkeypatch.setattr(se, "GROUP_BYTES", 4 << 20)  # the table's distinct counts from a part of its rows
    assert real / 1.3 <= estimate_storage(df).first()["estimated_bytes"] <= real * 1.3


def test_record_edges_then_latest(spark):
    log = edge_log(spark, [("a", "b", "copy", {"v": 1})])
    new = spark.createDataFrame([("a", "b", "copy", {"v": "2"}), ("b", "c", "agg", {"v": "3"})],
                                "source_id string, target_id string, transformation_type string, details map<string,string>")
    latest = {(r["source_id"], r["target_id"]): r["details"]
              for r in lineage.latest_edges(lineage.record_edges(log, new)).collect()}
    assert latest == {("a", "b"): '{"v":"2"}', ("b", "c"): '{"v":"3"}'}


def test_estimate_int_wrapper(spark):
    from riskflow.operators.storage_estimate import estimate_parquet_storage
    li = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet")
    assert estimate_parquet_storage(li) > 0
    assert estimate_parquet_storage(li.where(F.lit(False))) == 0


def test_estimate_scales_with_row_count(spark):
    li = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet")
    one = estimate_storage(li, sample_size_rows=1000).first()
    two = estimate_storage(li.unionByName(li), sample_size_rows=1000).first()
    assert two["row_count"] == 2 * one["row_count"]
    # doubled rows share their dictionaries: written, the two tables differ by a factor of 1.498
    assert 1.4 < two["estimated_bytes"] / one["estimated_bytes"] < 2.5


def test_cdc_topics_and_change_event_decode(spark):
    from pyspark.sql.types import StructType
    from riskflow.sources.cdc import cdc_topics, decode_change_events
    assert cdc_topics({"topic.prefix": "app", "table.include.list": "db.a, db.b"}) == ["app.db.a", "app.db.b"]
    rows = [(b'{"id": 1}', b'{"after": {"v": "x"}, "op": "c", "ts_ms": 1000}', 0),
            (b'{"id": 1}', b'{"before": {"v": "x"}, "op": "d", "ts_ms": 2000}', 1),
            (b'{"id": 1}', None, 2),                                              # tombstone
            (b'{"id": 2}', b'{"after": {"v": "y"}, "op": "r", "ts_ms": 1500}', 3)]
    rec = spark.createDataFrame(rows, "key binary, value binary, offset long")
    changes = decode_change_events(rec, StructType.fromDDL("v string"), StructType.fromDDL("id long"), "id")
    assert changes.count() == 3
    live = [(r["key"], r["op"], r["v"], r["ts"]) for r in cdc.current_state(changes.drop("before")).collect()]
    assert live == [(2, "r", "y", dt.datetime(1970, 1, 1, 0, 0, 1, 500000))]


def test_track_transformation_and_single_target(spark):
    log = spark.createDataFrame([], EDGE_SCHEMA)
    log = lineage.track_transformation(log, "web_log", "sessions", "sessionize", {"filters": ["x"]})
    log = lineage.track_transformation(log, "sessions", "daily_visits", "aggregation")
    rows = lineage.get_upstream_lineage(lineage.latest_edges(log), "daily_visits").collect()
    assert sorted((r["source_id"], r["depth"]) for r in rows) == [("sessions", 0), ("web_log", 1)]
