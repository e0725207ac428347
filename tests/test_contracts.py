"""Schema contracts on declared definitions and on observed payloads."""

import json
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from riskflow.operators import contracts

ORDERS_V1 = {
    "order": {"type": "long", "nullable": False},
    "placed": {"type": "timestamp"},
    "channel": "string",
    "ship": {"carrier": {"type": "string"}, "box": {"weight": {"type": "double"}}},
}
ORDERS_V2 = {**ORDERS_V1, "ship": {**ORDERS_V1["ship"], "zone": {"type": "string"}}}

SCHEMA = "topic string, version int, definition string"


def catalog(spark, rows):
    return spark.createDataFrame([(t, v, json.dumps(d)) for t, v, d in rows], SCHEMA)


def fields_of(df):
    return {(r["topic"], r["version"], r["field_path"], r["field_type"]) for r in df.collect()}


def test_flatten_three_levels(spark):
    cat = catalog(spark, [("orders", 1, ORDERS_V1), ("orders", 2, ORDERS_V2)])
    got = fields_of(contracts.flatten_definitions(cat))
    v1 = {("orders", 1, p, t) for p, t in [
        ("order", "long"), ("placed", "timestamp"), ("channel", "string"),
        ("ship.carrier", "string"), ("ship.box.weight", "double")]}
    assert v1 <= got and len(got) == 5 + 6
    assert ("orders", 2, "ship.zone", "string") in got


def test_added_field_is_no_breaking_change(spark):
    cat = catalog(spark, [("orders", 1, ORDERS_V1), ("orders", 2, ORDERS_V2)])
    f = contracts.flatten_definitions(cat)
    assert contracts.breaking_changes(f, versions=cat).count() == 0
    added = contracts.breaking_changes(f, versions=cat, include_added=True).collect()
    assert [(r["change"], r["field_path"]) for r in added] == [("added", "ship.zone")]


def test_leaf_rules(spark):
    d = {"a": "string",                                   # shorthand leaf
         "grp": {"type": {"inner": {"type": "int"}}},     # a group with a field named type
         "empty": {},                                     # empty group: no field
         "typed": {"type": "long", "nullable": True}}     # leaf with extra attributes
    got = fields_of(contracts.flatten_definitions(catalog(spark, [("t", 1, d)])))
    assert got == {("t", 1, "a", "string"), ("t", 1, "grp.type.inner", "int"), ("t", 1, "typed", "long")}


def test_definitions_that_do_not_parse_are_never_lost_silently(spark):
    bad = spark.createDataFrame([("t", 1, "not json"), ("t", 2, '{"a": "int", "a": "long"}'), ("t", 3, "[1]"), ("t", 4, None),
                                 ("t", 5, '{"a": "int"}')], SCHEMA)
    with pytest.raises(contracts.InvalidDefinitionError):
        contracts.flatten_definitions(bad)
    assert fields_of(contracts.flatten_definitions(bad, on_invalid="skip")) == {("t", 5, "a", "int")}
    assert sorted(r["version"] for r in contracts.invalid_definitions(bad).collect()) == [1, 2, 3, 4]


def test_paths_that_are_leaf_and_group_and_names_with_dots(spark):
    payloads = spark.createDataFrame([
        ("t", 1, '{"src": null, "a.b": 1, "p%": "x", "": 2}'), ("t", 1, '{"src": {"app": "x", "deep": {"er": 1}}, "a.b": 1}'),
        ("t", 1, '{"src": {"deep": 5}}')], "topic string, version int, payload string")
    obs = contracts.observed_schema(payloads)
    want = {("src", "VOID"), ("src.app", "STRING"), ("src.deep", "BIGINT"), ("src.deep.er", "BIGINT"), ("a%2Eb", "BIGINT"),
            ("p%25", "STRING"), ("%", "BIGINT")}
    assert {(r["field_path"], r["field_type"]) for r in obs.collect()} == want
    defs = contracts.definitions_from_fields(obs)
    text = json.loads(defs.first()["definition"])
    assert text["a.b"] == {"type": "BIGINT"} and text["src"][""] == {"type": "VOID"} and text["src"]["deep"][""] == {"type": "BIGINT"}
    back = {(r["field_path"], r["field_type"]) for r in contracts.flatten_definitions(defs).collect()}
    assert back == want


def test_many_definitions_have_no_row_limit(spark):
    from pyspark.sql import functions as F
    n = 300_000
    cat = spark.range(n).select(F.lit("t").alias("topic"), F.col("id").cast("int").alias("version"),
                                F.lit('{"a":"int","b":{"c":"int","d":"int"},"e":"int"}').alias("definition"))
    assert contracts.flatten_definitions(cat).count() == 4 * n
    deep = "x"
    for i in range(130):
        deep = {f"n{i}": deep}
    (row,) = contracts.flatten_definitions(catalog(spark, [("t", 1, deep)])).collect()
    assert row["field_path"].count(".") == 129


def test_removed_retyped_gap_and_empty(spark):
    rows = [("t", 1, {"a": {"type": "int"}, "b": {"type": "string"}, "n": {"x": "int"}}),
            ("t", 5, {"a": {"type": "long"}, "n": {"x": "int"}}),      # gap: compared with v1
            ("t", 6, {}),                                              # empty new: all removed
            ("t", 7, {"z": "int"})]                                    # empty old: nothing
    cat = catalog(spark, rows)
    f = contracts.flatten_definitions(cat)
    got = {(r["old_version"], r["new_version"], r["change"], r["field_path"], r["old_type"], r["new_type"])
           for r in contracts.breaking_changes(f, versions=cat).collect()}
    assert got == {(1, 5, "removed", "b", "string", None),
                   (1, 5, "type_changed", "a", "int", "long"),
                   (5, 6, "removed", "a", "long", None),
                   (5, 6, "removed", "n.x", "int", None)}
    strict = contracts.breaking_changes(f, versions=cat, strict_adjacent=True).collect()
    assert {(r["old_version"], r["new_version"]) for r in strict} == {(5, 6)}


def test_register_versions(spark):
    cat = catalog(spark, [("t", 5, {"a": "int"}), ("t", 2, {"a": "int"})])
    new = spark.createDataFrame([("t", None, '{"a":"int"}'), ("u", None, '{"b":"int"}'),
                                 ("t", None, '{"c":"int"}')], SCHEMA)
    out = contracts.register_versions(cat, new)
    assert sorted((r["topic"], r["version"]) for r in out.collect()) == [
        ("t", 2), ("t", 5), ("t", 6), ("t", 7), ("u", 1)]
    latest = {r["topic"]: (r["latest_version"], r["next_version"])
              for r in contracts.latest_versions(out).collect()}
    assert latest == {"t": (7, 8), "u": (1, 2)}
    with pytest.raises(contracts.DuplicateVersionError):
        contracts.register_versions(cat, spark.createDataFrame([("t", 5, "{}")], SCHEMA))
    with pytest.raises(contracts.DuplicateVersionError):
        contracts.register_versions(cat, spark.createDataFrame([("t", 9, "{}"), ("t", 9, "{}")], SCHEMA))


def test_interleaved_writers_share_no_version_and_lose_none(spark, scratch, monkeypatch):
    from riskflow.operators import registry as reg
    from riskflow.sinks.commits import CommitLog

    one, two = reg.SchemaRegistry(spark, f"{scratch}/reg"), reg.SchemaRegistry(spark, f"{scratch}/reg")
    auto = lambda *topics: spark.createDataFrame([(t, None, '{"a":"int"}') for t in topics], SCHEMA)
    one.register(auto("t"))
    commit, first = CommitLog.commit, []

    def after_the_other(self, number, text):  # the other writer commits between this one's reading and its commit
        if not first:
            first.append(1)
            assert [(r["topic"], r["version"]) for r in two.register(auto("t")).collect()] == [("t", 2)]
        commit(self, number, text)

    with monkeypatch.context() as m:
        m.setattr(CommitLog, "commit", after_the_other)
        mine = one.register(auto("t", "t", "u"))
    assert sorted((r["topic"], r["version"]) for r in mine.collect()) == [("t", 3), ("t", 4), ("u", 1)]
    with pytest.raises(contracts.DuplicateVersionError):
        two.register(spark.createDataFrame([("t", 4, "{}")], SCHEMA))
    rows = one.catalog().collect()
    assert sorted((r["topic"], r["version"]) for r in rows) == [("t", 1), ("t", 2), ("t", 3), ("t", 4), ("u", 1)]
    assert all(r["created_at"] is not None for r in rows)


def test_concurrent_writers_of_a_registry(spark, scratch, monkeypatch):
    from concurrent.futures import ThreadPoolExecutor

    from riskflow.operators import registry as reg

    monkeypatch.setattr(reg, "MOST_FOLDERS", 3)
    new = [spark.createDataFrame([("t", None, json.dumps({f"f{i}": "int"}))], SCHEMA) for i in range(6)]
    with ThreadPoolExecutor(3) as pool:
        list(pool.map(lambda df: reg.SchemaRegistry(spark, f"{scratch}/reg").register(df), new))
    last = reg.SchemaRegistry(spark, f"{scratch}/reg")
    rows = last.catalog().collect()
    assert sorted(r["version"] for r in rows) == [1, 2, 3, 4, 5, 6] and len({r["definition"] for r in rows}) == 6
    assert last.log.numbers() == list(range(6)) and len(last._state()[1]) <= 3


def _shuffled(d, rnd):
    items = list(d.items())
    rnd.shuffle(items)
    return {k: _shuffled(v, rnd) if isinstance(v, dict) else v for k, v in items}


@settings(max_examples=5, deadline=None)
@given(seed=st.integers(0, 10_000))
def test_fingerprint_ignores_field_order(spark, seed):
    rnd = random.Random(seed)
    a = catalog(spark, [("t", 1, ORDERS_V2)])
    b = catalog(spark, [("t", 1, _shuffled(ORDERS_V2, rnd))])
    fa = contracts.schema_fingerprints(contracts.flatten_definitions(a)).collect()[0]["fingerprint"]
    fb = contracts.schema_fingerprints(contracts.flatten_definitions(b)).collect()[0]["fingerprint"]
    assert fa == fb and len(fa) == 64
    c = catalog(spark, [("t", 1, ORDERS_V1)])
    assert contracts.schema_fingerprints(contracts.flatten_definitions(c)).collect()[0]["fingerprint"] != fa


def test_observed_schema_and_definitions_round_trip(spark):
    payloads = spark.createDataFrame([
        ("t", 1, '{"k": 1, "m": {"a": "x"}}'), ("t", 1, '{"k": 2}'), ("t", 1, "not json"),
        ("t", 1, "[1]"), ("t", 2, '{"k": "s"}')], "topic string, version int, payload string")
    obs = {(r["version"], r["field_path"], r["field_type"], r["n_rows"])
           for r in contracts.observed_schema(payloads).collect()}
    assert obs == {(1, "k", "BIGINT", 2), (1, "m.a", "STRING", 1), (2, "k", "STRING", 1)}
    defs = contracts.definitions_from_fields(contracts.observed_schema(payloads))
    text = {r["version"]: json.loads(r["definition"]) for r in defs.collect()}
    assert text[1] == {"k": {"type": "BIGINT"}, "m": {"a": {"type": "STRING"}}}
    back = {(r["version"], r["field_path"], r["field_type"])
            for r in contracts.flatten_definitions(defs).collect()}
    assert back == {(v, p, t) for v, p, t, _ in obs}


def test_keys_that_are_data_are_one_step(spark, monkeypatch):
    rows = [("t", 1, json.dumps({"k": i, "by": {f"u{i}": {"n": i, "tags": {f"x{j}": True for j in range(i % 3)}}}, "*": 1, "w": {f"c{j}": j for j in range(80)}}))
            for i in range(200)]
    rows += [("few", 1, json.dumps({"by": {f"u{i % 5}": i}})) for i in range(50)] + [(None, None, '{"a": {"b": 1}}'), ("t", 1, "[1]"), ("t", 1, "{")]
    df = spark.createDataFrame(rows, "topic string, version int, payload string")
    got = {(r["topic"], r["version"], r["field_path"]): (r["field_type"], r["n_rows"]) for r in contracts.observed_schema(df).collect()}
    assert got.pop((None, None, "a.b")) == ("BIGINT", 1)
    assert {p: v for (t, _, p), v in got.items() if t == "few"} == {f"by.u{i}": ("BIGINT", 10) for i in range(5)}
    want = {"k": ("BIGINT", 200), "by.*.n": ("BIGINT", 200), "by.*.tags.x0": ("BOOLEAN", 133), "by.*.tags.x1": ("BOOLEAN", 66), "%2A": ("BIGINT", 200)}
    want |= {f"w.c{j}": ("BIGINT", 200) for j in range(80)}  # a wide object that is always the same: names
    assert {p: v for (t, _, p), v in got.items() if t == "t"} == want
    monkeypatch.setattr(contracts, "MAX_SHAPES", 20)  # the walk over rows folds the same paths
    again = {(r["topic"], r["version"], r["field_path"]): (r["field_type"], r["n_rows"]) for r in contracts.observed_schema(df).collect()}
    assert {k: v for k, v in again.items() if k[0] is not None} == got


def test_a_million_keys_give_few_rows(spark, monkeypatch):
    levels = []
    plain = contracts._to_shapes
    monkeypatch.setattr(contracts, "_to_shapes", lambda rows: levels.append(plain(rows)) or levels[-1])
    df = spark.range(1_000_000).selectExpr(
        "'t' AS topic", "1 AS version", """concat('{"k":', id % 7, ',"by":{"u', id, '":{"n":', id, ',"s":"x"}}}') AS payload""")
    got = {r["field_path"]: (r["field_type"], r["n_rows"]) for r in contracts.observed_schema(df).collect()}
    assert got == {"k": ("BIGINT", 1_000_000), "by.*.n": ("BIGINT", 1_000_000), "by.*.s": ("STRING", 1_000_000)}
    assert levels[-2].count() <= 10  # the objects below by.*: one shape


def test_observed_types_merge_and_void_is_not_a_change(spark):
    payloads = spark.createDataFrame([
        ("t", 1, '{"k": 1, "n": null}'), ("t", 1, '{"k": 1.5, "n": null}'),
        ("t", 2, '{"k": 2.5, "n": "x"}')], "topic string, version int, payload string")
    obs = {(r["version"], r["field_path"]): r["field_type"]
           for r in contracts.observed_schema(payloads).collect()}
    assert obs[(1, "n")] == "VOID" and obs[(1, "k")].startswith("DECIMAL")
    changes = contracts.breaking_changes(contracts.observed_schema(payloads)).collect()
    assert all(r["field_path"] != "n" for r in changes)


def test_a_change_across_void_versions_is_reported(spark):
    f = spark.createDataFrame([("t", 1, "a", "BIGINT"), ("t", 2, "a", "VOID"), ("t", 3, "a", "STRING"),
                               ("t", 1, "b", "VOID"), ("t", 2, "b", "INT"), ("t", 3, "b", "INT"),
                               ("t", 1, "c", "INT"), ("t", 3, "c", "VOID"), ("t", 4, "c", "LONG"), ("t", 4, "a", "STRING"), ("t", 4, "b", "INT")],
                              "topic string, version int, field_path string, field_type string")
    got = {(r["old_version"], r["new_version"], r["change"], r["field_path"], r["old_type"], r["new_type"])
           for r in contracts.breaking_changes(f).collect()}
    assert got == {(2, 3, "type_changed", "a", "BIGINT", "STRING"), (1, 2, "removed", "c", "INT", None)}
    plain = {(r["old_version"], r["field_path"]) for r in contracts.breaking_changes(f, void="plain").collect()}
    assert plain == {(1, "a"), (2, "a"), (1, "b"), (1, "c"), (3, "c")}


def test_fingerprints_tell_paths_types_and_attributes_apart(spark):
    defs = [{"a:b": "c"}, {"a": "b:c"}, {"a": {"type": "int", "nullable": True}}, {"a": {"type": "int", "nullable": False}},
            {"a": {"type": "int"}}, {"a": "int"}, {}]
    cat = catalog(spark, [("t", i, d) for i, d in enumerate(defs)])
    out = {r["version"]: (r["fingerprint"], r["n_fields"]) for r in contracts.schema_fingerprints(contracts.flatten_definitions(cat), cat).collect()}
    assert len(out) == len(defs) and out[4] == out[5]
    assert len({v[0] for v in out.values()}) == len(defs) - 1
    assert out[6] == ("e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855", 0)


def test_registration_record(spark):
    empty = spark.createDataFrame([], SCHEMA + ", created_at timestamp")
    cat = contracts.register_versions(empty, spark.createDataFrame(
        [("t", 3, '{"a":"int","b":"int"}'), ("t", None, '{"a":"long"}')], SCHEMA))
    rows = {r["version"]: r for r in contracts.registration_records(cat).collect()}
    assert set(rows) == {3, 4}  # numbered after the batch's own highest version
    assert rows[4]["breaking"] == ["removed b", "type_changed a: int -> long"] and rows[3]["breaking"] == []
    assert rows[4]["created_at"] is not None and len(rows[4]["fingerprint"]) == 64 and rows[4]["n_fields"] == 1


def test_register_schema_one_definition(spark):
    empty = spark.createDataFrame([], SCHEMA)
    cat = contracts.register_schema(empty, "orders", ORDERS_V1, version=1)
    cat = contracts.register_schema(cat, "orders", ORDERS_V2)          # next version
    assert sorted(r["version"] for r in cat.collect()) == [1, 2]
    with pytest.raises(contracts.DuplicateVersionError):
        contracts.register_schema(cat, "orders", ORDERS_V1, version=2)
    assert contracts.breaking_changes(contracts.flatten_definitions(cat), versions=cat).count() == 0
