"""Schema contracts as table jobs: flatten, register, fingerprint, observe, diff.

A catalog is a table ``(topic, version, definition)`` where ``definition`` is a
JSON document in the registry format: a field is a leaf ``{"type": "..."}`` or
a shorthand ``"string"``; an object without a string ``type`` is a group of
fields. Flattened fields are rows ``(topic, version, field_path, field_type)``.

A path is its field names joined by dots; a dot or percent sign within a name is
written ``%2E`` or ``%25``, an empty name ``%``. A path that is both a leaf and
a group (``"src": null`` in one payload, ``"src": {...}`` in another) keeps both:
in a definition the group has a member with the empty name for its own type.

Scale notes
-----------
- Flattening walks nesting levels, one narrow explode and one checkpoint a
  level; the number of levels is the nesting depth, not the data size, and
  neither depth nor rows are bounded.
- Observed schemas from payload rows first reduce the rows to one per
  (topic, version, shape) with map-side partial aggregation, so a topic with a
  third of all rows ships one row per shape and map task; the level walk
  then runs on that table only. Where payload objects are keyed by data (a map
  from user ids, say), there are as many shapes as rows: such topics are found by
  a distinct-count sketch of their shapes and walked level by level instead. On the
  way a HyperLogLog sketch of the child keys of each path tells names from data,
  and keys that are data become one step ``*`` before their values are
  reduced to shapes. Both ways fold the same paths.
- Per-version work (fingerprints, version pairs) groups by (topic, version):
  the group size is the schema width, bounded by the schema, not by the data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskflow.session import checkpoint_root

# --- leaf rule (fixed): a value is a leaf unless it is an object whose
# ``type`` is missing or not a string --------------------------------------
_IS_OBJECT = "schema_of_variant(v) LIKE 'OBJECT%'"
_IS_GROUP = (f"({_IS_OBJECT} AND "
             "coalesce(schema_of_variant(try_variant_get(v, '$.type', 'variant')) <> 'STRING', true))")
_LEAF_TYPE = (f"CASE WHEN {_IS_OBJECT} THEN try_variant_get(v, '$.type', 'string') "
              "ELSE cast(v AS string) END")
_LEAF_JSON = f"CASE WHEN {_IS_OBJECT} THEN to_json(v) ELSE to_json(named_struct('type', cast(v AS string))) END"


def _encoded(name):
    """A field name as a path step (see the module text)."""
    dots = F.replace(F.replace(name, F.lit("%"), F.lit("%25")), F.lit("."), F.lit("%2E"))
    return F.when(name == "", F.lit("%")).otherwise(dots)


def _decoded(step):
    plain = F.replace(F.replace(step, F.lit("%2E"), F.lit(".")), F.lit("%25"), F.lit("%"))
    return F.when(step == "%", F.lit("")).otherwise(plain)


def _json_string(c):
    """A string column as a JSON string literal (quoted, escaped)."""
    return F.regexp_extract(F.to_json(F.array(c)), r"(?s)^\[(.*)\]$", 1)


def _walk(rows: DataFrame, is_group: str, self_member: bool) -> DataFrame:
    """Leaves below the objects ``v`` of ``rows``: all other columns, ``field_path`` and the leaf's ``v``.

    One explode and one checkpoint per nesting level, until no groups are left.
    """
    checkpoint_root(rows.sparkSession)
    keep = [c for c in rows.columns if c != "v"]
    level = rows.withColumn("field_path", F.lit(None).cast("string"))
    leaves = None
    while True:
        member = level.sparkSession.sql(
            "SELECT s.* EXCEPT (v), e.key AS _name, e.value AS v FROM {level} s, LATERAL variant_explode(s.v) e", level=level)
        step = F.concat_ws(".", "field_path", _encoded(F.col("_name")))
        if self_member:  # the empty name stands for the group itself
            step = F.when((F.col("_name") == "") & F.col("field_path").isNotNull(), F.col("field_path")).otherwise(step)
        member = member.select(*keep, step.alias("field_path"), "v").withColumn("_group", F.expr(is_group)).checkpoint()
        here = member.where("NOT _group").drop("_group")
        leaves = here if leaves is None else leaves.unionByName(here)
        level = member.where("_group").drop("_group")
        if level.isEmpty():
            return leaves


class InvalidDefinitionError(ValueError):
    """A definition is not a JSON object in the registry format."""


class DuplicateVersionError(ValueError):
    """A registered (topic, version) would be overwritten."""


def invalid_definitions(catalog: DataFrame) -> DataFrame:
    """Catalog rows whose definition is no JSON object (or repeats a key)."""
    return catalog.where(~F.coalesce(F.expr("schema_of_variant(try_parse_json(definition)) LIKE 'OBJECT%'"), F.lit(False)))


def flatten_definitions(catalog: DataFrame, on_invalid: str = "raise") -> DataFrame:
    """Catalog rows -> ``(topic, version, field_path, field_type, field_definition)``.

    Shorthand leaves give their string as the type; ``field_definition`` is the
    whole leaf as JSON with sorted keys. Empty groups give no row. A definition
    that is no JSON object raises ``InvalidDefinitionError``; with
    ``on_invalid='skip'`` it gives no rows (``invalid_definitions`` lists them).
    """
    if on_invalid not in ("raise", "skip"):
        raise ValueError(f"on_invalid must be 'raise' or 'skip', got {on_invalid!r}")
    checkpoint_root(catalog.sparkSession)
    src = catalog.select("topic", F.col("version").cast("int").alias("version"), "definition").checkpoint()
    if on_invalid == "raise":
        bad = invalid_definitions(src).select("topic", "version").take(5)
        if bad:
            raise InvalidDefinitionError(f"unparsable definitions, among them {[tuple(r) for r in bad]}")
    src = src.withColumn("v", F.expr("try_parse_json(definition)")).drop("definition").where(_IS_OBJECT)
    return _walk(src, _IS_GROUP, True).select(
        "topic", "version", "field_path", F.expr(_LEAF_TYPE).alias("field_type"), F.expr(_LEAF_JSON).alias("field_definition"))


def payload_shapes(payloads: DataFrame, topic_col="topic", version_col="version",
                   payload_col="payload") -> DataFrame:
    """One row per (topic, version, JSON shape): row count and a sample value.

    Unparsable payloads and non-object payloads are skipped. The grouping is
    partial-aggregated on the map side.
    """
    v = F.expr(f"try_parse_json({payload_col})")
    parsed = payloads.select(F.col(topic_col).alias("topic"),
                             F.col(version_col).cast("int").alias("version"),
                             v.alias("v"))
    return (parsed.where(F.expr("schema_of_variant(v) LIKE 'OBJECT%'"))
            .groupBy("topic", "version", F.expr("schema_of_variant(v)").alias("shape"))
            .agg(F.count(F.lit(1)).alias("n_rows"), F.expr("any_value(v)").alias("sample")))


MAX_KEYS = 64  # child keys of a path that are taken for names, whatever objects hold them
FOLD_RATIO = 4  # data keys are at least so many times as many as an object holds on average
MAX_SHAPES = 1000  # shapes of a (topic, version, path) up to which rows are reduced to shapes
ANY_KEY = "*"  # the path step of keys that are data; a key of that name in a payload is %2A


def _to_shapes(rows: DataFrame) -> DataFrame:
    """Objects ``v`` with ``n_rows``: one row per shape of the other columns."""
    keys = [c for c in rows.columns if c not in ("v", "n_rows")]
    return (rows.groupBy(*keys, F.expr("schema_of_variant(v)").alias("shape"))
            .agg(F.sum("n_rows").alias("n_rows"), F.expr("any_value(v)").alias("v")).drop("shape"))


def _reduced(rows: DataFrame) -> tuple[DataFrame, bool]:
    """``rows`` reduced to shapes where a path has few, and whether that was all of them."""
    keys = [c for c in rows.columns if c not in ("v", "n_rows")]
    shapes = rows.groupBy(*keys).agg(F.approx_count_distinct(F.expr("schema_of_variant(v)")).alias("shapes"))
    many = shapes.where(F.col("shapes") > MAX_SHAPES).select(*keys).checkpoint()
    if many.isEmpty():
        return _to_shapes(rows), True
    many = many.select(*[F.col(c).alias(f"_{c}") for c in keys])
    same = F.lit(True)
    for c in keys:
        same = same & F.col(c).eqNullSafe(F.col(f"_{c}"))
    return _to_shapes(rows.join(many, same, "left_anti")).unionByName(rows.join(many, same, "left_semi").select(*rows.columns)), False


def _keyed_by_data(members: DataFrame, max_keys: int) -> DataFrame:
    """The paths ``(t, ver, above)`` whose objects are keyed by data: many keys, of which an object holds few."""
    stats = members.groupBy(F.col("topic").alias("t"), F.col("version").alias("ver"), F.col("parent").alias("above")).agg(
        F.hll_sketch_estimate(F.hll_sketch_agg("_name")).alias("keys"), F.sum("n_rows").alias("total"),
        F.sum(F.when(F.col("pos") == 0, F.col("n_rows"))).alias("objects"))
    return stats.where((F.col("keys") > max_keys) & (F.col("keys") * F.col("objects") > FOLD_RATIO * F.col("total"))).select(
        "t", "ver", "above", F.lit(True).alias("_fold"))


def observed_schema(payloads: DataFrame, topic_col="topic", version_col="version",
                    payload_col="payload", max_keys: int = MAX_KEYS) -> DataFrame:
    """Schema observed in JSON payload rows.

    Output ``(topic, version, field_path, field_type, n_rows)``: the type is the
    merge of the leaf types seen (``schema_of_variant_agg``), ``n_rows`` the
    number of values seen at the path, which is the number of payloads holding it
    unless a step is ``*``. Keys that are data (more than ``max_keys``, and an
    object holds less than a quarter of them on average) are one step ``*``.
    Unparsable payloads and such that are no objects give no rows.
    """
    checkpoint_root(payloads.sparkSession)
    rows = payloads.select(F.col(topic_col).alias("topic"), F.col(version_col).cast("int").alias("version"),
                           F.expr(f"try_parse_json({payload_col})").alias("v"), F.lit(1).cast("long").alias("n_rows"))
    level, small = _reduced(rows.where(F.expr(_IS_OBJECT)))
    # the scan of all payloads runs only here
    level = level.withColumn("field_path", F.lit(None).cast("string")).checkpoint()
    leaves = None
    while True:
        members = level.sparkSession.sql(
            "SELECT s.topic, s.version, s.field_path AS parent, s.n_rows, e.pos, e.key AS _name, e.value AS v "
            "FROM {level} s, LATERAL variant_explode(s.v) e", level=level).checkpoint()
        folded = _keyed_by_data(members, max_keys)
        of = (F.col("topic").eqNullSafe(F.col("t")) & F.col("version").eqNullSafe(F.col("ver")) & F.col("parent").eqNullSafe(F.col("above")))
        name = F.when(F.col("_name") == ANY_KEY, F.lit("%2A")).otherwise(_encoded(F.col("_name")))
        step = F.concat_ws(".", "parent", F.when(F.col("_fold"), F.lit(ANY_KEY)).otherwise(name))
        members = members.join(folded, of, "left").select("topic", "version", step.alias("field_path"), "n_rows", "v")
        here = (members.where(f"NOT {_IS_OBJECT}").groupBy("topic", "version", "field_path")
                .agg(F.expr("schema_of_variant_agg(v)").alias("field_type"), F.sum("n_rows").cast("long").alias("n_rows"))).checkpoint()
        leaves = here if leaves is None else leaves.unionByName(here)
        groups = members.where(F.expr(_IS_OBJECT))
        level, small = (_to_shapes(groups), True) if small else _reduced(groups)
        level = level.checkpoint()
        if level.isEmpty():
            return leaves


def definitions_from_fields(fields: DataFrame) -> DataFrame:
    """Fields -> catalog rows in the registry format (inverse of flatten).

    Built bottom-up, one aggregation per nesting level, on the (small) field
    table; keys are sorted so equal schemas give equal text.
    """
    checkpoint_root(fields.sparkSession)
    fields = fields.checkpoint()  # small; read once per level below
    parts = fields.select("topic", "version", F.transform(F.split("field_path", r"\."), _decoded).alias("p"),
                          F.to_json(F.struct(F.col("field_type").alias("type"))).alias("j"))
    # leaves that are also groups become a member with the empty name
    above = (parts.where(F.size("p") > 1)
             .select("topic", "version", F.explode(F.transform(F.sequence(F.lit(1), F.size("p") - 1), lambda n: F.slice("p", 1, n))).alias("p"))
             .distinct().withColumn("_above", F.lit(True)))
    parts = (parts.join(above, ["topic", "version", "p"], "left")
             .withColumn("p", F.when(F.col("_above"), F.concat("p", F.array(F.lit("")))).otherwise(F.col("p"))).drop("_above")).checkpoint()
    depth_row = parts.agg(F.max(F.size("p")).alias("d")).first()
    depth = int(depth_row["d"] or 0)
    # level nodes: (topic, version, prefix array, name, json text)
    nodes = None
    for level in range(depth, 0, -1):
        leaves_here = (parts.where(F.size("p") == level)
                       .select("topic", "version",
                               F.slice("p", 1, level - 1).alias("prefix"),
                               F.element_at("p", level).alias("name"), "j"))
        if nodes is not None:
            leaves_here = leaves_here.unionByName(nodes)
        member = F.concat(_json_string(F.col("name")), F.lit(":"), F.col("j"))
        grouped = (leaves_here.groupBy("topic", "version", "prefix")
                   .agg(F.concat(F.lit("{"), F.array_join(F.sort_array(F.collect_list(member)), ","),
                                 F.lit("}")).alias("j")))
        if level == 1:
            return grouped.select("topic", "version", F.col("j").alias("definition"))
        nodes = grouped.select("topic", "version",
                               F.slice("prefix", 1, level - 2).alias("prefix"),
                               F.element_at("prefix", level - 1).alias("name"), "j")
    return fields.sparkSession.createDataFrame([], "topic string, version int, definition string")


def schema_fingerprints(fields: DataFrame, versions: DataFrame | None = None) -> DataFrame:
    """SHA-256 per (topic, version) over the sorted pairs of path and whole leaf
    definition, each pair a JSON array; independent of the field order.

    With ``versions`` (the catalog) versions without fields have a row as well:
    the hash of the empty string.
    """
    from riskflow.functions.columns import schema_fingerprint
    out = (fields.groupBy("topic", "version")
           .agg(schema_fingerprint().alias("fingerprint"), F.count(F.lit(1)).alias("n_fields")))
    if versions is None:
        return out
    all_of = versions.select("topic", F.col("version").cast("int").alias("version")).distinct()
    return all_of.join(out, ["topic", "version"], "left").select(
        "topic", "version", F.coalesce("fingerprint", F.sha2(F.lit(""), 256)).alias("fingerprint"),
        F.coalesce("n_fields", F.lit(0)).cast("long").alias("n_fields"))


def registration_records(catalog: DataFrame) -> DataFrame:
    """The registry's record of each version: ``(topic, version, definition, created_at,
    fingerprint, n_fields, breaking)``.

    ``breaking`` holds one sorted line per breaking change against the previous
    version (``removed <path>`` or ``type_changed <path>: <old> -> <new>``).
    ``created_at`` is NULL where the catalog has none.
    """
    fields = flatten_definitions(catalog).checkpoint()
    changes = breaking_changes(fields, versions=catalog)
    line = F.when(F.col("change") == "removed", F.concat(F.lit("removed "), "field_path")).otherwise(
        F.concat(F.lit("type_changed "), "field_path", F.lit(": "), "old_type", F.lit(" -> "), "new_type"))
    broken = (changes.groupBy("topic", F.col("new_version").alias("version"))
              .agg(F.sort_array(F.collect_list(line)).alias("breaking")))
    created = F.col("created_at") if "created_at" in catalog.columns else F.lit(None).cast("timestamp")
    rows = catalog.select("topic", F.col("version").cast("int").alias("version"), "definition", created.alias("created_at"))
    return (rows.join(schema_fingerprints(fields, catalog), ["topic", "version"])
            .join(broken, ["topic", "version"], "left")
            .withColumn("breaking", F.coalesce("breaking", F.array().cast("array<string>"))))


def latest_versions(catalog: DataFrame) -> DataFrame:
    """Highest registered version per topic and the next auto version."""
    return (catalog.groupBy("topic")
            .agg(F.max("version").alias("latest_version"),
                 F.count(F.lit(1)).alias("n_versions"))
            .withColumn("next_version", F.col("latest_version") + 1))


def number_versions(catalog: DataFrame, new: DataFrame, order_col: str | None = None) -> DataFrame:
    """The rows of ``new`` (topic, version or NULL, definition) with their versions and the columns of ``catalog``.

    NULL versions are numbered after the topic's highest version in catalog and
    batch, in ``order_col`` order within the batch. A (topic, version) already
    present, or repeated in the batch, refuses the whole batch.
    """
    checkpoint_root(catalog.sparkSession)
    order = F.col(order_col) if order_col else F.monotonically_increasing_id()
    # numbered once: the checks and the result read the same rows
    new = new.withColumn("_order", order).checkpoint()
    highest = (catalog.select("topic", F.col("version").cast("int").alias("version"))
               .unionByName(new.where("version IS NOT NULL").select("topic", F.col("version").cast("int").alias("version")))
               .groupBy("topic").agg(F.max("version").alias("_highest")))
    w = Window.partitionBy("topic", F.col("version").isNull()).orderBy("_order", "definition")
    numbered = (new.withColumn("_place", F.row_number().over(w))
                .join(highest, "topic", "left")
                .withColumn("version", F.coalesce(
                    F.col("version").cast("int"),
                    (F.coalesce(F.col("_highest"), F.lit(0)) + F.col("_place")).cast("int")))
                .drop("_place", "_highest", "_order")).checkpoint()
    clash_old = numbered.join(catalog.select("topic", F.col("version").cast("int").alias("version")), ["topic", "version"], "left_semi")
    clash_new = numbered.groupBy("topic", "version").count().where(F.col("count") > 1)
    if not clash_old.isEmpty() or not clash_new.isEmpty():
        raise DuplicateVersionError("version already exists for a topic in the batch")
    cols = catalog.columns
    extra = {c: F.lit(None).cast(catalog.schema[c].dataType) for c in cols if c not in numbered.columns}
    if "created_at" in cols and "created_at" not in numbered.columns:
        extra["created_at"] = F.current_timestamp()
    return numbered.withColumns(extra).select(*cols)


def register_versions(catalog: DataFrame, new: DataFrame,
                      order_col: str | None = None) -> DataFrame:
    """``catalog`` with ``new`` appended (see ``number_versions``).

    The result is a new table and knows of no other writer; ``registry.SchemaRegistry``
    is the form for several writers of one catalog.
    """
    return catalog.unionByName(number_versions(catalog, new, order_col))


def register_schema(catalog: DataFrame, topic: str, definition: dict | str,
                    version: int | None = None) -> DataFrame:
    """Register one definition (a dict in the registry format, or its JSON)
    for ``topic``: the next version when ``version`` is None; an existing
    version raises ``DuplicateVersionError``."""
    import json

    text = definition if isinstance(definition, str) else json.dumps(definition, sort_keys=True)
    new = catalog.sparkSession.createDataFrame(
        [(topic, version, text)], "topic string, version int, definition string")
    return register_versions(catalog, new)


def version_pairs(versions: DataFrame, strict_adjacent: bool = False) -> DataFrame:
    """Each version with its predecessor per topic (previous existing version;
    with ``strict_adjacent`` only ``version - 1`` counts)."""
    v = versions.select("topic", F.col("version").cast("int").alias("version")).distinct()
    w = Window.partitionBy("topic").orderBy("version")
    pairs = v.select("topic", F.lag("version").over(w).alias("old_version"),
                     F.col("version").alias("new_version")).where(F.col("old_version").isNotNull())
    if strict_adjacent:
        pairs = pairs.where(F.col("old_version") == F.col("new_version") - 1)
    return pairs


def breaking_changes(fields: DataFrame, versions: DataFrame | None = None,
                     include_added: bool = False, strict_adjacent: bool = False,
                     void: str = "last") -> DataFrame:
    """Removed fields and type changes between consecutive versions.

    Rows ``(topic, old_version, new_version, change, field_path, old_type,
    new_type)``, ``change`` in ``removed``, ``type_changed`` (and ``added``
    with ``include_added``). Versions come from ``versions`` (the catalog) when
    given, so a version without fields still counts. An empty old schema gives
    no changes; an empty new one gives every old field as removed. Types are
    compared by name, NULL-safe. ``VOID`` means that only NULLs were seen: with
    ``void='last'`` it is no change by itself, and a later type is compared with
    the field's last other type; ``'plain'`` compares it like any type.
    """
    if void not in ("last", "plain"):
        raise ValueError(f"void must be 'last' or 'plain', got {void!r}")
    checkpoint_root(fields.sparkSession)
    listed = versions if versions is not None else fields
    f = fields.select("topic", F.col("version").cast("int").alias("version"), "field_path", "field_type")
    place = F.row_number().over(Window.partitionBy("topic").orderBy("version"))
    places = listed.select("topic", F.col("version").cast("int").alias("version")).distinct().withColumn("_place", place)
    f = f.join(places, ["topic", "version"], "left")
    # a field's versions without a gap; within them its last type other than VOID
    along = Window.partitionBy("topic", "field_path").orderBy("version")
    f = f.withColumn("_run", F.col("_place") - F.row_number().over(along))
    is_void = F.upper("field_type").eqNullSafe("VOID")
    known = F.last(F.when(~is_void, F.col("field_type")), ignorenulls=True).over(
        Window.partitionBy("topic", "field_path", "_run").orderBy("version"))
    f = f.withColumn("last_type", F.coalesce(known, "field_type") if void == "last" else F.col("field_type"))
    f = f.drop("_place", "_run").checkpoint()  # small; joined three times below
    old_nonempty = f.select("topic", F.col("version").alias("old_version")).distinct()
    pairs = (version_pairs(listed, strict_adjacent)
             .join(old_nonempty, ["topic", "old_version"], "left_semi")
             .checkpoint())  # small; joined twice below
    old = pairs.join(f.select("topic", F.col("version").alias("old_version"), "field_path",
                              F.col("last_type").alias("old_type"), F.lit(True).alias("_in_old")),
                     ["topic", "old_version"])
    new = pairs.join(f.select("topic", F.col("version").alias("new_version"), "field_path",
                              F.col("field_type").alias("new_type"), F.lit(True).alias("_in_new")),
                     ["topic", "new_version"])
    keys = ["topic", "old_version", "new_version", "field_path"]
    both = old.join(new, keys, "full_outer")
    silent = F.lit(False)
    if void == "last":  # nothing is known of the new or of all old types
        silent = F.upper("new_type").eqNullSafe("VOID") | F.upper("old_type").eqNullSafe("VOID")
    change = (F.when(F.col("_in_new").isNull(), F.lit("removed"))
              .when(F.col("_in_old").isNull(), F.lit("added"))
              .when(~F.col("old_type").eqNullSafe(F.col("new_type")) & ~silent, F.lit("type_changed")))
    out = (both.withColumn("change", change).where(F.col("change").isNotNull())
           .select("topic", "old_version", "new_version", "change", "field_path", "old_type", "new_type"))
    if not include_added:
        out = out.where(F.col("change") != "added")
    return out
