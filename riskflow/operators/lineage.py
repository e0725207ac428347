"""Data lineage as table jobs over an edge log.

An edge log has rows ``(source_id, target_id, transformation_type, details,
ts, seq)``; recording the same source -> target again supersedes the earlier
row (latest by ``(ts, seq)``).

Closure runs for many start nodes at once, on the edges' ends alone: what an
edge carries is read in a second pass over the log, for the edges of reached
nodes only. It begins as a breadth-first walk: each round joins the frontier with
the ends (a frontier of few rows is broadcast, so that nothing else is
shuffled), removes what each start node has already reached and stops when the
frontier is empty. Real graphs mostly end there.

Where the frontier is still not empty after a few rounds the graph is deep. Then
it is contracted first, while it has many edges: each round drops nodes of which
no two are neighbours and whose edges in and out can be replaced by no more
edges from each node before to each node after, as long as the way through. On
chains and trees a round drops a share of all nodes, so all rounds together handle
a few times the edges. What is left, the core, is walked by path doubling: a
table of jumps of 1, 2, 4, ... edges is joined with itself to the next power, and
every power takes the nodes reached so far that much further, so rounds grow with
the logarithm of the depth. Jumps of nodes with very many are thinned by a hash, so
that a table of jumps has a bounded number of rows for each node. A last phase
follows single edges from every row that it improves until none is left: it
finds nothing where jumps were complete, and makes the result exact where they
were thinned. Dropped nodes come back round by round, each as far as the nearest of
the nodes before it. A cycle needs no special case: no shortest path is longer
than the number of nodes, where doubling ends. (Cycles are not condensed to one
node, because depths are distances inside of them as well.)

Every round is written to a folder of its own under ``spark.checkpoint.dir`` and
read back, so the plan does not grow with the rounds, a lost executor recomputes one
round at most, and the planner knows each table's size.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskflow.session import scratch_path

EDGE_COLUMNS = ("source_id", "target_id", "transformation_type", "details", "ts")


def record_edges(edge_log: DataFrame, new_edges: DataFrame) -> DataFrame:
    """Append transformation records to an edge log.

    ``new_edges`` has ``source_id, target_id, transformation_type`` and
    optionally ``details`` (any column, stored as JSON text), ``ts`` (default:
    now) and ``seq`` (default: a per-record id, for ties within one ``ts``).
    """
    cols = {}
    if "details" in new_edges.columns:
        d = new_edges.schema["details"].dataType.simpleString()
        cols["details"] = F.col("details") if d == "string" else F.to_json(F.col("details"))
    else:
        cols["details"] = F.lit(None).cast("string")
    if "ts" not in new_edges.columns:
        cols["ts"] = F.localtimestamp()
    if "seq" not in new_edges.columns:
        cols["seq"] = F.monotonically_increasing_id()
    rows = new_edges.withColumns(cols).select(*edge_log.columns)
    return edge_log.unionByName(rows)


def latest_edges(edge_log: DataFrame) -> DataFrame:
    """One row per (source_id, target_id): the latest record by (ts, seq).

    ``max_by`` is partial-aggregated on the map side, so a pair recorded
    millions of times still ships one row per map task.
    """
    order = F.struct(F.col("ts"), F.col("seq")) if "seq" in edge_log.columns else F.col("ts")
    payload = F.struct(*[F.col(c) for c in ("transformation_type", "details", "ts")])
    return (edge_log.groupBy("source_id", "target_id")
            .agg(F.max_by(payload, order).alias("e"))
            .select("source_id", "target_id", "e.*"))


#: Rows of a table of jumps that need no thinning, and the jumps that a node then keeps at least.
JUMP_ROWS, LEAST_JUMPS = 4_000_000, 8
#: Rounds of the plain walk before doubling: few while complete tables of jumps are cheap.
PLAIN_ROUNDS, PLAIN_ROUNDS_LARGE = 4, 32
#: Edges of a deep graph that are doubled without contraction.
CORE_ROWS = 20_000
#: Rows of a frontier, of dropped nodes or of reached nodes that are broadcast.
BROADCAST_ROWS = 250_000


def _kept(rows: DataFrame) -> DataFrame:
    """``rows`` written once under the shared checkpoint folder and read back."""
    path = scratch_path(rows.sparkSession, "lineage")
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def _sized(rows: DataFrame, n: int) -> DataFrame:
    return F.broadcast(rows) if n <= BROADCAST_ROWS else rows


def _least(reach: DataFrame, *keys: str) -> DataFrame:
    keys = keys or ("root", "node")
    (value,) = set(reach.columns) - set(keys)
    return reach.groupBy(*keys).agg(F.min(value).alias(value))


def _union(tables: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, tables)


def _thinned(jumps: DataFrame, rows: int, nodes: int) -> DataFrame:
    """About ``JUMP_ROWS`` jumps, at least ``LEAST_JUMPS`` a node, kept by a hash of both ends."""
    if rows <= JUMP_ROWS:
        return jumps
    most = max(LEAST_JUMPS, JUMP_ROWS // nodes)
    degree = jumps.groupBy("node").agg(F.count("*").alias("n"))
    chance = F.shiftrightunsigned(F.xxhash64("node", "next"), 11) / float(1 << 53)
    return _kept(jumps.join(degree, "node").where(chance * F.col("n") < most).select("node", "next", "length"))


def _further(reach: DataFrame, jumps: DataFrame) -> DataFrame:
    return reach.join(jumps, "node").select("root", F.col("next").alias("node"), (F.col("depth") + F.col("length")).alias("depth"))


def _improved(rows: DataFrame, reach: DataFrame, hops: DataFrame) -> DataFrame:
    """What one edge more from ``rows`` adds to ``reach``: new nodes and lesser depths."""
    known = reach.withColumnRenamed("depth", "known")
    step = _least(_further(rows, hops)).join(known, ["root", "node"], "left")
    return _kept(step.where("known IS NULL OR depth < known").drop("known"))


def _doubled(reach: DataFrame, hops: DataFrame, rows: int, on_round) -> DataFrame:
    """``reach`` (root, node, depth) taken along jumps of 1, 2, 4, ... edges, until an edge more adds nothing."""
    nodes = hops.select("node").distinct().count()
    jumps, edges = hops, 1
    while rows:
        on_round()
        jumps = _thinned(jumps, rows, nodes)
        reach = _kept(_least(reach.unionByName(_further(reach, jumps))))
        edges *= 2
        if edges >= nodes or _improved(reach, reach, hops).isEmpty():
            break
        second = jumps.select(F.col("node").alias("next"), F.col("next").alias("end"), F.col("length").alias("more"))
        jumps = jumps.join(second, "next").select("node", F.col("end").alias("next"), (F.col("length") + F.col("more")).alias("length"))
        jumps = _kept(_least(jumps.where("node <> next"), "node", "next"))
        rows = jumps.count()
    return reach


def _relaxed(reach: DataFrame, hops: DataFrame, on_round) -> DataFrame:
    """``reach`` followed along single edges until no depth falls and no node is new."""
    frontier = reach
    while True:
        on_round()
        frontier = _improved(frontier, reach, hops)
        if frontier.isEmpty():
            return reach
        reach = _kept(_least(reach.unionByName(frontier)))


def _droppable(hops: DataFrame, roots: DataFrame, seed: int) -> DataFrame:
    """``(node)``: no root, first by a hash among its neighbours, and with no more ways through it than edges."""
    node, after = (F.xxhash64(F.lit(seed), c) for c in ("node", "next"))
    ends = (hops.select("node", F.lit(1).alias("n_out"), F.lit(0).alias("n_in"), (node > after).alias("first"))
            .unionByName(hops.select(F.col("next").alias("node"), F.lit(0).alias("n_out"), F.lit(1).alias("n_in"), (after > node).alias("first"))))
    degree = ends.groupBy("node").agg(F.sum("n_out").alias("n_out"), F.sum("n_in").alias("n_in"), F.min("first").alias("first"))
    return degree.where("first AND n_out * n_in <= n_out + n_in").select("node").join(roots.select("node"), "node", "left_anti")


def _contracted(hops: DataFrame, rows: int, roots: DataFrame, on_round) -> tuple[DataFrame, int, list[DataFrame]]:
    """The core of ``hops``, its rows, and the edges into the nodes that each round dropped."""
    dropped_edges = []
    while rows > CORE_ROWS:
        on_round()
        dropped = _kept(_droppable(hops, roots, len(dropped_edges)))
        n = dropped.count()
        if n * 20 < rows:  # dense: hardly a node can go without more edges than before
            break
        dropped = _sized(dropped.withColumn("gone", F.lit(True)), n)
        marked = _kept(hops.join(dropped.withColumnRenamed("gone", "from_gone"), "node", "left")
                       .join(dropped.select(F.col("node").alias("next"), F.col("gone").alias("to_gone")), "next", "left"))
        into, onward = marked.where("to_gone").select("node", "next", "length"), marked.where("from_gone")
        through = into.join(onward.select(F.col("node").alias("next"), F.col("next").alias("end"), F.col("length").alias("more")), "next")
        through = through.select("node", F.col("end").alias("next"), (F.col("length") + F.col("more")).alias("length")).where("node <> next")
        rest = marked.where("from_gone IS NULL AND to_gone IS NULL").select("node", "next", "length")
        hops = _kept(_least(rest.unionByName(through), "node", "next"))
        rows = hops.count()
        dropped_edges.append(into)
    return hops, rows, dropped_edges


def _hash_seed(names: DataFrame) -> int:
    """The first seed of the hash that makes ids under which no two of the names have the same id."""
    seed = 0
    while not names.groupBy(F.xxhash64(F.lit(seed), "name").alias("id")).count().where("count > 1").isEmpty():
        seed += 1
    return seed


def _deep_closure(ends: DataFrame, roots: DataFrame, on_round) -> DataFrame:
    """``(root, node, depth)`` by contraction, doubling in the core, and dropped nodes put back."""
    names = _kept(ends.where("node IS NOT NULL").select(F.col("node").alias("name")).distinct())  # no dead ends
    seed = _hash_seed(names)

    def number(column):
        return F.xxhash64(F.lit(seed), column)

    onward = ends.where("node <> next").join(names.withColumnRenamed("name", "next"), "next", "left_semi")
    hops = _kept(onward.select(number("node").alias("node"), number("next").alias("next"), F.lit(1).alias("length")))
    n_roots = roots.count()
    start = names.join(_sized(roots.withColumnRenamed("root", "name"), n_roots), "name")
    start = _kept(start.select(number("name").alias("node"), F.col("name").alias("root")))
    core, rows, dropped_edges = _contracted(hops, hops.count(), start, on_round)
    reach = start.select(F.col("node").alias("root"), "node", F.lit(0).alias("depth"))
    parts = [_relaxed(_doubled(reach, core, rows, on_round), core, on_round)]
    for into in reversed(dropped_edges):
        on_round()
        parts.append(_kept(_least(_further(_union(parts), into))))
    reach = _union(parts).where("root <> node").withColumnRenamed("root", "root_id")
    reach = reach.join(_sized(start.select(F.col("node").alias("root_id"), "root"), n_roots), "root_id")
    reach = reach.join(names.select(number("name").alias("node"), "name"), "node").select("root", F.col("name").alias("node"), "depth")
    return _kept(reach.unionByName(roots.select("root", F.col("root").alias("node"), F.lit(0).alias("depth"))))


def _closure(edges: DataFrame, roots: DataFrame, upstream: bool, on_round=lambda: None) -> DataFrame:
    """``(root, node, depth)`` for every node reachable from each root that can
    lead further (has an edge onward), plus the roots themselves; ``depth`` is
    the shortest distance. ``on_round`` is called once a round.

    Nodes with no edge onward (e.g. pure sources upstream) add no output row of
    their own (their edges into reached nodes are still listed) and would
    otherwise dominate the visited set.
    """
    near, far = ("target_id", "source_id") if upstream else ("source_id", "target_id")
    ends = _kept(edges.select(F.col(near).alias("node"), F.col(far).alias("next")).distinct())  # read every round
    plain = PLAIN_ROUNDS if ends.count() <= JUMP_ROWS else PLAIN_ROUNDS_LARGE
    roots = _kept(roots.select("root").distinct())
    frontier = roots.select("root", F.col("root").alias("node"))
    parts = [frontier.withColumn("depth", F.lit(0))]
    for depth in range(plain + 1):
        matched = _kept(_sized(frontier, frontier.count()).join(ends, "node").select("root", "node", "next"))
        if depth:
            parts.append(_kept(matched.select("root", "node").distinct().withColumn("depth", F.lit(depth))))
        if depth == plain:
            return _union(parts) if matched.isEmpty() else _deep_closure(ends, roots, on_round)
        on_round()
        step = matched.where("node <> next").select("root", F.col("next").alias("node")).distinct()
        frontier = _kept(step.join(_union(parts), ["root", "node"], "left_anti"))
        if frontier.isEmpty():
            return _union(parts)


def _lineage(edges: DataFrame, targets: DataFrame, upstream: bool) -> DataFrame:
    roots = targets.select(F.col(targets.columns[0]).alias("root"))
    reach = _closure(edges, roots, upstream)
    key = "target_id" if upstream else "source_id"
    if reach.count() <= BROADCAST_ROWS:
        # a condition, since it goes below the log's aggregation by its ends: only edges of reached nodes are shuffled
        edges = edges.where(F.col(key).isin(F.broadcast(reach.select("node").distinct())))
    return (reach.join(edges, reach["node"] == edges[key])
            .select(F.col("root").alias("target" if upstream else "origin"),
                    "source_id", "target_id", "depth",
                    "transformation_type", "details", "ts"))


def upstream_lineage(edges: DataFrame, targets: DataFrame) -> DataFrame:
    """Every edge into a node upstream of each target (the target included).

    Rows ``(target, source_id, target_id, depth, transformation_type,
    details, ts)`` where ``depth`` is the distance of ``target_id`` from the
    target. An unknown target gives no rows; a self edge is listed once and
    not followed.
    """
    return _lineage(edges, targets, upstream=True)


def downstream_lineage(edges: DataFrame, origins: DataFrame) -> DataFrame:
    """Impact analysis: every edge out of a node downstream of each origin.

    Rows ``(origin, source_id, target_id, depth, ...)`` where ``depth`` is the
    distance of ``source_id`` from the origin.
    """
    return _lineage(edges, origins, upstream=False)


def track_transformation(edge_log: DataFrame, source_id: str, target_id: str,
                         transformation_type: str, details: dict | None = None) -> DataFrame:
    """Record one transformation (now) in the edge log; same pair again
    supersedes the earlier record on read (``latest_edges``)."""
    import json

    new = edge_log.sparkSession.createDataFrame(
        [(source_id, target_id, transformation_type, json.dumps(details or {}))],
        "source_id string, target_id string, transformation_type string, details string")
    return record_edges(edge_log, new)


def get_upstream_lineage(edges: DataFrame, target_id: str) -> DataFrame:
    """Upstream lineage rows of one target (``upstream_lineage`` for one node)."""
    targets = edges.sparkSession.createDataFrame([(target_id,)], "node string")
    return upstream_lineage(edges, targets)
