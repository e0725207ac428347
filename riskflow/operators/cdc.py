"""Change-data-capture fold: a change log -> the table's current rows.

A change log has rows ``(key, op, ts, seq, after)`` with ``op`` in ``c``
(create), ``u`` (update), ``d`` (delete) and ``after`` the row image (NULL for
deletes). The current state keeps the last change per key by ``seq``, the log's
own order (a connector's offset; clocks may step back), and drops keys whose
last change is a delete.

Batch: one ``max_by`` aggregation per key, partial-aggregated on the map side,
so a key changed a billion times ships one row per map task.
Stream: the snapshot is a table that is merged when it is read. A micro-batch
writes its own last change per key as one delta, so a batch of k keys writes O(k)
bytes however large the table is. Keys are dealt to buckets by ranges of a 63-bit hash;
deltas are sorted by it, so a bucket's rows lie together. Work in the
background of a batch stays proportional to the changes as well:

- a bucket whose deltas have grown to a share of its rows is folded into a new
  base version of that bucket;
- buckets split one after another as the table grows (linear hashing on the
  hash's leading bits), so a bucket keeps its size;
- deltas are merged in tiers of ``FAN``, without the rows that bases already hold,
  so a reader meets few of them.

Tombstones stay, so a late older change cannot resurrect a deleted row, and a fold
is idempotent, so a row that both a base and a delta hold does no harm. The table's
state (buckets, base versions, deltas) is one commit file per batch, made when all its
files are there (``sinks.commits``): readers see whole batches, a replayed
batch finds its commit or writes the same files again, and a second writer is
refused. ``vacuum_snapshot`` deletes files that the newest commits do not name.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from riskflow.sinks.commits import CommitLog

ROWS_PER_BUCKET = 1_000_000
LEAST_PENDING, PENDING_SHARE = 10_000, 0.25  # delta rows of a bucket before it is folded: so many, and such a share of its rows
FAN = 8  # deltas of a tier before they are merged
HASH_BITS = 63


def fold_latest(changes: DataFrame, key: str = "key") -> DataFrame:
    """Last change per key, tombstones included (``op = 'd'``)."""
    cols = [c for c in changes.columns if c != key]
    last = F.max_by(F.struct(*[F.col(c) for c in cols]), F.col("seq"))
    return changes.groupBy(key).agg(last.alias("_last")).select(key, "_last.*")


def current_state(changes: DataFrame, key: str = "key", flatten_after: bool = True) -> DataFrame:
    """Live rows: the last change per key, unless it is a delete."""
    live = fold_latest(changes, key).where(F.col("op") != "d")
    if flatten_after and "after" in live.columns:
        live = live.select(*[c for c in live.columns if c != "after"], "after.*")
    return live


class Snapshot:
    """The state of a snapshot table after a batch, and the folders that hold it.

    Buckets are ranges of the hash: with ``2^bits + split`` buckets the first
    ``split`` prefixes of ``bits`` bits are cut in two. ``buckets`` maps
    (bits, prefix) to [base version or None, base rows, delta rows since]; ``deltas``
    lists [folder, tier, rows].
    """

    def __init__(self, path: str, text: str | None = None):
        state = json.loads(text) if text else {"batch": -1, "bits": 0, "split": 0, "buckets": [[0, 0, None, 0, 0]], "deltas": []}
        self.path, self.batch, self.bits, self.split = path, state["batch"], state["bits"], state["split"]
        self.buckets = {(b, p): rest for b, p, *rest in state["buckets"]}
        self.deltas = state["deltas"]

    def text(self) -> str:
        return json.dumps({"batch": self.batch, "bits": self.bits, "split": self.split,
                           "buckets": [[*k, *v] for k, v in sorted(self.buckets.items())], "deltas": self.deltas})

    def bucket_of(self):
        """(bits, prefix) of the hash column ``h``."""
        prefix = F.shiftrightunsigned("h", HASH_BITS - self.bits)
        cut = prefix < self.split
        return F.struct(F.when(cut, self.bits + 1).otherwise(self.bits).alias("bits"),
                        F.when(cut, F.shiftrightunsigned("h", HASH_BITS - 1 - self.bits)).otherwise(prefix).alias("prefix"))

    def base_dirs(self, of=None) -> list[str]:
        return [f"{self.path}/base/version={v}/bits={b}/prefix={p}" for (b, p), (v, _, _) in sorted(self.buckets.items())
                if v is not None and (of is None or (b, p) in of)]

    def delta_dirs(self) -> list[str]:
        return [f"{self.path}/delta/{d}" for d, _, _ in self.deltas]

    def grown(self, rows_per_bucket: int) -> list[tuple[int, int]]:
        """Split on to the number of buckets that the rows need; the buckets that are cut."""
        rows = sum(n + pending for _, n, pending in self.buckets.values())
        need = max(1, -(-rows // rows_per_bucket))
        bits = need.bit_length() - 1
        if (bits, need - (1 << bits)) <= (self.bits, self.split):
            return []
        self.bits, self.split = bits, need - (1 << bits)
        return [(b, p) for b, p in self.buckets if b < bits or b == bits and p < self.split]


    def parts_of(self, bits: int, prefix: int) -> list[tuple[int, int]]:
        """The buckets of the present layout that make up a bucket of it or of an earlier one."""
        if bits > self.bits:
            return [(bits, prefix)]
        whole = range(prefix << (self.bits - bits), (prefix + 1) << (self.bits - bits))
        return [k for p in whole for k in ([(self.bits + 1, 2 * p), (self.bits + 1, 2 * p + 1)] if p < self.split else [(self.bits, p)])]


def read_state(spark, snapshot_path: str) -> Snapshot:
    return Snapshot(snapshot_path, CommitLog(spark, f"{snapshot_path}/_commits").latest()[1])


def _hashed(rows: DataFrame, key: str) -> DataFrame:
    return rows.withColumn("h", F.shiftrightunsigned(F.xxhash64(key), 1))


def _apply_batch(batch_df: DataFrame, batch_id: int, path: str, key: str, rows_per_bucket: int) -> None:
    spark = batch_df.sparkSession
    log = CommitLog(spark, f"{path}/_commits")
    state = Snapshot(path, log.latest()[1])
    if state.batch >= batch_id:  # replayed after its commit
        return
    columns = batch_df.columns
    folder = f"batch-{batch_id}"
    delta = _hashed(fold_latest(batch_df.select(*columns), key), key).withColumn("batch", F.lit(batch_id).cast("long"))
    delta.sortWithinPartitions("h").write.mode("overwrite").parquet(f"{path}/delta/{folder}")
    delta = spark.read.schema(delta.schema).parquet(f"{path}/delta/{folder}")
    touched = delta.groupBy(state.bucket_of().alias("of")).count().collect()  # at most one row a bucket
    if not touched:
        return
    for r in touched:
        state.buckets[r["of"]["bits"], r["of"]["prefix"]][2] += r["count"]
    state.deltas.append([folder, 0, sum(r["count"] for r in touched)])

    old_bucket = state.bucket_of()
    fold = {k for k, (_, rows, pending) in state.buckets.items() if pending > max(LEAST_PENDING, PENDING_SHARE * rows)}
    fold |= set(state.grown(rows_per_bucket))
    if fold:
        rows = spark.read.schema(delta.schema).parquet(*state.delta_dirs())
        keys = spark.createDataFrame(sorted(fold), "bits int, prefix long").select(F.struct("bits", "prefix").alias("of"))
        rows = rows.withColumn("of", old_bucket).join(keys, "of", "left_semi").drop("of", "batch")
        old = state.base_dirs(fold)
        if old:
            rows = rows.unionByName(spark.read.schema(rows.schema).parquet(*old))
        rows = _hashed(fold_latest(rows.drop("h"), key), key).withColumn("of", state.bucket_of()).select("*", "of.*").drop("of")
        base = f"{path}/base/version={batch_id}"
        (rows.repartition("bits", "prefix").sortWithinPartitions("bits", "prefix", "h")
         .write.mode("overwrite").partitionBy("bits", "prefix").parquet(base))
        for k in fold:
            del state.buckets[k]
            state.buckets |= {part: [None, 0, 0] for part in state.parts_of(*k)}
        for r in spark.read.parquet(base).groupBy("bits", "prefix").count().collect():  # at most one row a bucket
            state.buckets[r["bits"], r["prefix"]] = [batch_id, r["count"], 0]

    for tier in sorted({t for _, t, _ in state.deltas}):
        some = [d for d in state.deltas if d[1] == tier]
        if len(some) >= FAN:
            merged = f"merged-{tier + 1}-{batch_id}"
            rows = spark.read.schema(delta.schema).parquet(*(f"{path}/delta/{d}" for d, _, _ in some))
            versions = [(b, p, -1 if v is None else v) for (b, p), (v, _, _) in sorted(state.buckets.items())]
            versions = spark.createDataFrame(versions, "bits int, prefix long, version long").select(
                F.struct("bits", "prefix").alias("of"), "version")
            rows = rows.withColumn("of", state.bucket_of()).join(versions, "of").where("batch > version").drop("of", "version")
            fold_latest(rows, key).select(*delta.columns).sortWithinPartitions("h").write.mode("overwrite").parquet(f"{path}/delta/{merged}")
            n = spark.read.schema(delta.schema).parquet(f"{path}/delta/{merged}").count()
            state.deltas = [d for d in state.deltas if d[1] != tier] + ([[merged, tier + 1, n]] if n else [])
    state.batch = batch_id
    log.commit(batch_id, state.text())


def start_snapshot_stream(changes: DataFrame, snapshot_path: str, checkpoint_path: str,
                          key: str = "key", available_now: bool = False,
                          rows_per_bucket: int = ROWS_PER_BUCKET) -> StreamingQuery:
    """Fold a change-log stream into a snapshot table. The columns ``h``, ``batch``,
    ``bits`` and ``prefix`` are the table's own. A snapshot goes with one checkpoint,
    which numbers its batches: with a fresh one an existing snapshot is refused."""
    log = CommitLog(changes.sparkSession, f"{snapshot_path}/_commits")
    if log.numbers() and not log.fs.exists(log.path(f"{checkpoint_path}/offsets")):
        raise ValueError(f"the snapshot {snapshot_path} was written with another checkpoint than {checkpoint_path}")

    def on_batch(batch_df: DataFrame, batch_id: int) -> None:
        _apply_batch(batch_df, batch_id, snapshot_path, key, rows_per_bucket)

    writer = changes.writeStream.option("checkpointLocation", checkpoint_path).foreachBatch(on_batch)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def read_snapshot(spark, snapshot_path: str, key: str = "key") -> DataFrame:
    """Live rows as of the newest commit: bases and deltas, folded."""
    state = read_state(spark, snapshot_path)
    if not state.deltas and not state.base_dirs():
        raise FileNotFoundError(f"no snapshot at {snapshot_path}")
    rows = spark.read.parquet(*state.base_dirs(), *state.delta_dirs()).drop("h", "batch")
    return current_state(rows, key)


def vacuum_snapshot(spark, snapshot_path: str, keep: int = 2) -> list[str]:
    """Delete base versions and deltas that none of the newest ``keep`` commits names; returns their folders."""
    log = CommitLog(spark, f"{snapshot_path}/_commits")
    states = [Snapshot(snapshot_path, log.read(n)) for n in log.numbers()[-keep:]]
    if not states:
        return []
    named = {d for s in states for d in s.delta_dirs()}
    named |= {f"{snapshot_path}/base/version={v}" for s in states for v, _, _ in s.buckets.values() if v is not None}
    gone = []
    for part in ("base", "delta"):
        folder = log.path(f"{snapshot_path}/{part}")
        if not log.fs.exists(folder):
            continue
        for f in log.fs.listStatus(folder):
            name = f"{snapshot_path}/{part}/{f.getPath().getName()}"
            if name not in named:
                log.fs.delete(f.getPath(), True)
                gone.append(name)
    return sorted(gone)
