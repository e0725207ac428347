"""Lake files with statistics, clustered along a space-filling curve.

A streaming sink leaves many small files in arrival order. Here the table's files are
listed by a manifest (rows: file, row count, least and greatest value of each clustered
column), itself a parquet folder that a commit names (``sinks.commits``). ``append``
adds files; ``compact`` rewrites the small ones in the order of a Z curve over the
clustered columns, so that each new file covers a small box of them, and commits a
manifest in which the new files stand in place of the old. A reader opens one
manifest: it sees the old files or the new ones, never both, and only
those whose box meets the ranges that it asks for. Old files stay for readers under
way until ``vacuum``. A writer that loses a race starts from the newer manifest; a
compaction whose files another one has replaced gives up.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskflow.sinks.commits import CommitConflictError, CommitLog

CURVE_BITS = 8  # of each column's place on the curve: its 256 quantiles
TARGET_ROWS = 1_000_000  # of a compacted file


def _number(column: str, kind: str):
    """A double that does not fall as the column rises."""
    if kind == "string":  # the first six bytes
        return F.conv(F.rpad(F.hex(F.substring(F.col(column).cast("binary"), 1, 6)), 12, "0"), 16, 10).cast("double")
    if kind.startswith("timestamp"):
        return F.unix_micros(F.col(column).cast("timestamp")).cast("double")
    return F.col(column).cast("double")


def curve(rows: DataFrame, columns: list[str]):
    """The place of a row on a Z curve through the quantiles of ``columns``; nulls lie first.

    One pass estimates the quantiles.
    """
    kinds = dict(rows.dtypes)
    share = [i / (1 << CURVE_BITS) for i in range(1, 1 << CURVE_BITS)]
    cuts = rows.agg(*[F.percentile_approx(_number(c, kinds[c]), share, 10_000).alias(c) for c in columns]).first()

    def place(c):
        ends, x = F.array(*[F.lit(x) for x in sorted(set(cuts[c] or []))]), _number(c, kinds[c])
        return F.when(x.isNull(), 0).otherwise(F.size(F.filter(ends, lambda e: e < x)))

    places = [place(c) for c in columns]
    z = F.lit(0).cast("long")
    for bit in range(CURVE_BITS):
        for i, p in enumerate(places):
            z = z + F.shiftleft(F.shiftright(p, bit).bitwiseAND(1).cast("long"), bit * len(columns) + i)
    return z


class ClusteredLake:
    """A table of parquet files at ``path``, clustered by ``columns`` (numbers, times or strings)."""

    def __init__(self, spark: SparkSession, path: str, columns: list[str]):
        self.spark, self.path, self.columns, self.log = spark, path, columns, CommitLog(spark, f"{path}/_commits")

    def _latest(self) -> tuple[int, str | None]:
        number, text = self.log.latest()
        return (-1, None) if number is None else (number, json.loads(text)["manifest"])

    def _manifest(self, name: str | None) -> DataFrame | None:
        return None if name is None else self.spark.read.parquet(f"{self.path}/{name}")

    def manifest(self) -> DataFrame:
        """``(file, rows, least, greatest)`` of the files as of the newest commit; the bounds are structs of the clustered columns."""
        return self._manifest(self._latest()[1])

    def _write(self, rows: DataFrame) -> DataFrame:
        """Write ``rows`` as they are dealt; the new files' manifest rows."""
        folder = f"{self.path}/data/{uuid.uuid4().hex}"
        rows.write.parquet(folder)
        written = self.spark.read.schema(rows.schema).parquet(folder)
        bound = lambda f: F.struct(*[f(F.col(c)).alias(c) for c in self.columns])
        # parquet's own footers would do; one scan of the new files is the same work on any store
        return written.select(*self.columns, F.col("_metadata.file_path").alias("file")).groupBy("file").agg(
            F.count("*").alias("rows"), bound(F.min).alias("least"), bound(F.max).alias("greatest"))

    def _commit(self, number: int, files: DataFrame) -> None:
        name = f"manifests/{uuid.uuid4().hex}"
        files.write.parquet(f"{self.path}/{name}")
        try:
            self.log.commit(number, json.dumps({"manifest": name}))
        except CommitConflictError:
            self.log.fs.delete(self.log.path(f"{self.path}/{name}"), True)
            raise

    def append(self, rows: DataFrame) -> None:
        new = self._write(rows).checkpoint()
        while True:
            number, name = self._latest()
            try:
                return self._commit(number + 1, new if name is None else self._manifest(name).unionByName(new))
            except CommitConflictError:
                continue

    def compact(self, target_rows: int = TARGET_ROWS) -> int:
        """Rewrite the files of less than half of ``target_rows``, clustered; the number of files replaced (0: nothing to do, or another compaction was first)."""
        number, name = self._latest()
        if name is None:
            return 0
        small = self._manifest(name).where(F.col("rows") * 2 < target_rows).select("file", "rows").checkpoint()
        n, total = small.agg(F.count("*"), F.sum("rows")).first()
        files = max(1, -(-int(total or 0) // target_rows))
        if n <= files:
            return 0
        old = self.spark.read.parquet(*[r["file"] for r in small.select("file").collect()])  # names only
        rows = old.withColumn("_curve", curve(old, self.columns))
        rows = rows.repartitionByRange(files, "_curve").sortWithinPartitions("_curve").drop("_curve")
        new = self._write(rows).checkpoint()
        while True:
            now = self._manifest(name)
            if now.join(small, "file", "left_semi").count() < n:
                return 0
            try:
                self._commit(number + 1, now.join(small.select("file"), "file", "left_anti").select(*new.columns).unionByName(new))
                return n
            except CommitConflictError:
                number, name = self._latest()

    def files_for(self, **ranges) -> DataFrame:
        """Manifest rows of the files that may hold rows with each named column within its (low, high), ends included."""
        files = self.manifest()
        for c, (low, high) in ranges.items():
            files = files.where((F.col(f"least.{c}") <= F.lit(high)) & (F.col(f"greatest.{c}") >= F.lit(low)))
        return files

    def read(self, **ranges) -> DataFrame:
        """The rows with each named clustered column within its (low, high), from the files that may hold some."""
        names = [r["file"] for r in self.files_for(**ranges).select("file").collect()]  # names only
        if not names:
            first = self.manifest().select("file").first()
            return self.spark.read.parquet(first["file"]).limit(0)
        rows = self.spark.read.parquet(*names)
        for c, (low, high) in ranges.items():
            rows = rows.where(F.col(c).between(F.lit(low), F.lit(high)))
        return rows

    def vacuum(self, keep: int = 2) -> int:
        """Delete data folders of which no file is named by the newest ``keep`` manifests; returns their number."""
        numbers = self.log.numbers()[-keep:]
        used = set()
        for n in numbers:
            folder = F.regexp_extract("file", r"/data/([0-9a-f]{32})/", 1).alias("folder")
            used |= {r["folder"] for r in self._manifest(json.loads(self.log.read(n))["manifest"]).select(folder).distinct().collect()}
        gone = [f.getPath() for f in self.log.fs.listStatus(self.log.path(f"{self.path}/data")) if f.getPath().getName() not in used]
        for path in gone:
            self.log.fs.delete(path, True)
        return len(gone)
