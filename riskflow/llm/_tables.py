"""Written intermediate tables and small DataFrame helpers of the operators."""

from __future__ import annotations

import contextlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskflow.session import scratch_path


#: Rows and bytes of the Arrow batches that tasks get while a table is written: whole texts can be long.
BATCH = {"spark.sql.execution.arrow.maxRecordsPerBatch": "2000", "spark.sql.execution.arrow.maxBytesPerBatch": "4m"}

_written: list[list[str]] = []  # folders of the open ``passing_tables`` blocks


@contextlib.contextmanager
def passing_tables(spark: SparkSession):
    """Remove the tables that ``saved`` writes within the block when it ends.

    For results that are written in full before the block ends, elsewhere or
    with ``keep=True``.
    """
    _written.append([])
    try:
        yield
    finally:
        for folder in _written.pop():
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


@contextlib.contextmanager
def bounded_batches(spark: SparkSession):
    """Small Arrow batches for the jobs of the block; the session's own settings return after it."""
    old = {k: spark.conf.get(k, None) for k in BATCH}
    for k, v in BATCH.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def saved(df: DataFrame, name: str, parts: int | None = None, keep: bool = False) -> DataFrame:
    """``df`` written under spark.checkpoint.dir and read again.

    Cuts the lineage at files that outlive any executor; several readers then
    share one computation. ``parts`` bounds the number of tasks and files: pass
    ``parts_for(rows)`` for tables of few narrow rows, which hundreds of small
    files would slow down.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    if _written and not keep:
        _written[-1].append(path)
    with bounded_batches(spark):
        (df if parts is None else df.coalesce(parts)).write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def parts_for(rows: int, per_part: int = 20_000, least: int = 6) -> int:
    """Tasks for a table of ``rows`` narrow rows; grows with them."""
    return max(least, -(-int(rows) // per_part))


def buckets(spark: SparkSession, entries: int, per_bucket: int = 1 << 20) -> int:
    """How many buckets hold ``entries`` entries at about ``per_bucket`` each."""
    return max(1, -(-int(entries) // per_bucket), min(16, int(spark.conf.get("spark.sql.shuffle.partitions"))))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def numbered(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """``df`` written with a number for each row, and that column's name, which no other column has."""
    column = "_row"
    while column in df.columns:
        column = "_" + column
    return saved(df.withColumn(column, F.monotonically_increasing_id()), name), column
