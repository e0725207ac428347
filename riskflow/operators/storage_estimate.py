"""Parquet storage estimate: bytes per row of a written sample, scaled to all rows.

One ``count`` of the input and a seeded random sample of at most about
``sample_size_rows`` rows (a bound by parameter, so one task may hold it), which
is written as a single parquet file; a file with the same columns and no rows
gives the fixed cost of a file (header and footer). The estimate is the rest,
scaled to all rows, plus one such fixed cost, so it does not depend on how
many partitions the input happens to have. Sizes are ``binaryFile`` lengths read
by Spark; nothing depends on a driver-local disk.

Dictionaries serve a small sample less well than a large file: in a thousand rows most
values of a column are new, in a million they repeat. So bytes do not grow with the
rows alone, and the scale is the ratio of two modelled sizes. A column's chunk costs
its distinct values once and an index of log2(distinct) bits for each value, or
the plain values where that is less or the dictionary would pass its page limit.
Distinct counts (sketches) and widths come from the sample and from as many rows of the
table as a row group holds, since dictionaries start anew in each. What compression
saves cancels out of the ratio.
"""

from __future__ import annotations

import logging
import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskflow.config import DEFAULT_ESTIMATE_SAMPLE_ROWS
from riskflow.session import scratch_path

log = logging.getLogger(__name__)

RESULT_SCHEMA = "row_count long, sample_rows long, sample_bytes long, estimated_bytes long"


def parquet_data_bytes(spark, path: str) -> int:
    """Sum of the parquet data files' sizes under ``path`` (side files excluded)."""
    files = (spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet")
             .option("recursiveFileLookup", "true").load(path))
    total = files.agg(F.sum("length")).first()[0]
    return int(total or 0)


DICTIONARY_BYTES, GROUP_BYTES = 1 << 20, 128 << 20  # parquet's defaults: a dictionary page, a row group
_FIXED_WIDTHS = {"boolean": 0.125, "tinyint": 4, "smallint": 4, "int": 4, "date": 4, "float": 4}


def _width(column: str, kind: str):
    """Average plain bytes of the column's values, nulls as nothing."""
    c = F.col(f"`{column}`")
    if kind in ("string", "binary"):
        size = F.octet_length(c) + 4
    elif kind.startswith(("array", "map", "struct", "variant")):
        size = F.octet_length(F.to_json(F.struct(c)))
    elif kind.startswith("decimal"):
        digits = int(kind[8:].split(",")[0])
        size = F.lit(4 if digits <= 9 else 8 if digits <= 18 else 16)
    else:
        size = F.lit(_FIXED_WIDTHS.get(kind, 8))
    return F.coalesce(F.avg(F.when(c.isNull(), 0).otherwise(size)), F.lit(0.0)).cast("double")


def _column_stats(df: DataFrame) -> list[tuple[int | None, float]]:
    """(distinct values, average width) of each column; None for nested ones, taken as without a dictionary."""
    aggs = []
    for i, (column, kind) in enumerate(df.dtypes):
        nested = kind.startswith(("array", "map", "struct", "variant"))
        distinct = F.lit(None).cast("long") if nested else F.approx_count_distinct(F.col(f"`{column}`"))
        aggs += [F.max(distinct).alias(f"d{i}") if nested else distinct.alias(f"d{i}"), _width(column, kind).alias(f"w{i}")]
    row = df.agg(*aggs).first()
    return [(row[f"d{i}"], row[f"w{i}"]) for i in range(len(df.columns))]


def _modelled_bytes(rows: int, stats: list[tuple[int | None, float]]) -> float:
    """Modelled size of a row group of ``rows`` rows, before compression."""
    total = 0.0
    for distinct, width in stats:
        size = rows * width
        if distinct is not None and distinct * width <= DICTIONARY_BYTES:
            size = min(size, distinct * width + rows * max(1, math.ceil(math.log2(max(distinct, 2)))) / 8)
        total += size
    return total


def _growth(df: DataFrame, sample: DataFrame, rows: int, sample_rows: int, seed: int) -> float:
    """How many times the sample's size the table's is, by the model."""
    few = _column_stats(sample)
    base = _modelled_bytes(sample_rows, few)
    if not base or sample_rows >= rows:
        return rows / sample_rows
    group = min(rows, max(sample_rows, int(GROUP_BYTES // max(1.0, sum(w for _, w in few)))))
    whole = df if group == rows else df.sample(withReplacement=False, fraction=group / rows, seed=seed + 1)
    return _modelled_bytes(group, _column_stats(whole)) / base * rows / group


def estimate_storage(df: DataFrame, sample_size_rows: int = DEFAULT_ESTIMATE_SAMPLE_ROWS,
                     seed: int = 42, method: str = "sample", path: str | None = None,
                     on_error: str = "raise") -> DataFrame:
    """One-row DataFrame ``(row_count, sample_rows, sample_bytes, estimated_bytes)``.

    ``method='limit'`` takes the first rows instead of a random sample.
    ``on_error='minus_one'`` returns ``estimated_bytes = -1`` on failure
    instead of raising. An empty input estimates 0.
    """
    spark = df.sparkSession
    try:
        n = df.count()
        if n == 0:
            return spark.createDataFrame([(0, 0, 0, 0)], RESULT_SCHEMA)
        k = min(sample_size_rows, n)
        if method == "limit":
            sample = df.limit(k)
        elif method == "sample":
            sample = df.sample(withReplacement=False, fraction=min(1.0, k / n), seed=seed)
        else:
            raise ValueError(f"method must be 'sample' or 'limit', got {method!r}")
        out = path or scratch_path(spark, "storage-estimate")
        sample.repartition(1).write.mode("overwrite").parquet(f"{out}/sample")
        sample_rows = spark.read.parquet(f"{out}/sample").count()
        if not sample_rows:  # an unlucky draw from few rows
            df.limit(k).repartition(1).write.mode("overwrite").parquet(f"{out}/sample")
            sample_rows = spark.read.parquet(f"{out}/sample").count()
        spark.createDataFrame([], df.schema).repartition(1).write.mode("overwrite").parquet(f"{out}/empty")
        fixed = parquet_data_bytes(spark, f"{out}/empty")
        sample_bytes = parquet_data_bytes(spark, f"{out}/sample")
        growth = _growth(df, spark.read.schema(df.schema).parquet(f"{out}/sample"), n, sample_rows, seed)
        est = int(max(sample_bytes - fixed, 0) * growth) + fixed
        return spark.createDataFrame([(n, sample_rows, sample_bytes, est)], RESULT_SCHEMA)
    except Exception:
        if on_error != "minus_one":
            raise
        log.exception("storage estimate failed")
        return spark.createDataFrame([(None, None, None, -1)], RESULT_SCHEMA)


def estimate_parquet_storage(df: DataFrame, sample_size_rows: int = DEFAULT_ESTIMATE_SAMPLE_ROWS,
                             **kw) -> int:
    """Estimated parquet bytes as an int; -1 on failure, 0 for an empty input."""
    kw.setdefault("on_error", "minus_one")
    row = estimate_storage(df, sample_size_rows, **kw).first()
    return int(row["estimated_bytes"])
