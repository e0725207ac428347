"""Vectors that take part in searches and joins, as fixed-width rows of doubles."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskflow.llm._tables import saved


def usable(vectors: DataFrame, id_col: str = "vec_id", column: str = "embedding", every_length: bool = False) -> DataFrame:
    """(rid, vec_id, v): the vectors without null or non-finite components, not zero, of the table's usual length.

    ``rid`` numbers the rows of the written table. The usual length is the most
    frequent one (the smaller of equals); rows of another length (unless
    ``every_length``) and rows with a null id take no part.
    """
    v = F.col(column).cast("array<double>")
    fine = (F.col("vec_id").isNotNull() & F.col("v").isNotNull() & (F.size("v") > 0)
            & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0))
    rows = vectors.select(F.col(id_col).cast("bigint").alias("vec_id"), v.alias("v")).filter(F.coalesce(fine, F.lit(False)))
    rows = saved(rows.withColumn("rid", F.monotonically_increasing_id()), "vectors")
    if every_length:
        return rows.select("rid", "vec_id", "v")
    top = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    return rows.filter(F.size("v") == (top["n"] if top else 0)).select("rid", "vec_id", "v")


def matrix(column) -> np.ndarray:
    """Rows of equal length as a matrix of doubles."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    n = len(column)
    return np.asarray(column.flatten(), np.float64).reshape(n, -1) if n else np.empty((0, 0))


def lists(m: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(np.arange(0, m.size + 1, max(m.shape[1], 1), dtype=np.int32), pa.array(m.reshape(-1)))


def sample(rows: DataFrame, most: int, salt: int) -> np.ndarray:
    """About ``most`` vectors, chosen by a hash of their ids and values (reruns agree)."""
    n = rows.count()
    if not n:
        return np.empty((0, 0))
    got = _drawn(rows, n, most, salt)
    m = matrix(got.column("v"))
    return m[np.lexsort((*m.T[:3][::-1], np.asarray(got.column("vec_id"))))] if len(m) else m


def samples(rows: DataFrame, n: int, most: int, salt: int) -> dict[int, np.ndarray]:
    """About ``most`` of ``n`` vectors of several lengths, by length; a rare length may have none."""
    by: dict[int, list] = {}
    for _, v in sorted(zip(*(_drawn(rows, n, most, salt).column(c).to_pylist() for c in ("vec_id", "v")))):
        by.setdefault(len(v), []).append(v)
    return {size: np.array(vs, np.float64) for size, vs in by.items()}


def _drawn(rows: DataFrame, n: int, most: int, salt: int) -> pa.Table:
    draw = F.shiftrightunsigned(F.xxhash64(F.lit(salt), "vec_id", "v"), 11) / float(1 << 53)
    return rows.filter(draw < most / n).select("vec_id", "v").toArrow()
