"""Connected components of an edge table by alternating large-star and small-star steps.

Kiveris et al., "Connected Components in MapReduce and Beyond" (SoCC 2014).
Every step is a min-aggregation (combined before its shuffle) and a join. Both
join sides are read from written tables, so that a hub's rows are a plain
skewed join that adaptive execution splits, and no node's neighbours meet in
one list.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskflow.llm._tables import parts_for, saved


def _is_forest_of_stars(edges: DataFrame) -> bool:
    """Whether every u has one edge and no v is a u as well."""
    ends = edges.select("u", F.lit(1).alias("n")).unionByName(
        edges.select(F.col("v").alias("u"), F.lit(None).cast("int").alias("n")).distinct())
    return ends.groupBy("u").agg(F.count("n").alias("n"), F.count("*").alias("all")).filter("n > 1 OR (n = 1 AND all > 1)").isEmpty()


def _large_star(edges: DataFrame, parts: int) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = saved(both.groupBy("u").agg(F.min("v").alias("m")), "cc-least", parts)
    least = least.select("u", F.least("u", "m").alias("m"))
    far = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return saved(far.filter("u <> v").distinct(), "cc-large", parts)


def _small_star(edges: DataFrame, parts: int) -> DataFrame:
    # every edge of _large_star has u > v
    least = saved(edges.groupBy("u").agg(F.min("v").alias("m")), "cc-least", parts)
    near = edges.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return saved(near.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "cc-small", parts)


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root): each node that has an edge to another, with the least node of its component.

    Edges with a null end or from a node to itself are ignored; repeated edges
    count once; an empty table gives no rows.
    """
    parts = parts_for(edges.count())
    now = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).filter("u <> v")
    now = saved(now.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "cc-edges", parts)
    while not _is_forest_of_stars(now):
        now = _small_star(_large_star(now, parts), parts)
    # a star forest: u > v = root
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
