"""Enrichment of transactions with the user-profile dimension.

The profile is a static DataFrame (a batch read of parquet/JDBC), joined with
batch or streaming transactions by a left outer equi-join on ``user_id``.

Join strategy:
- broadcast hash join when the profile is proven small: its size in bytes is
  measured (one job on the dimension adds up its rows' lengths, so wide rows
  count) and must be at most ``max_broadcast_bytes``. No shuffle of the
  transactions, no state.
- otherwise a shuffle join in which hot users, and only these, are spread over
  several reducers by a deterministic salt of the transaction id (retry-safe).
  A batch finds them by a sketch of its own user column; a stream by a sketch of
  ``history``, a batch of earlier transactions. ``salt_buckets`` spreads all
  users alike instead.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskflow.config import DEFAULT_PROFILE_CATEGORY
from riskflow.operators.hot_keys import hot_salts, key_sketches, salted_left_join

# Bytes of profile that may be broadcast.
DEFAULT_MAX_BROADCAST_BYTES = 64 << 20


class ProfileNotUniqueError(ValueError):
    """The profile has more than one row for a user: the join would inflate counts."""


def augment_with_profile(tx: DataFrame, profile: DataFrame,
                         default_category: str | None = None,
                         max_broadcast_bytes: int = DEFAULT_MAX_BROADCAST_BYTES,
                         salt_buckets: int = 1,
                         check_unique: bool = True,
                         key: str = "user_id",
                         history: Callable[[], DataFrame] | None = None) -> DataFrame:
    """Left outer join of transactions with ``profile(user_id, risk_category, ...)``.

    Unmatched transactions keep NULL profile columns, or ``default_category``
    in ``risk_category`` when given. ``check_unique`` (one aggregation job on
    the dimension) refuses a profile with a repeated key, which would silently
    duplicate transactions. ``history()`` gives earlier transactions with the key;
    it is read only where a stream meets a profile that is not broadcast.
    """
    # one aggregation job on the dimension gives both its size and whether a
    # key repeats; 16 bytes a value stand for a row's fixed part
    width = F.length(F.to_json(F.struct(*profile.columns))) + 16 * len(profile.columns)
    stats = (profile.groupBy(key).agg(F.count("*").alias("count"), F.sum(width).alias("bytes"))
             .agg(F.sum("bytes").alias("bytes"), F.max("count").alias("max_per_key")).first())
    if check_unique and int(stats["max_per_key"] or 0) > 1:
        raise ProfileNotUniqueError(f"profile has repeated {key!r} values")
    broadcast_profile = int(stats["bytes"] or 0) <= max_broadcast_bytes
    # deterministic (retry-safe) salt: the transaction id, else the whole row
    salt_by = ["transaction_id"] if "transaction_id" in tx.columns else tx.columns
    if broadcast_profile:
        joined = tx.join(F.broadcast(profile), on=key, how="left")
    elif salt_buckets > 1:
        salt = F.pmod(F.xxhash64(*salt_by), F.lit(salt_buckets))
        salted_tx = tx.withColumn("_salt", salt)
        salted_profile = profile.withColumn(
            "_salt", F.explode(F.sequence(F.lit(0), F.lit(salt_buckets - 1)).cast("array<bigint>")))
        joined = salted_tx.join(salted_profile, on=[key, "_salt"], how="left").drop("_salt")
    else:
        seen = tx if not tx.isStreaming else history() if history is not None else None
        partitions = int(tx.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        hot = hot_salts(key_sketches(seen, key), partitions) if seen is not None else None
        joined = salted_left_join(tx, profile, key, hot, salt_by)
    if default_category is not None and "risk_category" in joined.columns:
        joined = joined.withColumn(
            "risk_category", F.coalesce(F.col("risk_category"), F.lit(default_category)))
    return joined


def augment_with_self_profile(tx: DataFrame, category: str = DEFAULT_PROFILE_CATEGORY,
                              key: str = "user_id") -> DataFrame:
    """Profile derived from the transactions themselves: every distinct user of
    the data gets the constant ``category``.

    Joining a frame with the distinct set of its own keys matches every
    non-NULL key exactly once and never a NULL key, so the result equals a
    projection: the category where the key is present, NULL otherwise. This
    form needs no distinct, no shuffle and no join state, and is also legal on
    a stream (where the self-join is not).
    """
    return tx.withColumn("risk_category",
                         F.when(F.col(key).isNotNull(), F.lit(category)))
