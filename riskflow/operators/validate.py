"""Parse, watermark, validate, audit and de-duplicate transactions.

All of it is row-local (Generate/Project/Filter, no shuffle) except
de-duplication. ``from_json`` runs in the JVM; only the columns of the declared
schema are materialised.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from riskflow.config import RiskParams
from riskflow.schemas import TRANSACTION_SCHEMA

# --- fixed values: rejection reasons, in check order ------------------------
REASON_UNPARSABLE = "unparsable"
REASON_MISSING_AMOUNT = "missing_amount"
REASON_NEGATIVE_AMOUNT = "negative_amount"
REASON_MISSING_TRANSACTION_ID = "missing_transaction_id"
REASON_MISSING_USER_ID = "missing_user_id"
REASON_MISSING_TIMESTAMP = "missing_timestamp"
# ---------------------------------------------------------------------------


def parse_transactions(raw: DataFrame, schema: StructType = TRANSACTION_SCHEMA,
                       value_col: str = "value", keep: tuple[str, ...] = ()) -> DataFrame:
    """JSON ``value`` (string or binary) -> the schema's columns.

    PERMISSIVE: malformed text, ``{}`` and arrays give all-NULL fields; a NULL
    value gives NULL fields. ``keep`` passes envelope columns through.
    """
    return raw.select(*keep, flatten_parsed(F.from_json(F.col(value_col).cast("string"), schema)))


def flatten_parsed(struct_col: Column) -> Column:
    """Spread a parsed struct into columns through a one-row generator.

    With ``select("data.*")`` the optimizer pushes later filters on the fields
    below the parse and rewrites each into its own ``from_json`` (one JSON
    scan per predicate, plus the real one). A filter on generator output is
    not pushed below the generator, so the JSON is parsed exactly once per
    row; a NULL struct still gives one row of NULLs.
    """
    return F.inline(F.array(struct_col))


def with_event_time_watermark(tx: DataFrame, params: RiskParams = RiskParams(),
                              time_col: str = "timestamp") -> DataFrame:
    """Event-time watermark (a no-op in batch). Needs a TIMESTAMP column."""
    return tx.withWatermark(time_col, params.watermark_duration)


def is_valid(require_timestamp: bool = False) -> Column:
    """``amount >= 0`` (drops negative and NULL) and both ids present."""
    cond = ((F.col("amount") >= 0)
            & F.col("transaction_id").isNotNull()
            & F.col("user_id").isNotNull())
    if require_timestamp:
        cond = cond & F.col("timestamp").isNotNull()
    return F.coalesce(cond, F.lit(False))


def validate_transactions(tx: DataFrame, require_timestamp: bool = False) -> DataFrame:
    """Keep valid rows. Filters are row-local; Spark moves them below a
    watermark when they do not read the event-time column, so a rejected row
    never advances the watermark."""
    return tx.where(is_valid(require_timestamp))


def rejection_reason(require_timestamp: bool = False) -> Column:
    """First failing check, or NULL for a valid row."""
    all_null = (F.col("transaction_id").isNull() & F.col("user_id").isNull()
                & F.col("amount").isNull() & F.col("timestamp").isNull())
    reason = (
        F.when(all_null, F.lit(REASON_UNPARSABLE))
        .when(F.col("amount").isNull(), F.lit(REASON_MISSING_AMOUNT))
        .when(F.col("amount") < 0, F.lit(REASON_NEGATIVE_AMOUNT))
        .when(F.col("transaction_id").isNull(), F.lit(REASON_MISSING_TRANSACTION_ID))
        .when(F.col("user_id").isNull(), F.lit(REASON_MISSING_USER_ID))
    )
    if require_timestamp:
        reason = reason.when(F.col("timestamp").isNull(), F.lit(REASON_MISSING_TIMESTAMP))
    return reason


def rejected_transactions(tx: DataFrame, require_timestamp: bool = False) -> DataFrame:
    """Complement of ``validate_transactions`` with a ``reason`` column."""
    return (tx.withColumn("reason", rejection_reason(require_timestamp))
            .where(F.col("reason").isNotNull()))


def dedup_transactions(tx: DataFrame, key: str = "transaction_id") -> DataFrame:
    """Drop repeated deliveries of the same transaction id.

    Streaming: ``dropDuplicatesWithinWatermark`` keeps state only until the
    watermark passes, so it stays bounded; the first delivery to arrive stays.
    Batch: the delivery with the earliest timestamp (nulls last), then the least
    of the other columns in their order, so that runs agree where copies
    differ; combined on the map side, and shuffled on the high-cardinality id.
    """
    if tx.isStreaming:
        return tx.dropDuplicatesWithinWatermark([key])
    others = [c for c in tx.columns if c != key]
    first = [F.col("timestamp").isNull().alias("_late"), "timestamp"] if "timestamp" in others else []
    row = F.struct(*first, *[c for c in others if c != "timestamp"])
    return tx.groupBy(key).agg(F.min(row).alias("_row")).select(*[key if c == key else F.col(f"_row.{c}") for c in tx.columns])


def distinct_users(tx: DataFrame) -> DataFrame:
    """Distinct user ids (partial aggregation before the shuffle)."""
    return tx.select("user_id").distinct()
