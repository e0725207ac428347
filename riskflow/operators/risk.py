"""Windowed per-user risk aggregation (the flagship operator).

Plan shape (batch and stream alike): Project(user_id, amount, timestamp) ->
HashAggregate(partial) -> Exchange hashpartitioning(window, user_id) ->
HashAggregate(final) [-> state store when streaming] -> Filter. The partial
aggregate collapses each (window, user) group inside every map task before the
shuffle, so a user holding a third of all rows still ships one row per map task
and window: the hot key cannot overload one reducer.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskflow.config import RiskParams
from riskflow.schemas import AMOUNT_SUM_TYPE


def window_totals(tx: DataFrame, params: RiskParams = RiskParams(),
                  time_col: str = "timestamp") -> DataFrame:
    """Row count and decimal amount sum per (tumbling window, user).

    Rows with a NULL event time fall in no window and are dropped (as Spark's
    ``window`` does). Output: ``window struct<start,end>, user_id, tx_count,
    total_amount DECIMAL(20,2)``.
    """
    return (
        tx.groupBy(F.window(F.col(time_col), params.window_duration).alias("window"),
                   F.col("user_id"))
        .agg(
            F.count(F.lit(1)).alias("tx_count"),
            F.sum("amount").cast(AMOUNT_SUM_TYPE).alias("total_amount"),
        )
    )


def risk_predicate(params: RiskParams = RiskParams()):
    """Strict ``>`` on both measures, joined with OR; the amount test is exact."""
    return ((F.col("tx_count") > F.lit(params.tx_count_threshold))
            | (F.col("total_amount") > F.lit(params.amount_threshold)))


def detect_high_risk(tx: DataFrame, params: RiskParams = RiskParams(),
                     time_col: str = "timestamp") -> DataFrame:
    """(window, user) groups whose count or amount passes the thresholds."""
    return window_totals(tx, params, time_col).where(risk_predicate(params))
