"""Starting, draining and awaiting streaming queries."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery

from riskflow.streaming.monitor import wait_for_end


def await_any_termination(queries: list[StreamingQuery], timeout: float | None = None):
    """Block until any of ``queries`` ends and return it; re-raise its failure, if any.

    Only the given queries count, not others of the session, and all of them
    are watched, so a failed lake writer is noticed while the alert stream
    keeps running. A listener wakes the waiter; nothing is polled. On a failure the
    others are stopped. Returns None when ``timeout`` seconds pass first.
    """
    if not queries:
        return None
    ended = wait_for_end(SparkSession.active(), queries, timeout)
    if ended is None:
        return None
    err = ended.exception()
    if err is not None:
        for other in queries:
            if other.isActive:
                other.stop()
        raise err
    return ended


def drain(query: StreamingQuery) -> StreamingQuery:
    """Wait for an ``availableNow`` query to finish and re-raise its failure."""
    query.awaitTermination()
    err = query.exception()
    if err is not None:
        raise err
    return query


def dropped_by_watermark(query: StreamingQuery) -> int:
    """Rows discarded as late by the stateful operators over the query's batches."""
    total = 0
    for p in query.recentProgress:
        for op in p.get("stateOperators", []) if isinstance(p, dict) else p.stateOperators:
            n = op.get("numRowsDroppedByWatermark", 0) if isinstance(op, dict) else op.numRowsDroppedByWatermark
            total += int(n or 0)
    return total
