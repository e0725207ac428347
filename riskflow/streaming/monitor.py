"""Supervision of streaming queries by events: a listener that wakes waiters and keeps a table of progress.

``wait_for_end`` sleeps until the session's listener bus reports the end of one of
its queries. ``QueryMonitor`` also writes every progress report and every end as a row of
a parquet table; its writer thread sleeps on a queue, and what came in while it
wrote goes into the next file together.
"""

from __future__ import annotations

import contextlib
import datetime as dt
import queue
import threading
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener

EVENT_SCHEMA = ("event string, id string, run_id string, name string, at timestamp, batch_id bigint, input_rows bigint, "
                "duration_ms bigint, watermark string, state_rows bigint, dropped_rows bigint, error string")
RECHECK_SECONDS = 60.0  # a listener bus under heavy load may drop events


class _Ends(StreamingQueryListener):
    """Sets an event whenever a query of the session ends."""

    def __init__(self):
        self.woken = threading.Event()

    def onQueryStarted(self, event):
        pass

    def onQueryProgress(self, event):
        pass

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        self.woken.set()


@contextlib.contextmanager
def _listening(spark: SparkSession, listener: StreamingQueryListener):
    spark.streams.addListener(listener)
    try:
        yield listener
    finally:
        spark.streams.removeListener(listener)


def wait_for_end(spark: SparkSession, queries: list[StreamingQuery], timeout: float | None = None) -> StreamingQuery | None:
    """The first of ``queries`` (in their order) found ended; None after ``timeout`` seconds."""
    deadline = None if timeout is None else time.monotonic() + timeout
    with _listening(spark, _Ends()) as ends:
        while True:
            ends.woken.clear()
            for q in queries:  # after the listener is there: no end is missed
                if not q.isActive:
                    return q
            left = RECHECK_SECONDS if deadline is None else min(RECHECK_SECONDS, deadline - time.monotonic())
            if left <= 0:
                return None
            ends.woken.wait(left)


class QueryMonitor(StreamingQueryListener):
    """Progress and ends of the session's streaming queries as a table at ``path``.

    Use as a context manager around the queries' life; the table is complete when
    the block ends.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        self._rows: queue.SimpleQueue = queue.SimpleQueue()
        self._writer = threading.Thread(target=self._write, name="query-monitor", daemon=True)

    def onQueryStarted(self, event):
        self._put("started", event.id, event.runId, event.name)

    def onQueryProgress(self, event):
        p = event.progress
        self._put("progress", p.id, p.runId, p.name, batch_id=p.batchId, input_rows=p.numInputRows,
                  duration_ms=p.durationMs.get("triggerExecution"), watermark=p.eventTime.get("watermark"),
                  state_rows=sum(s.numRowsTotal for s in p.stateOperators),
                  dropped_rows=sum(s.numRowsDroppedByWatermark for s in p.stateOperators))

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        self._put("ended", event.id, event.runId, None, error=event.exception)

    def _put(self, event, query_id, run_id, name, **kw):
        row = {"event": event, "id": str(query_id), "run_id": str(run_id), "name": name, "at": dt.datetime.now(dt.timezone.utc), **kw}
        self._rows.put(tuple(row.get(c.split()[0]) for c in EVENT_SCHEMA.split(", ")))

    def _write(self):
        going = True
        while going:
            some = [self._rows.get()]
            while not self._rows.empty():
                some.append(self._rows.get())
            going = None not in some
            some = [r for r in some if r is not None]
            if some:
                self.spark.createDataFrame(some, EVENT_SCHEMA).coalesce(1).write.mode("append").parquet(self.path)

    def __enter__(self):
        self._writer.start()
        self.spark.streams.addListener(self)
        return self

    def __exit__(self, *exc):
        # events of ended queries may still be on their way through the bus
        self.spark._jsparkSession.sparkContext().listenerBus().waitUntilEmpty()
        self.spark.streams.removeListener(self)
        self._rows.put(None)
        self._writer.join()

    def table(self) -> DataFrame:
        return self.spark.read.schema(EVENT_SCHEMA).parquet(self.path)
