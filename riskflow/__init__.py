"""riskflow: transaction-risk analytics on Spark DataFrames and Structured Streaming.

Layout
------
- ``sources``   readers: Kafka envelope decode, bronze ingest, fixtures, CDC log
- ``functions`` column expressions (wire formats, alert text, fingerprints)
- ``operators`` DataFrame -> DataFrame transforms (validate, enrich, risk,
                messages, schema contracts, lineage, CDC fold, size estimate)
- ``sinks``     Kafka / parquet lake / per-batch alert writers
- ``streaming`` replay sources, query start/await helpers
- ``plans``     end-to-end risk flow and the named query catalog

Every transform is free of I/O and works unchanged on batch and streaming
DataFrames, so the same plan is checked in batch against an SQL oracle and run
as a stream in production.
"""

from riskflow.config import RiskParams

__all__ = ["RiskParams"]
