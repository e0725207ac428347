"""Sources: Kafka envelope, bronze ingest, CDC change log, driver-table fixtures."""
