"""A schema catalog that several writers register in at once.

The catalog is a table of folders named by a commit log (``sinks.commits``). A writer reads
the newest commit, numbers its definitions after it, writes them as a folder of their own
and commits the next number. Where another writer has taken that number, it starts
again from the newer catalog: automatic versions are numbered anew, and an explicit
version that the other one has registered is refused as a duplicate. So no two
definitions get the same version and none is lost, without a lock.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession

from riskflow.operators.contracts import number_versions
from riskflow.sinks.commits import CommitConflictError, CommitLog

CATALOG_SCHEMA = "topic string, version int, definition string, created_at timestamp"
MOST_FOLDERS = 32  # folders of a commit before they are written as one


class SchemaRegistry:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path, self.log = spark, path, CommitLog(spark, f"{path}/_commits")

    def _state(self) -> tuple[int, list[str]]:
        number, text = self.log.latest()
        return (-1, []) if number is None else (number, json.loads(text)["folders"])

    def _read(self, folders: list[str]) -> DataFrame:
        if not folders:
            return self.spark.createDataFrame([], CATALOG_SCHEMA)
        return self.spark.read.schema(CATALOG_SCHEMA).parquet(*(f"{self.path}/{f}" for f in folders))

    def _write(self, rows: DataFrame) -> str:
        folder = f"rows-{uuid.uuid4().hex}"
        rows.write.parquet(f"{self.path}/{folder}")
        return folder

    def catalog(self) -> DataFrame:
        """``(topic, version, definition, created_at)`` as of the newest commit."""
        return self._read(self._state()[1])

    def register(self, new: DataFrame, order_col: str | None = None) -> DataFrame:
        """Register ``new`` (topic, version or NULL, definition) as one commit; returns its rows with their versions.

        ``DuplicateVersionError`` refuses the whole batch. Each lost race means that
        another writer has registered something, so some writer always gets on.
        """
        new = new.checkpoint()  # the same rows in every attempt
        while True:
            number, folders = self._state()
            known = self._read(folders)
            mine = self._write(number_versions(known, new, order_col))
            after = [*folders, mine]
            if len(after) > MOST_FOLDERS:
                after = [self._write(self._read(after))]
            try:
                self.log.commit(number + 1, json.dumps({"folders": after}))
                return self._read([mine])
            except CommitConflictError:
                for folder in {mine, after[-1]}:
                    self.log.fs.delete(self.log.path(f"{self.path}/{folder}"), True)
