"""A log of numbered commit files, for tables whose state changes as a whole.

Commit ``n`` is the file ``<path>/<n>.json``, written under another name and then
given its own name only if no file has it: of two writers of one number
exactly one succeeds, the other gets ``CommitConflictError`` and may read the newer
state and try the next number. A reader sees a commit whole or not at all.
Commit files are small (state and folder names, never rows).
"""

from __future__ import annotations

import errno
import os
import uuid

from pyspark.sql import SparkSession


class CommitConflictError(RuntimeError):
    """Another writer has made this commit."""


class CommitLog:
    def __init__(self, spark: SparkSession, path: str):
        self.jvm = spark._jvm
        self.dir = self.path(path)
        self.conf = spark._jsparkSession.sessionState().newHadoopConf()
        self.fs = self.dir.getFileSystem(self.conf)

    def path(self, text: str):
        return self.jvm.org.apache.hadoop.fs.Path(text)

    def _file(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(self.dir, name)

    def numbers(self) -> list[int]:
        """Numbers of the commits, ascending."""
        if not self.fs.exists(self.dir):
            return []
        names = (f.getPath().getName() for f in self.fs.listStatus(self.dir))
        return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())

    def read(self, number: int) -> str:
        stream = self.fs.open(self._file(f"{number:020d}.json"))
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def latest(self) -> tuple[int | None, str | None]:
        numbers = self.numbers()
        return (numbers[-1], self.read(numbers[-1])) if numbers else (None, None)

    def commit(self, number: int, text: str) -> None:
        """Write commit ``number``; ``CommitConflictError`` if there is one."""
        self.fs.mkdirs(self.dir)
        draft, final = self._file(f".{uuid.uuid4().hex}"), self._file(f"{number:020d}.json")
        stream = self.fs.create(draft, False)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        try:
            self._name(draft, final)
        finally:
            self.fs.delete(draft, False)

    def _array_of(self, item):
        array = self.jvm.java.lang.reflect.Array.newInstance(item.getClass(), 1)
        self.jvm.java.lang.reflect.Array.set(array, 0, item)
        return array

    def _name(self, draft, final) -> None:
        if self.fs.getScheme() == "file":  # a rename replaces files there; a link never does
            try:
                os.link(draft.toUri().getPath(), final.toUri().getPath())
            except OSError as e:
                if e.errno == errno.EEXIST:
                    raise CommitConflictError(final.toString()) from None
                raise
            return
        context = self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(final.toUri(), self.conf)
        none = self.jvm.org.apache.hadoop.fs.Options.Rename.NONE
        options = self._array_of(none)
        try:
            context.rename(draft, final, options)
        except Exception as e:
            if self.fs.exists(final) and self.fs.exists(draft):
                raise CommitConflictError(final.toString()) from e
            raise
