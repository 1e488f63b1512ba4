"""Marks of what a stream's batches have done, in a folder that outlives the driver.

A mark is a small file, `stream/batch/name`, whose content may carry a value. It is written under another name and
moved, so it is there as a whole or not at all. Spark begins a batch only when the one before it is committed, so
marks of batches before the last one are cleared away; the folder stays small however long a stream runs.
"""

from __future__ import annotations

import uuid
from urllib.parse import quote

from pyspark.sql import SparkSession

from scoreflow.sinks.writers import Batch


class Ledger:
    """`folder` lies on any file system that Spark reaches, best beside the checkpoint of the stream."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def _path(self, *parts: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path("/".join([self.folder, *parts]))

    def _files(self, path):
        return path.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf())

    def _mark(self, batch: Batch, name: str):
        stream, number = batch
        return self._path(quote(str(stream), safe=""), str(int(number)), quote(name, safe=""))

    def done(self, batch: Batch, name: str) -> bool:
        path = self._mark(batch, name)
        return bool(self._files(path).exists(path))

    def value(self, batch: Batch, name: str) -> str | None:
        """What was written with the mark; None without one."""
        if not self.done(batch, name):
            return None
        path = self._mark(batch, name)
        stream = self._files(path).open(path)
        try:
            return str(stream.readUTF())
        finally:
            stream.close()

    def write(self, batch: Batch, name: str, value: str = "") -> None:
        path = self._mark(batch, name)
        files = self._files(path)
        if files.exists(path):
            return
        part = self._path(".parts", uuid.uuid4().hex)
        stream = files.create(part)
        stream.writeUTF(value)
        stream.close()
        files.mkdirs(path.getParent())
        if not files.rename(part, path) and not files.exists(path):
            raise OSError(f"no mark could be put at {path.toString()}")

    def forget_before(self, batch: Batch, kept: int = 1) -> None:
        """Clears the marks of a stream's batches but for the last `kept` before this one."""
        stream, number = batch
        top = self._path(quote(str(stream), safe=""))
        files = self._files(top)
        if not files.exists(top):
            return
        for entry in files.listStatus(top):
            name = entry.getPath().getName()
            if name.isdigit() and int(name) < int(number) - kept:
                files.delete(entry.getPath(), True)
