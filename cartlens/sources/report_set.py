"""A set of reports that appears at once.

Every run writes its reports under a version folder of its own; when all of them
are there, one small file, the pointer, is replaced by renaming, which the file
system does as one step. Readers follow the pointer, so they see the set of one
run, whole, whatever a later run is doing or has left behind.
"""

from __future__ import annotations

import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from .files import read_report

POINTER, VERSIONS = "current", "versions"


class ReportSet:
    """The report versions under ``root`` (any Hadoop URI)."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        hadoop = spark._jvm.org.apache.hadoop.fs
        self._path = hadoop.Path
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()
        self._fs = self._path(self.root).getFileSystem(self._conf)
        qualified = self._fs.makeQualified(self._path(self.root))
        self._files = hadoop.FileContext.getFileContext(qualified.toUri(), self._conf)
        self._options = getattr(hadoop, "Options$Rename")

    def begin(self) -> str:
        """The folder of a new version; nobody reads it before it is published."""
        return f"{self.root}/{VERSIONS}/{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"

    def publish(self, version: str) -> None:
        """Make ``version``, a folder given by ``begin``, the set that readers see."""
        if not self._fs.exists(self._path(version)):
            raise ValueError(f"nothing was written to {version}")
        draft = self._path(f"{self.root}/.{POINTER}-{uuid.uuid4().hex}")
        out = self._fs.create(draft, True)
        out.write(version.rsplit("/", 1)[1].encode())
        out.close()
        overwrite = self.spark.sparkContext._gateway.new_array(self._options, 1)
        overwrite[0] = self._options.OVERWRITE
        self._files.rename(draft, self._path(f"{self.root}/{POINTER}"), overwrite)

    def current(self) -> str | None:
        """The folder of the published version; None before the first one."""
        where = self._path(f"{self.root}/{POINTER}")
        if not self._fs.exists(where):
            return None
        name = self.spark.read.text(f"{self.root}/{POINTER}").first()["value"]
        return f"{self.root}/{VERSIONS}/{name}"

    def versions(self) -> list[str]:
        """The names of all version folders, oldest first, published or not."""
        where = self._path(f"{self.root}/{VERSIONS}")
        if not self._fs.exists(where):
            return []
        return sorted(s.getPath().getName() for s in self._fs.listStatus(where))

    def read(self, name: str, schema: T.StructType, fmt: str = "csv") -> DataFrame:
        """A report of the published version."""
        version = self.current()
        if version is None:
            raise ValueError(f"no report set was published under {self.root}")
        return read_report(self.spark, f"{version}/{name}", schema, fmt)

    def prune(self, keep: int = 2) -> list[str]:
        """Delete older versions, published or left unfinished, but for the newest
        ``keep`` and the published one. Not while another run writes."""
        current = self.current()
        old = [v for v in self.versions()[:-keep or None] if not current or not current.endswith("/" + v)]
        for name in old:
            self._fs.delete(self._path(f"{self.root}/{VERSIONS}/{name}"), True)
        return old
