"""Tables that are replaced in place: a directory of versions, and a pointer that is switched last.

A version is written whole in a directory of its own. Only then does the file ``_current`` name it, put in place by
one rename (or, on an object store, one object). A job that fails at any point before leaves the old version named
and readable; what it had written is not named and is dropped by the next successful write.

One writer at a time. Readers need no lock: the version they planned on stays until the write after the next.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

POINTER = "_current"
_VERSION = "version-"


class Versions:
    """The versions under one path."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path.rstrip("/")
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._files = self._path(self.path).getFileSystem(spark._jsc.hadoopConfiguration())

    def _at(self, name: str):
        return self._path(f"{self.path}/{name}")

    def current(self) -> str | None:
        """The path of the current version, None without one."""
        if not self._files.exists(self._at(POINTER)):
            return None
        stream = self._files.open(self._at(POINTER))
        try:
            name = bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()
        return f"{self.path}/{name}"

    def _point(self, name: str) -> None:
        ready = self._at(f"{POINTER}-{uuid.uuid4().hex}")
        stream = self._files.create(ready)
        try:
            stream.write(name.encode())
        finally:
            stream.close()
        self._rename(ready, self._at(POINTER))

    def _rename(self, source, target) -> None:
        """Replace a file by another in one step."""
        jvm = self.spark._jvm
        options = self.spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
        options[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._files.getUri(), self.spark._jsc.hadoopConfiguration())
        context.rename(context.makeQualified(source), context.makeQualified(target), options)

    def replace(self, write: Callable[[str], None]) -> str:
        """Let ``write`` fill the path of a new version, make it the current one, and return its path.

        The version before stays for those who read it; older and unfinished ones are deleted.
        """
        before = self.current()
        name = f"{_VERSION}{uuid.uuid4().hex}"
        write(f"{self.path}/{name}")
        self._point(name)
        wanted = {name, before.rsplit("/", 1)[-1] if before else name}
        for status in self._files.listStatus(self._path(self.path)):
            found = status.getPath().getName()
            if found.startswith((_VERSION, f"{POINTER}-")) and found not in wanted:
                self._files.delete(status.getPath(), True)
        return f"{self.path}/{name}"


def read_current(spark: SparkSession, path: str) -> DataFrame | None:
    """The current version of a table of text columns, None without one."""
    current = Versions(spark, path).current()
    return None if current is None else spark.read.option("header", "true").csv(current)


def replace_current(table: DataFrame, path: str) -> str:
    """Write a table as the current version of a path, which the table itself may have been read from."""
    return Versions(table.sparkSession, path).replace(lambda to: table.write.option("header", "true").csv(to))
