"""Tables that appear at once: written aside, then put in place by renaming.

A write that breaks off leaves the old table as it was. Should the process end
between the two renames, the next reader or writer puts the old table back. On
stores without a rename (object stores) use a table format instead.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import SparkSession


class _Folder:
    """A folder on whatever file system Spark knows for its path."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self._path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        self.place = self._path(path.rstrip("/"))
        self.store = self.place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        self.name, parent = self.place.getName(), self.place.getParent()
        if parent is None:
            raise ValueError(f"{path} has no folder around it")
        self.parent = parent

    def beside(self, kind: str) -> object:
        """A fresh name that Spark's readers pass over."""
        return self._path(self.parent, f"_{kind}-{self.name}-{uuid.uuid4().hex}")

    def exists(self) -> bool:
        return self.store.exists(self.place)

    def settle(self) -> None:
        """Put back a table that was moved aside and whose successor never came."""
        if self.exists() or not self.store.exists(self.parent):
            return
        aside = [f.getPath() for f in self.store.listStatus(self.parent) if f.getPath().getName().startswith(f"_old-{self.name}-")]
        if aside:
            self.store.rename(aside[0], self.place)

    def replace(self, staged: object) -> None:
        self.settle()
        old = self.beside("old")
        self.store.mkdirs(self.parent)
        if self.exists() and not self.store.rename(self.place, old):
            raise OSError(f"cannot move {self.place.toString()} aside")
        if not self.store.rename(staged, self.place):
            raise OSError(f"cannot put {self.place.toString()} in place")
        self.store.delete(old, True)


def exists(spark: SparkSession, path: str) -> bool:
    folder = _Folder(spark, path)
    folder.settle()
    return folder.exists()


def publish(spark: SparkSession, path: str, write: Callable[[str], None], per_partition: bool = False) -> None:
    """Let `write` fill a folder beside `path`, and put it in place once it is whole.

    With `per_partition` the first-level folders of what was written (one per
    partition value) are put in place one by one, and others stay.
    """
    folder = _Folder(spark, path)
    staged = folder.beside("staged")
    try:
        write(staged.toString())
        if not per_partition:
            folder.replace(staged)
            return
        for found in folder.store.listStatus(staged):
            name = found.getPath().getName()
            if found.isDirectory() and "=" in name:
                _Folder(spark, f"{path.rstrip('/')}/{name}").replace(found.getPath())
    finally:
        folder.store.delete(staged, True)
