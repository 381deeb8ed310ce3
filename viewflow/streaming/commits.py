"""Folders that appear whole and once: written aside by an attempt of their own, put in place by one rename."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

# Hidden from readers, as all folders that begin with an underscore are.
ATTEMPTS = "_attempts"


class Folders:
    """The file system of a path."""

    def __init__(self, spark: SparkSession, path: str):
        jvm = spark.sparkContext._jvm
        self._fs = jvm.org.apache.hadoop.fs
        conf = spark.sparkContext._jsc.hadoopConfiguration()
        self._files = self._path(path).getFileSystem(conf)
        uri = self._files.makeQualified(self._path(path)).toUri()
        self._context = self._fs.FileContext.getFileContext(uri, conf)
        self._no_options = spark.sparkContext._gateway.new_array(getattr(self._fs, "Options$Rename"), 0)

    def _path(self, path: str):
        return self._fs.Path(path)

    def exists(self, path: str) -> bool:
        return self._files.exists(self._path(path))

    def delete(self, path: str) -> None:
        self._files.delete(self._path(path), True)

    def names(self, path: str) -> list[str]:
        return [s.getPath().getName() for s in self._files.listStatus(self._path(path))] if self.exists(path) else []

    def moved(self, source: str, target: str) -> bool:
        """Rename a folder; false if the target is there already, which then stays as it is."""
        try:
            self._context.rename(self._path(source), self._path(target), self._no_options)
        except Py4JJavaError:
            # Another attempt was faster, and may have cleared this one away.
            if not self.exists(target):
                raise
            return False
        return True


def commit_once(
    spark: SparkSession, path: str, name: str, write: Callable[[str], None], again: bool = False
) -> bool:
    """Let ``write`` fill a folder and put it in place as ``path/name``; whether this attempt did so.

    A folder in place stays as it is, for readers that have seen it, and nothing is written; with ``again`` it is
    replaced. Readers see all of an attempt or nothing. What broken attempts left of this folder is deleted.
    Needs a file system that renames a folder in one step, as HDFS and local disks do.
    """
    folders = Folders(spark, path)
    aside, place = f"{path}/{ATTEMPTS}", f"{path}/{name}"
    done = folders.exists(place) and not again
    if not done:
        attempt = f"{aside}/{name}-{uuid.uuid4().hex}"
        write(attempt)
        if again and folders.exists(place):
            folders.moved(place, f"{aside}/{name}-{uuid.uuid4().hex}")
        done = not folders.moved(attempt, place)
    for left in folders.names(aside):
        if left.startswith(f"{name}-"):
            folders.delete(f"{aside}/{left}")
    return not done
